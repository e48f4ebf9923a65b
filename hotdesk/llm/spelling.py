"""Spelling variants: a variable-length gram index finds words one edit apart.

Words are counted over the whole corpus. A word is closed to a ring by a mark, so that an
edit anywhere leaves grams of full length on its other side. The gram dictionary holds the
frequent grams: those of 2 to 5 signs that stand in more than ``positions / ENTRIES`` places
(so it holds at most ``ENTRIES`` of each length, whatever the corpus, and can be sent to the
tasks). At each place of a ring the word's gram is the shortest one that the dictionary has
not, so a gram is rare or five signs long, and its signs alone decide how far it reaches.

An edit at a place affects the grams that cover it. The most that any place has is the word's
bound: a word shares all its grams but so many with each word near it, and of its rarest
``bound + 1`` grams, in an order that all words agree on, at least one. Only these lists are
merged. A list is that of a gram, at its place in words of one length; words one sign apart
in length ask the list at both places where their shared gram can stand. Pairs of a list are
verified by their exact distance.

Lists of more than ``LIST`` entries are not opened: their words take another exact way, by
each of their places as a wildcard. Words that agree but for one sign are at most as many as
there are signs, so those lists stay short.

Near words lead to forms, and forms to roots by doubling their reach, in rounds of joins.

Defined results: NULL or empty texts have no words; a NULL id counts as empty text in the
hash; repeated rows count as often as they stand there; equal counts go to the smallest word;
an empty table gives no rows. Words are never cut, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.llm.batches import in_batches
from hotdesk.llm.tables import stored

LETTERS = r"[A-Za-zÀ-ÿ]+"
MARK = "$"
SHORTEST, LONGEST = 2, 5
#: Frequent grams of one length that the dictionary may hold, and the least places of a frequent gram.
ENTRIES, FREQUENT = 100_000, 16
LIST = 64
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An edit may leave no gram of a shorter word whole.
LEAST = LONGEST


def runs(documents: DataFrame, doc_id: str, text: str, every: int) -> DataFrame:
    """One row per run of letters (``word``), one in ``every`` damaged by a hash of its document and itself."""
    found = documents.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(text, CAPITALS, SMALL), F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    if not every:
        return found.select(F.col("run").alias("word"))
    hashed = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def words(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = 3,
    length: int = LEAST,
    every: int = 0,
) -> DataFrame:
    """Words of at least ``length`` signs that stand in at least ``least`` places: word, n."""
    if length < LEAST:
        raise ValueError(f"words of fewer than {LEAST} signs have no bound")
    return (
        runs(documents, doc_id, text, every)
        .where(F.length("word") >= length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
    )


# ---- the index ---------------------------------------------------------------------


def _ring(word: Column) -> Column:
    return F.concat(word, F.lit(MARK), F.substring(word, 1, LONGEST))


def dictionary(vocabulary: DataFrame) -> dict[str, int]:
    """The frequent grams and in how many places they stand; at most ``ENTRIES`` of each length."""
    positions = vocabulary.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    rare = max(FREQUENT, -(-positions // ENTRIES))
    ring = _ring(F.col("word"))
    every = F.concat(
        *[
            F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda p, n=n: F.substring(ring, p, F.lit(n)))
            for n in range(SHORTEST, LONGEST + 1)
        ]
    )
    counted = vocabulary.select(F.explode(every).alias("gram")).groupBy("gram").count().where(F.col("count") > rare)
    return {row.gram: row["count"] for row in counted.toLocalIterator()}


def decomposed(word: str, frequent: dict[str, int]) -> list[str]:
    """The gram at each place of the word's ring: the shortest that is not frequent, or the longest."""
    ring, grams = word + MARK + word[:LONGEST], []
    for place in range(len(word) + 1):
        end = place + SHORTEST
        while end < place + LONGEST and ring[place:end] in frequent:
            end += 1
        grams.append(ring[place:end])
    return grams


def bound(grams: list[str]) -> int:
    """The most grams that one edit can affect: those that cover one place of the ring."""
    size, covers = len(grams), [0] * (2 * len(grams))
    for place, gram in enumerate(grams):
        for at in range(place, place + len(gram)):
            covers[at % size] += 1
    return max(covers)


def probed(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """The rarest grams, one more than an edit can affect, with their places."""
    grams = decomposed(word, frequent)
    order = sorted(range(len(grams)), key=lambda p: (frequent.get(grams[p], 0), grams[p], p))
    return [(p, grams[p]) for p in order[: bound(grams) + 1]]


def _entries(vocabulary: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(list, word, asks): the lists a word stands in, and those it asks, being one sign shorter."""
    held = vocabulary.sparkSession.sparkContext.broadcast(frequent)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        for batch in batches:
            for word in batch.column(0).to_pylist():
                size = len(word)
                for place, gram in probed(word, held.value):
                    yield len(word), (f"{gram}{place},{size}", word, False)
                    yield len(word), (f"{gram}{place},{size + 1}", word, True)
                    yield len(word), (f"{gram}{place + 1},{size + 1}", word, True)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(schema, rows(batches))

    schema = pa.schema([("list", pa.string()), ("word", pa.string()), ("asks", pa.bool_())])
    return vocabulary.select("word").mapInArrow(index, "list string, word string, asks boolean")


def _wildcards(vocabulary: DataFrame) -> DataFrame:
    """(list, word, asks): every place of a word as a wildcard; a shorter word asks with one put in."""
    word, size = F.col("word"), F.length("word")

    def at(place: Column, skipped: int) -> Column:
        return F.concat(F.substring(word, F.lit(1), place), F.lit("?"), F.substring(word, place + 1 + skipped, size))

    own = F.transform(F.sequence(F.lit(0), size - 1), lambda p: at(p, 1))
    other = F.transform(F.sequence(F.lit(0), size), lambda p: at(p, 0))
    return vocabulary.select(F.explode(own).alias("list"), "word", F.lit(False).alias("asks")).unionByName(
        vocabulary.select(F.explode(F.array_distinct(other)).alias("list"), "word", F.lit(True).alias("asks"))
    )


def _opened(entries: DataFrame) -> DataFrame:
    """Pairs (a, b) of the words of each list that are one edit apart, each in one order."""
    lists = entries.groupBy("list").agg(
        F.collect_list(F.when(~F.col("asks"), F.col("word"))).alias("own"),
        F.collect_list(F.when(F.col("asks"), F.col("word"))).alias("asking"),
    )
    # Words of one length are compared once, the smaller with the larger.
    pairs = lists.where(F.size("own") > 0).select(
        "own", F.explode(F.concat("own", "asking")).alias("a")
    )
    pairs = pairs.select("a", F.explode("own").alias("b")).where(
        (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    )
    return pairs.where(F.levenshtein("a", "b", 1) == 1)


def near(vocabulary: DataFrame) -> DataFrame:
    """All pairs of words one edit apart, each in one order: a, b. ``vocabulary`` has distinct words."""
    vocabulary = vocabulary.select("word")
    entries = stored(_entries(vocabulary, dictionary(vocabulary)), "grams")
    sizes = entries.groupBy("list").agg(F.count("*").alias("size"), F.bool_or(~F.col("asks")).alias("held"))
    sizes = sizes.where("held AND size > 1").select("list", "size")
    sized = stored(entries.join(sizes, "list"), "lists")
    short = _opened(sized.where(F.col("size") <= LIST).drop("size"))
    crowded = sized.where(F.col("size") > LIST).select("word").distinct()
    return short.unionByName(_opened(_wildcards(crowded))).distinct()


# ---- forms and roots ------------------------------------------------------------------


def variants(vocabulary: DataFrame, ratio: int = 2) -> DataFrame:
    """Each word's form, the most frequent near word that stands at least ``ratio`` times as often.

    ``vocabulary`` has distinct words and their counts (word, n). Returns word, form, root (where
    forms lead in the end), n, n_near and form_n.
    """
    vocabulary = stored(vocabulary.select("word", "n"), "words")
    pairs = near(vocabulary)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = (
        both.join(counts, "b")
        .groupBy(F.col("a").alias("word"))
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("least"), F.col("b"))).alias("best"))
    )
    taken = -F.col("best.least") >= ratio * F.col("n")
    rows = stored(
        vocabulary.join(best, "word", "left").select(
            "word",
            F.when(taken, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, -F.col("best.least")).alias("form_n"),
        ),
        "forms",
    )
    # Counts grow along forms, so there is no circle, and chains are short.
    reach = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reach = stored(
            reach.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if reach.where("moved").isEmpty():
            break
        reach = reach.drop("moved")
    return rows.join(reach.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def digest(documents: DataFrame) -> DataFrame:
    """Variants among the words of whole texts, one run in 97 of which has lost a sign."""
    return variants(words(documents, every=97))
