"""Language of a text by prediction by partial matching.

For every language a tree of byte contexts up to ``ORDER`` bytes long holds how often each
byte followed. A byte costs ``-log2`` of its share in the longest known context; a context
that never saw it charges an escape (its number of different bytes over its total plus
that number) and hands over to the next shorter one, at last to equal shares of all bytes. The
language in which the text's code is shortest is predicted.

The counts are frozen after training, so a byte's cost depends on it and the ``ORDER`` bytes
before it alone: costs are tables, and scoring sums table entries over every byte of a text.

Training takes at most ``SAMPLE`` texts of a language, chosen by a hash of the id among the
labelled texts that are not held out. Every label is learned, in blocks of about ``LANGUAGES``:
each text is scored against all blocks, and the shortest code of all blocks predicts.

Defined results: ``und`` with score 0 for NULL, for texts without a letter and when nothing
was learned; a NULL id is neither held out nor learned from; repeated rows are rows of their
own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hotdesk.llm.tables import stored
from hotdesk.llm.words import portions

ORDER = 3
SAMPLE, LANGUAGES = 300, 64
#: Bytes that are scored at a time.
BLOCK = 1 << 19
#: The byte that is taken to stand before a text.
BEFORE = 0x20
UNKNOWN = "und"


def remainder(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each after ``ORDER`` filling bytes, and where each text begins."""
    pad = bytes([BEFORE]) * ORDER
    sizes = np.array([0, *(len(t) + ORDER for t in texts)])
    joined = pad.join([b"", *texts]) if texts else b""
    return np.frombuffer(joined, np.uint8), np.cumsum(sizes)[:-1] + ORDER


def counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, text) to rows (lang, size, gram, n): how often each run of up to ``ORDER + 1`` bytes occurs."""

    def work(table: pa.Table) -> pa.Table:
        data, begins = _padded([t.as_py().encode() for t in table.column("text")])
        real = np.ones(len(data), bool)
        for i in range(1, ORDER + 1):
            real[begins - i] = False
        at, columns = np.flatnonzero(real), {"lang": [], "size": [], "gram": [], "n": []}
        for size in range(1, ORDER + 2):
            code = np.zeros(len(at), np.int64)
            for back in range(size - 1, -1, -1):
                code = code * 256 + data[at - back]
            grams, n = np.unique(code, return_counts=True)
            columns["gram"].append(grams)
            columns["n"].append(n.astype(np.int64))
            columns["size"].append(np.full(len(n), size, np.int64))
        rows = {name: np.concatenate(parts) for name, parts in columns.items() if parts}
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(rows["n"]), pa.string()), **rows})

    return docs.groupBy("lang").applyInArrow(work, "lang string, size long, gram long, n long")


def sample(docs: DataFrame, chosen: Column) -> DataFrame:
    """Rows (lang, text) to learn from; at most ``SAMPLE`` of each language."""
    rows = docs.where(chosen & F.col("lang").isNotNull() & F.col("text").isNotNull()).where("text <> ''")
    keys = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"))
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id")
    taken = keys.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= SAMPLE)
    taken = taken.select("lang", "doc_id").distinct()
    # At most SAMPLE small rows of a language, whatever the table's size.
    texts = rows.select("lang", "doc_id", "text").join(F.broadcast(taken), ["lang", "doc_id"], "left_semi")
    return texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))


class Model:
    """Code lengths of bytes after their contexts, a column per language."""

    def __init__(self, learned: list[tuple[str, int, int, int]], seen: list[int] | None = None):
        """``learned``: rows (lang, size, gram, n). ``seen``: the bytes that any language saw, if more than these."""
        self.languages = sorted({row[0] for row in learned})
        width = len(self.languages)
        column = {name: i for i, name in enumerate(self.languages)}
        lang = np.array([column[row[0]] for row in learned], np.int64)
        size, gram, n = (np.array([row[i] for row in learned], np.int64) for i in (1, 2, 3))
        letters = np.unique(gram[size == 1] if seen is None else np.array(seen, np.int64))
        # Bytes that no language saw share the last symbol.
        self.symbols = len(letters) + 1
        self.symbol = np.full(256, len(letters), np.int64)
        self.symbol[letters] = np.arange(len(letters))
        self.contexts: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.escapes: list[np.ndarray] = []
        self.grams: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        lower = np.full((self.symbols, width), np.log2(self.symbols))
        self.uniform = lower.astype(np.float32)
        for order in range(ORDER + 1):
            own = size == order + 1
            code = self._code(gram[own], order + 1)
            context = code // self.symbols
            contexts = np.unique(context)
            grams, row = np.unique(code, return_inverse=True)
            found = np.zeros((len(grams), width))
            found[row, lang[own]] = n[own]
            at = np.searchsorted(contexts, grams // self.symbols)
            total = np.zeros((len(contexts), width))
            kinds = np.zeros((len(contexts), width))
            np.add.at(total, at, found)
            np.add.at(kinds, at, found > 0)
            whole = total + kinds
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(whole > 0, -np.log2(kinds / whole), 0.0)
                seen = -np.log2(found / whole[at])
            shorter = self._shorter(grams, order)
            self.contexts.append(contexts)
            self.escapes.append(escape.astype(np.float32))
            self.grams.append(grams)
            self.costs.append(np.where(found > 0, seen, escape[at] + shorter).astype(np.float32))
        # Where a known context's grams lie, by its rank: symbol -> row of costs, or none.
        self.maps = []
        for order in range(ORDER + 1):
            contexts, grams = self.contexts[order + 1], self.grams[order]
            table = np.zeros(len(contexts) * self.symbols, np.int32)
            rank = np.searchsorted(contexts, grams // self.symbols)
            table[rank * self.symbols + grams % self.symbols] = np.arange(1, len(grams) + 1)
            self.maps.append(table)
        self.ranks = []
        for order in range(ORDER + 1):
            ranks = np.full(self.symbols**order, -1, np.int32)
            ranks[self.contexts[order + 1]] = np.arange(len(self.contexts[order + 1]))
            self.ranks.append(ranks)

    def _code(self, gram: np.ndarray, size: int) -> np.ndarray:
        """Runs of bytes as numbers over the symbols."""
        code = np.zeros(len(gram), np.int64)
        for i in range(size - 1, -1, -1):
            code = code * self.symbols + self.symbol[(gram >> (8 * i)) & 255]
        return code

    def _shorter(self, grams: np.ndarray, order: int) -> np.ndarray:
        """While building: the cost of each gram's last symbol without its first."""
        if order == 0:
            return self.uniform[grams]
        code = grams % self.symbols**order
        out = np.zeros((len(code), len(self.languages)))
        known, at = self._find(self.grams[order - 1], code)
        out[known] = self.costs[order - 1][at[known]]
        rest = ~known
        if rest.any():
            has, where = self._find(self.contexts[order], code[rest] // self.symbols)
            left = self._shorter(code[rest], order - 1)
            left[has] += self.escapes[order - 1][where[has]]
            out[rest] = left
        return out

    @staticmethod
    def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, values), len(table) - 1)
        return table[at] == values, at

    def _cost(self, symbols: list[np.ndarray], order: int) -> np.ndarray:
        """Cost of ``symbols[0]`` after ``symbols[1]``, the one before, and so on."""
        if order < 0:
            return self.uniform[symbols[0]]
        code = np.zeros(len(symbols[0]), np.int64)
        for back in range(order, 0, -1):
            code = code * self.symbols + symbols[back]
        rank = self.ranks[order][code]
        at = np.where(rank >= 0, self.maps[order][np.maximum(rank, 0) * self.symbols + symbols[0]], 0)
        out = self.costs[order][np.maximum(at, 1) - 1]
        rest = np.flatnonzero(at == 0)
        if len(rest):
            left = self._cost([s[rest] for s in symbols[: order + 1]], order - 1)
            out[rest] = left + np.where(rank[rest, None] >= 0, self.escapes[order][np.maximum(rank[rest], 0)], 0)
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text in each language."""
        data, begins = _padded(texts)
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.array([len(t) for t in texts])
        ends = begins + sizes
        for low in range(0, len(data), BLOCK):
            high = min(low + BLOCK, len(data))
            first, last = np.searchsorted(ends, low, "right"), np.searchsorted(begins, high, "left")
            if first >= last:
                continue
            symbols = self.symbol[data[max(low - ORDER, 0) : high]]
            skip = low - max(low - ORDER, 0)
            if not skip:  # the first block begins with filling bytes
                symbols, skip = np.append(np.full(ORDER, self.symbol[BEFORE]), symbols), ORDER
            count = high - low
            cost = self._cost([symbols[skip - back : skip - back + count] for back in range(ORDER + 1)], ORDER)
            sums = np.zeros((count + 1, cost.shape[1]))
            np.cumsum(cost, axis=0, dtype=np.float64, out=sums[1:])
            own = slice(first, last)
            out[own] += sums[np.minimum(ends[own], high) - low] - sums[np.maximum(begins[own], low) - low]
        return out


def predict(docs: DataFrame, model: Model, last: bool) -> DataFrame:
    """Rows with the best language so far, its code length and the sum of all likelihoods over its own, to the
    same after a block of languages; after the last one without the text."""
    names = [n for n in docs.columns if not (last and n in ("text", "lettered"))]
    schema = docs.select(*names).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            best = np.array(batch.column("lang_pred").to_pylist(), object)
            least, mass = (batch.column(n).to_numpy(zero_copy_only=False).copy() for n in ("least", "mass"))
            if lettered.any():
                texts = batch.column("text").filter(lettered)
                parts = [model.lengths([t.as_py().encode() for t in texts[rows]]) for rows in portions(texts)]
                bits = np.concatenate(parts)
                own, old = bits.min(axis=1), least[lettered]
                found = np.array(model.languages, object)[bits.argmin(axis=1)]
                first = (own < old) | ((own == old) & (found < best[lettered]))
                low = np.minimum(own, old)
                beyond = np.minimum(bits - low[:, None], 1000)
                before = np.minimum(old - low, 1000)
                mass[lettered] = mass[lettered] * np.exp2(-before) + np.exp2(-beyond).sum(axis=1)
                best[lettered] = np.where(first, found, best[lettered])
                least[lettered] = low
            made = {"lang_pred": pa.array(best, pa.string()), "least": pa.array(least), "mass": pa.array(mass)}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in names], names)

    return docs.mapInArrow(work, schema)


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the prediction's share of the likelihood)."""
    held_out = F.coalesce(remainder(F.col("doc_id"), folds) == 0, F.lit(False))
    learn = remainder(F.col("doc_id"), folds) != 0
    known = stored(counts(sample(docs, learn)), "counts")
    seen = [r["gram"] for r in known.where("size = 1").select("gram").distinct().collect()]
    blocks = -(-known.select("lang").distinct().count() // LANGUAGES)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    rows = docs.select(
        F.col("doc_id").cast("long"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"), lettered,
        F.lit(UNKNOWN).alias("lang_pred"), F.lit(float("inf")).alias("least"), F.lit(0.0).alias("mass"),
    )
    for block in range(blocks):
        own = F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block
        learned = [tuple(row) for row in known.where(own).collect()]
        if learned:
            rows = stored(rows, "languages") if block else rows
            rows = predict(rows, Model(learned, seen), block == blocks - 1)
    score = F.when(F.col("mass") > 0, 1 / F.col("mass")).otherwise(0.0).alias("score")
    return rows.select("doc_id", "held_out", "lang_pred", score)
