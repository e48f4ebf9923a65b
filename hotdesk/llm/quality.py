"""Quality of documents by co-training: a content view and a metadata view teach each other.

The content view sees the text: shares of character and word kinds and the words that tell
the classes apart. The metadata view sees what came with it: source, language, length. A
logistic model is fitted per view on the labelled rows; in every round each view labels the
unlabelled rows that it is sure of, for the other view to learn from. Both views are then
calibrated on labelled rows that took no part in the fit, and combined there.

The models are fitted in one task on a bounded sample of labelled rows, at most ``LABELLED`` of
each class of a target, those of the smallest hash of the id, and on what the views taught each
other. For that every unlabelled row is scored by both views in every round, on Spark, and
the surest of each class are taken from all of them, at most ``TAUGHT`` a round; only what is
chosen is bounded. Rows are scored by their numbers, which are made from the texts once, and
copies with the same numbers count once. Chances
are put back to the shares that the classes have among all labelled rows. Words are hashed to ``BUCKETS``
numbers, of which at most ``CHOSEN`` per class are used. All documents are scored.

A document is kept when it is more likely good than not and more likely harmless than toxic.

Defined results: NULL text counts as empty; NULL metadata is a value of its own; without
labelled rows of both classes every row gets the labels' mean, or 0.5 without any label, and
is kept; labels that name a document twice count once, by the larger value; of documents that
share an id the least row is learned from; a row without a label of one target can be taught that
target; equally sure rows go by the hash of their id; repeated rows are scored each on its own.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from hotdesk.llm.tables import stored
from hotdesk.llm.words import Spans, Words, portions

TARGETS = ("quality", "toxic")
LABELLED = 6000
BUCKETS, CHOSEN, PREFIX = 1 << 20, 128, 5
ROUNDS, SURE, TAUGHT = 3, 0.95, 300
#: Ridge of the content and of the metadata view.
DECAY = (1.0, 5.0)
VIEWS = ("content", "metadata")
#: Share of the labelled rows that is set aside for calibration.
HELD_OUT = 0.25
#: Numbers of the metadata view: hashed source, hashed language, length class.
SOURCES, LANGUAGES, LENGTHS = 128, 32, 32
THRESHOLD = 0.5
SEED = 7


def _kinds() -> np.ndarray:
    """For each byte its kind: other, letter, capital, digit, punctuation, white, line end, beyond ASCII."""
    kind = np.zeros(256, np.uint8)
    for byte in range(256):
        sign = chr(byte)
        kind[byte] = (
            7 if byte > 127 else 6 if sign == "\n" else 5 if sign.isspace() else 3 if sign.isdigit()
            else 2 if sign.isupper() else 1 if sign.isalpha() else 4 if sign.isprintable() else 0
        )
    return kind


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the stretches between bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(found: Spans, kind: np.ndarray) -> np.ndarray:
    """Numbers about each text, a row per text, each of order one."""
    kinds, words = kind[found.data], np.diff(found.bounds)
    size = np.maximum(np.diff(found.offsets), 1)
    shares = [_sums(kinds == k, found.offsets) / size for k in (2, 3, 4, 6)]
    many = np.maximum(words, 1)
    same = np.append(found.hashes[1:] == found.hashes[:-1], False)
    same[found.bounds[1:-1][found.bounds[1:-1] > 0] - 1] = False
    lengths = found.ends - found.begins
    ends_odd = kinds[found.ends - 1] == 4
    bare = ends_odd & (lengths == 1)
    loud = kinds[found.begins] == 2
    of_words = [_sums(v, found.bounds) / many for v in (same, ends_odd, bare, loud)]
    mean = _sums(lengths, found.bounds) / many / 10
    return np.column_stack([*shares, *of_words, mean, np.log1p(words) / 10])


def buckets(found: Spans) -> np.ndarray:
    """The hashed words, and in a second row the hashed beginnings of words."""
    whole = (found.hashes % np.uint64(BUCKETS)).astype(np.int64)
    begun = ((found.prefixes * np.uint64(3)) % np.uint64(BUCKETS)).astype(np.int64)
    return np.stack([whole, begun])


def metadata(batch: pa.RecordBatch) -> np.ndarray:
    """Three numbers per row: hashed source, hashed language and length class, as columns of one view."""

    def hashed(name: str, size: int) -> np.ndarray:
        column = batch.column(name).dictionary_encode()
        values = [xxhash.xxh32_intdigest(v) % (size - 1) + 1 if v is not None else 0 for v in column.dictionary.to_pylist()]
        codes = column.indices.to_numpy(zero_copy_only=False)
        codes = np.where(np.isnan(codes.astype(float)), len(values), codes).astype(np.int64)
        return np.array([*values, 0])[codes]

    length = np.nan_to_num(batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float))
    classes = np.minimum(np.log2(np.maximum(length, 0) + 1) * 1.5, LENGTHS - 1).astype(np.int64)
    source, lang = hashed("source", SOURCES), hashed("lang", LANGUAGES)
    return np.column_stack([source, SOURCES + lang, SOURCES + LANGUAGES + classes])


def _one_hot(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), SOURCES + LANGUAGES + LENGTHS), np.float64)
    out[np.arange(len(codes))[:, None], codes] = 1
    return out


def logistic(x: np.ndarray, y: np.ndarray, decay: float, steps: int = 12) -> np.ndarray:
    """Weights of a logistic model, the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], decay)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def logits(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip(x @ weights[:-1] + weights[-1], -30, 30)


def chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


def telling(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The buckets whose presence tells the classes apart most, in at least five rows."""
    texts = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    every = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    found, at = np.unique(every, return_inverse=True)
    total = np.bincount(at, minlength=len(found)).astype(float)
    good = np.bincount(at, weights=y[texts], minlength=len(found))
    share = y.mean()
    z = (good - total * share) / np.sqrt(total * share * (1 - share) + 1e-9)
    z[total < 5] = 0
    chosen = np.concatenate([np.argsort(-z, kind="stable")[:CHOSEN], np.argsort(z, kind="stable")[:CHOSEN]])
    return np.sort(np.unique(found[chosen[np.abs(z[chosen]) > 4]]))


def presence(rows: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(chosen)))
    for row, own in zip(out, rows, strict=True):
        row[np.isin(chosen, own, assume_unique=True)] = 1
    return out


def divided(rows: list[np.ndarray], y: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Labelled rows to calibrate on and to fit on, and the telling words; None without both classes."""
    known = np.flatnonzero(y >= 0)
    if len(known) < 20 or len(set(y[known].tolist())) < 2:
        return None
    order = np.random.default_rng(seed).permutation(known)
    held, fit = order[: int(len(order) * HELD_OUT)], order[int(len(order) * HELD_OUT) :]
    if min(len(set(y[held].tolist())), len(set(y[fit].tolist()))) < 2:
        held = fit = known
    return held, fit, telling([rows[i] for i in fit], y[fit])


def fitted(views: list[np.ndarray], y: np.ndarray, fit: np.ndarray, taught: list[dict[int, int]]) -> list[np.ndarray]:
    """A model per view, from the labelled rows and those that the other view has taught it."""
    models = []
    for view, extra, ridge in zip(views, taught, DECAY, strict=True):
        at = np.concatenate([fit, np.array(list(extra), np.int64)])
        models.append(logistic(view[at], np.concatenate([y[fit], list(extra.values())]), ridge))
    return models


def quotas(y: np.ndarray, shift: float) -> dict[int, int]:
    """How many rows of each class a view may teach in a round."""
    prior = chance(np.log(y.mean() / (1 - y.mean())) + shift)
    return {1: max(1, int(TAUGHT * prior)), 0: max(1, int(TAUGHT * (1 - prior)))}


def surest(p: np.ndarray, most: dict[int, int]) -> Iterator[tuple[int, np.ndarray]]:
    """Of each class the rows that a view is most sure of, and sure enough."""
    for value, sure in ((1, p), (0, 1 - p)):
        best = np.argsort(-sure, kind="stable")[: most[value]]
        yield value, best[sure[best] >= SURE]


def completed(
    views: list[np.ndarray], models: list[np.ndarray], y: np.ndarray, held: np.ndarray, shift: float
) -> dict[str, np.ndarray]:
    """The views, calibrated on rows that they were not fitted on, and their combination."""
    scores = [logits(view[held], model) for view, model in zip(views, models, strict=True)]
    calibrated = [logistic(s[:, None], y[held], 1e-3) for s in scores]
    both = np.column_stack([logits(s[:, None], c) for s, c in zip(scores, calibrated, strict=True)])
    combined = logistic(both, y[held], 0.1)
    combined[-1] += shift
    return {"calibration": np.stack(calibrated), "combined": combined}


def co_train(
    content: np.ndarray, codes: np.ndarray, rows: list[np.ndarray], y: np.ndarray, seed: int = SEED, shift: float = 0.0
) -> dict[str, np.ndarray]:
    """A model of the two views of rows at hand, unlabelled ones (``y`` is -1) among them.

    ``y`` holds 0, 1 and, for rows to leave out, -2. ``shift`` is what the log odds of class 1
    are too low by in the sample (negative: too high).
    """
    parts = divided(rows, y, seed)
    if parts is None:
        known = y[y >= 0]
        return {"prior": np.array([known.mean() if len(known) else 0.5])}
    held, fit, chosen = parts
    views = [np.column_stack([content, presence(rows, chosen)]), _one_hot(codes)]
    pool, most = np.flatnonzero(y == -1), quotas(y[fit], shift)
    taught: list[dict[int, int]] = [{}, {}]
    models = fitted(views, y, fit, taught)
    for _ in range(ROUNDS if len(pool) else 0):
        for own, other in ((0, 1), (1, 0)):
            p = chance(logits(views[own][pool], models[own]) + shift)
            for value, best in surest(p, most):
                taught[other].update({int(pool[i]): value for i in best})
        models = fitted(views, y, fit, taught)
    return {
        "chosen": chosen,
        "content": models[0],
        "metadata": models[1],
        **completed(views, models, y, held, shift),
    }


def score(model: dict[str, np.ndarray], stats: np.ndarray, found: Spans, hashed: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The chance of class 1 for each text of a batch."""
    if "prior" in model:
        return np.full(len(stats), model["prior"][0])
    chosen, weights = model["chosen"], model["content"]
    fixed = stats.shape[1]
    content = stats @ weights[:fixed] + weights[-1]
    if len(chosen):
        place = np.full(BUCKETS, -1, np.int16)
        place[chosen] = np.arange(len(chosen))
        hits = []
        for words in hashed:
            at = np.flatnonzero(place[words] >= 0)
            text = np.searchsorted(found.bounds, at, "right") - 1
            hits.append(text * len(chosen) + place[words[at]])
        once = np.unique(np.concatenate(hits))
        content += np.bincount(once // len(chosen), weights[fixed + once % len(chosen)], len(content))
    views = [np.clip(content, -30, 30), np.clip(model["metadata"][codes].sum(axis=1) + model["metadata"][-1], -30, 30)]
    both = np.column_stack([logits(v[:, None], c) for v, c in zip(views, model["calibration"], strict=True)])
    return chance(logits(both, model["combined"]))


def _packed(models: dict[str, dict[str, np.ndarray]]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{target}/{name}": a for target, model in models.items() for name, a in model.items()})
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, dict[str, np.ndarray]]:
    models: dict[str, dict[str, np.ndarray]] = {}
    for name, array in np.load(io.BytesIO(data)).items():
        target, part = name.split("/")
        models.setdefault(target, {})[part] = array
    return models


def _over(size: int) -> float:
    """The log of how many rows of a class stand behind one of its sample."""
    return float(np.log(max(1.0, size / LABELLED)))


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, dict[str, np.ndarray]]:
    """Models of the targets ``quality`` and ``toxic``, from a bounded sample of labelled rows and all others."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic")
    )
    ids = docs.where("doc_id IS NOT NULL").select("doc_id").distinct()
    marked = ids.join(known, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    strata = [F.struct(F.lit(t).alias("target"), (F.col(t) > 0).cast("int").alias("value"), F.col(t).alias("is")) for t in TARGETS]
    cases = marked.select("*", F.explode(F.array(*strata)).alias("case")).where("case.is >= 0")
    sizes = {(r["target"], r["value"]): r["count"] for r in cases.groupBy("case.target", "case.value").count().collect()}
    shifts = {t: _over(sizes.get((t, 1), 0)) - _over(sizes.get((t, 0), 0)) for t in TARGETS}
    by_hash = Window.partitionBy("case.target", "case.value").orderBy("h", "doc_id")
    cases = cases.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= LABELLED)
    # A row that another target's stratum brought is left out, or classes would be sampled unevenly.
    drawn = cases.groupBy("doc_id", "h").agg(
        *(
            F.coalesce(
                F.max(F.when(F.col("case.target") == t, F.col("case.value"))),
                F.max(F.when(F.col(t).isNotNull(), -2)),
            ).alias(t)
            for t in TARGETS
        )
    )
    # At most 4 * LABELLED small rows, whatever the table's size.
    own = F.struct("text", "source", "lang", "n_chars")
    rows = docs.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "h", *TARGETS).agg(F.min(own).alias("own"))
    texts = rows.select("h", *TARGETS, "own.*")
    shaped = texts.mapInArrow(_word_sets, "h long, quality int, toxic int, stats binary, codes binary, words binary")
    labelled = stored(shaped, "labelled").withColumns(dict.fromkeys(("target", "view", "value", "turn"), F.lit(None).cast("int")))

    def trained(rows: DataFrame, final: bool) -> dict[str, dict[str, np.ndarray]]:
        def train(table: pa.Table) -> pa.Table:
            return pa.table({"model": pa.array([_packed(_models(table, shifts, final))], pa.binary())})

        found = rows.groupBy(F.lit(0).alias("all")).applyInArrow(train, "model binary").first()
        return _unpacked(found["model"]) if found else {}

    models = trained(labelled, final=False)
    open_ = {t: m for t, m in models.items() if "prior" not in m}
    if not open_:
        return models
    pool = stored(_pool(docs, known, {t: m["chosen"] for t, m in open_.items()}), "pool")
    for turn in range(ROUNDS):
        labelled = labelled.unionByName(
            stored(_taught(pool, {t: models[t] for t in open_}, shifts, turn), "taught"), allowMissingColumns=True
        )
        models = trained(labelled, final=turn == ROUNDS - 1)
    return models


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their numbers, and the buckets of their words, in place of texts."""
    words, kind = Words(), _kinds()
    for whole in batches:
        for rows in portions(whole.column("text")):
            batch = whole.slice(rows.start, rows.stop - rows.start)
            found = words.spans(batch.column("text"), PREFIX)
            hashed, bounds = buckets(found), zip(found.bounds[:-1], found.bounds[1:], strict=True)
            sets = [np.unique(hashed[:, low:high]).astype(np.int32) for low, high in bounds]
            numbers = (statistics(found, kind), metadata(batch), sets)
            columns = [batch.column(n) for n in ("h", *TARGETS)]
            columns += [pa.array([v.tobytes() for v in part], pa.binary()) for part in numbers]
            yield pa.RecordBatch.from_arrays(columns, ["h", *TARGETS, "stats", "codes", "words"])


def _numbers(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """Equally long runs of numbers as a matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), -1)


def _models(table: pa.Table, shifts: dict[str, float], final: bool) -> dict[str, dict[str, np.ndarray]]:
    """Models from labelled rows and rows that were taught (with the target and the view they are for)."""
    labelled = table.filter(pc.is_null(table.column("target"))).sort_by([("h", "ascending")])
    stats, codes = _numbers(labelled.column("stats"), np.float64), _numbers(labelled.column("codes"), np.int64)
    sets = [np.frombuffer(v.as_py(), np.int32) for v in labelled.column("words")]
    models = {}
    for number, target in enumerate(TARGETS):
        y = labelled.column(target).fill_null(-1).to_numpy()
        parts = divided(sets, y, SEED)
        if parts is None:
            models[target] = {"prior": np.array([y[y >= 0].mean() if (y >= 0).any() else 0.5])}
            continue
        held, fit, chosen = parts
        views = [np.column_stack([stats, presence(sets, chosen)]), _one_hot(codes)]
        own = table.filter(pc.fill_null(pc.equal(table.column("target"), number), False))
        own = own.sort_by([("turn", "ascending"), ("h", "ascending")])
        lessons: list[dict[int, int]] = [{}, {}]
        if len(own):
            extra_codes = _one_hot(_numbers(own.column("codes"), np.int64))
            present = [[np.frombuffer(v.as_py(), np.int32)] for v in own.column("words")]
            hits = np.zeros((len(own), len(chosen)))
            for row, (at,) in zip(hits, present, strict=True):
                row[at] = 1
            extra = [np.column_stack([_numbers(own.column("stats"), np.float64), hits]), extra_codes]
            # A row that is taught again takes its newest label.
            latest: dict[tuple, int] = {}
            places = zip(own.column("view").to_pylist(), own.column("h").to_pylist(), strict=True)
            for i, (view, h) in enumerate(places):
                latest[view, h] = i
            values = own.column("value").to_pylist()
            for (view, _), i in latest.items():
                lessons[view][len(y) + i] = values[i]
            views = [np.concatenate([view, more]) for view, more in zip(views, extra, strict=True)]
        fitted_models = fitted(views, y, fit, lessons)
        models[target] = {"chosen": chosen, "content": fitted_models[0], "metadata": fitted_models[1]}
        models[target]["known"] = np.array([y[fit].mean()])
        if final:
            models[target] |= completed(views, fitted_models, y, held, shifts[target])
    return models


def _pool(docs: DataFrame, known: DataFrame, chosen: dict[str, np.ndarray]) -> DataFrame:
    """Every row that lacks a label of a target, by its numbers; rows of the same numbers once.

    ``words_<target>`` has the places of the row's words among the telling ones.
    """
    names = [f"words_{t}" for t in chosen]

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, kind = Words(), _kinds()
        for whole in batches:
            for rows in portions(whole.column("text")):
                batch = whole.slice(rows.start, rows.stop - rows.start)
                found = words.spans(batch.column("text"), PREFIX)
                hashed = buckets(found)
                present = {}
                for target, telling_words in chosen.items():
                    place = np.full(BUCKETS, -1, np.int32)
                    place[telling_words] = np.arange(len(telling_words))
                    hits = [place[h] for h in hashed]
                    present[target] = [
                        np.unique(np.concatenate([h[low:high][h[low:high] >= 0] for h in hits])).astype(np.int32)
                        for low, high in zip(found.bounds[:-1], found.bounds[1:], strict=True)
                    ]
                parts = (statistics(found, kind), metadata(batch), *present.values())
                columns = [batch.column("doc_id")]
                columns += [pa.array([v.tobytes() for v in part], pa.binary()) for part in parts]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "stats", "codes", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.mapInArrow(
        numbers, f"doc_id {kind}, stats binary, codes binary, " + ", ".join(f"{n} binary" for n in names)
    )
    lacks = [F.col(t).isNull().alias(f"lacks_{t}") for t in chosen]
    marked = made.join(known, "doc_id", "left").select("doc_id", "stats", "codes", *names, *lacks)
    marked = marked.where(reduce(Column.__or__, [F.col(f"lacks_{t}") for t in chosen]))
    same = ["stats", "codes", *names, *[f"lacks_{t}" for t in chosen]]
    return marked.groupBy(*same).agg(F.min(F.xxhash64("doc_id")).alias("h"))


def _taught(
    pool: DataFrame, models: dict[str, dict[str, np.ndarray]], shifts: dict[str, float], turn: int
) -> DataFrame:
    """Of all rows of the pool the surest of each view, class and target, for the other view to learn."""
    most = {
        t: {v: max(1, int(TAUGHT * share)) for v, share in ((1, prior), (0, 1 - prior))}
        for t, prior in (
            (t, chance(np.log(m["known"][0] / (1 - m["known"][0])) + shifts[t])) for t, m in models.items()
        )
    }

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.sort_by("h")  # noqa: PLW2901 - equally sure rows go by it
            stats, codes = _numbers(batch.column("stats"), np.float64), _numbers(batch.column("codes"), np.int64)
            for target, model in models.items():
                lacking = batch.column(f"lacks_{target}").to_numpy(zero_copy_only=False)
                weights, fixed = model["content"], stats.shape[1]
                present = [np.frombuffer(v.as_py(), np.int32) for v in batch.column(f"words_{target}")]
                known = np.array([weights[fixed + at].sum() for at in present])
                scores = (
                    stats @ weights[:fixed] + known + weights[-1],
                    model["metadata"][codes].sum(axis=1) + model["metadata"][-1],
                )
                for view, score in enumerate(scores):
                    p = chance(np.clip(score, -30, 30) + shifts[target])
                    at = np.flatnonzero(lacking)
                    # Of one batch no more can be among the surest of all.
                    for value, best in surest(p[at], most[target]):
                        rows, size = at[best], len(best)
                        sure = p[rows] if value else 1 - p[rows]
                        taken = batch.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(size, TARGETS.index(target), np.int32)),
                                pa.array(np.full(size, 1 - view, np.int32)),
                                pa.array(np.full(size, value, np.int32)),
                                pa.array(np.full(size, turn, np.int32)),
                                pa.array(sure),
                                *[taken.column(n) for n in ("h", "stats", "codes", f"words_{target}")],
                            ],
                            ["target", "view", "value", "turn", "sure", "h", "stats", "codes", "words"],
                        )

    found = pool.mapInArrow(
        candidates,
        "target int, view int, value int, turn int, sure double, h long, stats binary, codes binary, words binary",
    )
    case = Window.partitionBy("target", "view", "value").orderBy(F.desc("sure"), "h", "stats", "codes", "words")
    bound = F.lit(0)
    for t, own in most.items():
        for value, size in own.items():
            bound = F.when((F.col("target") == TARGETS.index(t)) & (F.col("value") == value), size).otherwise(bound)
    ranked = found.withColumn("place", F.row_number().over(case)).where(F.col("place") <= TAUGHT)
    return ranked.where(F.col("place") <= bound).drop("place", "sure")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc`` (all its columns), ``quality``, ``toxic`` (chances) and ``keep``."""
    source, lang = (F.col(name).cast("string").alias(name) for name in ("source", "lang"))
    length = F.col("n_chars").cast("long").alias("n_chars")
    models = fit(docs.select("doc_id", "text", source, lang, length), labels)
    names = ("text", "source", "lang", "n_chars")

    @F.arrow_udf("struct<quality: double, toxic: double, keep: boolean>")
    def judged(
        batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]],
    ) -> Iterator[pa.Array]:
        words, kind = Words(), _kinds()
        targets = [models.get(t, {"prior": np.array([0.5])}) for t in ("quality", "toxic")]
        for columns in batches:
            batch = pa.RecordBatch.from_arrays(list(columns), names)
            chances = [np.zeros((2, 0))]
            for rows in portions(batch.column("text")):
                part = batch.slice(rows.start, rows.stop - rows.start)
                found = words.spans(part.column("text"), PREFIX)
                stats, hashed, codes = statistics(found, kind), buckets(found), metadata(part)
                chances.append(np.stack([score(model, stats, found, hashed, codes) for model in targets]))
            good, bad = np.concatenate(chances, axis=1)
            keep = np.ones(len(good), bool)
            if "prior" not in targets[0]:
                keep &= good >= THRESHOLD
            if "prior" not in targets[1]:
                keep &= bad < THRESHOLD
            columns = [pa.array(good), pa.array(bad), pa.array(keep)]
            yield pa.StructArray.from_arrays(columns, ["quality", "toxic", "keep"])

    marked = judged(F.col("text"), source, lang, length).alias("judged")
    return docs.select(F.struct("*").alias("doc"), marked).select("doc", "judged.*")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores and decision for every document."""
    rows = classify(docs, labels)
    return rows.select(
        "doc.doc_id", F.col("quality").alias("quality_score"), F.col("toxic").alias("toxic_score"), "keep"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns."""
    return classify(docs, labels).where("keep").select("doc.*")
