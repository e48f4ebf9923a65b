"""Co-training: accuracy on labels that it did not see, and odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hotdesk.llm import quality
from hotdesk.llm.tables import read


def test_unseen_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    known = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    rows = quality.digest(docs, labels.where("doc_id % 2 = 0")).collect()
    assert len(rows) == docs.count()
    unseen = [(known[r.doc_id], r.keep) for r in rows if r.doc_id in known and r.doc_id % 2]
    for label, keep, least in (((1, 0), True, 0.97), ((0, 0), False, 0.95), ((1, 1), False, 0.85)):
        own = [k == keep for found, k in unseen if found == label]
        assert np.mean(own) >= least


def test_views_teach_each_other():
    """A metadata view that the labelled rows barely cover learns from the content view."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 2000)
    content = np.column_stack([y + rng.normal(0, 0.3, 2000), rng.normal(size=2000)])
    codes = np.column_stack([y * 5 + rng.integers(0, 5, 2000), np.full(2000, 128), np.full(2000, 160)])
    seen = np.where(np.arange(2000) < 60, y, -1)
    model = quality.co_train(content, codes, [np.zeros(0, np.int32)] * 2000, seen)
    by_source = model["metadata"][:10]
    assert by_source[5:].min() > by_source[:5].max()
    odds = quality.logits(quality._one_hot(codes), model["metadata"])
    assert np.mean((odds > 0) == y) > 0.95


def test_a_rare_class_is_learned_whole(spark, monkeypatch):
    monkeypatch.setattr(quality, "LABELLED", 200)
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(4000):
        words = [f"w{n}" for n in rng.integers(0, 300, 30)] + ["vile", "foul"] * (i % 100 == 0)
        rows.append((i, " ".join(words), "en", "a", 100))
        labels.append((i, 1, int(i % 100 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.keep for r in quality.digest(docs, known).collect()}
    assert {i for i, keep in kept.items() if not keep} == set(range(0, 4000, 100))


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, "a b", None, "x", 3), (None, "", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("keep", F.lit(1)).withColumn("quality", F.lit("q")).withColumn("h", F.lit(1))
    labels = spark.createDataFrame([(1, 1, None), (1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = quality.digest(docs, labels).collect()
    assert {(r.quality_score, r.toxic_score, r.keep) for r in found} == {(1.0, 0.5, True)} and len(found) == 3
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 3
    assert {r.quality_score for r in quality.digest(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.digest(docs.limit(0), labels).collect() == []


def labelled_few(spark, unlabelled: int, told: int):
    """Few labelled rows of one source; the last ``told`` rows have others, and words that tell their class best."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(unlabelled + 120):
        good = int(rng.random() < 0.5)
        late = i >= unlabelled + 120 - told
        words = ["".join(rng.choice(list("wW5"), n)) for n in rng.integers(1, 60, 25)] + [("poor", "fine")[good]]
        if late or (i < 120 and rng.random() < 0.5):
            words.append(("awful", "great")[good])
        rows.append((i, " ".join(words), "en", ("bad", "good")[good] if late else "mixed", 100))
        if i < 120:
            labels.append((i, good, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def sources(*names: str) -> np.ndarray:
    rows = [{"text": "x", "lang": "en", "source": name, "n_chars": 100} for name in names]
    return quality.metadata(pa.RecordBatch.from_pylist(rows))


def test_every_unlabelled_row_is_asked(spark):
    """Of 20,000 unlabelled rows the 60 that teach the metadata view its sources are found."""
    docs, labels = labelled_few(spark, 20_000, 60)
    model = quality.fit(docs, labels)["quality"]
    good, bad = model["metadata"][sources("good", "bad")].sum(axis=1)
    assert good > bad + 0.5


def test_rounds_on_spark_are_those_of_one_machine(spark):
    """The distributed rounds and the plain ones, on the same rows, end in the same models."""
    docs, labels = labelled_few(spark, 700, 350)
    found = quality.fit(docs, labels)["quality"]
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = docs.withColumn("h", F.xxhash64("doc_id")).orderBy("h").collect()
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in rows])
    words, kind = quality.Words(), quality._kinds()
    spans = words.spans(batch.column("text"), quality.PREFIX)
    hashed = quality.buckets(spans)
    sets = [np.unique(hashed[:, a:b]).astype(np.int32) for a, b in zip(spans.bounds[:-1], spans.bounds[1:])]
    stats, codes = quality.statistics(spans, kind), quality.metadata(batch)
    # Labelled rows first, as the sample has them.
    order = [i for i, r in enumerate(rows) if r.doc_id in known] + [i for i, r in enumerate(rows) if r.doc_id not in known]
    y = np.array([known.get(rows[i].doc_id, -1) for i in order])
    plain = quality.co_train(stats[order], codes[order], [sets[i] for i in order], y)
    assert (plain["chosen"] == found["chosen"]).all()
    for part in ("content", "metadata", "combined"):
        assert np.allclose(plain[part], found[part], atol=1e-6), part
    # Sources that no labelled row has are told apart: the content view taught them.
    good, bad = found["metadata"][sources("good", "bad")].sum(axis=1)
    assert good > bad + 0.5
