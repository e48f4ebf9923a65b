"""The corpus pipeline: documents to packed training sequences.

Every stage is a function of (spark, docs, sf_dir); its rows are written as Parquet to the
shared folder and read again as the next stage's documents. All but the last return the
columns of ``documents``:

1. quality: documents that the co-trained classifier rejects (poor or toxic) go;
2. near duplicates: of documents linked at 80 percent of their 5-word shingles one stays;
3. decontamination: documents into which a benchmark item of three words or more leaks go;
4. personal data: spans are replaced by their kind, texts change, no document goes;
5. packing: the ids of all texts, in sequences of 1024.

NULL and empty texts pass all stages; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hotdesk.llm import decontaminate, ngram_join, packing, pii, quality
from hotdesk.llm.tables import read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"), least_words=decontaminate.GRAM)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good),
    ("ngram_jaccard_join", unique),
    ("benchmark_decontamination", unleaked),
    ("pii", redacted),
    ("packing", packed),
]

#: SQL cannot train the classifier nor cut text into token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
