"""Reading the given tables and cutting lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hotdesk.sources.storage import new_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the folder that all executors share, and read back."""
    spark = rows.sparkSession
    folder = new_folder(spark, f"llm-{purpose}")
    rows.write.mode("errorifexists").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
