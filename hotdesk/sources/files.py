"""JSON and CSV in and out, UTF-8 throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of JSON documents that each hold one array of objects.

    A document is read by one task, so land big data as many documents
    (``write_json_arrays``) rather than as one.
    """
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def write_json_arrays(rows: DataFrame, path: str, rows_per_file: int = 10_000, overwrite: bool = False) -> None:
    """Writes JSON arrays of at most ``rows_per_file`` objects, one array per file.

    Rows are numbered where they lie and gathered by stretches of that many, so no task
    holds more than its stretches.
    """
    numbered = rows.select(F.struct("*").alias("object"), F.monotonically_increasing_id().alias("n"))
    # The upper bits of the number are the input partition, the lower 33 count its rows.
    partition, place = F.shiftright("n", 33), F.col("n").bitwiseAND((1 << 33) - 1)
    stretches = numbered.groupBy(
        partition.alias("partition"), F.floor(place / rows_per_file).alias("stretch")
    ).agg(F.collect_list("object").alias("objects"))
    documents = stretches.select(F.to_json("objects").alias("value"))
    documents.write.option("maxRecordsPerFile", 1).mode(_mode(overwrite)).text(path)


def export_json(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object per line, text unescaped."""
    rows.write.mode(_mode(overwrite)).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def export_csv(rows: DataFrame, path: str, overwrite: bool = False) -> bool:
    """CSV with a header; writes nothing and returns False when there are no rows."""
    if rows.isEmpty():
        return False
    rows.write.mode(_mode(overwrite)).option("header", True).option("escape", '"').csv(path)
    return True


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    )
