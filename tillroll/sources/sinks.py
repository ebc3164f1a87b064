"""Table and report sinks, previews, and lineage cuts through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import scratch_path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write a result table (Parquet by default; CSV gets a header row)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def materialize(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    joins) and lets several later steps share one computation.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def head(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First n rows under an explicit order (a top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def write_report(rows: DataFrame, path: str) -> str:
    """Text report, one ``section | key | value`` line per row, ordered."""
    lines = rows.orderBy("section", "key").select(
        F.format_string("%s | %s | %s", "section", "key", F.coalesce("value", F.lit(""))).alias("value"))
    lines.write.mode("overwrite").text(path)
    return path
