"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.session import scratch_path

# word characters of every contract: everything but ASCII white space
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_FILE = 1_000_000  # of a narrow table


def stored(df: DataFrame, name: str, rows: int | None = None, spread: bool = False) -> DataFrame:
    """Write to the shared checkpoint folder and read back: the work happens
    once, lineage is cut, and a lost executor only re-reads files.

    ``rows``, an upper bound of a narrow table's rows, keeps it from being
    written as many small files: the last step runs in as few tasks as make
    whole files, or, where that step is costly (``spread``), its results are
    dealt anew."""
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        files = max(1, -(-rows // ROWS_PER_FILE))
        df = df.repartition(files) if spread else df.coalesce(files)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_in_small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are read, and handed to Python workers, ``rows`` at a time.

    Texts may be long: a reader's batch of one column is a single array, and a
    worker holds an Arrow batch, its strings and its results at once. These are
    session settings, read when a query runs."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", rows // 4)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def crc_mod(column: str, m: int):
    """crc32 of the id written as text, modulo m; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % m


def spread_rank(df: DataFrame, group: str, key, order: list, out: str, rows: int,
                per_bucket: int = 50_000, least: int = 256) -> DataFrame:
    """Add ``out``: a gapless 0-based rank of each row within its ``group``.

    A group may hold any share of the rows, so it is cut into sub-buckets by a
    hash of ``key``: bucket counts (pre-aggregated) give each bucket's first
    rank, and only a bucket is numbered in one task. ``rows`` is the row count
    of ``df``; buckets grow in number with it. ``df`` is read twice, so pass a
    stored frame.
    """
    subs = max(least, -(-rows // per_bucket))
    df = df.withColumn("_sub", F.pmod(F.xxhash64(*key), F.lit(subs)).cast("int"))
    first = (df.groupBy(group, "_sub").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_first", F.sum("_n").over(W.partitionBy(group).orderBy("_sub")) - F.col("_n"))
             .select(group, "_sub", "_first"))
    w = W.partitionBy(group, "_sub").orderBy(*order)
    return (df.join(first, [group, "_sub"])
            .withColumn(out, F.col("_first") + F.row_number().over(w) - 1)
            .drop("_sub", "_first"))


def parts_of(batch: pa.RecordBatch, size: int, text: int = 1) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have about ``size`` bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
