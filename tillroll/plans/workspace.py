"""Session-wide reuse of intermediate tables derived from the driver tables.

Several registered queries start from the same derived tables (cleaned
lines, per-customer RFM, cluster assignments, labelled customers, the
classifier split). Each is computed once per Spark application and input
files, written as Parquet under the shared checkpoint folder, and read back
by every later query: the work happens once, the lineage is cut, and a lost
executor re-reads files instead of recomputing joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import scratch_path

_TABLES: dict[tuple, str] = {}
_OBJECTS: dict[tuple, object] = {}


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and modification time of the input folder's files, by whatever
    file system Spark reads it with; a rewritten table is another input."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)))


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, _files(spark, sf_dir), name)


def shared_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = _key(spark, sf_dir, name)
    path = _TABLES.get(key)
    if path is None:
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        _TABLES[key] = path
    return spark.read.parquet(path)


def shared_object(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """Memoised small driver-side objects (fitted models, scaler parameters)."""
    key = _key(spark, sf_dir, name)
    if key not in _OBJECTS:
        _OBJECTS[key] = build()
    return _OBJECTS[key]


def table_path(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """Where a shared table was written (None before it is built)."""
    return _TABLES.get(_key(spark, sf_dir, name))


def clear() -> None:
    _TABLES.clear()
    _OBJECTS.clear()
