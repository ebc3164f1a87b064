"""Run tracking as a table of committed runs, and model persistence.

A run's rows stand under its id, and its commit, one row, is written after them;
readers see only runs with a commit. Each writer writes its own run's files, so
writers don't disturb each other. A step that is tried again under the same id
leaves one run: a committed one is kept, rows without a commit are replaced.

Each run has long rows ``(run_id, run_name, stage, start_time, kind, key,
value, value_num)``. Metrics arrive as one-row DataFrames and are unpivoted
with ``stack`` on the executors; nothing is collected to log them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = ("run_id string, run_name string, stage string, start_time timestamp, kind string, key string, "
              "value string, value_num double")
COMMIT_SCHEMA = "run_id string, run_name string, start_time timestamp"


def _kv_rows(spark: SparkSession, kind: str, items: dict) -> DataFrame:
    rows = [(kind, str(k), None if v is None else str(v),
             float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None)
            for k, v in items.items()]
    return spark.createDataFrame(rows, "kind string, key string, value string, value_num double")


def _metric_rows(metrics: DataFrame) -> DataFrame:
    if set(metrics.columns) == {"key", "value_num"}:  # already long: one row per metric
        return metrics.select(F.lit("metric").alias("kind"), "key",
                              F.col("value_num").cast("string").alias("value"),
                              F.col("value_num").cast("double").alias("value_num"))
    cols = metrics.columns
    parts = [x for c in cols for x in (F.lit(c), F.col(c).cast("double"))]
    return metrics.select(F.lit("metric").alias("kind"),
                          F.stack(F.lit(len(cols)), *parts).alias("key", "value_num")).select(
        "kind", "key", F.col("value_num").cast("string").alias("value"), "value_num")


def step_run_id(pipeline_id: str, step: str) -> str:
    """The run id of a step, the same whenever the step is tried again."""
    return f"r{uuid.uuid5(uuid.NAMESPACE_OID, f'{pipeline_id}/{step}').hex}"


def log_run(spark: SparkSession, runs_path: str, run_name: str, stage: str, params: dict | None = None,
            metrics: DataFrame | dict | None = None, tags: dict | None = None,
            start_time: dt.datetime | None = None, run_id: str | None = None) -> str:
    """Write one run's params, tags and metrics; returns the run id.

    ``metrics`` is a dict, a one-row wide DataFrame, or a long DataFrame with
    columns (key, value_num), e.g. per-segment metrics keyed by name. With
    ``run_id`` (``step_run_id``) a retried step is logged once."""
    run_id = run_id or f"r{uuid.uuid4().hex}"
    if _read(spark, f"{runs_path}/commits/run_id={run_id}") is not None:
        return run_id
    start_time = start_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    parts = [_kv_rows(spark, "param", params or {}), _kv_rows(spark, "tag", tags or {})]
    if isinstance(metrics, dict):
        parts.append(_kv_rows(spark, "metric", metrics))
    elif metrics is not None:
        parts.append(_metric_rows(metrics))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.select(F.lit(run_name).alias("run_name"), F.lit(stage).alias("stage"),
                       F.lit(start_time).cast("timestamp").alias("start_time"), "kind", "key", "value", "value_num")
    rows.write.mode("overwrite").parquet(f"{runs_path}/rows/run_id={run_id}")
    _commit(spark, runs_path, run_id, run_name, start_time)
    return run_id


def _commit(spark: SparkSession, runs_path: str, run_id: str, run_name: str, start_time: dt.datetime) -> None:
    row = spark.createDataFrame([(run_name,)], "run_name string").withColumn("start_time", F.lit(start_time).cast("timestamp"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{runs_path}/commits/run_id={run_id}")


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def runs(spark: SparkSession, runs_path: str) -> DataFrame:
    """The rows of all committed runs; none without a run table."""
    commits = _read(spark, f"{runs_path}/commits", COMMIT_SCHEMA)
    if commits is None:
        return spark.createDataFrame([], RUN_SCHEMA)
    rows = spark.read.schema(RUN_SCHEMA).parquet(f"{runs_path}/rows")
    return rows.join(commits.select("run_id"), "run_id", "left_semi").select([c.split()[0] for c in RUN_SCHEMA.split(", ")])


def latest_run_id(spark: SparkSession, runs_path: str, run_name: str) -> str | None:
    """The id of the one most recent run with this name (of equal start times,
    the least id); None without such a run or without a run table."""
    found = _read(spark, f"{runs_path}/commits", COMMIT_SCHEMA)
    if found is None:
        return None
    row = (found.where(F.col("run_name") == run_name).select("start_time", "run_id").distinct()
           .orderBy(F.desc("start_time"), "run_id").first())
    return row["run_id"] if row else None


def latest_run(spark: SparkSession, runs_path: str, run_name: str) -> DataFrame:
    """All rows of the most recent run with this name."""
    return runs(spark, runs_path).where(F.col("run_id") == F.lit(latest_run_id(spark, runs_path, run_name)))


def latest_param(spark: SparkSession, runs_path: str, run_name: str, key: str, fallback: str | None = None):
    """A parameter of the latest run (e.g. a model path), or ``fallback`` if
    there is no such run or parameter."""
    run_id = latest_run_id(spark, runs_path, run_name)
    if run_id is None:
        return fallback
    row = (runs(spark, runs_path).where((F.col("run_id") == run_id) & (F.col("kind") == "param") & (F.col("key") == key))
           .select("value").first())
    return row[0] if row else fallback


# ----------------------------------------------------------- persistence
def save_model(spark: SparkSession, model, path: str) -> str:
    model.save(spark, path)
    return path


def load_latest_model(spark: SparkSession, runs_path: str, run_name: str, fallback_path: str | None = None):
    """The forest that the latest run of this name logged as
    ``model_path``, else the one at ``fallback_path``; no model is an error."""
    from tillroll.operators.forest import Forest
    path = latest_param(spark, runs_path, run_name, "model_path", fallback_path)
    if path is None:
        raise FileNotFoundError(f"no run {run_name!r} with a model_path, and no fallback")
    return Forest.load(spark, path)


def save_rfm_bundle(spark: SparkSession, path: str, scaler_params: DataFrame,
                    centroids: list[tuple[int, list[float]]], segments: dict[int, str]) -> str:
    """Scaler table, centroids and the learned cluster->segment table, as Parquet
    under a version of their own; ``current`` names the version, and is written last."""
    version = f"v{uuid.uuid4().hex}"
    scaler_params.write.parquet(f"{path}/{version}/scaler")
    spark.createDataFrame([(int(i), [float(x) for x in c]) for i, c in centroids],
                          "cluster int, centroid array<double>").write.parquet(f"{path}/{version}/centroids")
    spark.createDataFrame([(int(k), v) for k, v in segments.items()],
                          "cluster int, segment string").write.parquet(f"{path}/{version}/segments")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").parquet(f"{path}/current")
    return path


def load_rfm_bundle(spark: SparkSession, path: str):
    """RfmScorer from the current version of a bundle (k-row tables only)."""
    from tillroll.streaming.scoring import RfmScorer
    path = f"{path}/{spark.read.parquet(f'{path}/current').first()['version']}"
    params = spark.read.parquet(f"{path}/scaler")
    cents = [(r["cluster"], list(r["centroid"])) for r in spark.read.parquet(f"{path}/centroids").collect()]
    segs = {r["cluster"]: r["segment"] for r in spark.read.parquet(f"{path}/segments").collect()}
    return RfmScorer.from_tables(params, sorted(cents), segs)
