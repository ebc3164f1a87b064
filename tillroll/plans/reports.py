"""The steps' text reports and the parameters and metrics of their runs.

Report rows and metrics are small aggregates of result tables; they are written
by Spark like any other table. Metric names are fixed values where a step's
run has published ones (see ``METRIC_NAMES``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import sanitize_key
from tillroll.operators.segments import SEGMENT_ORDER

# Metric keys of the labelling run, by the column they come from.
METRIC_NAMES = {"Count": "count", "Revenue_Share": "revenue_share", "Churn_Probability": "churn_prob",
                "Avg_Monetary": "avg_monetary", "Avg_Frequency": "avg_frequency", "Avg_Recency": "avg_recency"}


def cell(df: DataFrame, c: str) -> Column:
    """A value as report text: four digits for doubles."""
    if dict(df.dtypes)[c] in ("double", "float"):
        return F.when(F.col(c).isNotNull(), F.format_string("%.4f", F.col(c)))
    return F.col(c).cast("string")


def rows_of(df: DataFrame, section: str, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """(section, key, value) lines of a small table: a line for each row and value column."""
    values = values or [c for c in df.columns if c not in keys]
    name = F.concat_ws(" / ", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
    parts = [x for c in values for x in (F.lit(c), cell(df, c))]
    out = df.select(name.alias("_k"), F.stack(F.lit(len(values)), *parts).alias("_c", "value"))
    key = F.concat_ws(" : ", F.when(F.col("_k") != "", F.col("_k")), "_c")
    return out.select(F.lit(section).alias("section"), key.alias("key"), "value")


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -------------------------------------------------------------------- reports
def dataset_report(summary: DataFrame, missing: DataFrame, stats: DataFrame, first: DataFrame) -> DataFrame:
    return union([rows_of(summary, "1 SHAPE", []), rows_of(missing, "2 COLUMNS", ["Column"], ["Missing_Count", "Missing_Percentage"]),
                  rows_of(first, "3 FIRST ROWS", first.columns[:2]), rows_of(stats, "4 STATISTICS", ["Column"])])


def preprocessing_report(lineage: DataFrame, new_columns: list[str], scaled: list[str], rows: DataFrame, columns: int) -> DataFrame:
    """``rows``: a one-row frame with the final row count."""
    shape = rows.withColumn("columns", F.lit(columns))
    names = rows.select(F.lit(", ".join(new_columns)).alias("new_columns"), F.lit(", ".join(scaled)).alias("scaled_columns"))
    return union([rows_of(lineage, "1 CLEANING", []), rows_of(names, "2 FEATURES", []), rows_of(shape, "3 FINAL SHAPE", [])])


def segment_report(scored: DataFrame, metrics: DataFrame, labeled: DataFrame) -> DataFrame:
    totals = labeled.agg(F.count(F.lit(1)).alias("customers"), F.sum("Monetary").alias("total_revenue"))
    return union([rows_of(scored, "1 LABELS", ["Cluster"], ["Segment"]), rows_of(metrics, "2 SEGMENTS", ["Segment"]),
                  rows_of(totals, "3 TOTALS", [])])


def classifier_report(summary: DataFrame, report: DataFrame, importance: DataFrame | None = None) -> DataFrame:
    parts = [rows_of(summary, "1 OVERALL", []), rows_of(report, "2 CLASSES", ["label"])]
    if importance is not None:
        parts.append(rows_of(importance, "3 IMPORTANCE", ["Feature"]))
    return union(parts)


# ------------------------------------------------------------ metrics of runs
def one_row(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Long (key, value_num) metrics of the numeric columns of a one-row frame."""
    cols = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float")]
    names = names or {}
    parts = [x for c in cols for x in (F.lit(names.get(c, c)), F.col(c).cast("double"))]
    return df.select(F.stack(F.lit(len(cols)), *parts).alias("key", "value_num"))


def per_row(df: DataFrame, label: str, names: dict[str, str]) -> DataFrame:
    """Long metrics ``<name>_<label value>`` of each row."""
    parts = [x for c, n in names.items() for x in (F.lit(n), F.col(c).cast("double"))]
    out = df.select(F.col(label).cast("string").alias("_l"), F.stack(F.lit(len(names)), *parts).alias("_n", "value_num"))
    return out.select(F.concat_ws("_", "_n", sanitize_key("_l")).alias("key"), "value_num")


def profile_metrics(summary: DataFrame, missing: DataFrame) -> DataFrame:
    return union([one_row(summary, {"rows": "total_rows", "columns": "total_columns", "total_missing": "total_missing_values"}),
                  per_row(missing, "Column", {"Missing_Count": "missing", "Missing_Percentage": "missing_pct"})])


def clustering_metrics(quality: DataFrame, rfm_summary: DataFrame, clusters: DataFrame, elbow: DataFrame | None) -> DataFrame:
    parts = [one_row(quality), one_row(rfm_summary),
             per_row(clusters.withColumn("l", F.concat(F.lit("cluster_"), F.col("Cluster"))), "l",
                     {"Count": "count", "Percentage": "pct"})]
    if elbow is not None:
        parts.append(per_row(elbow.withColumn("l", F.concat(F.lit("k"), F.col("k"))), "l",
                             {"inertia": "inertia", "silhouette": "silhouette"}))
    return union(parts)


def labelling_metrics(metrics: DataFrame, labeled: DataFrame) -> DataFrame:
    totals = labeled.agg(F.sum("Monetary").alias("total_revenue"), F.count(F.lit(1)).alias("total_customers"))
    return union([per_row(metrics.where(F.col("Segment").isin(SEGMENT_ORDER)), "Segment", METRIC_NAMES), one_row(totals)])


def classifier_metrics(summary: DataFrame, report: DataFrame, importance: DataFrame) -> DataFrame:
    return union([one_row(summary), per_row(report.where("label not in ('accuracy', 'macro avg', 'weighted avg')"), "label",
                                            {"precision": "precision", "recall": "recall", "f1": "f1", "support": "support"}),
                  per_row(importance, "Feature", {"Importance": "importance"})])
