"""Cluster summaries, rank-based segment labels and segment business metrics.

Per-cluster and per-segment frames have k rows; the windows without a
partition key below only ever run on those k-row aggregates. Customer-level
frames join them as small tables (broadcast while their counted rows allow).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.functions.columns import join_small, np_round

# Segment names by descending total RFM score position.
SEGMENT_ORDER = ["Champions", "Potential Loyalists", "At Risk", "Lost"]
# Serving-side id -> segment table for unknown-label fallback.
SERVING_SEGMENTS = {0: "Champions", 1: "Potential Loyalists", 2: "At Risk", 3: "Lost"}


def cluster_summary(df: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """Cluster, mean Recency / Frequency / Monetary, Count, Percentage of customers."""
    s = df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        F.avg("Recency").alias("Recency"), F.avg("Frequency").alias("Frequency"),
        F.avg("Monetary").alias("Monetary"), F.count(F.lit(1)).alias("Count"))
    return s.withColumn("Percentage", F.col("Count") * 100.0 / F.sum("Count").over(W.partitionBy()))


def average_rank(col: str, ascending: bool = True) -> F.Column:
    """pandas ``rank(method='average')`` over the whole (k-row) frame."""
    order = F.col(col).asc() if ascending else F.col(col).desc()
    return F.rank().over(W.orderBy(order)) + (F.count(F.lit(1)).over(W.partitionBy(col)) - 1) / 2.0


def score_clusters(summary: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """R/F/M average-tie ranks, Total_Score, Position (1 = best) and Segment label.

    Recency ranks descending (recent = small = high score), Frequency and
    Monetary ascending. Equal totals are ordered by cluster id. Clusters beyond
    the four named positions get a null Segment.
    """
    s = summary.select(
        "*",
        average_rank("Recency", ascending=False).alias("R_Score"),
        average_rank("Frequency").alias("F_Score"),
        average_rank("Monetary").alias("M_Score"),
    ).withColumn("Total_Score", F.col("R_Score") + F.col("F_Score") + F.col("M_Score"))
    s = s.withColumn("Position", F.row_number().over(W.orderBy(F.col("Total_Score").desc(), F.col(cluster).asc())))
    names = F.array(*[F.lit(n) for n in SEGMENT_ORDER])
    return s.withColumn("Segment", F.when(F.col("Position") <= len(SEGMENT_ORDER),
                                          F.element_at(names, F.col("Position"))))


def label_customers(df: DataFrame, labels: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """Segment per customer (left lookup of the k-row label table) and
    ChurnProbability = Recency / max(Recency) (scalar subquery)."""
    out = join_small(df, labels.select(cluster, "Segment"), cluster)
    max_r = df.agg(F.max("Recency")).scalar()
    return out.withColumn("ChurnProbability", F.col("Recency") / max_r)


def segment_metrics(labeled: DataFrame) -> DataFrame:
    """Per present segment: Count, Revenue_Share (% of summed Monetary),
    Avg_Recency, Avg_Frequency, Avg_Monetary, Churn_Probability (mean); with a
    Monetary_raw column also Revenue_Share_raw, the share of unlogged money."""
    raw = "Monetary_raw" in labeled.columns
    money = ["Monetary", "Monetary_raw"] if raw else ["Monetary"]
    s = labeled.where(F.col("Segment").isNotNull()).groupBy("Segment").agg(
        F.count(F.lit(1)).alias("Count"), *[F.sum(c).alias(f"_{c}") for c in money],
        F.avg("Recency").alias("Avg_Recency"), F.avg("Frequency").alias("Avg_Frequency"),
        F.avg("Monetary").alias("Avg_Monetary"), F.avg("ChurnProbability").alias("Churn_Probability"))
    for c in money:
        share = F.col(f"_{c}") * 100.0 / labeled.agg(F.sum(c)).scalar()
        s = s.withColumn("Revenue_Share" + c.removeprefix("Monetary"), share).drop(f"_{c}")
    return s


def labeled_summary(metrics: DataFrame, rounded: bool = True) -> DataFrame:
    """The four fixed segments in order, absent ones filled with 0.

    With ``rounded`` the reference report precision is applied: share 1 dp,
    recency 0 dp, frequency 1 dp, monetary 2 dp, churn 2 dp.
    """
    spark = metrics.sparkSession
    fixed = spark.createDataFrame([(i, s) for i, s in enumerate(SEGMENT_ORDER)], "ord int, Segment string")
    j = fixed.join(metrics, on="Segment", how="left")
    cols = {"Count": 0, "Revenue_Share": 1, "Avg_Recency": 0, "Avg_Frequency": 1, "Avg_Monetary": 2,
            "Churn_Probability": 2}
    out = [F.col("ord"), F.col("Segment"), F.coalesce(F.col("Count"), F.lit(0)).cast("bigint").alias("Count")]
    for c, d in cols.items():
        if c == "Count":
            continue
        v = F.coalesce(F.col(c), F.lit(0.0))
        out.append((np_round(v, d) if rounded else v).alias(c))
    return j.select(*out).withColumnRenamed("Revenue_Share", "Revenue_Share_%")


def cluster_mean_matrix(summary: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """Cluster means and their min-max normalised copies (``<col>_norm``);
    a column with equal values across clusters normalises to null (pandas NaN)."""
    out = summary.select(cluster, "Recency", "Frequency", "Monetary")
    w = W.partitionBy()
    for c in ("Recency", "Frequency", "Monetary"):
        out = out.withColumn(f"{c}_norm", F.try_divide(F.col(c) - F.min(c).over(w), F.max(c).over(w) - F.min(c).over(w)))
    return out


def box_summary(df: DataFrame, cluster: str = "Cluster", cols=("Recency", "Frequency", "Monetary")) -> DataFrame:
    """Box-plot numbers per (cluster, feature) over all rows: Q1, median, Q3,
    whiskers at the most extreme values inside 1.5 IQR, and the outlier count.

    The quartiles of all clusters are selected together, one column for each
    (cluster, feature); k clusters make k rows of them.
    """
    from tillroll.operators.quantiles import percentiles_exact
    ids = sorted(r[0] for r in df.where(F.col(cluster).isNotNull()).select(cluster).distinct().collect())  # k rows
    names = {f"c{i}_{c}": (x, c) for i, x in enumerate(ids) for c in cols}
    wide = df.select(*[F.when(F.col(cluster) == x, F.col(c).cast("double")).alias(n) for n, (x, c) in names.items()])
    got = percentiles_exact(wide, list(names), [0.25, 0.5, 0.75]) if names else {}
    kind = df.schema[cluster].dataType.simpleString()
    q = df.sparkSession.createDataFrame([(*names[n], v[0.25], v[0.5], v[0.75]) for n, v in got.items()],
                                        f"`{cluster}` {kind}, feature string, q1 double, median double, q3 double")
    long = df.select(cluster, F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(c).cast("double"))])
                     .alias("feature", "value"))
    j = join_small(long, q, [cluster, "feature"], "inner")
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    return j.groupBy(cluster, "feature", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def pair_plot(df: DataFrame, cluster: str = "Cluster", cols=("Recency", "Frequency", "Monetary"), key: str = "Customer ID",
              n: int = 5000, bins: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The tables behind the cluster pair plot: a sample of n customers with
    their cluster, and per (cluster, feature) a histogram over all customers
    on edges shared by the clusters."""
    from tillroll.functions.columns import attach_row
    from tillroll.operators.sampling import random_sample
    points = random_sample(df.select(key, cluster, *cols), n, key, seed, tiebreak=[key])
    edges = df.agg(*[f(c).cast("double").alias(f"{f.__name__}_{c}") for c in cols for f in (F.min, F.max)])
    rows = attach_row(df.select(cluster, *cols), edges)
    parts = []
    for c in cols:
        lo, hi = F.col(f"min_{c}"), F.col(f"max_{c}")
        b = F.when(hi > lo, F.least(F.floor((F.col(c) - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
        parts += [F.lit(c), b.cast("int"), lo, hi]
    cells = rows.select(cluster, F.stack(F.lit(len(cols)), *parts).alias("feature", "bin", "lo", "hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    return points, (cells.where("bin is not null").groupBy(cluster, "feature", "bin", "lo", "hi")
                    .agg(F.count(F.lit(1)).alias("count"))
                    .select(cluster, "feature", "bin", (F.col("lo") + F.col("bin") * step).alias("bin_start"), "count"))


def rfm_summary(rfm: DataFrame, medians: dict | None = None) -> DataFrame:
    """One row: mean and median of Recency, Frequency, Monetary (exact medians;
    ``medians`` {col: {0.5: value}} may be passed in when already computed)."""
    from tillroll.operators.quantiles import percentiles_exact
    med = medians or percentiles_exact(rfm, ["Recency", "Frequency", "Monetary"], [0.5])
    base = rfm.agg(F.count(F.lit(1)).alias("customers"),
                   *[F.avg(c).alias(f"{c}_mean") for c in ("Recency", "Frequency", "Monetary")])
    return base.select("*", *[F.lit(med[c][0.5]).cast("double").alias(f"{c}_median")
                              for c in ("Recency", "Frequency", "Monetary")])
