"""Segment classifier: encoding, forest fit / predict, and evaluation metrics.

Evaluation works from two small stored tables: the confusion counts (one row
for each pair of classes that occurs), from which report, accuracy and averages
follow, and the per-(class, score) positive / negative counts. Cumulative
counts over scores use range buckets with about as many distinct scores each,
so no task sorts a whole class.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.functions.columns import attach_row, importance_band, join_small
from tillroll.operators import forest
from tillroll.sources.sinks import materialize

BUCKET_SCORES = 50_000  # distinct scores that a range bucket may be expected to hold
# The classifier's inputs in model order.
FEATURES = ["AvgBasketValue", "AvgBasketSize", "Volatility", "FavoriteDay_Encoded", "Country_Encoded"]


# ----------------------------------------------------------------- encoding
def label_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(value, code) with codes 0.. in alphabetical order of the string form.

    Values are numbered by a sort over range partitions: a value's code is its
    place within its partition plus the values before that partition."""
    out = out or f"{col}_Encoded"
    vals = df.select(F.col(col).cast("string").alias(col)).where(F.col(col).isNotNull()).distinct()
    placed = materialize(vals.repartitionByRange(col).withColumn("_part", F.spark_partition_id()), "codes")
    size = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    before = size.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(W.partitionBy("_part").orderBy(col))
    return join_small(placed, before, "_part", "inner").select(
        col, (F.col("_before") + within - 1).cast("int").alias(out))


def label_encode(df: DataFrame, col: str, out: str | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Alphabetical integer codes for a categorical column (LabelEncoder)."""
    out = out or f"{col}_Encoded"
    codes = codes if codes is not None else label_codes(df, col, out)
    codes = codes.select(F.col(col).alias("_value"), out)
    return (join_small(df.withColumn("_value", F.col(col).cast("string")), codes, "_value")
            .select(*df.columns, out))


def encode_features(df: DataFrame) -> DataFrame:
    return label_encode(label_encode(df, "FavoriteDay"), "Country")


# ------------------------------------------------------------------- model
def fit_forest(train: DataFrame, features: list[str] = FEATURES, label: str = "Segment", num_trees: int = 100,
               max_depth: int | None = None, seed: int = 42, growth: forest.Growth | None = None) -> forest.Forest:
    """Random forest (Gini, sqrt features, no depth limit) over numeric features; classes in alphabetical order."""
    g = growth or forest.Growth(trees=num_trees, max_depth=max_depth, max_features=max(1, isqrt(len(features))), seed=seed)
    return forest.fit(train, features, label, g)


def fit_forest_raw(train: DataFrame, label: str = "Segment", num_trees: int = 100, max_depth: int | None = None,
                   seed: int = 42) -> forest.Forest:
    """Forest over raw FavoriteDay / Country strings: the model holds their
    alphabetical codes, and gives unseen values an extra one."""
    g = forest.Growth(trees=num_trees, max_depth=max_depth, max_features=max(1, isqrt(len(FEATURES))), seed=seed)
    return forest.fit(train, FEATURES, label, g, raw=("FavoriteDay", "Country"))


def class_names(model: forest.Forest) -> list[str]:
    return model.labels


def predict(model: forest.Forest, df: DataFrame) -> DataFrame:
    """Adds predicted_class (name), prediction (code) and probabilities (array<double>)."""
    return forest.predict(model, df)


def feature_importance(model, features: list[str] = FEATURES) -> DataFrame:
    """Feature, Importance (descending) and the chart band."""
    imp = model.importance.tolist()
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    df = s.createDataFrame(list(zip(features, [float(x) for x in imp])), "Feature string, Importance double")
    return df.withColumn("Band", importance_band("Importance")).orderBy(F.col("Importance").desc(), "Feature")


# ----------------------------------------------------------------- metrics
def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """actual, predicted, n: the one pass over the predictions, stored."""
    return materialize(df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
                       .agg(F.count(F.lit(1)).alias("n")), "confusion")


def confusion_grid(counts: DataFrame) -> DataFrame:
    """Full k x k grid with row percents (absent pairs count 0)."""
    classes = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).agg(F.collect_set("c").alias("c"))
    grid = classes.select(F.explode("c").alias("actual"), "c").select("actual", F.explode("c").alias("predicted"))
    size = F.sum("n").over(W.partitionBy("actual"))
    return (grid.join(counts.withColumn("p", F.col("n") * 100.0 / size), ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
                    F.coalesce("p", F.lit(0.0)).alias("row_percent")))


def per_class(counts: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support (zero_division = 0)."""
    hit = F.col("actual").eqNullSafe(F.col("predicted"))
    each = counts.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("s"), F.lit(0).cast("long").alias("p"),
                 F.when(hit, F.col("n")).otherwise(0).alias("t")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("s"), F.col("n").alias("p"),
                 F.lit(0).cast("long").alias("t")))).alias("e")).select("e.*")
    sums = each.groupBy("label").agg(F.sum("s").alias("s"), F.sum("p").alias("p"), F.sum("t").alias("t"))
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    out = sums.select("label", ratio(F.col("t"), F.col("p")).alias("precision"),
                      ratio(F.col("t"), F.col("s")).alias("recall"), F.col("s").cast("bigint").alias("support"))
    both = F.col("precision") + F.col("recall")
    return out.select("label", "precision", "recall",
                      ratio(2 * F.col("precision") * F.col("recall"), both).alias("f1"), "support")


def averages(counts: DataFrame) -> DataFrame:
    """One row: accuracy, macro_ and weighted_ precision, recall and f1, support.

    From the counts alone, so a class may have any name."""
    n = F.sum("support")
    out = per_class(counts).agg(
        n.cast("bigint").alias("support"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[(F.sum(F.col(c) * F.col("support")) / n).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")])
    right = F.sum(F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0))
    return attach_row(counts.agg((right / F.sum("n")).alias("accuracy")), out)


def classification_report(counts: DataFrame) -> DataFrame:
    """Per-class rows plus 'accuracy', 'macro avg' and 'weighted avg' rows."""
    none = F.lit(None).cast("double")
    row = lambda label, p, r, f: F.struct(
        F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("support"))
    total = averages(counts).select(F.explode(F.array(
        row("accuracy", none, none, F.col("accuracy")),
        *[row(f"{kind} avg", *[F.col(f"{kind}_{c}") for c in ("precision", "recall", "f1")])
          for kind in ("macro", "weighted")])).alias("r")).select("r.*")
    return per_class(counts).unionByName(total)


def score_counts(long: DataFrame) -> DataFrame:
    """(class, score, pos, neg, neg_below, pos_below, pos_next, neg_next) from
    rows (class, positive, score), stored.

    ``*_below`` count rows of the same class with a strictly smaller score,
    ``*_next`` those at the next smaller score (null at the smallest). Bucket
    edges are approximate quantiles of the distinct scores, so a far-off score
    doesn't crowd the others; the buckets grow in number with the scores.
    """
    counts = materialize(long.groupBy("class", "score").agg(
        F.count_if(F.col("positive")).alias("pos"), F.count_if(~F.col("positive")).alias("neg")), "score-counts")
    buckets = max(16, -(-counts.count() // BUCKET_SCORES))
    shares = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)])
    edges = counts.groupBy("class").agg(F.array_distinct(F.percentile_approx("score", shares, F.lit(10 * buckets))).alias("_e"))
    b = F.size(F.filter("_e", lambda e: e < F.col("score")))
    cb = join_small(counts, edges, "class", "inner").withColumn("_b", b).drop("_e")
    last = F.max_by(F.struct("pos", "neg"), "score")
    tot = cb.groupBy("class", "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"), last.alias("_last"))
    w = W.partitionBy("class").orderBy("_b")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    off = tot.select("class", "_b", F.coalesce(F.sum("_bp").over(before), F.lit(0)).alias("_op"),
                     F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"), F.lag("_last").over(w).alias("_prev"))
    win = W.partitionBy("class", "_b").orderBy("score")
    below = win.rowsBetween(W.unboundedPreceding, -1)
    out = (cb.join(off, ["class", "_b"])
           .withColumn("neg_below", F.col("_on") + F.coalesce(F.sum("neg").over(below), F.lit(0)))
           .withColumn("pos_below", F.col("_op") + F.coalesce(F.sum("pos").over(below), F.lit(0)))
           .withColumn("_next", F.coalesce(F.lag(F.struct("pos", "neg")).over(win), F.col("_prev"))))
    return materialize(out.select("class", "score", "pos", "neg", "neg_below", "pos_below",
                                  F.col("_next.pos").alias("pos_next"), F.col("_next.neg").alias("neg_next")), "score-steps")


def roc_auc_by_class(steps: DataFrame) -> DataFrame:
    """class, positives, negatives, auc (rank statistic with average ties) from ``score_counts``."""
    agg = steps.groupBy("class").agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("_u"))
    auc = F.when((F.col("positives") == 0) | (F.col("negatives") == 0), F.lit(None).cast("double")).otherwise(
        F.col("_u") / (F.col("positives") * F.col("negatives")))
    return agg.select("class", F.col("positives").cast("bigint").alias("positives"),
                      F.col("negatives").cast("bigint").alias("negatives"), auc.alias("auc"))


def roc_auc_weighted(steps: DataFrame) -> DataFrame:
    """One row: support-weighted one-vs-rest AUC; 0.0 when some class lacks
    positives or negatives."""
    a = roc_auc_by_class(steps)
    return a.agg(F.when(F.count_if(F.col("auc").isNull()) > 0, F.lit(0.0)).otherwise(
        F.sum(F.col("auc") * F.col("positives")) / F.sum("positives")).alias("roc_auc_weighted"))


def roc_curve(steps: DataFrame) -> DataFrame:
    """class, threshold, fpr, tpr from ``score_counts``: the (inf, 0, 0) start of
    each class, then its distinct scores, without those where the curve goes
    straight on (as many positives and negatives as the next score has)."""
    tot = steps.groupBy("class").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.max("score").alias("top"))
    corner = (F.col("score") == F.col("top")) | F.col("pos_next").isNull() | (
        F.col("pos") != F.col("pos_next")) | (F.col("neg") != F.col("neg_next"))
    j = join_small(steps, tot, "class", "inner").where(corner)
    pts = j.select("class", F.col("score").alias("threshold"),
                   ((F.col("N") - F.col("neg_below")) / F.col("N")).alias("fpr"),
                   ((F.col("P") - F.col("pos_below")) / F.col("P")).alias("tpr"))
    start = tot.select("class", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                       F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def one_vs_rest(df: DataFrame, actual: str, scores: dict[str, Column]) -> DataFrame:
    """Long (class, positive, score) rows: one per (row, class)."""
    parts = [F.struct(F.lit(c).alias("class"), (F.col(actual) == F.lit(c)).alias("positive"),
                      s.cast("double").alias("score")) for c, s in scores.items()]
    return df.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def class_scores(pred: DataFrame, actual: str, names: list[str], probabilities: str = "probabilities") -> DataFrame:
    """Long (class, positive, score) rows from predicted probabilities."""
    classes = F.array(*[F.lit(n) for n in names])
    return (pred.select(actual, F.posexplode(probabilities).alias("idx", "score"))
            .select(F.element_at(classes, F.col("idx") + 1).alias("class"), F.col(actual).alias("_actual"), "score")
            .select("class", (F.col("_actual") == F.col("class")).alias("positive"), "score"))


def summary_metrics(counts: DataFrame, steps: DataFrame) -> DataFrame:
    """One row: accuracy, weighted precision / recall / f1, weighted ROC-AUC."""
    w = averages(counts).select("accuracy", F.col("weighted_precision").alias("precision_weighted"),
                                F.col("weighted_recall").alias("recall_weighted"), F.col("weighted_f1").alias("f1_weighted"))
    return attach_row(w, roc_auc_weighted(steps))
