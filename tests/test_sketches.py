"""Quantile sketches and the silhouette estimate against exact values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tillroll.operators import clustering as CL
from tillroll.operators import quantiles as QU

PROBS = [0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0]


def test_merged_sketches_keep_to_the_bound(spark, tmp_path):
    df = spark.range(60_000).select((F.pmod(F.xxhash64("id"), F.lit(10**6)) / 7).alias("x"), (F.col("id") % 11).cast("double").alias("y"),
                                    (F.col("id") % 5).alias("day"))
    df = df.withColumn("x", F.when(F.col("day") == 3, F.lit(0.5)).otherwise(F.col("x")))  # a fifth of the rows are equal
    QU.quantile_sketches(df, ["x", "y"], ["day"]).write.partitionBy("day").parquet(str(tmp_path / "s"))
    kept = spark.read.parquet(str(tmp_path / "s"))
    got = QU.sketch_quantiles(QU.merge_sketches(kept, []), PROBS)
    assert got.count() == 2 * len(PROBS) and got.where("n = 60000").count() == 2 * len(PROBS)
    errors = [r["error"] for r in QU.rank_errors(df, got).collect()]
    assert max(errors) <= QU.sketch_error(800) < 0.012
    exact = QU.percentiles_exact(df, ["x", "y"], PROBS)
    near = {(r["col"], r["p"]): r["value"] for r in got.collect()}
    assert near["y", 0.5] == exact["y"][0.5] and near["x", 1.0] == exact["x"][1.0] and near["x", 0.0] == exact["x"][0.0]


def test_nulls_nan_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None)], "g string, x double")
    s = QU.quantile_sketches(df, ["x"], ["g"])
    got = {r["g"]: (r["n"], r["value"]) for r in QU.sketch_quantiles(s, [0.5]).collect()}
    assert got == {"a": (1, 1.0), "b": (0, None)}
    assert [(r["n"], r["value"]) for r in QU.sketch_quantiles(QU.merge_sketches(s, []), [0.5]).collect()] == [(1, 1.0)]
    assert QU.sketch_quantiles(QU.quantile_sketches(df.limit(0), ["x"], ["g"]), [0.5]).count() == 0


def exact_silhouette(x, own):
    d = np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ x.T + (x**2).sum(1)))
    np.fill_diagonal(d, 0)
    k = own.max() + 1
    n = np.bincount(own, minlength=k)
    sums = np.stack([d[:, own == c].sum(axis=1) for c in range(k)], axis=1)
    rows = np.arange(len(x))
    a = sums[rows, own] / np.maximum(1, n[own] - 1)
    mean = sums / n
    mean[rows, own] = np.inf
    b = mean.min(axis=1)
    return np.where(n[own] > 1, (b - a) / np.maximum(a, b), 0.0).mean()


@pytest.mark.parametrize("table", ["embeddings", "blobs"])
def test_interval_covers_the_exact_value_in_95_of_100_seeds(spark, table):
    rng = np.random.default_rng(2)
    if table == "embeddings":
        pdf = spark.read.parquet(f"{SF_MID}/embeddings.parquet").toPandas()
        x, label = np.array(pdf["embedding"].tolist(), float), pdf["label"].to_numpy()
    else:
        label = rng.choice(4, 3000, p=[0.5, 0.3, 0.15, 0.05])
        x = rng.normal(size=(3000, 3)) + 2 * rng.normal(size=(4, 3))[label]
    own = np.unique(label, return_inverse=True)[1]
    sizes, key = np.bincount(own), np.arange(len(x))
    centres = np.array([x[own == c].mean(axis=0) for c in range(len(sizes))])
    spread = np.array([((x[own == c] - centres[c]) ** 2).sum(axis=1).mean() for c in range(len(sizes))])
    want, reference, parts, covered = exact_silhouette(x, own), 24 if table == "embeddings" else 96, 12, 0
    for seed in range(100):
        r = np.random.default_rng(seed)
        refs = [r.permutation(np.flatnonzero(own == c))[:reference] for c in range(len(sizes))]
        sums = CL.silhouette_replicates(x, own, key, [x[i] for i in refs], refs, sizes, centres, spread, parts)
        value, low, high = CL.jackknife(sums, len(x))
        covered += low <= want <= high
        assert abs(value - want) < 0.05
    assert covered >= 95


def test_estimate_of_a_table_is_exact_within_the_reference(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(40, 2)), rng.normal(4, 1, size=(25, 2)), [[20.0, 20.0]]])
    own = np.r_[np.zeros(40, int), np.ones(25, int), 2]
    df = spark.createDataFrame([(i, [float(v) for v in p], f"c{o}") for i, (p, o) in enumerate(zip(x, own, strict=True))], "id long, vec array<double>, c string")
    row = CL.silhouette_estimate(df.repartition(5), "id", "vec", "c").first()
    assert row["n"] == 66 and row["silhouette"] == pytest.approx(exact_silhouette(x, own), abs=1e-9) and row["high"] - row["low"] < 1e-9
    some = CL.silhouette_estimate(df.repartition(5), "id", "vec", "c", reference=20, parts=8).first()
    assert some["low"] <= row["silhouette"] <= some["high"] and some["high"] > some["low"]
    assert CL.silhouette_estimate(df.where("c = 'c0'"), "id", "vec", "c").first()["silhouette"] == 0.0
