"""Classifier metrics against hand / brute-force computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import classification as CF
from tillroll.operators import sampling as SM


def test_report_and_confusion(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    counts = CF.confusion_counts(spark.createDataFrame(rows, "actual string, predicted string"), "actual", "predicted")
    rep = {r["label"]: r for r in CF.classification_report(counts).collect()}
    assert rep["a"]["precision"] == 0.5 and rep["a"]["recall"] == 0.5
    assert rep["b"]["precision"] == pytest.approx(2 / 3) and rep["b"]["recall"] == 1.0
    assert rep["c"]["precision"] == 0.0 and rep["c"]["f1"] == 0.0  # zero_division = 0
    assert rep["accuracy"]["f1"] == 0.6 and rep["accuracy"]["support"] == 5
    w = rep["weighted avg"]
    assert w["recall"] == pytest.approx(0.6)
    grid = CF.confusion_grid(counts).collect()
    assert len(grid) == 9 and sum(r["count"] for r in grid) == 5


def test_classes_may_be_named_like_report_rows(spark):
    rows = [("accuracy", "accuracy"), ("accuracy", "weighted avg"), ("weighted avg", "weighted avg"), ("x", "x")]
    df = spark.createDataFrame([(a, p, 0.5) for a, p in rows], "actual string, predicted string, s double")
    counts = CF.confusion_counts(df, "actual", "predicted")
    steps = CF.score_counts(CF.one_vs_rest(df, "actual", {c: F.col("s") for c in ("accuracy", "weighted avg", "x")}))
    row, = CF.summary_metrics(counts, steps).collect()
    assert row["accuracy"] == 0.75 and row["recall_weighted"] == 0.75 and row["roc_auc_weighted"] == 0.5


def steps_of(spark, y, s):
    rows = [("c", bool(a), float(b)) for a, b in zip(y, s)]
    return CF.score_counts(spark.createDataFrame(rows, "class string, positive boolean, score double"))


@pytest.mark.parametrize("outlier", [None, 1e12])
def test_auc_and_curve_match_plain(spark, outlier, monkeypatch):
    monkeypatch.setattr(CF, "BUCKET_SCORES", 3)
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400).astype(bool)
    s = np.round(rng.normal(y * 0.7, 1.0), 1)  # many ties
    if outlier:
        s[0] = outlier
    df = steps_of(spark, y, s)
    got = CF.roc_auc_by_class(df).first()["auc"]
    pos, neg = s[y], s[~y]
    brute = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(brute, rel=1e-12)
    curve = CF.roc_curve(df).orderBy("fpr", "tpr").collect()
    f = [r["fpr"] for r in curve]
    t = [r["tpr"] for r in curve]
    assert np.trapezoid(t, f) == pytest.approx(brute, rel=1e-9)
    # the plain curve, without the scores where it goes straight on
    score = np.unique(s)[::-1]
    fps, tps = np.array([(neg >= x).sum() for x in score]), np.array([(pos >= x).sum() for x in score])
    keep = np.r_[True, (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0), True]
    assert sorted(r["threshold"] for r in curve) == pytest.approx(sorted([np.inf, *score[keep]]))


def test_metric_queries_scan_the_table_once(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    for name in ("classify_metrics", "classify_report", "classify_confusion", "classify_roc_curve"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "c_custkey" not in plan and "c_mktsegment" not in plan, name  # only the stored counts are left


def test_label_encoding_alphabetical(spark):
    df = spark.createDataFrame([("Tuesday",), ("Monday",), ("Friday",), ("Monday",)], "FavoriteDay string")
    got = {r[0]: r[1] for r in CF.label_encode(df, "FavoriteDay").distinct().collect()}
    assert got == {"Friday": 0, "Monday": 1, "Tuesday": 2}


def test_stratified_split_exact_counts(spark):
    rows = [(i, "A" if i % 3 else "B") for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, cls string")
    out = SM.stratified_split(df, "cls", "id", 0.2, 42)
    counts = {r["cls"]: r["n"] for r in out.where("is_test").groupBy("cls").count().withColumnRenamed("count", "n").collect()}
    na, nb = sum(1 for _, c in rows if c == "A"), sum(1 for _, c in rows if c == "B")
    assert counts == {"A": int(np.floor(na * 0.2 + 0.5)), "B": int(np.floor(nb * 0.2 + 0.5))}
    # same rows as a plain per-class row_number over the hash order
    from pyspark.sql import Window as W
    ref = df.withColumn("r", F.row_number().over(W.partitionBy("cls").orderBy(SM.hash_key("id", 42), "id")))
    a = {r["id"] for r in out.where("is_test").collect()}
    b = {r["id"] for r in ref.join(df.groupBy("cls").count(), "cls")
         .where(F.col("r") <= F.floor(F.col("count") * 0.2 + 0.5)).collect()}
    assert a == b


def test_cluster_safe_sample(spark):
    rows = [(i, 0 if i < 990 else 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, label int")
    s = SM.cluster_safe_sample(df, "label", "id", n=100)
    assert s.count() == 100 and s.select("label").distinct().count() == 2
    assert SM.cluster_safe_sample(df, "label", "id", n=2000).count() == 1000
    one = SM.cluster_safe_sample(df.withColumn("label", F.lit(7)), "label", "id", n=100)
    assert one.count() == 1000  # one label: the table itself
    many = SM.cluster_safe_sample(df.withColumn("label", F.col("id") % 300), "label", "id", n=100)
    assert sorted(r["id"] for r in many.collect()) == list(range(300))  # every label keeps its first row


def test_random_sample_is_the_first_n_of_the_order_at_any_size(spark):
    df = spark.range(20_000).repartition(7)
    want = {r["id"] for r in df.orderBy(SM.hash_key("id"), "id").limit(50).collect()}
    assert {r["id"] for r in SM.random_sample(df, 50, "id", tiebreak=["id"]).collect()} == want
    assert SM.random_sample(df, 30_000, "id").count() == 20_000


def test_sample_sketch_has_the_first_rows_and_all_counts(spark):
    df = (spark.range(60_000).repartition(5)
          .select(F.col("id").alias("Row ID"), F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("label"),
                  F.when(F.col("id") % 5 > 0, F.lit("x")).alias("t"), F.array("id").alias("list")))
    plain = df.orderBy(SM.hash_key("Row ID"), "Row ID").limit(40).collect()
    sketch = SM.sample_sketch(df, 40, [SM.hash_key("Row ID"), F.col("Row ID")], "label", "Row ID")
    first = {r["label"]: r["n"] for r in sketch.where("_first").groupBy("label").agg(F.sum("_rows").alias("n")).collect()}
    assert first == {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    assert sketch.count() <= 5 * (40 + 7)
    low = sketch.where("not _first").orderBy(SM.hash_key("Row ID"), "Row ID").limit(40)
    assert low.select(df.columns).collect() == plain
    assert SM.random_sample(df, 40, "Row ID", tiebreak=["Row ID"]).orderBy("Row ID").collect() == sorted(plain)

    # the sample by its definition: least key of each label, then the rest in hash order
    rows = {r["Row ID"]: r for r in df.collect()}
    order = [r["Row ID"] for r in df.orderBy(SM.hash_key("Row ID")).select("Row ID").collect()]
    reps = set(range(7))
    want = reps | set([i for i in order if i not in reps][:33])
    got = SM.cluster_safe_sample(df, "label", "Row ID", n=40).collect()
    assert {r["Row ID"] for r in got} == want and len(got) == 40
    assert all(rows[r["Row ID"]] == r for r in got)


def test_samples_of_odd_tables(spark):
    df = spark.range(500).withColumn("label", F.col("id") % 2).repartition(3)
    none = df.limit(0)
    assert SM.random_sample(none, 5, "id").count() == SM.cluster_safe_sample(none, "label", "id", n=5).count() == 0
    assert SM.random_sample(df, 0, "id").count() == 0
    same = df.select(F.lit(1).alias("id"), "label")  # repeated keys: still n rows, both labels
    got = SM.cluster_safe_sample(same, "label", "id", n=20).collect()
    assert len(got) == 20 and {r["label"] for r in got} == {0, 1}
    nulls = df.select(F.when(F.col("label") == 1, F.col("id")).alias("id"), "label")
    got = SM.cluster_safe_sample(nulls, "label", "id", n=20).collect()
    assert len(got) == 20 and {r["label"] for r in got} == {0, 1}


def test_forest_fit_and_predict(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        seg = ["At Risk", "Champions"][i % 2]
        rows.append((i, float(rng.normal(10 if i % 2 else 0, 1)), 1.0, 0.5, i % 7, i % 3, seg))
    df = spark.createDataFrame(rows, "id long, AvgBasketValue double, AvgBasketSize double, Volatility double, "
                                     "FavoriteDay_Encoded int, Country_Encoded int, Segment string")
    model = CF.fit_forest(df, num_trees=10, max_depth=4)
    pred = CF.predict(model, df)
    acc = pred.where("predicted_class = Segment").count() / 200
    assert acc > 0.9
    assert CF.class_names(model) == ["At Risk", "Champions"]
    imp = CF.feature_importance(model).collect()
    assert imp[0]["Feature"] == "AvgBasketValue"
    again = CF.fit_forest(df.repartition(7), num_trees=10, max_depth=4)
    a, b = ([list(r["probabilities"]) for r in CF.predict(m, df).orderBy("id").collect()] for m in (model, again))
    assert a == b  # the layout of the input has no part in the fit
