"""End-to-end run of the six steps (what bench.py times) on the smallest tables."""

from tillroll.plans.steps import run_pipeline
from tillroll.sources.tables import retail_dirty

from conftest import SF_SMALL


def test_run_pipeline_end_to_end(spark):
    out = run_pipeline(spark, retail_dirty(spark, SF_SMALL), out_dir=None, num_trees=10)
    steps = set(out["timings"])
    assert {"load", "clean", "profile", "preprocess", "eda", "clustering", "cluster_metrics", "labelling",
            "classifier"} <= steps
    res = out["results"]
    assert res["labelling"].tables["labeled_summary"].count() == 4
    q = res["cluster_metrics"].tables["quality"].first()
    assert -1.0 <= q["silhouette"] <= 1.0 and q["k"] == 4
    rep = {r["label"] for r in res["classifier"].tables["classification_report"].collect()}
    assert {"accuracy", "macro avg", "weighted avg"} <= rep
    assert res["clean"].tables["clean"].count() > 0


def test_outputs_reports_runs_and_the_saved_forest(spark, tmp_path):
    from tillroll.operators import classification as CF
    from tillroll.sources import tracking as TR
    runs, out_dir = str(tmp_path / "runs"), str(tmp_path / "out")
    out = run_pipeline(spark, retail_dirty(spark, SF_SMALL), out_dir=out_dir, runs_path=runs, num_trees=5, sweep=True, n_init=2)
    names = {r[0] for r in TR.runs(spark, runs).select("run_name").distinct().collect()}
    assert names == {"profile", "preprocess", "eda", "cluster_metrics", "labelling", "classifier"}
    for step, key in (("profile", "missing_pct_Customer_ID"), ("preprocess", "dropped_duplicates"), ("eda", "total_revenue"),
                      ("cluster_metrics", "silhouette_k10"), ("labelling", "total_customers"), ("classifier", "accuracy")):
        got = {r["key"]: r["value_num"] for r in TR.latest_run(spark, runs, step).where("kind = 'metric'").collect()}
        assert got[key] is not None, step
    for step in ("profile", "preprocess", "labelling", "classifier"):
        assert spark.read.text(f"{out_dir}/{step}/report").count() > 5
    res = out["results"]["classifier"]
    loaded = TR.load_latest_model(spark, runs, "classifier")
    pred = res.tables["predictions"]
    again = CF.predict(loaded, pred.select("Customer ID", *CF.FEATURES))
    same = pred.alias("a").join(again.alias("b"), "Customer ID").where("a.probabilities = b.probabilities")
    assert same.count() == pred.count() > 0


def test_scratch_is_dropped_on_demand(spark, monkeypatch):
    import os

    from tillroll import session
    monkeypatch.setattr(session, "_SCRATCH", [])
    path = session.scratch_path(spark, "drop")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    session.drop_scratch(spark)
    assert not os.path.exists(local) and session._SCRATCH == []
