"""Runs and models are seen whole or not at all."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest

from tillroll.sources import tracking as TR


def test_a_retried_step_leaves_one_run(spark, tmp_path, monkeypatch):
    path, run_id = str(tmp_path / "runs"), TR.step_run_id("p1", "clean")
    assert run_id == TR.step_run_id("p1", "clean") != TR.step_run_id("p2", "clean")

    def dies(*a):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(TR, "_commit", dies)
        with pytest.raises(RuntimeError):
            TR.log_run(spark, path, "clean", "clean", {"a": 1, "half": 2}, run_id=run_id)
    assert TR.runs(spark, path).count() == 0 and TR.latest_run_id(spark, path, "clean") is None
    for value in (3, 4):  # the second try commits, the third finds its commit
        assert TR.log_run(spark, path, "clean", "clean", {"a": value}, {"m": 1.0}, run_id=run_id) == run_id
    rows = {(r["kind"], r["key"], r["value"]) for r in TR.latest_run(spark, path, "clean").collect()}
    assert rows == {("param", "a", "3"), ("metric", "m", "1.0")} and TR.runs(spark, path).count() == 2


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "runs")
    at = dt.datetime(2024, 1, 1)
    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(lambda i: TR.log_run(spark, path, f"s{i % 2}", "s", {"i": i}, start_time=at + dt.timedelta(seconds=i)), range(8)))
    rows = TR.runs(spark, path).collect()
    assert {r["run_id"] for r in rows} == set(ids) and sorted(int(r["value"]) for r in rows) == list(range(8))
    assert TR.latest_param(spark, path, "s0", "i") == "6" and TR.latest_param(spark, path, "s1", "i") == "7"


def test_a_bundle_is_replaced_at_once(spark, tmp_path, monkeypatch):
    params = spark.createDataFrame([(f, 0.0, 1.0) for f in ("Recency", "Frequency", "Monetary")], "feature string, mean double, scale double")
    path = str(tmp_path / "b")
    TR.save_rfm_bundle(spark, path, params, [(0, [1.0, 2.0, 3.0])], {0: "A"})
    broken = params.withColumn("scale", params["scale"] * 5)
    with monkeypatch.context() as m:  # dies after the new scaler, before the centroids
        m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            TR.save_rfm_bundle(spark, path, broken, [(0, [9.0, 9.0, 9.0])], {0: "B"})
    assert TR.load_rfm_bundle(spark, path).segments == {0: "A"} and TR.load_rfm_bundle(spark, path).scales == [1.0] * 3
    TR.save_rfm_bundle(spark, path, broken, [(0, [9.0, 9.0, 9.0])], {0: "B"})
    assert TR.load_rfm_bundle(spark, path).segments == {0: "B"}
