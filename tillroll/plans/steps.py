"""The six analysis steps as Spark plans, and the end-to-end run.

profile -> preprocess -> EDA -> RFM + K-Means -> labelling -> classifier.
Steps hand over DataFrames; the few frames reused by several steps (clean
lines, RFM, labelled customers) are materialised once as Parquet in the
shared checkpoint folder, which also cuts their lineage.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER, with_total_price
from tillroll.operators import basket as BK
from tillroll.operators import classification as CF
from tillroll.operators import clean as C
from tillroll.operators import clustering as CL
from tillroll.operators import eda as EDA
from tillroll.operators import features as FE
from tillroll.operators import profile as P
from tillroll.operators import quantiles as Q
from tillroll.operators import rfm as R
from tillroll.operators import sampling as SM
from tillroll.operators import segments as SG
from tillroll.plans import reports as RP
from tillroll.session import partitions_for
from tillroll.sources.sinks import head, materialize, write_report, write_table
from tillroll.sources.tracking import log_run, save_model, step_run_id

SCALED = ["Recency_s", "Frequency_s", "Monetary_s"]


@dataclass
class StepResult:
    """A step's result tables and driver-side values, and what its run records:
    parameters, long (key, value_num) metrics, and report rows."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    values: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)
    metrics: DataFrame | None = None
    report: DataFrame | None = None


def profile_step(raw: DataFrame) -> StepResult:
    summary, missing, stats = P.dataset_summary(raw), P.missing_report(raw), P.describe(raw)
    first = head(raw, 5, raw.columns[:2])
    return StepResult(
        {"dataset_summary": summary, "missing_values_report": missing, "basic_statistics": stats,
         "data_types": P.dtypes_table(raw)},
        params={"column_names": ", ".join(raw.columns), **{f"dtype_{c}": t for c, t in raw.dtypes}},
        metrics=RP.profile_metrics(summary, missing), report=RP.dataset_report(summary, missing, stats, first))


def preprocess_step(raw: DataFrame, cleaned: DataFrame | None = None) -> StepResult:
    if cleaned is None:
        cleaned = clean_step(raw).tables["clean"]
    feats = FE.feature_engineering(cleaned)
    processed = FE.encode_and_scale(feats)
    lineage = P.cleaning_lineage(raw, cleaned)
    new = P.schema_diff(raw, feats)
    rows = cleaned.agg(F.count(F.lit(1)).alias("rows"))
    return StepResult(
        {"features": feats, "processed": processed, "lineage": lineage,
         "processed_sample": head(processed, 100, ["Invoice", "StockCode"])},
        {"new_columns": P.schema_diff(raw, processed)},
        params={"cleaning_steps": "drop null Description, drop null Customer ID, drop duplicates",
                "new_features_created": ", ".join(new), "scaled_columns": ", ".join(FE.SCALE_FEATURES),
                "encoding_method": "one-hot", "scaler_type": "standard", "final_columns": len(processed.columns)},
        metrics=RP.one_row(lineage), report=RP.preprocessing_report(lineage, new, FE.SCALE_FEATURES, rows, len(processed.columns)))


def clean_step(raw: DataFrame) -> StepResult:
    """C1..C4, materialised once: every later step starts from this table."""
    return StepResult({"clean": materialize(C.clean(raw), "clean_lines")})


def eda_step(cleaned: DataFrame) -> StepResult:
    d = with_total_price(FE.add_date_parts(cleaned))
    q = Q.percentiles_exact(d, ["TotalPrice"], [0.5, 0.99])["TotalPrice"]  # one selection for both
    kpis, frequency = EDA.kpis(d, median=q[0.5]), EDA.purchase_frequency_stats(d)
    tables = {
        "kpis": kpis,
        "monthly_revenue": EDA.monthly_revenue(d),
        "top_countries": EDA.top_countries(d),
        "top_products": EDA.top_products(d),
        "weekday_hour": EDA.weekday_hour_matrix(d),
        "revenue_histogram": EDA.revenue_histogram(d, p99=q[0.99]),
        "revenue_stats": EDA.revenue_stats(d, p99=q[0.99]),
        "revenue_by_weekday": EDA.revenue_by_weekday(d),
        "purchase_frequency": frequency,
        "purchase_histogram": EDA.purchase_frequency_histogram(d),
        "monthly_active_customers": EDA.monthly_active_customers(d),
        "quantity_price_sample": EDA.quantity_price_sample(d),
        "top_customers": EDA.top_customers(d),
    }
    return StepResult(tables, params={"tables": ", ".join(tables)},
                      metrics=RP.union([RP.one_row(kpis), RP.one_row(frequency.drop("customers"))]))


def clustering_step(cleaned: DataFrame, k: int = 4, n_init: int = 10, seed: int = 42) -> StepResult:
    """RFM -> scaling -> K-Means -> assignments (what labelling needs)."""
    rfm = materialize(R.rfm_log(cleaned), "rfm")
    scaled, params = CL.scale_rfm(rfm)
    scaled = materialize(scaled, "rfm_scaled")
    model = CL.fit_kmeans(scaled, SCALED, k=k, seed=seed, n_init=n_init)
    cents = CL.model_centroids(model)
    clustered = materialize(CL.assign_nearest(scaled, SCALED, cents), "rfm_clusters")
    summary = SG.cluster_summary(clustered)
    out = {
        "rfm": rfm,
        "scaler": params,
        "customer_segments": clustered,
        "cluster_summary": summary,
        "cluster_means": SG.cluster_mean_matrix(summary),
    }
    return StepResult(out, {"model": model, "centroids": cents, "scaled": scaled})


def cluster_metrics_step(rfm: DataFrame, clustered: DataFrame, model: CL.KMeansFit, seed: int = 42,
                         scaled: DataFrame | None = None, sweep: bool = False, n_init: int = 10) -> StepResult:
    """Quality metrics on the cluster-safe sample, box-plot numbers and pair-plot
    tables, RFM statistics and (with ``sweep``) the k = 2..10 elbow table."""
    pts = clustered.select(CUSTOMER, F.col("Cluster").cast("bigint").alias("Cluster"),
                           CL.as_vector(SCALED).alias("vec"))
    sample = SM.cluster_safe_sample(pts, "Cluster", CUSTOMER, CL.METRIC_SAMPLE, seed)
    quality = CL.quality_summary(sample, CUSTOMER, "vec", "Cluster").withColumn("inertia_full", F.lit(model.cost))
    rq = Q.percentiles_exact(rfm, ["Recency", "Frequency", "Monetary"], [0.25, 0.5, 0.75])
    elbow = CL.k_sweep(scaled, SCALED, CUSTOMER, seed=seed, n_init=n_init) if sweep else None
    points, histograms = SG.pair_plot(clustered, seed=seed)
    summary = SG.rfm_summary(rfm, medians=rq)
    return StepResult({
        **({"elbow": elbow} if sweep else {}),
        "quality": quality,
        "cluster_boxes": SG.box_summary(clustered),
        "pair_plot_sample": points,
        "pair_plot_histograms": histograms,
        "rfm_statistics": P.describe(rfm, ["Recency", "Frequency", "Monetary"], quartiles=rq),
        "rfm_summary": summary,
    }, params={"n_clusters": len(model.centroids), "n_init": n_init, "random_state": seed, "features_used": ", ".join(CL.RFM_FEATURES)},
        metrics=RP.clustering_metrics(quality, summary, SG.cluster_summary(clustered), elbow))


def labelling_step(clustered: DataFrame) -> StepResult:
    scored = SG.score_clusters(SG.cluster_summary(clustered))
    labeled = materialize(SG.label_customers(clustered, scored), "labeled_customers")
    metrics = SG.segment_metrics(labeled)
    labels = {f"cluster_{r['Cluster']}_label": r["Segment"] for r in scored.collect()}  # a row for each cluster
    return StepResult({
        "cluster_scores": scored,
        "labeled_customers": labeled,
        "segment_metrics": metrics,
        "labeled_summary": SG.labeled_summary(metrics),
    }, params={"labeling_method": "rank sums", **labels}, metrics=RP.labelling_metrics(metrics, labeled),
        report=RP.segment_report(scored, metrics, labeled))


def basket_features(cleaned: DataFrame) -> DataFrame:
    """Per-customer basket metrics + favourites (needs only the clean lines)."""
    return materialize(BK.basket_metrics(cleaned).join(BK.favourites(cleaned), on=CUSTOMER, how="inner"),
                       "basket_features")


def classifier_step(cleaned: DataFrame, labeled: DataFrame, num_trees: int = 100, max_depth: int | None = None,
                    seed: int = 42, baskets: DataFrame | None = None) -> StepResult:
    baskets = baskets if baskets is not None else basket_features(cleaned)
    feats = CF.encode_features(materialize(
        baskets.join(labeled.select(CUSTOMER, "Segment"), on=CUSTOMER, how="inner"), "classifier_features"))
    split = materialize(SM.stratified_split(feats, "Segment", CUSTOMER, 0.2, seed), "classifier_split")
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    model = CF.fit_forest(train, num_trees=num_trees, max_depth=max_depth, seed=seed)
    names = CF.class_names(model)
    pred = materialize(CF.predict(model, test), "classifier_predictions")
    counts = CF.confusion_counts(pred, "Segment", "predicted_class")
    steps = CF.score_counts(CF.class_scores(pred, "Segment", names))
    report, importance = CF.classification_report(counts), CF.feature_importance(model)
    summary = CF.summary_metrics(counts, steps)
    return StepResult({
        "predictions": pred,
        "classification_report": report,
        "confusion": CF.confusion_grid(counts),
        "roc_auc": CF.roc_auc_by_class(steps),
        "roc_curve": CF.roc_curve(steps),
        "metrics": summary,
        "feature_importance": importance,
    }, {"model": model, "class_names": names},
        params={"algorithm": "random forest", "n_estimators": num_trees, "max_depth": max_depth, "random_state": seed,
                "test_size": 0.2, "stratified_split": True, "features_used": ", ".join(CF.FEATURES),
                "target_classes": ", ".join(names)},
        metrics=RP.classifier_metrics(summary, report, importance), report=RP.classifier_report(summary, report, importance))


def run_pipeline(spark: SparkSession, raw: DataFrame, out_dir: str | None = None, runs_path: str | None = None,
                 k: int = 4, n_init: int = 10, sweep: bool = False, num_trees: int = 100,
                 concurrency: int = 4, serial: bool = False, pipeline_id: str | None = None) -> dict:
    """Run all six steps. Writes every table and the four text reports to
    ``out_dir`` and appends every step's parameters and metrics to the run
    table ``runs_path``, when given; the classifier is then saved beside it and
    its run says where.

    Independent work is submitted as concurrent Spark jobs (Spark schedules
    jobs from several threads over the same executors): outputs are written by
    a small pool while later steps build, profile / feature engineering / EDA
    run beside the clean -> clustering -> labelling -> classifier chain. With
    ``serial`` each step is built and written before the next one starts, so
    that its seconds are its wall time. Returns per-step seconds (overlapping
    unless serial), per-output write seconds and the results. A run that is tried
    again with the same ``pipeline_id`` logs each step once.
    """
    from concurrent.futures import ThreadPoolExecutor

    pipeline_id = pipeline_id or uuid.uuid4().hex
    timings, results, detail = {}, {}, {}
    writers = ThreadPoolExecutor(max_workers=max(1, concurrency - 1))
    pending = []

    def pool(name):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)

    def timed(name, fn):
        def job():
            pool("writes")
            t1 = time.time()
            fn()
            detail[name] = time.time() - t1
        pending.append(writers.submit(job))

    def outputs(name, res):
        for t, df in res.tables.items():
            timed(f"{name}.{t}", lambda df=df, t=t: write_table(df, f"{out_dir}/{name}/{t}") if out_dir
                  else df.write.format("noop").mode("overwrite").save())
        if out_dir and res.report is not None:
            timed(f"{name}.report", lambda: write_report(res.report, f"{out_dir}/{name}/report"))
        if runs_path and (res.params or res.metrics is not None):
            params = dict(res.params)
            if name == "classifier":
                params["model_path"] = f"{runs_path.rstrip('/')}-models/{uuid.uuid4().hex}"
                timed(f"{name}.model", lambda: save_model(spark, res.values["model"], params["model_path"]))
            timed(f"{name}.run", lambda: log_run(spark, runs_path, name, name, params, res.metrics, {"step": name},
                                                 run_id=step_run_id(pipeline_id, name)))

    def run(name, fn):
        t0 = time.time()
        res = fn()
        detail[f"{name}.build"] = time.time() - t0
        results[name] = res
        outputs(name, res)
        if serial:
            for f in pending:
                f.result()
        timings[name] = time.time() - t0
        return res

    try:
        t0 = time.time()
        raw = materialize(raw, "raw_lines")  # the load: one scan of the sources, like reading the file
        partitions_for(spark, raw.count())
        timings["load"] = detail["load"] = time.time() - t0
        pool("chain")
        cleaned = run("clean", lambda: clean_step(raw)).tables["clean"]

        def side_branch():
            pool("side")
            run("profile", lambda: profile_step(raw))
            run("preprocess", lambda: preprocess_step(raw, cleaned=cleaned))
            run("eda", lambda: eda_step(cleaned))

        def metrics_branch(cl):
            pool("side")
            run("cluster_metrics", lambda: cluster_metrics_step(
                cl.tables["rfm"], cl.tables["customer_segments"], cl.values["model"], scaled=cl.values["scaled"],
                sweep=sweep, n_init=n_init))

        def baskets_branch():
            pool("side")
            return basket_features(cleaned)

        with ThreadPoolExecutor(max_workers=1 if serial else 4) as branches:
            side = [branches.submit(side_branch)]
            if serial:
                side[0].result()
            baskets = branches.submit(baskets_branch)
            cl = run("clustering", lambda: clustering_step(cleaned, k=k, n_init=n_init))
            side.append(branches.submit(metrics_branch, cl))
            if serial:
                side[1].result()
            lab = run("labelling", lambda: labelling_step(cl.tables["customer_segments"]))
            run("classifier", lambda: classifier_step(cleaned, lab.tables["labeled_customers"],
                                                      num_trees=num_trees, baskets=baskets.result()))
            for f in side:
                f.result()
        t1 = time.time()
        for f in pending:
            f.result()
        timings["final_writes"] = time.time() - t1
    finally:
        writers.shutdown(wait=True)
    return {"timings": timings, "results": results, "detail": detail}
