"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the fixture views of
``tillroll.sources.tables``) and runs over whole tables. Double outputs are
rounded with ``np_round`` so that results hash identically against the
DuckDB oracle in ``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER, np_round, with_total_price
from tillroll.operators import basket as BK
from tillroll.operators import classification as CF
from tillroll.operators import clean as C
from tillroll.operators import clustering as CL
from tillroll.operators import eda as EDA
from tillroll.operators import features as FE
from tillroll.operators import profile as P
from tillroll.operators import rfm as R
from tillroll.operators import sampling as SM
from tillroll.operators import segments as SG
from tillroll.plans import reports as RP
from tillroll.plans import workspace as WS
from tillroll.session import partitions_for
from tillroll.sources import tables as S
from tillroll.streaming import request_stream as RS
from tillroll.streaming import scoring as SC
from tillroll.streaming import validation as VA

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: dict[str, int] | None = None, default: int = 6) -> DataFrame:
    """Round every double column (``digits`` overrides per column)."""
    digits = digits or {}
    out = []
    for name, dtype in df.dtypes:
        if dtype in ("double", "float"):
            out.append(np_round(F.col(name).cast("double"), digits.get(name, default)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's standard step input: dirty transactions after C1..C4
    (computed once per session, then read from the shared folder)."""
    partitions_for(spark, S.read_table(spark, sf_dir, "lineitem").count())
    return WS.shared_table(spark, sf_dir, "clean_lines", lambda: C.clean(S.retail_dirty(spark, sf_dir)))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty transactions, joined once per session like one load of the file."""
    partitions_for(spark, S.read_table(spark, sf_dir, "lineitem").count())
    return WS.shared_table(spark, sf_dir, "raw_lines", lambda: S.retail_dirty(spark, sf_dir))


# --------------------------------------------------------------------- RFM
@query("rfm_log")
def q_rfm_log(spark, sf_dir):
    df = R.rfm_log(clean_lines(spark, sf_dir))
    return rounded(df, {"Monetary_raw": 2})


def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lines with date parts, TotalPrice and invoice basket stats."""
    return FE.feature_engineering(clean_lines(spark, sf_dir))


def money_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lines with date parts and TotalPrice (no invoice join)."""
    return with_total_price(FE.add_date_parts(clean_lines(spark, sf_dir)))


# ----------------------------------------------------------------- profile
@query("profile_summary")
def q_profile_summary(spark, sf_dir):
    return P.dataset_summary(S.retail_dirty(spark, sf_dir))


@query("profile_missing")
def q_profile_missing(spark, sf_dir):
    return P.missing_report(S.retail_dirty(spark, sf_dir))


@query("profile_describe")
def q_profile_describe(spark, sf_dir):
    return rounded(P.describe(raw_lines(spark, sf_dir), ["Invoice", "StockCode", "Quantity", "Price", CUSTOMER]))


@query("clean_lineage")
def q_clean_lineage(spark, sf_dir):
    return P.cleaning_lineage(raw_lines(spark, sf_dir), clean_lines(spark, sf_dir))


@query("clean_lines")
def q_clean_lines(spark, sf_dir):
    return clean_lines(spark, sf_dir)


# ---------------------------------------------------------------- features
@query("features_invoice_stats")
def q_features_invoice_stats(spark, sf_dir):
    return rounded(feature_lines(spark, sf_dir).drop("Description"), {"TotalPrice": 4})


@query("features_scaled")
def q_features_scaled(spark, sf_dir):
    df = FE.encode_and_scale(feature_lines(spark, sf_dir))
    keep = ["Invoice", "StockCode", "InvoiceDate", CUSTOMER, *FE.SCALE_FEATURES]
    # the one-hot matrix of each row: which of its columns are on, and how many
    hot = sorted(c for c in df.columns if c.startswith("Country_"))
    on = F.concat_ws(",", *[F.when(F.col(c) == 1, F.lit(c)) for c in hot])
    return rounded(df.select(*keep, on.alias("hot_columns"), sum((F.col(c) for c in hot), F.lit(0)).alias("hot_count")))


@query("features_scaler_params")
def q_features_scaler_params(spark, sf_dir):
    df = feature_lines(spark, sf_dir)
    return rounded(FE.fit_standard_scaler(df, FE.SCALE_FEATURES))


# --------------------------------------------------------------------- EDA
@query("eda_kpis")
def q_eda_kpis(spark, sf_dir):
    return rounded(EDA.kpis(money_lines(spark, sf_dir)), {"total_revenue": 2})


@query("eda_monthly_revenue")
def q_eda_monthly_revenue(spark, sf_dir):
    return rounded(EDA.monthly_revenue(money_lines(spark, sf_dir)), {"TotalPrice": 2})


@query("eda_monthly_active_customers")
def q_eda_monthly_active(spark, sf_dir):
    return EDA.monthly_active_customers(money_lines(spark, sf_dir))


@query("eda_top_countries")
def q_eda_top_countries(spark, sf_dir):
    return rounded(EDA.top_countries(money_lines(spark, sf_dir)), {"TotalPrice": 2})


@query("eda_top_products")
def q_eda_top_products(spark, sf_dir):
    return rounded(EDA.top_products(money_lines(spark, sf_dir)), {"Quantity": 2})


@query("eda_top_customers")
def q_eda_top_customers(spark, sf_dir):
    return rounded(EDA.top_customers(money_lines(spark, sf_dir)), {"TotalPrice": 2})


@query("eda_weekday_hour")
def q_eda_weekday_hour(spark, sf_dir):
    act = FE.add_date_parts(S.activity(spark, sf_dir))
    return EDA.weekday_hour_invoices(act)


@query("eda_revenue_by_weekday")
def q_eda_revenue_by_weekday(spark, sf_dir):
    return rounded(EDA.revenue_by_weekday(money_lines(spark, sf_dir)), {"TotalPrice": 2})


@query("eda_revenue_histogram")
def q_eda_revenue_histogram(spark, sf_dir):
    return rounded(EDA.revenue_histogram(money_lines(spark, sf_dir)))


@query("eda_revenue_stats")
def q_eda_revenue_stats(spark, sf_dir):
    return rounded(EDA.revenue_stats(money_lines(spark, sf_dir)))


@query("eda_purchase_frequency")
def q_eda_purchase_frequency(spark, sf_dir):
    return rounded(EDA.purchase_frequency_stats(money_lines(spark, sf_dir)))


@query("eda_purchase_histogram")
def q_eda_purchase_histogram(spark, sf_dir):
    return rounded(EDA.purchase_frequency_histogram(money_lines(spark, sf_dir)))


@query("eda_quantity_price_sample")
def q_eda_qp_sample(spark, sf_dir):
    return EDA.quantity_price_sample(money_lines(spark, sf_dir))


@query("features_one_hot_counts")
def q_features_one_hot_counts(spark, sf_dir):
    """Sum of each generated Country_<v> indicator column (= rows of that country)."""
    df = FE.one_hot(clean_lines(spark, sf_dir), "Country")
    cols = [c for c in df.columns if c.startswith("Country_")]
    sums = df.agg(*[F.sum(F.col(c)).cast("bigint").alias(f"s{i}") for i, c in enumerate(cols)])
    parts = [x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"s{i}"))]
    return sums.select(F.stack(F.lit(len(cols)), *parts).alias("column", "ones"))


# -------------------------------------------------------------- clustering
METRIC_SAMPLE = CL.METRIC_SAMPLE
# The four reference centroids on scaled (Recency, Frequency, Monetary).
FIXED_CENTROIDS = [(0, [-0.6, 0.6, 0.6]), (1, [-0.3, -0.5, -0.4]), (2, [0.5, 0.4, 0.5]), (3, [2.0, -1.2, -1.3])]
SCALED = ["Recency_s", "Frequency_s", "Monetary_s"]


def rfm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WS.shared_table(spark, sf_dir, "rfm_log", lambda: R.rfm_log(clean_lines(spark, sf_dir)))


def rfm_fixed_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled log-RFM per customer assigned to the fixed centroids."""
    def build():
        scaled, _ = CL.scale_rfm(rfm_customers(spark, sf_dir))
        return CL.assign_nearest(scaled, SCALED, FIXED_CENTROIDS, dist_out="SqDistance")
    return WS.shared_table(spark, sf_dir, "rfm_fixed_clusters", build)


@query("cluster_assign_fixed")
def q_cluster_assign_fixed(spark, sf_dir):
    df = rfm_fixed_clusters(spark, sf_dir)
    return rounded(df.select(CUSTOMER, *SCALED, "Cluster", "SqDistance"))


@query("cluster_inertia_fixed")
def q_cluster_inertia_fixed(spark, sf_dir):
    df = rfm_fixed_clusters(spark, sf_dir)
    return rounded(df.groupBy("Cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("SqDistance").alias("inertia")))


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("label").cast("bigint").alias("label"), CL.as_double_array("embedding").alias("vec"))


def embedding_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SM.cluster_safe_sample(embedding_points(spark, sf_dir), "label", "vec_id", n=METRIC_SAMPLE)


@query("cluster_quality_embeddings")
def q_cluster_quality_embeddings(spark, sf_dir):
    """Metrics on the cluster-safe sample, as the clustering step reports them."""
    return rounded(CL.quality_summary(embedding_sample(spark, sf_dir), "vec_id", "vec", "label"))


@query("cluster_silhouette_embeddings")
def q_cluster_silhouette_embeddings(spark, sf_dir):
    return rounded(CL.silhouette_samples(embedding_sample(spark, sf_dir), "vec_id", "vec", "label"))


@query("cluster_silhouette_squared_embeddings")
def q_cluster_silhouette_squared(spark, sf_dir):
    """Mean silhouette by squared distance over every row, linear in the rows."""
    score = CL.silhouette_squared(embedding_points(spark, sf_dir), "vec", "label")
    return rounded(spark.createDataFrame([(score,)], "silhouette_squared double"))


@query("cluster_quality_rfm_fixed")
def q_cluster_quality_rfm_fixed(spark, sf_dir):
    df = rfm_fixed_clusters(spark, sf_dir).select(
        CUSTOMER, F.col("Cluster").cast("bigint").alias("Cluster"), CL.as_vector(SCALED).alias("vec"))
    return rounded(CL.quality_summary(SM.cluster_safe_sample(df, "Cluster", CUSTOMER, n=METRIC_SAMPLE),
                                      CUSTOMER, "vec", "Cluster"))


def all_rows_metrics(df: DataFrame, vec: str, label: str) -> DataFrame:
    """n, k, inertia, Davies-Bouldin and Calinski-Harabasz of every row: two aggregations."""
    from tillroll.sources.sinks import materialize
    stats = CL.cluster_stats(materialize(df.select(label, vec), "metric-points"), vec, label)
    vals = CL.metrics_from_stats(stats)
    return rounded(df.sparkSession.createDataFrame(
        [(sum(s["n"] for s in stats), len(stats), vals["inertia"], vals["davies_bouldin"], vals["calinski_harabasz"])],
        "n bigint, k bigint, inertia double, davies_bouldin double, calinski_harabasz double"))


def rfm_fixed_points(spark, sf_dir):
    return rfm_fixed_clusters(spark, sf_dir).select(
        CUSTOMER, F.col("Cluster").cast("bigint").alias("Cluster"), CL.as_vector(SCALED).alias("vec"))


@query("cluster_metrics_embeddings")
def q_cluster_metrics_embeddings(spark, sf_dir):
    return all_rows_metrics(embedding_points(spark, sf_dir), "vec", "label")


@query("cluster_metrics_rfm")
def q_cluster_metrics_rfm(spark, sf_dir):
    return all_rows_metrics(rfm_fixed_points(spark, sf_dir), "vec", "Cluster")


@query("cluster_silhouette_estimate")
def q_cluster_silhouette_estimate(spark, sf_dir):
    """The mean silhouette of every customer against reference rows of each cluster, with its interval: what must
    hold of any estimate (its coverage of the exact value is tested)."""
    e = CL.silhouette_estimate(rfm_fixed_points(spark, sf_dir), CUSTOMER, "vec", "Cluster")
    return e.select("n", F.col("silhouette").between(-1, 1).alias("in_range"), F.col("silhouette").between(F.col("low"), F.col("high")).alias("inside"),
                    (F.col("high") - F.col("low") < 0.1).alias("narrow"))


SKETCHED, SKETCH_PROBS = ["Quantity", "Price", "TotalPrice"], [0.01, 0.25, 0.5, 0.75, 0.99]


@query("quantile_sketch_checks")
def q_quantile_sketch_checks(spark, sf_dir):
    """KLL sketches of each month's lines, kept in a table, merged to one a column; the ranks of their quantiles
    among all lines against the bound."""
    from tillroll.operators import quantiles as QU
    from tillroll.sources.sinks import materialize
    lines = FE.with_total_price(clean_lines(spark, sf_dir)).withColumn("Month", F.date_format("InvoiceDate", "yyyy-MM"))
    months = materialize(QU.quantile_sketches(lines, SKETCHED, ["Month"]), "sketches")
    found = materialize(QU.sketch_quantiles(QU.merge_sketches(months, []), SKETCH_PROBS), "sketch-quantiles")
    errors = QU.rank_errors(lines, found)
    return (found.join(errors, ["col", "p"]).select(F.col("col").alias("Column"), "p", "n", (F.col("error") <= QU.sketch_error(800)).alias("within_bound")))


# ---------------------------------------------------------------- segments
@query("segment_cluster_summary")
def q_segment_cluster_summary(spark, sf_dir):
    return rounded(SG.cluster_summary(rfm_fixed_clusters(spark, sf_dir)))


def scored_clusters(spark, sf_dir):
    return SG.score_clusters(SG.cluster_summary(rfm_fixed_clusters(spark, sf_dir)))


@query("segment_scores")
def q_segment_scores(spark, sf_dir):
    return rounded(scored_clusters(spark, sf_dir))


def labeled_customers(spark, sf_dir):
    def build():
        clustered = rfm_fixed_clusters(spark, sf_dir)
        return SG.label_customers(clustered, SG.score_clusters(SG.cluster_summary(clustered)))
    return WS.shared_table(spark, sf_dir, "labeled_customers", build)


@query("segment_customers")
def q_segment_customers(spark, sf_dir):
    df = labeled_customers(spark, sf_dir)
    return rounded(df.select(CUSTOMER, "Recency", "Frequency", "Monetary", "Cluster", "Segment", "ChurnProbability"))


@query("segment_metrics")
def q_segment_metrics(spark, sf_dir):
    return rounded(SG.segment_metrics(labeled_customers(spark, sf_dir)))


@query("segment_labeled_summary")
def q_segment_labeled_summary(spark, sf_dir):
    return SG.labeled_summary(SG.segment_metrics(labeled_customers(spark, sf_dir)), rounded=False).transform(rounded)


@query("segment_labeled_report")
def q_segment_labeled_report(spark, sf_dir):
    """The summary at the precision of the report (0, 1 and 2 digits)."""
    return SG.labeled_summary(SG.segment_metrics(labeled_customers(spark, sf_dir)))


@query("segment_pair_plot")
def q_segment_pair_plot(spark, sf_dir):
    """Per-cluster histograms of the pair plot's diagonal, over all customers."""
    return rounded(SG.pair_plot(rfm_fixed_clusters(spark, sf_dir))[1])


@query("segment_pair_plot_sample")
def q_segment_pair_plot_sample(spark, sf_dir):
    return rounded(SG.pair_plot(rfm_fixed_clusters(spark, sf_dir))[0])


@query("segment_cluster_means")
def q_segment_cluster_means(spark, sf_dir):
    return rounded(SG.cluster_mean_matrix(SG.cluster_summary(rfm_fixed_clusters(spark, sf_dir))))


@query("segment_box_summary")
def q_segment_box_summary(spark, sf_dir):
    return rounded(SG.box_summary(rfm_fixed_clusters(spark, sf_dir)))


@query("rfm_summary")
def q_rfm_summary(spark, sf_dir):
    return rounded(SG.rfm_summary(rfm_customers(spark, sf_dir)))


@query("rfm_describe")
def q_rfm_describe(spark, sf_dir):
    return rounded(P.describe(rfm_customers(spark, sf_dir), ["Recency", "Frequency", "Monetary"]))


# ---------------------------------------------------------------- sampling
@query("sample_cluster_safe")
def q_sample_cluster_safe(spark, sf_dir):
    o = S.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return SM.cluster_safe_sample(o, "o_orderpriority", "o_orderkey", n=10_000, seed=42)


@query("sample_random")
def q_sample_random(spark, sf_dir):
    o = S.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return SM.random_sample(o, 5000, "o_orderkey", 42, tiebreak=["o_orderkey"])


@query("split_stratified")
def q_split_stratified(spark, sf_dir):
    c = S.read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return SM.stratified_split(c, "c_mktsegment", "c_custkey", 0.2, 42)


# ------------------------------------------------------------------ basket
@query("basket_metrics")
def q_basket_metrics(spark, sf_dir):
    return rounded(BK.basket_metrics(clean_lines(spark, sf_dir)))


@query("basket_favourites")
def q_basket_favourites(spark, sf_dir):
    return BK.favourites(clean_lines(spark, sf_dir))


def classify_table(spark, sf_dir):
    """Basket features + favourites + Segment from the fixed-centroid labelling."""
    return WS.shared_table(spark, sf_dir, "classify_table", lambda: BK.classification_features(
        clean_lines(spark, sf_dir), labeled_customers(spark, sf_dir)))


@query("classify_features")
def q_classify_features(spark, sf_dir):
    return rounded(classify_table(spark, sf_dir))


@query("classify_encoded")
def q_classify_encoded(spark, sf_dir):
    df = CF.encode_features(classify_table(spark, sf_dir))
    df = CF.label_encode(df, "Segment")
    return rounded(df.select(CUSTOMER, "FavoriteDay", "FavoriteDay_Encoded", "Country", "Country_Encoded",
                             "Segment", "Segment_Encoded"))


@query("classify_split")
def q_classify_split(spark, sf_dir):
    df = classify_table(spark, sf_dir).select(CUSTOMER, "Segment")
    return SM.stratified_split(df, "Segment", CUSTOMER, 0.2, 42)


# --------------------------------------------- classifier metrics (fixture)
def prediction_fixture(spark, sf_dir):
    """customer: actual = market segment; predicted = actual, or the next
    segment alphabetically (cyclic) for every fifth customer; score = balance."""
    c = S.read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("actual"), F.col("c_acctbal").alias("score"))
    names = WS.shared_object(spark, sf_dir, "market_segments", lambda: sorted(
        r[0] for r in c.where("actual is not null").select("actual").distinct().collect()))  # market segments: a code list
    after = F.create_map(*[F.lit(x) for a, b in zip(names, names[1:] + names[:1]) for x in (a, b)])
    pred = F.when(F.col("c_custkey") % 5 != 0, F.col("actual")).otherwise(after[F.col("actual")])
    return c.where("actual is not null").select("c_custkey", "actual", pred.alias("predicted"), "score"), names


def fixture_counts(spark, sf_dir):
    return CF.confusion_counts(prediction_fixture(spark, sf_dir)[0], "actual", "predicted")


def fixture_steps(spark, sf_dir):
    fx, names = prediction_fixture(spark, sf_dir)
    return CF.score_counts(CF.one_vs_rest(fx, "actual", {c: F.col("score") for c in names}))


@query("classify_confusion")
def q_classify_confusion(spark, sf_dir):
    return rounded(CF.confusion_grid(fixture_counts(spark, sf_dir)))


@query("classify_report")
def q_classify_report(spark, sf_dir):
    return rounded(CF.classification_report(fixture_counts(spark, sf_dir)))


@query("classify_roc_auc")
def q_classify_roc_auc(spark, sf_dir):
    return rounded(CF.roc_auc_by_class(fixture_steps(spark, sf_dir)))


@query("classify_roc_curve")
def q_classify_roc_curve(spark, sf_dir):
    return rounded(CF.roc_curve(fixture_steps(spark, sf_dir)))


@query("classify_metrics")
def q_classify_metrics(spark, sf_dir):
    return rounded(CF.summary_metrics(fixture_counts(spark, sf_dir), fixture_steps(spark, sf_dir)))


# ----------------------------------------------------------------- scoring
RFM_VALID_FMT = '{"Recency":%d,"Frequency":%d,"Monetary":%.2f}'


def rfm_requests(spark, sf_dir):
    """One JSON request per customer built from its raw RFM; a fixed share of
    requests carries each validation failure (by customer id residue).
    Written once as a request file set, like requests arriving from a source."""
    return WS.shared_table(spark, sf_dir, "rfm_requests", lambda: _rfm_requests(spark, sf_dir))


def _rfm_requests(spark, sf_dir):
    r = R.rfm_raw(clean_lines(spark, sf_dir))
    i = F.col(CUSTOMER)
    rec, fr, mo = F.col("Recency"), F.col("Frequency_raw"), F.col("Monetary_raw")
    text = (F.when(i % 11 == 0, F.format_string('{"Recency":%d,"Frequency":%d}', rec, fr))
            .when(i % 13 == 0, F.format_string(RFM_VALID_FMT, -rec - 1, fr, mo))
            .when(i % 17 == 0, F.format_string('{"Recency":"%d","Frequency":%d,"Monetary":%.2f}', rec, fr, mo))
            .when(i % 19 == 0, F.lit("[1,2,3]"))
            .when(i % 23 == 0, F.format_string('{"Recency":%d,"Frequency":true,"Monetary":%.2f}', rec, mo))
            .when(i % 29 == 0, F.format_string('{"Recency":%d,"Frequency":%d,"Monetary":null}', rec, fr))
            .otherwise(F.format_string(RFM_VALID_FMT, rec, fr, mo)))
    return r.select(CUSTOMER, text.alias("value"))


@query("score_validate_rfm")
def q_score_validate_rfm(spark, sf_dir):
    v = VA.validate_rfm(rfm_requests(spark, sf_dir))
    return v.select(CUSTOMER, "valid", "error", "Recency", "Frequency", "Monetary")


def fixed_scorer(spark, sf_dir) -> SC.RfmScorer:
    def build():
        params = FE.fit_standard_scaler(rfm_customers(spark, sf_dir), CL.RFM_FEATURES)
        return SC.RfmScorer.from_tables(params, FIXED_CENTROIDS)
    return WS.shared_object(spark, sf_dir, "fixed_scorer", build)


@query("score_rfm_fixed")
def q_score_rfm_fixed(spark, sf_dir):
    out = SC.score_rfm_requests(rfm_requests(spark, sf_dir), fixed_scorer(spark, sf_dir))
    return out.where("valid").select(CUSTOMER, "cluster", "segment")


def response_fields(scored: DataFrame) -> DataFrame:
    """What the JSON response of every request says, read back from its text."""
    field = lambda path: F.get_json_object("response", path)
    return scored.select(
        CUSTOMER, "valid", "error", field("$.error").alias("response_error"),
        field("$.cluster").alias("response_cluster"), field("$.segment").alias("response_segment"),
        *[field(f"$.input.{f}").cast("double").alias(f"input_{f}") for f in VA.RFM_FIELDS])


@query("score_rfm_response")
def q_score_rfm_response(spark, sf_dir):
    return response_fields(SC.score_rfm_requests(rfm_requests(spark, sf_dir), fixed_scorer(spark, sf_dir)))


CLASSIFIER_FMT = ('{"Recency":%d,"Frequency":%d,"Monetary":%.2f,"AvgBasketValue":%.2f,"AvgBasketSize":%d,'
                  '"Volatility":%.1f,"FavoriteDay_Encoded":%d,"Country_Encoded":%d}')


def classifier_requests(spark, sf_dir):
    """Behaviour requests per customer (with failures by customer id residue).

    Field values come from exact per-customer quantities (counts, cent sums,
    weekday / country codes) so their text form is the same in any engine.
    """
    return WS.shared_table(spark, sf_dir, "classifier_requests", lambda: _classifier_requests(spark, sf_dir))


def _classifier_requests(spark, sf_dir):
    lines = clean_lines(spark, sf_dir)
    fav = CF.encode_features(BK.favourites(lines))
    df = R.rfm_raw(lines).join(fav, CUSTOMER)
    i = F.col(CUSTOMER)
    args = [F.col("Recency"), F.col("Frequency_raw"), F.col("Monetary_raw"), F.col("Monetary_raw"),
            F.col("Frequency_raw") * 2, F.col("Recency") / 2.0, F.col("FavoriteDay_Encoded"),
            F.col("Country_Encoded")]
    text = (F.when(i % 7 == 0, F.format_string(CLASSIFIER_FMT.replace('"FavoriteDay_Encoded":%d',
                                                                      '"FavoriteDay_Encoded":%d.0'), *args))
            .when(i % 11 == 0, F.format_string(CLASSIFIER_FMT.replace(',"Volatility":%.1f', ''),
                                               *[a for k, a in enumerate(args) if k != 5]))
            .when(i % 13 == 0, F.format_string(CLASSIFIER_FMT.replace('"Country_Encoded":%d',
                                                                      '"Country_Encoded":"%d"'), *args))
            .when(i % 17 == 0, F.format_string(CLASSIFIER_FMT, -F.col("Recency") - 1, *args[1:]))
            .otherwise(F.format_string(CLASSIFIER_FMT, *args)))
    return df.select(CUSTOMER, text.alias("value"))


@query("score_validate_classifier")
def q_score_validate_classifier(spark, sf_dir):
    v = VA.validate_classifier(classifier_requests(spark, sf_dir))
    return rounded(v.select(CUSTOMER, "valid", "error", *VA.RFM_FIELDS, *VA.CLASSIFIER_NUMERIC,
                            *[F.col(c).cast("double").alias(c) for c in VA.CLASSIFIER_INT]))


# ------------------------------------------------ model fits (own fits have no SQL; see the *_checks queries)
def kmeans_run(spark, sf_dir, k: int = 4):
    scaled = WS.shared_table(spark, sf_dir, "rfm_scaled", lambda: CL.scale_rfm(rfm_customers(spark, sf_dir))[0])
    model = WS.shared_object(spark, sf_dir, f"kmeans_{k}", lambda: CL.fit_kmeans(scaled, SCALED, k=k, seed=42))
    return scaled, model, CL.assign_nearest(scaled, SCALED, CL.model_centroids(model), dist_out="SqDistance")


@query("kmeans_segments")
def q_kmeans_segments(spark, sf_dir):
    """K-Means (k=4, best of ten starts) on scaled log-RFM; clusters renumbered by
    mean Monetary (descending) so the summary does not depend on arbitrary fit ids."""
    return rounded(SG.cluster_summary(CL.relabel_by(kmeans_run(spark, sf_dir)[2], "Cluster", "Monetary")))


@query("kmeans_checks")
def q_kmeans_checks(spark, sf_dir):
    """What must hold of any K-Means fit: all customers are assigned, to k
    clusters; the reported cost is the assignment's inertia; every centroid is
    its cluster's mean; and a single seeded Spark ML fit costs no less."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    scaled, model, lab = kmeans_run(spark, sf_dir)
    own = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.centroids])
    off = [F.abs(F.col(f"m{i}") - F.element_at(own, F.col("Cluster") + 1)[i]) for i in range(len(SCALED))]
    means = lab.groupBy("Cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("SqDistance").alias("ss"),
                                       *[F.avg(c).alias(f"m{i}") for i, c in enumerate(SCALED)])
    one = KMeans(k=4, seed=1, maxIter=300).fit(VectorAssembler(inputCols=SCALED, outputCol="features").transform(scaled))
    cost = F.lit(model.cost)
    return means.agg(F.sum("n").alias("customers"), F.count(F.lit(1)).alias("clusters"),
                     (F.abs(F.sum("ss") - cost) <= 1e-6 * cost).alias("cost_is_inertia"),
                     (F.max(F.greatest(*off)) < 0.05).alias("centroids_are_means"),
                     (cost <= F.lit(one.summary.trainingCost * 1.001)).alias("no_worse_than_one_start"))


@query("kmeans_k_sweep")
def q_kmeans_k_sweep(spark, sf_dir):
    return rounded(k_sweep_table(spark, sf_dir))


def k_sweep_table(spark, sf_dir):
    scaled = kmeans_run(spark, sf_dir)[0]
    return WS.shared_table(spark, sf_dir, "k_sweep", lambda: CL.k_sweep(scaled, SCALED, CUSTOMER, ks=range(2, 11), seed=42))


@query("kmeans_k_sweep_checks")
def q_kmeans_k_sweep_checks(spark, sf_dir):
    """One row for each k; more clusters never cost more (within 1 %); silhouettes lie in [-1, 1]."""
    from pyspark.sql import Window as W
    before = F.lag("inertia").over(W.orderBy("k"))
    return k_sweep_table(spark, sf_dir).select(
        "k", (before.isNull() | (F.col("inertia") <= before * 1.01)).alias("inertia_falls"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"))


def classifier_split(spark, sf_dir):
    return WS.shared_table(spark, sf_dir, "classifier_split", lambda: SM.stratified_split(
        CF.encode_features(classify_table(spark, sf_dir)), "Segment", CUSTOMER, 0.2, 42))


def forest_run(spark, sf_dir, num_trees: int = 100):
    split = classifier_split(spark, sf_dir)
    model = WS.shared_object(spark, sf_dir, f"forest_{num_trees}", lambda: CF.fit_forest(
        split.where(~F.col("is_test")), num_trees=num_trees))
    pred = WS.shared_table(spark, sf_dir, f"forest_{num_trees}_pred", lambda: CF.predict(
        model, split.where("is_test")))
    return model, pred


@query("rf_predictions")
def q_rf_predictions(spark, sf_dir):
    _, pred = forest_run(spark, sf_dir)
    return pred.select(CUSTOMER, "Segment", "predicted_class", "probabilities")


@query("rf_feature_importance")
def q_rf_feature_importance(spark, sf_dir):
    model, _ = forest_run(spark, sf_dir)
    return CF.feature_importance(model)


@query("rf_metrics")
def q_rf_metrics(spark, sf_dir):
    model, pred = forest_run(spark, sf_dir)
    steps = CF.score_counts(CF.class_scores(pred, "Segment", CF.class_names(model)))
    return rounded(CF.summary_metrics(CF.confusion_counts(pred, "Segment", "predicted_class"), steps))


@query("rf_checks")
def q_rf_checks(spark, sf_dir):
    """What must hold of any forest: a prediction for every test customer, its
    class the most probable one, probabilities and importances that sum to 1,
    the evaluation's accuracy the plain share of hits, and no fewer hits than
    the largest class has members."""
    model, pred = forest_run(spark, sf_dir)
    names = F.array(*[F.lit(n) for n in CF.class_names(model)])
    p = F.col("probabilities")
    top = F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))
    hit = F.col("Segment") == F.col("predicted_class")
    accuracy = CF.averages(CF.confusion_counts(pred, "Segment", "predicted_class")).select("accuracy").scalar()
    largest = pred.groupBy("Segment").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    importance = CF.feature_importance(model).agg(F.sum("Importance")).scalar()
    return pred.agg(F.count(F.lit(1)).alias("test_customers"), F.every(top == F.col("predicted_class")).alias("most_probable"),
                    F.every(F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-6).alias("probabilities_sum_to_1"),
                    (F.abs(F.avg(hit.cast("double")) - accuracy) < 1e-9).alias("accuracy_is_share_of_hits"),
                    (F.count_if(hit) >= largest).alias("no_worse_than_largest_class"),
                    (F.abs(importance - 1) < 1e-6).alias("importances_sum_to_1"))


@query("rf_metrics_checks")
def q_rf_metrics_checks(spark, sf_dir):
    """What must hold of any forest's metrics: shares, weighted recall the accuracy, and an AUC no worse than chance."""
    m = q_rf_metrics(spark, sf_dir)
    shares = F.lit(True)
    for c in m.columns:
        shares = shares & F.col(c).between(0, 1)
    return m.select(shares.alias("all_are_shares"), (F.abs(F.col("recall_weighted") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"),
                    (F.col("roc_auc_weighted") >= 0.5).alias("auc_beats_chance"))


@query("rf_importance_checks")
def q_rf_importance_checks(spark, sf_dir):
    """Every feature's importance: a share, with its band."""
    imp = q_rf_feature_importance(spark, sf_dir)
    return imp.select("Feature", F.col("Importance").between(0, 1).alias("is_a_share"), F.col("Band").isNotNull().alias("has_band"))


@query("rf_model_round_trip")
def q_rf_model_round_trip(spark, sf_dir):
    """The forest saved, logged with its path, found by its run's name, loaded,
    and its predictions for all customers compared with the unsaved model's."""
    from tillroll.session import scratch_path
    from tillroll.sources import tracking as TR
    model, _ = forest_run(spark, sf_dir)
    base = scratch_path(spark, "forest")
    TR.log_run(spark, f"{base}/runs", "classifier", "classifier", {"model_path": TR.save_model(spark, model, f"{base}/model")})
    loaded = TR.load_latest_model(spark, f"{base}/runs", "classifier")
    split = classifier_split(spark, sf_dir)
    a = CF.predict(model, split).select(CUSTOMER, "predicted_class", "probabilities")
    b = CF.predict(loaded, split).select(CUSTOMER, F.col("predicted_class").alias("c2"), F.col("probabilities").alias("p2"))
    same = (F.col("predicted_class") == F.col("c2")) & (F.col("probabilities") == F.col("p2"))
    return a.hint("merge").join(b, CUSTOMER).agg(F.count(F.lit(1)).alias("customers"), F.every(same).alias("equal"))


def classifier_scored(spark, sf_dir):
    model, _ = forest_run(spark, sf_dir)
    return WS.shared_table(spark, sf_dir, "classifier_scored", lambda: SC.score_classifier_requests(
        classifier_requests(spark, sf_dir), model))


@query("score_classifier_requests")
def q_score_classifier_requests(spark, sf_dir):
    return classifier_scored(spark, sf_dir).select(CUSTOMER, "valid", "error", "segment_class", "segment", "probabilities")


def classifier_verdicts(scored: DataFrame) -> DataFrame:
    field = lambda path: F.get_json_object("response", path)
    return scored.select(
        CUSTOMER, "valid", "error", field("$.error").alias("response_error"),
        field("$.segment").isNotNull().alias("response_has_segment"),
        (field("$.segment_class").cast("int") == F.col("segment_class")).alias("response_class_matches"),
        field("$.input.Recency").cast("double").alias("input_Recency"))


@query("score_classifier_validate_response")
def q_score_classifier_validate_response(spark, sf_dir):
    """Every request's verdict and the parts of its response that don't depend on the fit."""
    return classifier_verdicts(classifier_scored(spark, sf_dir))


@query("score_stream_classifier")
def q_score_stream_classifier(spark, sf_dir):
    """The behaviour requests as a stream of JSON-lines files, two a batch: accepted, rejected and response
    tables by batch number, read back from the committed batches."""
    from tillroll.session import scratch_path
    model, _ = forest_run(spark, sf_dir)
    base = scratch_path(spark, "classifier-stream")
    (classifier_requests(spark, sf_dir).select(F.to_json(F.struct(F.col(CUSTOMER).alias("id"), F.col("value").alias("body"))).alias("value"))
     .repartition(5).write.text(f"{base}/in"))
    RS.start_request_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", lambda lines: SC.score_classifier_requests(lines, model, "body"),
                            envelope=True, text_col="body", files_a_batch=2).awaitTermination()
    accepted, rejected = (RS.read_committed(spark, f"{base}/out", t) for t in ("accepted", "rejected"))
    rejected = rejected.select("id", F.lit(False).alias("valid"), "error", F.lit(None).cast("int").alias("segment_class"),
                               F.to_json(F.struct("error")).alias("response"))
    every = accepted.select(rejected.columns).unionByName(rejected)
    return classifier_verdicts(every.withColumn(CUSTOMER, F.col("id").cast("bigint")))


@query("score_ranked_probabilities")
def q_score_ranked_probabilities(spark, sf_dir):
    model, _ = forest_run(spark, sf_dir)
    return SC.ranked_probabilities(classifier_scored(spark, sf_dir).where("valid"), CF.class_names(model), CUSTOMER)


@query("score_ranked_checks")
def q_score_ranked_checks(spark, sf_dir):
    """Per accepted request: ranks are a permutation, probabilities fall with them and sum to 1."""
    model, _ = forest_run(spark, sf_dir)
    names = CF.class_names(model)
    rows = SC.ranked_probabilities(classifier_scored(spark, sf_dir).where("valid"), names, CUSTOMER)
    by_rank = F.transform(F.sort_array(F.collect_list(F.struct("rank", "probability"))), lambda s: s["probability"])
    per = rows.groupBy(CUSTOMER).agg(F.sort_array(F.collect_list("rank")).alias("r"), by_rank.alias("p"))
    falls = F.col("p") == F.sort_array("p", asc=False)
    return per.select(CUSTOMER, (F.col("r") == F.sequence(F.lit(1), F.lit(len(names)))).alias("ranks_are_a_permutation"),
                      falls.alias("probabilities_fall"),
                      (F.abs(F.aggregate("p", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-6).alias("sum_to_1"))


@query("score_raw_categories")
def q_score_raw_categories(spark, sf_dir):
    """Forest over raw FavoriteDay / Country strings (indexers inside the pipeline,
    unseen categories kept as an extra index); all customers are scored."""
    split = classifier_split(spark, sf_dir).drop("FavoriteDay_Encoded", "Country_Encoded")
    model = WS.shared_object(spark, sf_dir, "forest_raw", lambda: CF.fit_forest_raw(split.where(~F.col("is_test"))))
    return CF.predict(model, split).select(CUSTOMER, "Segment", "predicted_class")


@query("score_stream_rfm")
def q_score_stream_rfm(spark, sf_dir):
    """Structured Streaming run over request files written from the tables:
    text source -> validate -> score -> Parquet sink (availableNow)."""
    from tillroll.session import scratch_path
    base = scratch_path(spark, "rfm-stream")
    reqs = rfm_requests(spark, sf_dir).select(
        F.to_json(F.struct(F.col(CUSTOMER).alias("id"), F.col("value").alias("body"))).alias("value"))
    reqs.write.mode("overwrite").text(f"{base}/in")
    scorer = fixed_scorer(spark, sf_dir)
    q = SC.start_rfm_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", scorer,
                            text_col="body", envelope=True)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return response_fields(out.withColumn(CUSTOMER, F.col("id").cast("bigint")))


# ------------------------------------------------------- sources and sinks
# The header spellings of the two file variants, and one in another order.
CSV_HEADERS = {
    "source_csv_scan": ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID",
                        "Country"],
    "source_csv_canonical": ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID",
                             "Country"],
    "source_csv_reordered": ["Country", "Description", "StockCode", "CustomerID", "UnitPrice", "InvoiceNo", "InvoiceDate",
                             "Quantity"],
}


def csv_file(spark, sf_dir, header: list[str], broken: bool = False, breaks: bool = False) -> str:
    """The dirty transactions as a Latin-1 CSV with this header. With ``broken``
    some quantities, prices, customers and dates are text that doesn't fit; with
    ``breaks`` some descriptions hold line breaks, quotes and commas."""
    from tillroll.functions.columns import COLUMN_ALIASES
    from tillroll.session import scratch_path
    d = raw_lines(spark, sf_dir)
    cells = {"Quantity": F.col("Quantity").cast("bigint").cast("string"), "Price": F.col("Price").cast("string"),
             "Customer ID": F.col(CUSTOMER).cast("double").cast("string"),
             "InvoiceDate": F.date_format("InvoiceDate", "M/d/yyyy H:mm")}
    if broken:
        i = F.col("Invoice")
        for c, m, bad in (("Quantity", 7, "six"), ("Price", 11, "9,99"), ("Customer ID", 13, "x17"), ("InvoiceDate", 17, "31.12.2010")):
            cells[c] = F.when(i % m == 0, F.lit(bad)).otherwise(cells[c])
    if breaks:
        cells["Description"] = F.when(F.col("StockCode") % 5 == 0, F.concat("Description", F.lit('\r\n"second",\n\nline'))).otherwise(F.col("Description"))
    canonical = [COLUMN_ALIASES.get(n, n) for n in header]
    path = scratch_path(spark, "retail-csv")
    (d.select(*[cells.get(c, F.col(c).cast("string")).alias(n) for n, c in zip(header, canonical)])
     .write.options(header=True, encoding="ISO-8859-1", **({"escape": '"', "quoteAll": True} if breaks else {})).csv(path))
    return path


def _csv_query(name: str):
    @query(name)
    def run(spark, sf_dir):
        """The dirty transactions written as CSV ('M/d/yyyy H:mm' dates), read back
        by the names in the header, typed and cleaned."""
        from tillroll.sources.retail_csv import read_transactions_csv
        return WS.shared_table(spark, sf_dir, name, lambda: C.clean(
            read_transactions_csv(spark, csv_file(spark, sf_dir, CSV_HEADERS[name]))))


for _name in CSV_HEADERS:
    _csv_query(_name)


@query("source_csv_line_breaks")
def q_source_csv_line_breaks(spark, sf_dir):
    """A file whose descriptions hold line breaks, quotes and commas, read back and cleaned."""
    from tillroll.sources.retail_csv import read_transactions_csv
    path = csv_file(spark, sf_dir, CSV_HEADERS["source_csv_canonical"], breaks=True)
    return C.clean(read_transactions_csv(spark, path))


@query("source_csv_problems")
def q_source_csv_problems(spark, sf_dir):
    """Counts of the values that typed columns cannot hold, over a file with broken cells."""
    from tillroll.sources.retail_csv import csv_problems, scan_text
    path = csv_file(spark, sf_dir, CSV_HEADERS["source_csv_reordered"], broken=True)
    return csv_problems(scan_text(spark, path), "M/d/yyyy H:mm")


@query("features_head")
def q_features_head(spark, sf_dir):
    """First 100 feature lines under an explicit total order (the preview sink)."""
    from tillroll.sources.sinks import head
    df = feature_lines(spark, sf_dir).drop("Description")
    return rounded(head(df, 100, ["Invoice", "StockCode", "Quantity", "Price", CUSTOMER]), {"TotalPrice": 4})


@query("score_rfm_bundle")
def q_score_rfm_bundle(spark, sf_dir):
    """Scaler + centroids + segment table saved as a bundle, loaded back and
    used to score the requests (persistence round trip)."""
    from tillroll.session import scratch_path
    from tillroll.sources import tracking as TR
    path = scratch_path(spark, "rfm-bundle")
    params = FE.fit_standard_scaler(rfm_customers(spark, sf_dir), CL.RFM_FEATURES)
    TR.save_rfm_bundle(spark, path, params, FIXED_CENTROIDS, SG.SERVING_SEGMENTS)
    out = SC.score_rfm_requests(rfm_requests(spark, sf_dir), TR.load_rfm_bundle(spark, path))
    return response_fields(out)


def report_text(spark, rows: DataFrame, name: str) -> DataFrame:
    from tillroll.session import scratch_path
    from tillroll.sources.sinks import write_report
    return spark.read.text(write_report(rows, scratch_path(spark, name)))


@query("report_dataset")
def q_report_dataset(spark, sf_dir):
    """Dataset report written as text lines and read back."""
    from tillroll.sources.sinks import head
    raw = raw_lines(spark, sf_dir)
    first = head(raw.select("Invoice", "StockCode", "Quantity", "Price"), 5, ["Invoice", "StockCode", "Quantity", "Price"])
    return report_text(spark, RP.dataset_report(P.dataset_summary(raw), P.missing_report(raw),
                                                P.describe(raw, ["Quantity", "Price"]), first), "dataset-report")


@query("report_preprocessing")
def q_report_preprocessing(spark, sf_dir):
    raw, cleaned = raw_lines(spark, sf_dir), clean_lines(spark, sf_dir)
    feats = FE.feature_engineering(cleaned)
    processed = FE.encode_and_scale(feats)
    return report_text(spark, RP.preprocessing_report(
        P.cleaning_lineage(raw, cleaned), P.schema_diff(raw, feats), FE.SCALE_FEATURES,
        cleaned.agg(F.count(F.lit(1)).alias("rows")), len(processed.columns)), "preprocessing-report")


@query("report_segments")
def q_report_segments(spark, sf_dir):
    """Segment analysis report written as text lines and read back."""
    labeled = labeled_customers(spark, sf_dir)
    return report_text(spark, RP.segment_report(scored_clusters(spark, sf_dir), SG.segment_metrics(labeled), labeled),
                       "segment-report")


@query("report_classification")
def q_report_classification(spark, sf_dir):
    counts = fixture_counts(spark, sf_dir)
    return report_text(spark, RP.classifier_report(CF.summary_metrics(counts, fixture_steps(spark, sf_dir)),
                                                   CF.classification_report(counts)), "classification-report")


@query("tracking_latest_run")
def q_tracking_latest_run(spark, sf_dir):
    """The labelling run logged twice, a second apart in the run table and with
    other values in the older one; the latest run is read back."""
    import datetime as dt
    from tillroll.session import scratch_path
    from tillroll.sources import tracking as TR
    path = scratch_path(spark, "runs")
    labeled = labeled_customers(spark, sf_dir)
    metrics = RP.labelling_metrics(SG.segment_metrics(labeled), labeled)
    tags = {"model_type": "none"}
    old = metrics.withColumn("value_num", F.col("value_num") + 1)
    TR.log_run(spark, path, "labelling", "labelling", {"method": "old"}, old, tags, start_time=dt.datetime(2024, 1, 1, 0, 0, 0))
    TR.log_run(spark, path, "labelling", "labelling", {"method": "rank sums"}, metrics, tags,
               start_time=dt.datetime(2024, 1, 1, 0, 0, 1))
    out = TR.latest_run(spark, path, "labelling")
    return rounded(out.select("run_name", "kind", "key", F.when(F.col("kind") != "metric", F.col("value")).alias("value"),
                              "value_num"))


@query("eda_weekday_hour_matrix")
def q_eda_weekday_hour_matrix(spark, sf_dir):
    """The heatmap as a matrix: one row per present weekday, hour columns 0..23."""
    return EDA.weekday_hour_matrix(FE.add_date_parts(S.activity(spark, sf_dir)))


@query("rfm_scaler_params")
def q_rfm_scaler_params(spark, sf_dir):
    """Scaler refit from the persisted RFM table (read back with its required
    columns checked), one row per feature."""
    from tillroll.sources.retail_csv import read_intermediate
    rfm_customers(spark, sf_dir)
    path = WS.table_path(spark, sf_dir, "rfm_log")
    rfm = read_intermediate(spark, path, required=[CUSTOMER, "Recency", "Frequency", "Monetary"])
    return rounded(FE.fit_standard_scaler(rfm, CL.RFM_FEATURES))


@query("score_customer_file")
def q_score_customer_file(spark, sf_dir):
    """Customer feature file (all customers of the classification table) scored
    by the forest and written back out."""
    from tillroll.session import scratch_path
    model, _ = forest_run(spark, sf_dir)
    src = scratch_path(spark, "customers-in")
    classifier_split(spark, sf_dir).drop("Segment", "is_test").write.parquet(src)
    return SC.score_customer_file(spark, model, src, scratch_path(spark, "customers-scored"))


@query("score_all_customers_checks")
def q_score_all_customers_checks(spark, sf_dir):
    """Both ways to score the customer table return every customer, with a known segment."""
    known = CF.class_names(forest_run(spark, sf_dir)[0])
    file = q_score_customer_file(spark, sf_dir).agg(F.count(F.lit(1)).alias("file_rows"),
                                                    F.every(F.col("segment").isin(known)).alias("file_segments_known"))
    raw = q_score_raw_categories(spark, sf_dir).agg(F.count(F.lit(1)).alias("raw_rows"),
                                                    F.every(F.col("predicted_class").isin(known)).alias("raw_segments_known"))
    from tillroll.functions.columns import attach_row
    return attach_row(file, raw)


def labels_fixture(spark, sf_dir):
    """labels: binary actual = quality, predicted = toxic, score = toxic (all ties)."""
    lb = S.read_table(spark, sf_dir, "labels")
    return lb.select("doc_id", F.col("quality").cast("string").alias("actual"),
                     F.col("toxic").cast("string").alias("predicted"), F.col("toxic").cast("double").alias("score"))


@query("classify_report_labels")
def q_classify_report_labels(spark, sf_dir):
    return rounded(CF.classification_report(CF.confusion_counts(labels_fixture(spark, sf_dir), "actual", "predicted")))


@query("classify_roc_auc_labels")
def q_classify_roc_auc_labels(spark, sf_dir):
    long = CF.one_vs_rest(labels_fixture(spark, sf_dir), "actual", {c: F.col("score") for c in ("0", "1")})
    return rounded(CF.roc_auc_by_class(CF.score_counts(long)))
