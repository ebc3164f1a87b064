"""Hypothesis properties from the test strategy (few examples: each runs Spark jobs)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.operators import clustering as CL
from tillroll.operators import eda as EDA
from tillroll.operators import sampling as SM
from tillroll.operators import segments as SG

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

cluster_rows = st.lists(
    st.tuples(st.integers(0, 5), st.integers(1, 400), st.floats(0, 5), st.floats(0, 12)),
    min_size=4, max_size=60)


@SETTINGS
@given(cluster_rows)
def test_cluster_percentages_sum_to_100_and_positions_are_a_permutation(spark, rows):
    df = spark.createDataFrame([(c, float(r), f, m) for c, r, f, m in rows],
                               "Cluster int, Recency double, Frequency double, Monetary double")
    scored = SG.score_clusters(SG.cluster_summary(df)).collect()
    assert abs(sum(r["Percentage"] for r in scored) - 100.0) < 1e-9
    assert sorted(r["Position"] for r in scored) == list(range(1, len(scored) + 1))
    k = len(scored)
    assert abs(sum(r["R_Score"] for r in scored) - k * (k + 1) / 2) < 1e-9


@SETTINGS
@given(st.lists(st.floats(-1e4, 1e4, allow_nan=False), min_size=1, max_size=300), st.integers(1, 60))
def test_histogram_counts_sum_to_n(spark, xs, bins):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    h = EDA.histogram(df, "v", bins).collect()
    assert len(h) == bins and sum(r["count"] for r in h) == len(xs)
    counts, _ = np.histogram(np.array(xs), bins=bins)
    assert [r["count"] for r in sorted(h, key=lambda r: r["bin"])] == counts.tolist()


@SETTINGS
@given(st.lists(st.sampled_from(["A", "B", "C"]), min_size=1, max_size=200), st.floats(0.05, 0.95))
def test_split_partitions_the_data(spark, classes, frac):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(classes)], "id long, cls string")
    out = SM.stratified_split(df, "cls", "id", frac, 7)
    assert out.count() == len(classes)
    assert out.select("id").distinct().count() == len(classes)
    for c in set(classes):
        n = classes.count(c)
        assert out.where((F.col("cls") == c) & F.col("is_test")).count() == int(np.floor(n * frac + 0.5))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(-3, 3), st.floats(-3, 3)), min_size=3, max_size=80))
def test_silhouette_in_range(spark, pts):
    df = spark.createDataFrame([(i, l, [a, b]) for i, (l, a, b) in enumerate(pts)],
                               "id long, label long, vec array<double>")
    s = [r["silhouette"] for r in CL.silhouette_samples(df, "id", "vec", "label").collect()]
    assert all(-1.0 - 1e-12 <= v <= 1.0 + 1e-12 for v in s)


def test_partitions_are_coalesced_to_sixteen_megabytes(spark):
    from pyspark.sql import functions as F
    from tillroll.session import BASE_CONF
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, BASE_CONF[key])
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = spark.range(3_000_000).select(F.md5(F.col("id").cast("string")).alias("k")).distinct()  # some 110 MB
        parts = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 750_000
