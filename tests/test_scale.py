"""What a task holds must not follow the session's partition count."""

import pytest
from pyspark.sql import functions as F

from tillroll import session
from tillroll.sources import tables as S

from conftest import SF_SMALL


@pytest.fixture
def two_partitions(spark):
    conf = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)
    spark.conf.unset(session.INITIAL_PARTITIONS)


def test_partitions_follow_the_rows_not_the_session(spark, two_partitions):
    session.partitions_for(spark, 3_000_000)
    rows = spark.range(3_000_000).select(F.md5(F.col("id").cast("string")).alias("k")).distinct()  # some 110 MB
    parts = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 750_000


def test_transaction_queries_set_it_and_others_do_not(spark, two_partitions, monkeypatch):
    import __spark_entry__ as E
    monkeypatch.setattr(session, "PARTITION_ROWS", 100)
    lines = S.read_table(spark, SF_SMALL, "lineitem").count()
    E.queries()["features_one_hot_counts"](spark, SF_SMALL)
    assert spark.conf.get(session.INITIAL_PARTITIONS) == str(-(-lines // 100))
    E.queries()["op8_url_filters"](spark, SF_SMALL)
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_many_customers_and_parts_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 10)
    plan = S.retail_dirty(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") <= 1 and plan.count("SortMergeJoin") == 3
