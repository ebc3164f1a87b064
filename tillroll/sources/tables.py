"""Driver-table scans and the retail fixture views built from them.

The fixture views are plain DataFrame plans over the given Parquet tables, so
every query built on them scans the whole tables and its work grows with them.
Filters and projections applied later are pushed into the Parquet scans by
Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.retail_csv import normalise_columns

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BROADCAST_ROWS = 100_000


def _not_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Merged with what it is joined to if it has many rows, however small the planner takes it for."""
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def retail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction lines in the raw 8-column layout (``CustomerID`` spelling).

    lineitem -> orders on the invoice key, -> part for the unit price and
    description, -> customer -> nation for the country. Returned lines have a
    negative Quantity for late return lines (returnflag R, linenumber >= 6).
    Join order is chosen for scale: orders meet customer x nation first (an
    orders-sized shuffle on the customer key), so only two lineitem-sized
    shuffles remain (order key, part key). The nation side is tiny and is
    broadcast by the planner's size check; customers and parts grow with the
    data, so beyond ``BROADCAST_ROWS`` they are merged and not held by the driver.
    Adaptive execution splits a hot order, part or customer key.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linenumber")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    ocn = o.join(_not_broadcast(cn, c.count()), o.o_custkey == cn.c_custkey)
    qty = (F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 6), -F.col("l_quantity"))
           .otherwise(F.col("l_quantity")))
    return (
        li.join(_not_broadcast(ocn, o.count()), li.l_orderkey == ocn.o_orderkey)
        .join(_not_broadcast(p, p.count()), li.l_partkey == p.p_partkey)
        .select(
            F.col("o_orderkey").alias("Invoice"),
            F.col("l_partkey").alias("StockCode"),
            F.col("p_name").alias("Description"),
            qty.alias("Quantity"),
            F.col("o_orderdate").alias("InvoiceDate"),
            F.col("p_retailprice").alias("Price"),
            F.col("o_custkey").alias("CustomerID"),
            F.col("n_name").alias("Country"),
        )
    )


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``retail_raw`` after column-alias normalisation (``Customer ID``)."""
    return normalise_columns(retail_raw(spark, sf_dir))


def retail_dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic nulls and full-row duplicates injected into every line.

    Description is null for StockCode % 97 = 0, CustomerID is null for
    Invoice % 4 = 0, and every line of Invoice % 50 = 0 appears twice. The
    copies come from one scan (explode of a 1- or 2-element sequence), not
    from a second scan + union.
    """
    d = retail_raw(spark, sf_dir)
    copies = F.when(F.col("Invoice") % 50 == 0, F.lit(2)).otherwise(F.lit(1))
    return (
        d.select(
            "Invoice", "StockCode",
            F.when(F.col("StockCode") % 97 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("Description")).alias("Description"),
            "Quantity", "InvoiceDate", "Price",
            F.when(F.col("Invoice") % 4 == 0, F.lit(None).cast("bigint"))
            .otherwise(F.col("CustomerID")).alias("CustomerID"),
            "Country",
            F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
        ).drop("_copy")
    )


def retail_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_columns(retail_dirty_raw(spark, sf_dir))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows in the transaction layout; InvoiceDate carries a time of day."""
    e = read_table(spark, sf_dir, "events")
    return normalise_columns(e.select(
        F.col("event_id").alias("Invoice"),
        F.col("event_type").alias("StockCode"),
        F.lit(1).cast("bigint").alias("Quantity"),
        F.col("ts").alias("InvoiceDate"),
        F.col("value").alias("Price"),
        F.col("user_id").alias("CustomerID"),
    ))
