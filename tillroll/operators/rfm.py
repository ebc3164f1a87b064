"""Recency / Frequency / Monetary per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER, ensure_timestamp, whole_days_between, with_total_price


def rfm_raw(df: DataFrame) -> DataFrame:
    """Per customer: last purchase, distinct invoices, summed TotalPrice, Recency.

    Two-level aggregation: (customer, invoice) first, so a customer owning a
    large share of all lines is spread over many tasks; the per-customer
    aggregate then runs on one row per invoice with map-side partial
    aggregation. The reference date (last purchase over all lines + 1 day)
    is a scalar subquery: one pruned column, a map-side max, no shuffle (a
    subquery over the customer aggregate would recompute both shuffles).
    Rows with a null customer are dropped (pandas groupby drops null keys).
    """
    df = with_total_price(ensure_timestamp(df))
    per_invoice = (
        df.where(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER, "Invoice")
        .agg(F.max("InvoiceDate").alias("_last"), F.sum("TotalPrice").alias("_value"))
    )
    per_customer = per_invoice.groupBy(CUSTOMER).agg(
        F.max("_last").alias("LastPurchase"),
        F.count(F.lit(1)).alias("Frequency_raw"),
        F.sum("_value").alias("Monetary_raw"),
    )
    reference_date = df.agg(F.max("InvoiceDate")).scalar() + F.expr("INTERVAL 1 DAY")
    return per_customer.withColumn("Recency", whole_days_between("LastPurchase", reference_date))


def positive_rfm(df: DataFrame) -> DataFrame:
    """Monetary > 0 and Frequency > 0 and Recency >= 0 (before the log)."""
    return df.where((F.col("Monetary_raw") > 0) & (F.col("Frequency_raw") > 0) & (F.col("Recency") >= 0))


def rfm_log(df: DataFrame) -> DataFrame:
    """RFM with log1p Frequency / Monetary, the clustering input.

    Columns: Customer ID, Recency (bigint days), Frequency = log1p(invoices),
    Monetary = log1p(spend), plus the raw counterparts.
    """
    r = positive_rfm(rfm_raw(df))
    return r.select(
        CUSTOMER,
        "Recency",
        F.log1p("Frequency_raw").alias("Frequency"),
        F.log1p("Monetary_raw").alias("Monetary"),
        "Frequency_raw",
        "Monetary_raw",
    )
