"""Per-customer basket behaviour: basket value / size / volatility, favourite day and country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER, day_name, ensure_timestamp, with_total_price


def basket_metrics(df: DataFrame) -> DataFrame:
    """AvgBasketValue, Volatility (sample std of basket value, 0 for one basket),
    AvgBasketSize per customer.

    Level one sums each (customer, invoice) basket, spread over tasks by both
    keys; level two is a map-side-combined per-customer aggregate.
    """
    df = with_total_price(df)
    baskets = (df.where(F.col(CUSTOMER).isNotNull()).groupBy(CUSTOMER, "Invoice")
               .agg(F.sum("TotalPrice").alias("_v"), F.sum("Quantity").alias("_q")))
    return baskets.groupBy(CUSTOMER).agg(
        F.avg("_v").alias("AvgBasketValue"),
        F.coalesce(F.stddev_samp("_v"), F.lit(0.0)).alias("Volatility"),
        F.avg("_q").alias("AvgBasketSize"),
    )


def favourites(df: DataFrame) -> DataFrame:
    """FavoriteDay (most frequent weekday name) and Country per customer.

    Mode over lines; ties go to the smallest value, all-null gives null.
    ``mode`` keeps a small value->count map per group (7 weekdays, a bounded
    set of countries) and combines map-side.
    """
    df = ensure_timestamp(df)
    return (df.where(F.col(CUSTOMER).isNotNull())
            .withColumn("_day", day_name("InvoiceDate"))
            .groupBy(CUSTOMER)
            .agg(F.mode("_day", deterministic=True).alias("FavoriteDay"),
                 F.mode("Country", deterministic=True).alias("Country")))


def classification_features(lines: DataFrame, labeled: DataFrame) -> DataFrame:
    """Basket metrics + favourites + Segment (inner joins on Customer ID).

    Both customer aggregates come out hash-partitioned by Customer ID, so the
    joins between them add no exchange.
    """
    feats = basket_metrics(lines).join(favourites(lines), on=CUSTOMER, how="inner")
    return feats.join(labeled.select(CUSTOMER, "Segment"), on=CUSTOMER, how="inner")
