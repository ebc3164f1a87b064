"""Exploratory aggregates: trends, top-k, weekday x hour matrix, histograms, KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER, attach_row, weekday_label, whole_days_between
from tillroll.operators.quantiles import percentiles_exact
from tillroll.operators.sampling import hash_key, random_sample


def distinct_count_by(df: DataFrame, keys: list[str], distinct_col: str, alias: str) -> DataFrame:
    """count(DISTINCT distinct_col) per key, written as two aggregations.

    The first level shuffles on (keys, distinct_col), so a coarse key (a month,
    a weekday) does not funnel every distinct value into a few tasks; the
    second level is a map-side-combined count.
    """
    pairs = df.where(F.col(distinct_col).isNotNull()).select(*keys, distinct_col).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def distinct_count(df: DataFrame, col: str, alias: str) -> DataFrame:
    """One row: count(DISTINCT col), as a distinct and a count of it."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().agg(F.count(F.lit(1)).alias(alias))


def monthly_revenue(df: DataFrame) -> DataFrame:
    """Year, Month, TotalPrice (sum), Date (first of month)."""
    return (df.where(F.col("Year").isNotNull() & F.col("Month").isNotNull())
            .groupBy("Year", "Month").agg(F.sum("TotalPrice").alias("TotalPrice"))
            .withColumn("Date", F.make_date("Year", "Month", F.lit(1))))


def monthly_active_customers(df: DataFrame) -> DataFrame:
    """Year, Month, ActiveCustomers (distinct customers), Date."""
    return (distinct_count_by(df.where(F.col("Year").isNotNull()), ["Year", "Month"], CUSTOMER, "ActiveCustomers")
            .withColumn("Date", F.make_date("Year", "Month", F.lit(1))))


def top_by(df: DataFrame, key: str, value: str, n: int = 10, out: str | None = None) -> DataFrame:
    """Top-n keys by summed value (ties broken by key); null keys dropped.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its n
    best, only n rows per task are merged.
    """
    out = out or value
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(out))
            .orderBy(F.col(out).desc(), F.col(key).asc()).limit(n))


def top_countries(df: DataFrame, n: int = 10) -> DataFrame:
    return top_by(df, "Country", "TotalPrice", n)


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    return top_by(df, "Description", "Quantity", n)


def top_customers(df: DataFrame, n: int = 10) -> DataFrame:
    t = top_by(df, CUSTOMER, "TotalPrice", n)
    return t.withColumn(CUSTOMER, F.col(CUSTOMER).cast("string"))


def weekday_hour_invoices(df: DataFrame) -> DataFrame:
    """Long form of the weekday x hour heatmap: DayOfWeek, Day, Hour, Invoices (distinct)."""
    t = distinct_count_by(df.where(F.col("DayOfWeek").isNotNull() & F.col("Hour").isNotNull()),
                          ["DayOfWeek", "Hour"], "Invoice", "Invoices")
    return t.withColumn("Day", weekday_label("DayOfWeek"))


def weekday_hour_matrix(df: DataFrame) -> DataFrame:
    """Wide heatmap: one row per present weekday (Mon..Sun order), columns 0..23,
    absent cells null. Pivot values are given, so no extra job finds them."""
    long = weekday_hour_invoices(df)
    wide = long.groupBy("DayOfWeek", "Day").pivot("Hour", list(range(24))).agg(F.first("Invoices"))
    return wide.orderBy("DayOfWeek")


def revenue_by_weekday(df: DataFrame) -> DataFrame:
    """DayOfWeek, TotalPrice, DayName."""
    return (df.where(F.col("DayOfWeek").isNotNull()).groupBy("DayOfWeek")
            .agg(F.sum("TotalPrice").alias("TotalPrice"))
            .withColumn("DayName", weekday_label("DayOfWeek", long=True)))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """numpy.histogram with equal-width bins over [min, max], last bin closed.

    bin, bin_start, bin_end, count for every bin (empty bins have count 0).
    Edges are ``min + i * (max - min) / bins`` and values are nudged across
    an edge exactly like numpy does, so counts match it bin for bin.
    """
    x = F.col(col).cast("double")
    stats = df.where(x.isNotNull()).agg(F.min(x).alias("mn"), F.max(x).alias("mx"))
    lo = F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn"))
    hi = F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx"))
    stats = stats.select(lo.alias("lo"), hi.alias("hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))

    def edge(i):
        return F.when(i == F.lit(bins), F.col("hi")).otherwise(i.cast("double") * step + F.col("lo"))

    rows = attach_row(df.where(x.isNotNull()).select(x.alias("_x")), stats)
    raw_i = F.floor((F.col("_x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))).cast("int")
    i0 = F.when(raw_i >= bins, F.lit(bins - 1)).otherwise(raw_i)
    i1 = F.when(F.col("_x") < edge(i0), i0 - 1).otherwise(i0)
    i2 = F.when((F.col("_x") >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1)
    counts = rows.select(i2.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    grid = stats.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    grid = grid.select("bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"))
    return (grid.join(counts, "bin", "left")
            .select("bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def trimmed_revenue(df: DataFrame, p99: float | None = None) -> tuple[DataFrame, float]:
    """Lines with 0 < TotalPrice < p99 (p99 over all rows), and p99."""
    if p99 is None:
        p99 = percentiles_exact(df, ["TotalPrice"], [0.99])["TotalPrice"][0.99]
    return df.where((F.col("TotalPrice") > 0) & (F.col("TotalPrice") < F.lit(p99))), p99


def revenue_histogram(df: DataFrame, bins: int = 50, p99: float | None = None) -> DataFrame:
    """Histogram of the outlier-trimmed TotalPrice."""
    return histogram(trimmed_revenue(df, p99)[0], "TotalPrice", bins)


def revenue_stats(df: DataFrame, p99: float | None = None) -> DataFrame:
    """One row: p99, n, mean and median of the outlier-trimmed TotalPrice."""
    kept, p99 = trimmed_revenue(df, p99)
    med = percentiles_exact(kept, ["TotalPrice"], [0.5])["TotalPrice"][0.5]
    return kept.agg(F.count(F.lit(1)).alias("n"), F.avg("TotalPrice").alias("mean")).select(
        F.lit(p99).cast("double").alias("p99"), "n", "mean", F.lit(med).cast("double").alias("median"))


def purchase_counts(df: DataFrame) -> DataFrame:
    """Customer ID, PurchaseCount = distinct invoices per customer."""
    return distinct_count_by(df.where(F.col(CUSTOMER).isNotNull()), [CUSTOMER], "Invoice", "PurchaseCount")


def purchase_frequency_stats(df: DataFrame) -> DataFrame:
    """One row: customers, avg / max purchases per customer, single-purchase customers."""
    pc = purchase_counts(df)
    return pc.agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("PurchaseCount").alias("avg_purchases_per_customer"),
        F.max("PurchaseCount").cast("bigint").alias("max_purchases_by_customer"),
        F.count_if(F.col("PurchaseCount") == 1).alias("single_purchase_customers"),
    )


def purchase_frequency_histogram(df: DataFrame, clip: int = 50, bins: int = 50) -> DataFrame:
    pc = purchase_counts(df).select(F.least(F.col("PurchaseCount"), F.lit(clip)).alias("PurchaseCount"))
    return histogram(pc, "PurchaseCount", bins)


def quantity_price_sample(df: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """Up to n positive (Quantity, Price) lines, chosen by a seeded hash order."""
    pos = df.where((F.col("Quantity") > 0) & (F.col("Price") > 0))
    key = hash_key(F.concat_ws(":", F.col("Invoice").cast("string"), F.col("StockCode").cast("string"),
                               F.col("Quantity").cast("bigint").cast("string")), seed)
    order = ["Invoice", "StockCode", "Quantity", "Price"]
    return random_sample(pos.select(*order, key.alias("_k")), n, "_k", tiebreak=order, hashed=True).drop("_k")


def kpis(df: DataFrame, median: float | None = None) -> DataFrame:
    """One row of headline numbers for the cleaned transactions (their names are
    fixed values: the metric keys of the EDA step)."""
    med = median if median is not None else percentiles_exact(df, ["TotalPrice"], [0.5])["TotalPrice"][0.5]
    base = df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("TotalPrice").alias("total_revenue"),
        F.avg("TotalPrice").alias("avg_transaction_value"),
        whole_days_between(F.min("InvoiceDate"), F.max("InvoiceDate")).alias("date_range_days"),
    )
    # two-level distinct counts, one narrow scan each, instead of an Expand of all lines
    for c, name in ((CUSTOMER, "unique_customers"), ("StockCode", "unique_products"), ("Country", "unique_countries")):
        base = attach_row(base, distinct_count(df, c, name))
    return base.withColumn("median_transaction_value", F.lit(med).cast("double"))
