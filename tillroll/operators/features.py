"""Feature engineering: date parts, TotalPrice, invoice basket stats, one-hot, scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import ensure_timestamp, weekday_index, with_total_price

MAX_ONE_HOT_CATEGORIES = 1000  # columns that one-hot encoding may add (a parameter)


def add_date_parts(df: DataFrame) -> DataFrame:
    """Year, Month, Day, Hour, DayOfWeek (0 = Monday) from InvoiceDate."""
    if "InvoiceDate" not in df.columns:
        return df
    df = ensure_timestamp(df)
    ts = F.col("InvoiceDate")
    return df.withColumns({
        "Year": F.year(ts),
        "Month": F.month(ts),
        "Day": F.dayofmonth(ts),
        "Hour": F.hour(ts),
        "DayOfWeek": weekday_index(ts),
    })


def invoice_stats(df: DataFrame) -> DataFrame:
    """Per invoice: TransactionSize = sum(Quantity), UniqueItems = distinct StockCode.

    Two-level: (Invoice, StockCode) first, so one huge invoice is spread over
    tasks; the per-invoice level then combines map-side.
    """
    per_item = df.groupBy("Invoice", "StockCode").agg(F.sum("Quantity").alias("_q"))
    return per_item.groupBy("Invoice").agg(
        F.sum("_q").alias("TransactionSize"),
        F.count("StockCode").alias("UniqueItems"),
    )


def with_invoice_stats(df: DataFrame) -> DataFrame:
    """Left join of the invoice stats back onto the lines (key unique on the right).

    Adaptive execution splits a skewed invoice partition on the line side or
    turns the join into a broadcast when the stats side is measured small.
    """
    return df.join(invoice_stats(df), on="Invoice", how="left")


def feature_engineering(df: DataFrame) -> DataFrame:
    df = add_date_parts(df)
    if "Quantity" in df.columns and "Price" in df.columns:
        df = with_total_price(df)
        if "Invoice" in df.columns and "StockCode" in df.columns:
            df = with_invoice_stats(df)
    return df


def category_values(df: DataFrame, col: str, max_categories: int = MAX_ONE_HOT_CATEGORIES) -> list[str]:
    """Sorted distinct non-null values. Each becomes a column, so more than
    ``max_categories`` of them is an error (use an indexer)."""
    values = df.where(F.col(col).isNotNull()).select(col).distinct().limit(max_categories + 1).collect()
    if len(values) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories: use an indexer")
    return sorted(r[0] for r in values)


def one_hot(df: DataFrame, col: str = "Country", prefix: str | None = None,
            categories: list[str] | None = None, max_categories: int = MAX_ONE_HOT_CATEGORIES) -> DataFrame:
    """``<prefix>_<value>`` 0/1 int columns for each category; the source column is dropped."""
    if col not in df.columns:
        return df
    prefix = prefix or col
    cats = categories if categories is not None else category_values(df, col, max_categories)
    cols = {f"{prefix}_{v}": F.when(F.col(col) == F.lit(v), 1).otherwise(0).cast("int") for v in cats}
    return df.withColumns(cols).drop(col)


def fit_standard_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, scale) with population std; zero variance -> scale 1.

    One aggregation; the result has one row per feature.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    wide = df.agg(*aggs)
    parts = []
    for i, c in enumerate(cols):
        parts += [F.lit(c), F.col(f"m{i}"),
                  F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}"))]
    return wide.select(F.stack(F.lit(len(cols)), *parts).alias("feature", "mean", "scale"))


def standard_scale(df: DataFrame, cols: list[str], params: DataFrame | None = None,
                   suffix: str = "") -> DataFrame:
    """(x - mean) / scale for each column. The fitted parameters (one row per
    feature) are fetched once and applied as literals."""
    params = params if params is not None else fit_standard_scaler(df, cols)
    p = {r["feature"]: (r["mean"], r["scale"]) for r in params.collect()}
    return df.withColumns({
        f"{c}{suffix}": (F.col(c).cast("double") - F.lit(p[c][0])) / F.lit(p[c][1]) for c in cols
    })


SCALE_FEATURES = ["Quantity", "Price", "TotalPrice", "TransactionSize", "UniqueItems"]


def encode_and_scale(df: DataFrame) -> DataFrame:
    """Country one-hot and standard scaling of the five line features."""
    df = one_hot(df, "Country")
    cols = [c for c in SCALE_FEATURES if c in df.columns]
    return standard_scale(df, cols) if cols else df
