"""Dataset profile: shape, duplicates, missing values, describe, cleaning lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER, attach_row, np_round
from tillroll.operators.eda import distinct_count
from tillroll.operators.quantiles import percentiles_exact

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def missing_report(df: DataFrame) -> DataFrame:
    """Column, DataType, Non_Null_Count, Missing_Count, Missing_Percentage (2 dp).

    One pass computes every column's null count; ``stack`` turns the single
    wide row into one row per column.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_m{i}"))
    wide = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    parts = []
    for i, c in enumerate(df.columns):
        parts += [F.lit(c), F.lit(dtypes[c]), F.col(f"_m{i}")]
    long = wide.select(
        F.col("_rows"),
        F.stack(F.lit(len(df.columns)), *parts).alias("Column", "DataType", "Missing_Count"),
    )
    return long.select(
        "Column", "DataType",
        (F.col("_rows") - F.col("Missing_Count")).cast("bigint").alias("Non_Null_Count"),
        F.col("Missing_Count").cast("bigint").alias("Missing_Count"),
        np_round(F.col("Missing_Count") * 100.0 / F.col("_rows"), 2).alias("Missing_Percentage"),
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, duplicate_rows (equal to an earlier row, nulls
    equal), total_missing. One aggregation on the full row, combined map-side,
    carries all of them."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    none = F.lit(0).cast("bigint")
    return per_row.agg(F.coalesce(F.sum("_n"), none).alias("rows"),
                       F.coalesce(F.sum(F.col("_n") - 1), none).alias("duplicate_rows"),
                       F.coalesce(F.sum(F.col("_n") * nulls), none).alias("total_missing")).select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"), "duplicate_rows", "total_missing")


def dtypes_table(df: DataFrame) -> DataFrame:
    """Column names and Spark types (schema only; no data job)."""
    return df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)],
                                           "position int, Column string, DataType string")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES or t.startswith("decimal")]


def describe(df: DataFrame, cols: list[str] | None = None, quartiles: dict | None = None) -> DataFrame:
    """pandas-style describe(): count, mean, std (ddof 1), min, 25/50/75 %, max.

    One row per column. Quartiles are exact linear-interpolated percentiles
    (distributed selection, see ``quantiles``); they may be passed in.
    """
    cols = cols or numeric_columns(df)
    q = quartiles or percentiles_exact(df, cols, [0.25, 0.5, 0.75])
    aggs, parts = [], []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        parts += [F.lit(c), F.col(f"n{i}").cast("bigint"), F.col(f"mean{i}"), F.col(f"std{i}"), F.col(f"min{i}"),
                  *[F.lit(q[c][p]).cast("double") for p in (0.25, 0.5, 0.75)], F.col(f"max{i}")]
    return df.agg(*aggs).select(F.stack(F.lit(len(cols)), *parts).alias(
        "Column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def cleaning_lineage(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows dropped per cleaning rule and distinct entities of the clean table.

    Reports each rule separately: null Description, null Customer ID (after
    the Description rule) and duplicate rows (after both). ``cleaned`` is read
    once for each distinct count, so pass the stored clean table.
    """
    d_null = F.col("Description").isNull()
    c_null = F.col(CUSTOMER).isNull() if CUSTOMER in raw.columns else F.lit(False)
    out = raw.agg(
        F.count(F.lit(1)).alias("original_rows"),
        F.count_if(d_null).alias("dropped_null_description"),
        F.count_if(~d_null & c_null).alias("dropped_null_customer"),
    )
    out = attach_row(out, cleaned.agg(F.count(F.lit(1)).alias("cleaned_rows")))
    for c, name in ((CUSTOMER, "unique_customers"), ("Invoice", "unique_invoices"), ("StockCode", "unique_products"),
                    ("Country", "unique_countries")):
        out = attach_row(out, distinct_count(cleaned, c, name))
    dropped = (F.col("original_rows") - F.col("dropped_null_description") - F.col("dropped_null_customer")
               - F.col("cleaned_rows"))
    return out.select("original_rows", "cleaned_rows", "dropped_null_description", "dropped_null_customer",
                      dropped.alias("dropped_duplicates"), "unique_customers", "unique_invoices", "unique_products",
                      "unique_countries")


def schema_diff(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns present in ``after`` but not in ``before`` (plan-time, no job)."""
    return [c for c in after.columns if c not in set(before.columns)]
