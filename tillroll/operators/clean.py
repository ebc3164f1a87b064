"""Cleaning rules: null Description, null Customer ID, id cast, full-row dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import CUSTOMER


def drop_null_description(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["Description"]) if "Description" in df.columns else df


def drop_null_customer(df: DataFrame) -> DataFrame:
    """Keep real customers only; the id becomes a long (text ``17850.0`` too)."""
    if CUSTOMER not in df.columns:
        return df
    out = df.dropna(subset=[CUSTOMER])
    dtype = dict(out.dtypes)[CUSTOMER]
    if dtype != "bigint":
        out = out.withColumn(CUSTOMER, F.col(CUSTOMER).cast("double").cast("bigint"))
    return out


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup (nulls compare equal), one shuffle on the whole row."""
    return df.distinct()


def clean(df: DataFrame) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 in the reference order."""
    return df.transform(drop_null_description).transform(drop_null_customer).transform(drop_duplicate_rows)
