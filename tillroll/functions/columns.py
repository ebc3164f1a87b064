"""Column-expression helpers. All return JVM-side ``Column`` expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Canonical column spellings of the two retail file variants.
COLUMN_ALIASES = {
    "InvoiceNo": "Invoice",
    "UnitPrice": "Price",
    "CustomerID": "Customer ID",
}

CUSTOMER = "Customer ID"

# Weekday labels indexed 0=Monday .. 6=Sunday.
WEEKDAY_SHORT = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WEEKDAY_LONG = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Timestamp spellings tried in order when InvoiceDate arrives as text.
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "d/M/yyyy H:mm",
    "yyyy-MM-dd",
    "M/d/yyyy",
]

MICROS_PER_DAY = 86_400_000_000


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column, fmt: str) -> Column:
    """Text -> timestamp by one format; null where the text doesn't fit it."""
    return F.try_to_timestamp(col_of(c).cast("string"), F.lit(fmt))


def _signs(c: Column) -> Column:
    """What a text has besides digits, + and -."""
    return F.translate(F.lower(F.trim(c)), "0123456789+-", "")


def _format_signs(fmt: str) -> str | None:
    """What the texts of a format of digits have besides them; None for other formats."""
    parts = fmt.split("'")
    letters = "".join(parts[::2])
    if fmt != fmt.strip() or len(parts) % 2 == 0 or "''" in fmt or "MMM" in letters or re.search(r"[^yMdHhmsS/:., -]", letters):
        return None
    return "".join(x.lower() if i % 2 else re.sub(r"[A-Za-z-]", "", x) for i, x in enumerate(parts))


def timestamp_format(df: DataFrame, name: str, formats: list[str] = TIMESTAMP_FORMATS) -> str:
    """The first format that parses every non-null value of a text column.

    One aggregation tries all formats, each on the texts with its separators
    alone (a failed parse costs many times a successful one). A column is read by
    one format only, so day-first and month-first dates never mix; if none fits
    all, that is an error that names the best one and how many values it leaves."""
    text = F.col(name).cast("string")
    rows = df.select(text.alias("_text"), _signs(text).alias("_signs"))

    def parsed(fmt: str) -> Column:
        signs = _format_signs(fmt)
        value = parse_timestamp("_text", fmt)
        return value if signs is None else F.when(F.col("_signs") == signs, value)

    left = rows.agg(*[F.count_if(F.col("_text").isNotNull() & parsed(f).isNull()).alias(f"f{i}") for i, f in enumerate(formats)]).first()
    best = min(range(len(formats)), key=lambda i: left[i])
    if left[best]:
        raise ValueError(f"no timestamp format fits all of {name}: {formats[best]} leaves {left[best]} values")
    return formats[best]


def ensure_timestamp(df: DataFrame, name: str = "InvoiceDate", fmt: str | None = None) -> DataFrame:
    """Parse a text timestamp column (no-op for timestamp types)."""
    if name not in df.columns:
        return df
    dtype = dict(df.dtypes)[name]
    if dtype.startswith("timestamp") or dtype == "date":
        return df
    return df.withColumn(name, parse_timestamp(name, fmt or timestamp_format(df, name)))


def weekday_index(c: str | Column) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(col_of(c))


def day_name(c: str | Column) -> Column:
    """'Monday' .. 'Sunday'."""
    return F.date_format(col_of(c), "EEEE")


def weekday_label(idx: str | Column, long: bool = False) -> Column:
    names = WEEKDAY_LONG if long else WEEKDAY_SHORT
    return F.element_at(F.array(*[F.lit(n) for n in names]), col_of(idx).cast("int") + 1)


def micros_between(start: str | Column, end: str | Column) -> Column:
    """Exact elapsed microseconds, independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", col_of(start), col_of(end))


def whole_days_between(start: str | Column, end: str | Column) -> Column:
    """Floor of the elapsed time in 24-hour days (timedelta ``.days``)."""
    return F.floor(micros_between(start, end) / F.lit(MICROS_PER_DAY)).cast("bigint")


def np_round(c: str | Column, digits: int) -> Column:
    """numpy-style rounding: rint(x * 10^d) / 10^d (ties to even on the scaled value)."""
    scale = float(10 ** digits)
    return F.rint(col_of(c) * F.lit(scale)) / F.lit(scale)


def with_total_price(df: DataFrame) -> DataFrame:
    """TotalPrice = Quantity * Price, added only when absent."""
    if "TotalPrice" in df.columns:
        return df
    return df.withColumn("TotalPrice", (F.col("Quantity") * F.col("Price")).cast("double"))


def segment_or_default(cluster: str | Column, mapping: dict[int, str]) -> Column:
    """Dictionary lookup with a ``Cluster_<id>`` fallback for unknown ids."""
    m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(int(k)), F.lit(v))])
    c = col_of(cluster)
    return F.coalesce(m[c.cast("int")], F.concat(F.lit("Cluster_"), c.cast("string")))


def sanitize_key(c: str | Column) -> Column:
    """Metric-key form of a label: spaces become underscores."""
    return F.replace(col_of(c), F.lit(" "), F.lit("_"))


def importance_band(c: str | Column) -> Column:
    """Chart band of a feature importance."""
    c = col_of(c)
    return F.when(c > 0.1, "high").when(c > 0.01, "medium").otherwise("low")


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``.

    Expressed as a struct-valued scalar subquery (evaluated once, shipped as
    a literal), so no join is planned.
    """
    s = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.select("*", s.alias("_attached")).select(
        *[F.col(c) for c in df.columns], *[F.col(f"_attached.{c}").alias(c) for c in one_row.columns])


def join_small(df: DataFrame, small: DataFrame, on: str | list[str], how: str = "left",
               broadcast_rows: int = 10_000) -> DataFrame:
    """Join a table that is usually small (one row per cluster, class or code).

    Its rows are counted up to the bound; within it the table is broadcast, and
    beyond it the planner joins it like any other (adaptive execution splits
    hot keys)."""
    if small.limit(broadcast_rows + 1).count() <= broadcast_rows:
        small = F.broadcast(small)
    return df.join(small, on=on, how=how)


def fixed_layout(df: DataFrame, cols: list[str], rows_per_partition: int = 100_000, least: int = 16) -> DataFrame:
    """Rows dealt by the hash of ``cols`` and sorted, over a number of partitions
    that follows the row count alone, so that what samples or adds per partition
    doesn't depend on the cores."""
    n = max(least, -(-df.count() // rows_per_partition))
    return df.repartition(n, *cols).sortWithinPartitions(*cols)
