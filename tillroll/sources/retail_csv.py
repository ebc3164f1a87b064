"""Transaction-file scans (CSV with declared schema) and intermediate-table scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import COLUMN_ALIASES, parse_timestamp, timestamp_format
from tillroll.sources.csv_records import has_broken_fields, read_records
from tillroll.sources.sinks import materialize


class MissingInputError(FileNotFoundError):
    """Raised when a step's input table or file cannot be read."""


# Declared schema of the raw transactions file; never inferred.
RAW_FIELDS = [
    ("Invoice", T.StringType()),
    ("StockCode", T.StringType()),
    ("Description", T.StringType()),
    ("Quantity", T.LongType()),
    ("InvoiceDate", T.StringType()),
    ("Price", T.DoubleType()),
    ("Customer ID", T.DoubleType()),
    ("Country", T.StringType()),
]

# Text tokens a pandas CSV reader treats as missing.
NULL_TOKENS = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "#N/A", "<NA>"]


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename InvoiceNo->Invoice, UnitPrice->Price, CustomerID->Customer ID when present."""
    ren = {k: v for k, v in COLUMN_ALIASES.items() if k in df.columns and v not in df.columns}
    return df.withColumnsRenamed(ren) if ren else df


def _not_found(exc: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc)


def scan_text(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """The file's columns as text under canonical names, placed by the header's
    names in whatever order it has them. Text null tokens become nulls. Lines
    that are longer or shorter than the header are kept, with their text in
    ``_corrupt``. Quoted fields may hold line breaks, which stay; a quote that is
    never closed makes one corrupt line of the rest of its file. ISO-8859-1
    decodes every byte; a UTF-8 file is read as such with ``encoding="UTF-8"``. A
    missing path raises ``MissingInputError``."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("quote", '"').option("escape", '"')
    try:
        names = reader.csv(path).columns  # one line is read
    except AnalysisException as exc:
        if _not_found(exc):
            raise MissingInputError(path) from exc
        raise
    names = [n.lstrip("\ufeff\u00ef\u00bb\u00bf").strip() for n in names]
    canonical = [COLUMN_ALIASES.get(n, n) for n in names]
    missing = [n for n, _ in RAW_FIELDS if n not in canonical]
    if missing:
        raise ValueError(f"{path} has no column {missing}; its header is {names}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in canonical] + [T.StructField("_corrupt", T.StringType())])
    if has_broken_fields(spark, path):
        record = F.from_csv("value", schema.toDDL(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "quote": '"', "escape": '"'})
        df = (read_records(spark, path, encoding).where(~F.col("first"))  # the header of each file
              .select(record.alias("_record"), F.when(~F.col("closed"), F.col("value")).alias("_open")).select("_record.*", "_open")
              .withColumn("_corrupt", F.coalesce("_corrupt", "_open")))
    else:
        df = (reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
              .option("columnPruning", False).csv(path))  # else short lines go unnoticed
    return df.select(*[F.when(~F.trim(n).isin(NULL_TOKENS), F.col(n)).alias(n) for n in canonical], "_corrupt")


def _typed(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.col(name)
    number = F.trim(name).try_cast("double")
    if not isinstance(kind, T.LongType):
        return number
    # whole numbers may be written 6 or 6.0
    return F.coalesce(F.trim(name).try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint")))


def csv_problems(text: DataFrame, date_format: str) -> DataFrame:
    """One row: lines, corrupt_lines (not as many fields as the header), and for
    each typed column the values that it cannot hold."""
    bad = [(n, _typed(n, k)) for n, k in RAW_FIELDS if not isinstance(k, T.StringType)]
    bad.append(("InvoiceDate", parse_timestamp("InvoiceDate", date_format)))
    return text.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("_corrupt").isNotNull()).alias("corrupt_lines"),
                    *[F.count_if(F.col(n).isNotNull() & v.isNull()).alias("bad_" + n.replace(" ", "_")) for n, v in bad])


def read_transactions_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", date_format: str | None = None,
                          allow_bad: bool = False) -> DataFrame:
    """A transactions CSV in either column spelling and any column order, typed.

    InvoiceDate is read by one format: ``date_format``, or the first that parses
    every value (an error if none does). Values that a typed column cannot hold
    are an error with their counts, unless ``allow_bad`` makes them nulls. The
    file is parsed once: its cells are stored, and the passes over them read the
    columns they need.
    """
    text = materialize(scan_text(spark, path, encoding), "csv-cells")
    date_format = date_format or timestamp_format(text, "InvoiceDate")
    if not allow_bad:
        row = csv_problems(text, date_format).first().asDict()
        if bad := {k: v for k, v in row.items() if k != "lines" and v}:
            raise ValueError(f"{path}: {bad} of {row['lines']} lines; pass allow_bad to read them as nulls")
    return text.select(*[(parse_timestamp(n, date_format) if n == "InvoiceDate" else _typed(n, k)).alias(n)
                         for n, k in RAW_FIELDS])


def read_intermediate(spark: SparkSession, path: str, required: list[str] | None = None,
                      fmt: str = "parquet") -> DataFrame:
    """Read a table written by an earlier step and check its required columns."""
    try:
        df = spark.read.format(fmt).option("header", True).option("inferSchema", fmt == "csv").load(path)
    except AnalysisException as exc:
        if _not_found(exc):
            raise MissingInputError(path) from exc
        raise
    missing = [c for c in (required or []) if c not in df.columns]
    if missing:
        raise ValueError(f"{path} is missing required columns: {missing}")
    return df
