"""Request validation over JSON text columns (batch or streaming).

Each request is parsed once with ``try_parse_json`` (VARIANT); per field the
JSON type is read with ``schema_of_variant`` and mapped to the name a Python
JSON decoder would give it, so error messages match the reference service.
Everything stays in JVM expressions; malformed text simply becomes "not an
object".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Request fields and validation messages of the scoring service.
RFM_FIELDS = ["Recency", "Frequency", "Monetary"]
CLASSIFIER_NUMERIC = ["AvgBasketValue", "AvgBasketSize", "Volatility"]
CLASSIFIER_INT = ["FavoriteDay_Encoded", "Country_Encoded"]
MSG_NOT_OBJECT = "Request body must be a JSON object."
MSG_MISSING = "Missing required field: '{f}'."
MSG_TYPE = "Field '{f}' must be numeric, got {t}."
MSG_NEGATIVE = "Field '{f}' must be non-negative."



# VARIANT base type -> name of the Python type a JSON decoder yields.
PY_TYPE = {"VOID": "NoneType", "BOOLEAN": "bool", "STRING": "str", "ARRAY": "list", "OBJECT": "dict",
           "TINYINT": "int", "SMALLINT": "int", "INT": "int", "BIGINT": "int",
           "FLOAT": "float", "DOUBLE": "float", "DECIMAL": "float"}


def json_type_name(text: Column, v: Column, f: str) -> Column:
    """Python type name of field ``f`` (null when the key is absent).

    The VARIANT base type is looked up in a literal map; a DECIMAL whose JSON
    token has no fraction or exponent (a big integer) counts as int.
    """
    t = F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant")), r"^[A-Z]+", 0)
    mapped = F.create_map(*[F.lit(x) for kv in PY_TYPE.items() for x in kv])[t]
    big_int = (t == "DECIMAL") & F.get_json_object(text, f"$.{f}").rlike(r"^-?[0-9]+$")
    return F.when(big_int, F.lit("int")).otherwise(mapped)


def _check(f: str, allowed: list[str], non_negative: bool) -> Column:
    name, value = F.col(f"_t_{f}"), F.col(f"_n_{f}")
    c = (F.when(name.isNull(), F.lit(MSG_MISSING.format(f=f)))
         .when(~name.isin(*allowed), F.format_string(MSG_TYPE.replace("{f}", f).replace("{t}", "%s"), name)))
    if non_negative:
        c = c.when(value < 0, F.lit(MSG_NEGATIVE.format(f=f)))
    return c


def _validate(df: DataFrame, text_col: str, checks: list[tuple[str, list[str], bool]],
              value_fields: list[tuple[str, str]]) -> DataFrame:
    """Staged projections: parse once (``_v``), then one type name and one
    numeric value per field, then the first failing rule. Each stage is a
    small expression, so generated code stays compact and the JSON text is
    parsed a single time per row."""
    text = F.col(text_col)
    staged = df.withColumn("_v", F.try_parse_json(text))
    staged = staged.withColumns({
        "_obj": F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)),
        **{f"_t_{f}": json_type_name(text, F.col("_v"), f) for f, _, _ in checks},
        **{f"_n_{f}": F.try_variant_get(F.col("_v"), f"$.{f}", "double") for f, _, nn in checks if nn},
    })
    errs = [_check(f, allowed, nn) for f, allowed, nn in checks]
    out = staged.withColumn("error", F.when(~F.col("_obj"), F.lit(MSG_NOT_OBJECT)).otherwise(F.coalesce(*errs)))
    out = out.withColumn("valid", F.col("error").isNull())
    vals = {f: F.when(F.col("valid"), F.try_variant_get(F.col("_v"), f"$.{f}", t)) for f, t in value_fields}
    helper = ["_v", "_obj"] + [c for c in staged.columns if c.startswith("_t_") or c.startswith("_n_")]
    return out.withColumns(vals).drop(*helper)


def validate_rfm(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Adds error (first failing rule, null when valid), valid, and the three
    numeric fields (null for rejected rows). Booleans are not numbers."""
    checks = [(f, ["int", "float"], True) for f in RFM_FIELDS]
    return _validate(df, text_col, checks, [(f, "double") for f in RFM_FIELDS])


def validate_classifier(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Eight fields present and numeric; the two encoded fields must be integers.
    No sign rule."""
    checks = ([(f, ["int", "float"], False) for f in RFM_FIELDS + CLASSIFIER_NUMERIC]
              + [(f, ["int"], False) for f in CLASSIFIER_INT])
    fields = [(f, "double") for f in RFM_FIELDS + CLASSIFIER_NUMERIC] + [(f, "int") for f in CLASSIFIER_INT]
    return _validate(df, text_col, checks, fields)
