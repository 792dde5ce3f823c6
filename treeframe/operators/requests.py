"""Request validation: one row in, one verdict out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Request kinds, their required fields, and the error texts.
REQUIRED = {
    "parse": ("content", "language"),
    "parse-file": ("file_path",),
    "check-language": ("language",),
}
NO_BODY = "No request body"
INVALID_JSON = "Invalid JSON"
NOT_FOUND = "Not found"

_BODY_DDL = "array<struct<content:string,language:string,file_path:string>>"


def _missing(fields: tuple[str, ...]) -> str:
    label = "Missing required field" + ("s" if len(fields) > 1 else "")
    return f"{label}: {', '.join(fields)}"


def _absent(name: str) -> Column:
    """Whether a field is missing or holds an empty or zero value, of any JSON type."""
    value = F.col(f"request.{name}")
    nothing = value.rlike(r"^(?:-?0[0.]*(?:[eE][+-]?[0-9]+)?|false|null|\[\s*\]|\{\s*\})$")
    # Read as text, 0 and "0" are alike; only what looks like nothing is parsed again for its type.
    kind = F.try_variant_get(F.try_parse_json("_body"), f"$.{name}", "variant")
    is_text = F.coalesce(F.schema_of_variant(kind), F.lit("VOID")) == "STRING"
    return F.when(value.isNull() | (value == ""), True).when(nothing, ~is_text).otherwise(False)


def validate_requests(df: DataFrame, kind: str = "kind", body: str = "body") -> DataFrame:
    """Add the parsed fields and ``error`` (NULL when the request is valid).

    An empty or zero value counts as missing: "", 0, false, null, [] and {}. Checks
    run in the order body, JSON, kind, fields.
    """
    # Read as the only element of an array: text after the object is then an error.
    parsed = df.withColumn(
        "_read",
        F.from_json(
            F.concat(F.lit("["), F.col(body), F.lit("]")), _BODY_DDL, {"allowSingleQuotes": "false"}
        ),
    ).withColumns({"request": F.get("_read", F.lit(0)), "_body": F.col(body)})
    is_object = F.col(body).rlike(r"^\s*\{") & (F.coalesce(F.size("_read"), F.lit(0)) == 1)
    error = (
        F.when(F.coalesce(F.col(body), F.lit("")) == "", F.lit(NO_BODY))
        .when(~is_object, F.lit(INVALID_JSON))
        .when(~F.col(kind).isin(*REQUIRED), F.lit(NOT_FOUND))
    )
    for name, fields in REQUIRED.items():
        absent = _absent(fields[0])
        for field in fields[1:]:
            absent = absent | _absent(field)
        error = error.when((F.col(kind) == name) & absent, F.lit(_missing(fields)))
    return parsed.select(
        *df.columns, "request.content", "request.language", "request.file_path",
        error.alias("error"),
    )
