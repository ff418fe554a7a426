"""Typed columns from JSON text, with evidence of what could not be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def parse_json(df: DataFrame, column: str, schema: StructType, prefix: str = "", bad_col: str = "_bad_json") -> DataFrame:
    """``df`` with a typed column for each field of ``schema`` and ``bad_col``, the text where it could not be read.

    One pass under a declared schema: nothing is inferred.  A row is never lost: text that is no JSON object, or holds a
    value that its field's type cannot take, gives null for what is unreadable and is kept in ``bad_col``.  A missing
    field or an explicit null is null and not bad; a null text gives nulls and is not bad; other fields are ignored.
    """
    hidden = "__corrupt"
    read = F.from_json(F.col(column), StructType([*schema.fields, StructField(hidden, StringType())]),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": hidden})
    out = df.withColumn("__json", read)
    # an array or a bare value is valid JSON but no object
    no_object = F.col(column).isNotNull() & ~F.coalesce(F.ltrim(F.col(column)).startswith("{"), F.lit(False))
    bad = F.when(no_object, F.col(column)).otherwise(F.col(f"__json.{hidden}"))
    fields = [F.col(f"__json.`{f.name}`").alias(f"{prefix}{f.name}") for f in schema.fields]
    return out.select(*df.columns, *fields, bad.alias(bad_col))


def json_entries(df: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per entry of a JSON object of unknown keys: ``key`` and its ``value`` as text; rows without entries stay,
    with nulls."""
    entries = F.from_json(F.col(column), "map<string,string>")
    return df.select("*", F.explode_outer(entries).alias(key, value))
