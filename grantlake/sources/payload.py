"""List-or-object payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_list(json: Column) -> Column:
    return json.rlike(r"^\s*\[")


def is_object(json: Column) -> Column:
    return json.rlike(r"^\s*\{")


def _opened(json: Column) -> Column:
    """The JSON inside a payload that is itself a JSON text of JSON; any other payload as it is."""
    inner = F.get(F.from_json(F.concat(F.lit("["), json, F.lit("]")), "array<string>"), F.lit(0))
    return F.when(json.rlike(r'^\s*"'), inner).otherwise(json)


def elements(json: Column) -> Column:
    """The elements of a JSON list, or the one JSON object, as an array of JSON texts; a text of either is read first."""
    json = _opened(json)
    return (
        F.when(is_list(json), F.from_json(json, "array<string>"))
        .when(is_object(json), F.array(json))
        .otherwise(F.array().cast("array<string>"))
    )


def explode_payload(df: DataFrame, payload: str, out: str = "raw", position: str = "_elem") -> DataFrame:
    """One row per payload element; payloads that are neither list nor object yield none."""
    kept = [c for c in df.columns if c != payload]
    return df.select(*kept, F.posexplode(elements(F.col(payload))).alias(position, out))
