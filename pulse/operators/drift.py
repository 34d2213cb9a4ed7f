"""Schema drift: fields that events carry and the fixed schema does not have.

The fixed schema drops what it does not name and nulls what has another type.
Here an event is read as a VARIANT, so every field it has can be reported with
its type, and any of them can be read by its path, without a new schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulse.operators.parse import decode_value
from pulse.schema import EVENT_SCHEMA

# How the types of the fixed schema show in JSON; VOID (null) fits each.
_JSON_TYPES = {"string": "STRING", "boolean": "BOOLEAN", "int": "BIGINT", "bigint": "BIGINT", "struct": "OBJECT"}


def schema_paths(schema: StructType = EVENT_SCHEMA, prefix: str = "") -> dict[str, str]:
    """Path -> JSON type of every field of a schema, nested ones by dots."""
    out = {}
    for f in schema.fields:
        nested = isinstance(f.dataType, StructType)
        out[prefix + f.name] = _JSON_TYPES["struct" if nested else f.dataType.simpleString()]
        if nested:
            out.update(schema_paths(f.dataType, f"{prefix}{f.name}."))
    return out


def _entries(v: Column) -> Column:
    return F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))


def event_fields(df: DataFrame, col: str = "value") -> DataFrame:
    """``stream, path, type``: one row per field of each event, of its top level and of the objects there.

    ``type`` is the JSON type (``BIGINT``, ``STRING``, ``OBJECT``, ``ARRAY``, ...).
    Text that is not a JSON object has no fields. One pass, no shuffle.
    """
    text = decode_value(df, col).select(F.try_parse_json("json_str").alias("v"))
    top = F.coalesce(_entries(F.col("v")), F.array().cast("array<struct<key:string,value:variant>>"))
    read = text.select(F.try_variant_get("v", "$.meta.stream", "string").alias("stream"), top.alias("top"))
    below = F.flatten(F.transform("top", lambda e: F.transform(F.coalesce(_entries(e["value"]), F.array().cast("array<struct<key:string,value:variant>>")),
                                                              lambda s: F.struct(F.concat(e["key"], F.lit("."), s["key"]).alias("key"), s["value"].alias("value")))))
    fields = read.select("stream", F.explode(F.concat("top", below)).alias("f"))
    return fields.select("stream", F.col("f.key").alias("path"), F.regexp_extract(F.schema_of_variant("f.value"), r"^[A-Z]+", 0).alias("type"))


def schema_drift(df: DataFrame, col: str = "value", schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """``stream, path, type, n, problem``: fields that ``schema`` drops (``unknown``) or nulls (``other_type``), counted per stream.

    Partial counts before the shuffle; the result has a row per stream, path and type.
    """
    paths = schema_paths(schema)
    known = F.create_map(*(x for p, t in paths.items() for x in (F.lit(p), F.lit(t))))
    fields = event_fields(df, col)
    want = F.try_element_at(known, F.col("path"))
    problem = F.when(want.isNull(), F.lit("unknown")).when(~F.col("type").isin("VOID") & (want != F.col("type")) & (want != "STRING"), F.lit("other_type"))
    return fields.select("*", problem.alias("problem")).where(F.col("problem").isNotNull()).groupBy("stream", "path", "type", "problem").agg(F.count(F.lit(1)).alias("n"))


def field(path: str, as_type: str, col: str = "value") -> Column:
    """Any field of an event by its path (``meta.request_id``), null where it is absent or of another type."""
    return F.try_variant_get(F.try_parse_json(F.col(col).cast("string")), f"$.{path}", as_type)
