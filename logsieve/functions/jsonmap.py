"""JSON text -> map, and key lowering."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_to_map(c: Column) -> Column:
    """one JSON object level as map<string,string>; nested values stay JSON text."""
    return F.from_json(c, "map<string,string>")


def json_to_nested_map(c: Column) -> Column:
    """F6 with its second level: map<string, struct<text, fields>>. `text` is the value
    as text; `fields` is the map of a nested object's own values, null for others. What is
    an object goes by the value's type: a string that looks like one is a string."""
    def value(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        nested, text = kind.startswith("OBJECT"), F.to_json(v)
        return F.struct(F.when(nested | kind.startswith("ARRAY"), text).otherwise(v.cast("string")).alias("text"),
                        F.when(nested, json_to_map(text)).alias("fields"))
    return F.transform_values(F.from_json(c, "map<string,variant>"), lambda _, v: value(v))


def json_lower_keys(c: Column) -> Column:
    """the top-level object of JSON text with lower-case keys, as map<string,string>.

    Keys equal but for case accumulate, as the JSON library does: the value becomes a JSON
    array of the colliding values in key order, each with its own type. A single value is
    its text. An object without such keys, the usual case, is read in one pass.
    """
    read = F.from_json(c, "map<string,variant>")
    entries = F.map_entries(read)
    lowered = F.transform(entries, lambda e: F.lower(e["key"]))
    keys = F.array_distinct(lowered)
    values = F.transform(keys, lambda k: F.transform(F.filter(entries, lambda e: F.lower(e["key"]) == k), lambda e: e["value"]))
    merged = F.transform(values, lambda vs: F.when(F.size(vs) == 1, F.get(vs, 0).cast("string")).otherwise(
        F.concat(F.lit("["), F.array_join(F.transform(vs, lambda v: F.to_json(v)), ",", "null"), F.lit("]"))))
    return F.when(F.size(keys) == F.size(lowered), F.map_from_arrays(lowered, F.transform(entries, lambda e: e["value"].cast("string")))) \
        .otherwise(F.map_from_arrays(keys, merged))
