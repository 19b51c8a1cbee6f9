from __future__ import annotations

from pyspark.sql import Column, functions as F


def variant_text(v: Column, path: str) -> Column:
    """Text of a field; JSON null and an absent key are both NULL."""
    return F.try_variant_get(v, path, "string")


# Leading word of a variant's schema text -> JSON type name.
_TYPE_NAMES = {
    "VOID": "null", "BOOLEAN": "boolean", "BIGINT": "integer", "DECIMAL": "float", "DOUBLE": "float", "FLOAT": "float",
    "STRING": "string", "ARRAY": "array", "OBJECT": "object",
}


def type_name(schema: Column) -> Column:
    """One of seven JSON type names from the text ``schema_of_variant`` gives.

    Whole numbers beyond 64 bits show as DECIMAL(p,0) with p of 19 or more; smaller
    decimals of scale 0 come from texts such as ``1.0`` and are floats. The schema text is
    referred to once, so it is computed once per value.
    """
    whole = F.regexp_replace(schema, r"^DECIMAL\((?:19|[23]\d),0\)$", "BIGINT")
    names = F.create_map(*[F.lit(x) for pair in _TYPE_NAMES.items() for x in pair])
    return F.try_element_at(names, F.regexp_extract(whole, "^[A-Z]+", 0))


def json_type(v: Column) -> Column:
    return type_name(F.schema_of_variant(v))


def shallow_json_type(v: Column) -> Column:
    """``json_type`` that opens objects and arrays by one level instead of walking all below them."""
    opens = lambda as_type: F.try_variant_get(v, "$", as_type).isNotNull()
    return F.when(opens("map<string,variant>"), "object").when(opens("array<variant>"), "array").otherwise(json_type(v))
