"""Schema profile of many JSON files: per file, per field, and across files.

Input rows are (path, size, text), one file each. Files are told apart by their path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sedgemill.functions import json_type, shallow_json_type
from sedgemill.operators.shuffles import lookup_join
from sedgemill.session import written

MAX_DEPTH = 10
EXAMPLE_LENGTH = 80
ITEM = "[]"
ROOT = "$"


def read_json_files(spark: SparkSession, paths: str | list[str], glob: str = "*.json") -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(paths, wholetext=True)
    return rows.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("text"))


def _parsed(files: DataFrame) -> DataFrame:
    return files.withColumn("_v", F.try_parse_json("text"))


def _items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _type_names(items: Column) -> Column:
    """Distinct type names of an array's items, sorted."""
    return F.array_sort(F.array_distinct(F.transform(items, shallow_json_type)))


def json_file_profile(files: DataFrame) -> DataFrame:
    """One row per file. Keys stand in the order of the text, which is parsed for them once."""
    v, kind, keys, items = F.col("_v"), F.col("_kind"), F.col("_keys"), F.col("_items")
    rows = _parsed(files).select("path", "size", "text", "_v", _items(v).alias("_items"), shallow_json_type(v).alias("_kind"))
    rows = rows.withColumn("_keys", F.when(kind == "object", F.array_distinct(F.json_object_keys("text"))))
    return rows.select(
        "path",
        F.substring_index("path", "/", -1).alias("filename"),
        v.isNotNull().alias("success"),
        F.when(v.isNull(), F.lit("invalid JSON")).alias("error"),
        F.when(v.isNotNull(), F.col("size")).alias("file_size_bytes"),
        kind.alias("root_type"),
        keys.alias("top_level_keys"),
        F.when(keys.isNotNull(), F.size(keys)).alias("top_level_count"),
        F.when(kind == "array", F.size(items)).alias("array_length"),
        F.when(kind == "array", _type_names(items)).alias("item_types"),
    )


def _described(level: DataFrame, deep: bool) -> DataFrame:
    """A row for each value of one depth; ``open_v`` keeps those that have values below."""
    v, fields, items, types = F.col("_v"), F.col("_fields"), F.col("_items"), F.col("_types")
    if deep:
        return level.select(
            "path", "trail", F.lit("unknown").alias("type"), F.lit(None).cast("int").alias("items"),
            F.lit(None).cast("int").alias("field_count"), F.lit(None).cast("array<string>").alias("item_types"),
            F.lit(None).cast("string").alias("text"), F.lit(None).cast("variant").alias("open_v"), F.lit(False).alias("opens"))
    rows = level.select("path", "trail", "_v", F.try_variant_get(v, "$", "map<string,variant>").alias("_fields"), _items(v).alias("_items"))
    opens = F.coalesce(F.size(fields), F.size(items), F.lit(0)) > 0
    return rows.select(
        "path", "trail", F.when(fields.isNotNull(), "object").when(items.isNotNull(), "array").otherwise(json_type(v)).alias("type"),
        F.size(items).alias("items"), F.size(fields).alias("field_count"), _type_names(items).alias("item_types"),
        F.when(fields.isNull() & items.isNull(), F.try_variant_get(v, "$", "string")).alias("text"),
        F.when(opens, v).alias("open_v"), opens.alias("opens"))


def _below(described: DataFrame) -> DataFrame:
    """The values one depth below; an array is entered through its first item that is not null, or the first."""
    items = _items(F.col("open_v"))
    sample = F.coalesce(F.get(F.filter(items, lambda i: ~F.is_variant_null(i)), 0), F.get(items, 0))
    entry = lambda key, value: F.struct(key.alias("key"), value.alias("value"))
    fields = F.map_entries(F.try_variant_get("open_v", "$", "map<string,variant>"))
    entries = F.when(F.col("type") == "object", F.transform(fields, lambda e: entry(e["key"], e["value"]))).otherwise(
        F.array(entry(F.lit(ITEM), sample)))
    rows = described.where("opens").select("path", "trail", F.explode(entries).alias("_e"))
    return rows.select("path", F.concat("trail", F.array("_e.key")).alias("trail"), F.col("_e.value").alias("_v"))


def json_field_profile(files: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per field path of every readable file.

    Goes down one depth at a time. The values of a depth are rows of a written table: their
    description, and the value itself only of objects and arrays that hold something, from
    which the next depth is read. So a row holds one value, files spread over tasks with
    their fields, and the walk ends with the deepest value. Arrays are entered through
    their first item that is not null; values below ``max_depth`` are ``unknown``.
    ``trail`` is the path as an array, so parents sort before children.
    """
    level = _parsed(files).where(F.col("_v").isNotNull()).select("path", F.array(F.lit(ROOT)).alias("trail"), "_v")
    rows = None
    for depth in range(max_depth + 2):
        described = written(_described(level, depth > max_depth), "json-depth")
        part = described.drop("open_v", "opens")
        rows = part if rows is None else rows.unionByName(part)
        if described.where("opens").isEmpty():
            break
        level = _below(described)

    kind, text, types = F.col("type"), F.col("text"), F.col("item_types")
    cut = F.concat(F.left(text, F.lit(EXAMPLE_LENGTH)), F.when(F.length(text) > EXAMPLE_LENGTH, "...").otherwise(""))
    return rows.select(
        "path", F.array_join("trail", ".").alias("field"), "trail", (F.size("trail") - 1).alias("depth"), "type",
        F.when(kind == "string", F.length(text)).when(kind == "array", F.col("items")).alias("length"),
        F.when(kind == "string", cut).alias("example"),
        F.when(kind.isin("integer", "float"), text).alias("value"),
        F.when(kind == "array", types).alias("item_types"),
        F.when(kind == "array", F.size(types) <= 1).alias("is_uniform"),
        F.when(kind == "object", F.col("field_count")).alias("field_count"),
        F.when(kind == "unknown", "max depth reached").alias("note"),
    )


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _object_files(files: DataFrame) -> DataFrame:
    return _parsed(files).where(_is_object(F.col("_v")))


def json_key_types(files: DataFrame) -> DataFrame:
    """(path, key, type) of the top-level keys of root-object files."""
    # Files of another root type have no entries.
    entries = _parsed(files).select("path", F.explode(F.try_variant_get("_v", "$", "map<string,variant>")).alias("key", "_value"))
    return entries.select("path", "key", shallow_json_type(F.col("_value")).alias("type"))


def _file_count(files: DataFrame) -> Column:
    return _object_files(files).agg(F.count("*")).scalar()


def key_sets(key_types: DataFrame, file_count: Column) -> DataFrame:
    """Keys, in how many files they are, and whether in all ``file_count`` of them."""
    keys = key_types.groupBy("key").agg(F.count("*").alias("files"))
    return keys.withColumn("shared", F.col("files") == file_count)


def unshared_keys(key_types: DataFrame, file_count: Column) -> DataFrame:
    some = key_sets(key_types, file_count).where(~F.col("shared")).select("key")
    return lookup_join(key_types.select("key", "path"), some, ["key"], "left_semi")


def type_conflicts(key_types: DataFrame, file_count: Column) -> DataFrame:
    mixed = key_types.groupBy("key").agg(
        F.count("*").alias("files"), F.min("type").alias("lo"), F.max("type").alias("hi")
    ).where((F.col("files") == file_count) & (F.col("lo") != F.col("hi"))).select("key")
    return lookup_join(key_types, mixed, ["key"], "left_semi").select("key", "path", "type")


def json_key_sets(files: DataFrame) -> DataFrame:
    """Top-level keys of the root-object files, in how many they are, and whether in all."""
    return key_sets(json_key_types(files), _file_count(files))


def json_unshared_keys(files: DataFrame) -> DataFrame:
    """Keys that some files lack, one row per file that has them."""
    return unshared_keys(json_key_types(files), _file_count(files))


def json_type_conflicts(files: DataFrame) -> DataFrame:
    """Shared keys with more than one type: the type in every file."""
    return type_conflicts(json_key_types(files), _file_count(files))


def json_consistency(sets: DataFrame) -> DataFrame:
    """Share of keys that every file has, in percent; 100 without any key."""
    shared, total = F.count_if("shared"), F.count("*")
    share = F.bround(shared / F.nullif(total, F.lit(0)) * 100, 1)
    return sets.agg(
        total.alias("all_keys"), shared.alias("shared_keys"), F.coalesce(share, F.lit(100.0)).alias("consistency_pct"))
