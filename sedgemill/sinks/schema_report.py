"""Schema report as text, Markdown or JSON, rendered row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sedgemill.operators import profile as pf
from sedgemill.operators.shuffles import with_row_index
from sedgemill.session import written

# Rules and marks of the report.
WIDE, THIN, TREE = "=" * 65, "-" * 65, "-" * 40
BRANCH, LEAF = "├─ ", "└─ sample item:"

HEAD, FILES, TAIL = 0, 1, 2


def _quoted(names: Column) -> Column:
    """``['a', 'b']``; an empty list gives ``[]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", "), F.lit("]"))


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _node_text() -> Column:
    kind = F.col("type")
    tag = F.concat(F.lit("["), kind, F.lit("]"))
    num = lambda c: F.col(c).cast("string")
    uniform = F.when(F.col("is_uniform"), "True").otherwise("False")
    return (
        F.when(kind == "object", _text(tag, "  (", num("field_count"), " fields)"))
        .when(kind == "array", _text(tag, "  length=", num("length"), "  item_types=", _quoted(F.col("item_types")), "  uniform=", uniform))
        .when(kind == "string", _text(tag, "  length=", num("length"), '  example="', F.translate("example", "\r\n", "  "), '"'))
        .when(kind.isin("integer", "float"), _text(tag, "  value=", F.col("value")))
        .otherwise(tag))


def _tree_lines(fields: DataFrame, indent: int) -> DataFrame:
    """Two lines per field below the root: its name and its description."""
    pad = lambda extra: F.repeat(F.lit("  "), F.col("depth") * 2 + indent + extra)
    name = F.element_at("trail", -1)
    label = F.when(F.col("depth") > 0, F.concat(
        pad(-1), F.when(name == pf.ITEM, F.lit(LEAF)).otherwise(_text(BRANCH, name, ":"))))
    lines = F.array_compact(F.array(label, F.concat(pad(0), _node_text())))
    return fields.select("path", F.lit(50).alias("step"), "trail", F.posexplode(lines).alias("sub", "line"))


def _numbered(profile: DataFrame) -> DataFrame:
    return with_row_index(profile, [F.split("path", "/")], "file_no")


def _file_lines(files: DataFrame, total: int, generated: str, style: str) -> tuple[Column, Column]:
    """Lines before and after the schema tree of one file."""
    ok = F.col("success")
    no = (F.col("file_no") + 1).cast("string")
    size = F.format_number("file_size_bytes", 0)
    kind = F.col("root_type")
    keys = F.array_join("top_level_keys", ", ")
    count = F.col("top_level_count").cast("string")
    length = F.format_number("array_length", 0)
    if style == "text":
        before = [
            _text("FILE ", no, f"/{total}: ", F.col("filename")), F.lit(THIN),
            _text("  Path      : ", F.col("path")), F.lit(f"  Analyzed  : {generated}"),
            F.when(~ok, _text("  ✗ ERROR   : ", F.col("error"))),
            F.when(ok, _text("  Size      : ", size, " bytes")),
            F.when(ok, _text("  Root type : ", kind)),
            F.when(kind == "object", _text("  Keys (", count, "): ", keys)),
            F.when(kind == "array", _text("  Length    : ", length)),
            F.when(kind == "array", _text("  Item types: ", _quoted(F.col("item_types")))),
            F.when(ok, ""), F.when(ok, "  SCHEMA TREE"), F.when(ok, "  " + TREE),
        ]
        after = [F.lit("")]
    else:
        before = [
            F.lit("---"), _text("## ", no, ". `", F.col("filename"), "`"), F.lit(""),
            F.lit("| Property | Value |"), F.lit("|----------|-------|"),
            _text("| Path | `", F.col("path"), "` |"), F.lit(f"| Analyzed | {generated} |"),
            F.when(~ok, "| Status | ❌ Error |"), F.when(~ok, _text("| Error | ", F.col("error"), " |")),
            F.when(ok, _text("| Size | ", size, " bytes |")), F.when(ok, _text("| Root type | `", kind, "` |")),
            F.when(ok, "| Status | ✅ OK |"), F.when(ok, ""),
            F.when(kind == "object", _text("**Top-level keys (", count, "):** ", F.array_join(
                F.transform("top_level_keys", lambda k: _text("`", k, "`")), ", "))),
            F.when(kind == "array", _text("**Array length:** ", length)),
            F.when(ok, ""), F.when(ok, "### Schema Tree"), F.when(ok, "```"),
        ]
        after = [F.when(ok, "```"), F.lit("")]
    return F.array_compact(F.array(*before)), F.array_compact(F.array(*after))


def _compared(style: str, sets: DataFrame, types: DataFrame, compared: int) -> list[DataFrame]:
    """Lines (step, trail, sub, line) of the comparison of root-object files."""
    text = style == "text"
    tick = (lambda c: F.col(c)) if text else (lambda c: _text("`", F.col(c), "`"))
    name = F.substring_index("path", "/", -1)
    none = F.array().cast("array<string>")
    fixed = lambda df, step, *lines: df.select(
        F.lit(step).alias("step"), none.alias("trail"), F.posexplode(F.array_compact(F.array(*lines))).alias("sub", "line"))
    listed = lambda df, step, line, trail=("key", "path"), sub=0: df.select(
        F.lit(step).alias("step"), F.array(*trail).alias("trail"), F.lit(sub).alias("sub"), line.alias("line"))
    unshared = pf.unshared_keys(types, F.lit(compared))
    conflicts = written(pf.type_conflicts(types, F.lit(compared)), "json-conflicts")

    totals = pf.json_consistency(sets)
    value = lambda c: F.col(c).cast("string")
    all_shared, none_shared = F.col("all_keys") == F.col("shared_keys"), F.col("shared_keys") == 0
    conflict = conflicts.agg((F.count("*") > 0).alias("any"))
    if text:
        counts = [
            F.lit(f"  Files compared : {compared}"), _text("  Total keys     : ", value("all_keys")),
            _text("  Shared keys    : ", value("shared_keys")), _text("  Consistency    : ", value("consistency_pct"), "%"), F.lit(""),
            F.when(none_shared, "  Shared keys  : none")]
        unique = [F.when(all_shared, "  Unique keys  : none").otherwise("  Unique keys (key → files that have it):")]
        mixed = [F.when(F.col("any"), ""), F.when(F.col("any"), "  ⚠  TYPE CONFLICTS:").otherwise("  Type conflicts: none  ✓")]
        lines = ["  Shared key: ", "    • ", " → ", ""]
        headed, typed = _text("    • '", F.col("key"), "':"), _text("        ", name, ": ", F.col("type"))
    else:
        counts = [
            F.lit(f"| Files compared | {compared} |"), _text("| Total keys | ", value("all_keys"), " |"),
            _text("| Shared keys | ", value("shared_keys"), " |"), _text("| Consistency | **", value("consistency_pct"), "%** |"), F.lit("")]
        unique = [F.when(~all_shared, ""), F.when(~all_shared, "**Unique keys:**"), F.when(~all_shared, "")]
        mixed = [F.lit(""), F.when(F.col("any"), "### ⚠️ Type Conflicts").otherwise("✅ **No type conflicts detected.**"), F.lit("")]
        lines = ["**Shared key:** ", "- ", " → found only in: *", "*"]
        headed, typed = _text("**", tick("key"), "**"), _text("- `", name, "` → `", F.col("type"), "`")
    heads = conflicts.groupBy("key").agg(F.max("path").alias("path"))
    return [
        fixed(totals, 10, *counts),
        listed(sets.where("shared"), 20, _text(lines[0], tick("key")), ("key",)),
        fixed(totals, 25, *unique),
        listed(unshared, 30, _text(lines[1], tick("key"), lines[2], name, lines[3])),
        fixed(conflict, 35, *mixed),
        listed(heads, 40, headed, ("key",)),
        listed(conflicts, 40, typed),
        *([] if text else [listed(heads, 40, F.lit(""), sub=1)]),  # behind a key's last file
    ]


def schema_report(files: DataFrame, generated: str, style: str = "text") -> DataFrame:
    """Report lines; sort by (block, file_no, step, trail, sub) for reading order.

    The comparison lists shared, unshared and conflicting keys in one line per key and
    file, so a key found in very many files makes many lines, not a long one. It is left
    out where no file is a root object. The key types are written once and serve all of it.
    """
    profile = _numbered(pf.json_file_profile(files))
    total, compared = profile.agg(F.count("*"), F.count_if(F.col("root_type") == "object")).first()
    before, after = _file_lines(profile, total, generated, style)
    none = F.array().cast("array<string>")
    part = lambda step, lines: profile.select(
        F.lit(FILES).alias("block"), "file_no", F.lit(step).alias("step"), none.alias("trail"), F.posexplode(lines).alias("sub", "line"))
    tree = _tree_lines(pf.json_field_profile(files), 1 if style == "text" else 0).join(
        profile.select("path", "file_no"), "path").select(F.lit(FILES).alias("block"), "file_no", "step", "trail", "sub", "line")

    spark = files.sparkSession
    fixed = lambda block, step, lines: spark.range(1).select(
        F.lit(block).alias("block"), F.lit(0).cast("bigint").alias("file_no"), F.lit(step).alias("step"), none.alias("trail"),
        F.posexplode(F.array(*[F.lit(x) for x in lines])).alias("sub", "line"))
    if style == "text":
        head = fixed(HEAD, 0, [WIDE, "  JSON SCHEMA ANALYSIS REPORT", f"  Generated : {generated}", f"  Files     : {total}", WIDE, ""])
        middle = [WIDE, "  CROSS-FILE COMPARISON", THIN]
        end = [fixed(TAIL, 90, ["", WIDE])]
    else:
        head = fixed(HEAD, 0, ["# JSON Schema Analysis Report", "", f"> **Generated:** {generated}  ", f"> **Files analyzed:** {total}", ""])
        middle = ["---", "## Cross-File Comparison", "", "| Metric | Value |", "|--------|-------|"]
        end = []
    tail = []
    if compared:
        types = written(pf.json_key_types(files), "json-keys")
        sets = written(pf.key_sets(types, F.lit(compared)), "json-sets")
        tail = [fixed(TAIL, 0, middle), *[
            lines.select(F.lit(TAIL).alias("block"), F.lit(0).cast("bigint").alias("file_no"), "step", "trail", "sub", "line")
            for lines in _compared(style, sets, types, compared)]]
    out = head
    for more in (part(10, before), tree, part(90, after), *tail, *end):
        out = out.unionByName(more)
    return out


def _write_json(files: DataFrame, path: str, generated: str) -> None:
    """Tables ``files``, ``fields``, ``keys``, ``unique``, ``conflicts`` and one row of ``summary`` as JSON lines.

    ``shared`` of a key says whether all compared files have it; the compared files are
    those of root type object. Without any the summary has a note and no key is listed.
    """
    profile = written(pf.json_file_profile(files), "json-files")
    total, compared = profile.agg(F.count("*"), F.count_if(F.col("root_type") == "object")).first()
    types = written(pf.json_key_types(files), "json-keys")
    sets = written(pf.key_sets(types, F.lit(compared)), "json-sets")
    profile.withColumn("analyzed", F.lit(generated)).write.json(f"{path}/files")
    pf.json_field_profile(files).drop("trail").write.json(f"{path}/fields")
    sets.write.json(f"{path}/keys")
    pf.unshared_keys(types, F.lit(compared)).write.json(f"{path}/unique")
    pf.type_conflicts(types, F.lit(compared)).write.json(f"{path}/conflicts")
    note = "No root-object files to compare." if total and not compared else None
    pf.json_consistency(sets).select(
        F.lit(generated).alias("generated"), F.lit(total).alias("file_count"), F.lit(compared).alias("files_compared"),
        "all_keys", "shared_keys", "consistency_pct", F.lit(note).cast("string").alias("note")).write.json(f"{path}/summary")


def write_schema_report(files: DataFrame, path: str, generated: str, fmt: str = "text") -> None:
    """Write the report below ``path``: ordered lines (``text``, ``markdown``), or JSON tables for ``json``."""
    if fmt == "json":
        _write_json(files, path, generated)
        return
    if fmt not in ("text", "markdown"):
        raise ValueError(f"unknown format {fmt}")
    lines = schema_report(files, generated, fmt)
    lines.orderBy("block", "file_no", "step", "trail", "sub").select("line").write.text(path)
