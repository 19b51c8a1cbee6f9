"""JSON schema profiles over documents built from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedgemill.operators import profile as pf
from sedgemill.plans.fixtures import VIEWS, fixture, with_views
from sedgemill.plans.registry import query
from sedgemill.session import new_folder
from sedgemill.sinks import write_schema_report

# Whole documents of four kinds: objects with and without tags, arrays, broken text.
VIEWS["f_json"] = (["events"], """
SELECT event_id AS n, concat('events/', CAST(event_id AS STRING), '.json') AS path,
  CASE WHEN event_id % 50 = 0 THEN concat('{"kind": ', event_type)
       WHEN event_id % 20 = 1 THEN concat('[null, ', CAST(user_id AS STRING), ', "', event_type, '"]')
       ELSE concat('{"kind": "', event_type, '", "user": ',
              CASE WHEN event_id % 3 = 0 THEN concat('"u', CAST(user_id AS STRING), '"') ELSE CAST(user_id AS STRING) END,
              ', "ok": ', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'null' END,
              CASE WHEN event_id % 4 = 0 THEN concat(', "tags": [', CAST(event_id AS STRING), ', 1.5, 2]') ELSE '' END,
              ', "props": ', props, '}') END AS text,
  event_type, user_id, props, event_id % 50 = 0 AS broken, event_id % 50 <> 0 AND event_id % 20 = 1 AS is_list
FROM events
""")


def files(spark, sf_dir) -> DataFrame:
    rows = fixture(spark, sf_dir, "f_json")
    return rows.select("path", F.length("text").cast("bigint").alias("size"), "text")


JSON_SQL = with_views("f_json")


@query("json_file_profile", JSON_SQL + """
SELECT path, split_part(path, '/', 2) AS filename, NOT broken AS success, CASE WHEN broken THEN 'invalid JSON' END AS error,
  CASE WHEN NOT broken THEN CAST(length(text) AS BIGINT) END AS file_size_bytes,
  CASE WHEN broken THEN NULL WHEN is_list THEN 'array' ELSE 'object' END AS root_type,
  CASE WHEN broken OR is_list THEN NULL WHEN n % 4 = 0 THEN 'kind,user,ok,tags,props' ELSE 'kind,user,ok,props' END AS top_level_keys,
  CAST(CASE WHEN broken OR is_list THEN NULL WHEN n % 4 = 0 THEN 5 ELSE 4 END AS INTEGER) AS top_level_count,
  CAST(CASE WHEN is_list THEN 3 END AS INTEGER) AS array_length, CASE WHEN is_list THEN 'integer,null,string' END AS item_types
FROM f_json
""")
def json_file_profile_query(spark, sf_dir):
    joined = lambda c: F.array_join(c, ",").alias(c)
    rows = pf.json_file_profile(files(spark, sf_dir))
    return rows.select(*[joined(c) if c in ("top_level_keys", "item_types") else c for c in rows.columns])


FIELDS_SQL = JSON_SQL + """,
obj AS (SELECT * FROM f_json WHERE NOT broken AND NOT is_list),
lists AS (SELECT * FROM f_json WHERE is_list),
k AS (SELECT *, replace(split_part(props, ': ', 2), '}', '') AS kv FROM obj),
fields AS (
  SELECT path, '$' AS field, 0 AS depth, 'object' AS type, CAST(NULL AS INTEGER) AS length, CAST(NULL AS VARCHAR) AS example,
    CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS item_types, CAST(NULL AS BOOLEAN) AS is_uniform,
    CASE WHEN n % 4 = 0 THEN 5 ELSE 4 END AS field_count FROM obj
  UNION ALL SELECT path, '$.kind', 1, 'string', CAST(length(event_type) AS INTEGER), event_type, NULL, NULL, NULL, NULL FROM obj
  UNION ALL SELECT path, '$.user', 1, CASE WHEN n % 3 = 0 THEN 'string' ELSE 'integer' END,
    CASE WHEN n % 3 = 0 THEN CAST(length(CAST(user_id AS VARCHAR)) + 1 AS INTEGER) END,
    CASE WHEN n % 3 = 0 THEN concat('u', user_id) END, CASE WHEN n % 3 <> 0 THEN CAST(user_id AS VARCHAR) END, NULL, NULL, NULL FROM obj
  UNION ALL SELECT path, '$.ok', 1, CASE WHEN n % 2 = 0 THEN 'boolean' ELSE 'null' END, NULL, NULL, NULL, NULL, NULL, NULL FROM obj
  UNION ALL SELECT path, '$.tags', 1, 'array', 3, NULL, NULL, 'float,integer', false, NULL FROM obj WHERE n % 4 = 0
  UNION ALL SELECT path, '$.tags.[]', 2, 'integer', NULL, NULL, CAST(n AS VARCHAR), NULL, NULL, NULL FROM obj WHERE n % 4 = 0
  UNION ALL SELECT path, '$.props', 1, 'object', NULL, NULL, NULL, NULL, NULL, 1 FROM obj
  UNION ALL SELECT path, '$.props.k', 2, 'integer', NULL, NULL, kv, NULL, NULL, NULL FROM k
  UNION ALL SELECT path, '$', 0, 'array', 3, NULL, NULL, 'integer,null,string', false, NULL FROM lists
  UNION ALL SELECT path, '$.[]', 1, 'integer', NULL, NULL, CAST(user_id AS VARCHAR), NULL, NULL, NULL FROM lists)
"""


@query("json_field_profile", FIELDS_SQL + "SELECT * FROM fields")
def json_field_profile_query(spark, sf_dir):
    rows = pf.json_field_profile(files(spark, sf_dir))
    return rows.select(
        "path", "field", "depth", "type", "length", "example", "value", F.array_join("item_types", ",").alias("item_types"),
        "is_uniform", "field_count")


KEYS_SQL = FIELDS_SQL + """,
keyed AS (SELECT path, substr(field, 3) AS key, type FROM fields WHERE depth = 1 AND field <> '$.[]'),
sets AS (SELECT key, count(*) AS files, count(*) = (SELECT count(*) FROM obj) AS shared FROM keyed GROUP BY key)
"""


@query("json_key_sets", KEYS_SQL + "SELECT * FROM sets")
def json_key_sets_query(spark, sf_dir):
    return pf.json_key_sets(files(spark, sf_dir))


@query("json_unshared_keys", KEYS_SQL + "SELECT key, path FROM keyed WHERE key IN (SELECT key FROM sets WHERE NOT shared)")
def json_unshared_keys_query(spark, sf_dir):
    return pf.json_unshared_keys(files(spark, sf_dir))


@query("json_type_conflicts", KEYS_SQL + """
SELECT key, path, type FROM keyed WHERE key IN
  (SELECT key FROM keyed JOIN sets USING (key) WHERE shared GROUP BY key HAVING count(DISTINCT type) > 1)
""")
def json_type_conflicts_query(spark, sf_dir):
    return pf.json_type_conflicts(files(spark, sf_dir))


@query("json_consistency", KEYS_SQL + """
SELECT count(*) AS all_keys, count(*) FILTER (WHERE shared) AS shared_keys,
  round(100.0 * count(*) FILTER (WHERE shared) / count(*), 1)::DOUBLE AS consistency_pct FROM sets
""")
def json_consistency_query(spark, sf_dir):
    return pf.json_consistency(pf.json_key_sets(files(spark, sf_dir)))


GENERATED = "2026-04-17 12:55:21"


REPORT_SQL = KEYS_SQL + """,
numbered AS (SELECT *, row_number() OVER (ORDER BY path) AS rn, count(*) OVER () AS total, split_part(path, '/', 2) AS name,
    CASE WHEN is_list THEN 'array' ELSE 'object' END AS root,
    CASE WHEN NOT broken AND NOT is_list THEN CASE WHEN n % 4 = 0 THEN ['kind', 'user', 'ok', 'tags', 'props']
      ELSE ['kind', 'user', 'ok', 'props'] END END AS keys FROM f_json),
mixed AS (SELECT keyed.*, split_part(path, '/', 2) AS name FROM keyed WHERE key IN
  (SELECT key FROM keyed JOIN sets USING (key) WHERE shared GROUP BY key HAVING count(DISTINCT type) > 1)),
totals AS (SELECT (SELECT count(*) FROM f_json) AS files, (SELECT count(*) FROM obj) AS compared, count(*) AS all_keys,
  count(*) FILTER (WHERE shared) AS shared_keys, round(100.0 * count(*) FILTER (WHERE shared) / count(*), 1)::DOUBLE AS pct FROM sets)
"""


def _tree_sql(indent: int) -> str:
    return f"""
UNION ALL SELECT concat(repeat('  ', depth * 2 - 1 + {indent}), CASE WHEN ends_with(field, '.[]') THEN '└─ sample item:'
  ELSE concat('├─ ', split_part(field, '.', -1), ':') END) FROM fields WHERE depth > 0
UNION ALL SELECT concat(repeat('  ', depth * 2 + {indent}), '[', type, ']', CASE
  WHEN type = 'object' THEN concat('  (', field_count, ' fields)')
  WHEN type = 'array' THEN concat('  length=', length, '  item_types=[''', replace(item_types, ',', ''', '''), ''']  uniform=',
    CASE WHEN is_uniform THEN 'True' ELSE 'False' END)
  WHEN type = 'string' THEN concat('  length=', length, '  example="', example, '"')
  WHEN type = 'integer' THEN concat('  value=', value) ELSE '' END) FROM fields"""


def _report_lines(spark, sf_dir, fmt: str) -> DataFrame:
    """All lines of the written report."""
    path = new_folder(spark, f"schema-report-{fmt}")
    write_schema_report(files(spark, sf_dir), path, GENERATED, fmt)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("write_schema_report", REPORT_SQL + f"""
SELECT line FROM (
SELECT unnest([repeat('=', 65), '  JSON SCHEMA ANALYSIS REPORT', '  Generated : {GENERATED}', concat('  Files     : ', files), repeat('=', 65), '',
  repeat('=', 65), '  CROSS-FILE COMPARISON', repeat('-', 65), concat('  Files compared : ', compared), concat('  Total keys     : ', all_keys),
  concat('  Shared keys    : ', shared_keys), concat('  Consistency    : ', pct, '%'), '', '  Unique keys (key → files that have it):',
  '', '  ⚠  TYPE CONFLICTS:', '', repeat('=', 65)]) AS line FROM totals
UNION ALL SELECT unnest([concat('FILE ', rn, '/', total, ': ', name), repeat('-', 65), concat('  Path      : ', path), '  Analyzed  : {GENERATED}', '']) FROM numbered
UNION ALL SELECT '  ✗ ERROR   : invalid JSON' FROM numbered WHERE broken
UNION ALL SELECT unnest([concat('  Size      : ', format('{{:,}}', length(text)), ' bytes'), concat('  Root type : ', root), '', '  SCHEMA TREE',
  concat('  ', repeat('-', 40))]) FROM numbered WHERE NOT broken
UNION ALL SELECT concat('  Keys (', len(keys), '): ', array_to_string(keys, ', ')) FROM numbered WHERE keys IS NOT NULL
UNION ALL SELECT unnest(['  Length    : 3', '  Item types: [''integer'', ''null'', ''string'']']) FROM numbered WHERE is_list
{_tree_sql(1)}
UNION ALL SELECT concat('  Shared key: ', key) FROM sets WHERE shared
UNION ALL SELECT concat('    • ', key, ' → ', split_part(path, '/', 2)) FROM keyed WHERE key IN (SELECT key FROM sets WHERE NOT shared)
UNION ALL SELECT DISTINCT concat('    • ''', key, ''':') FROM mixed
UNION ALL SELECT concat('        ', name, ': ', type) FROM mixed) AS lines
""")
def write_schema_report_query(spark, sf_dir):
    return _report_lines(spark, sf_dir, "text")


@query("write_schema_report_markdown", REPORT_SQL + f"""
SELECT line FROM (
SELECT unnest(['# JSON Schema Analysis Report', '', '> **Generated:** {GENERATED}  ', concat('> **Files analyzed:** ', files), '',
  '---', '## Cross-File Comparison', '', '| Metric | Value |', '|--------|-------|', concat('| Files compared | ', compared, ' |'),
  concat('| Total keys | ', all_keys, ' |'), concat('| Shared keys | ', shared_keys, ' |'), concat('| Consistency | **', pct, '%** |'), '',
  '', '**Unique keys:**', '', '', '### ⚠️ Type Conflicts', '']) AS line FROM totals
UNION ALL SELECT unnest(['---', concat('## ', rn, '. `', name, '`'), '', '| Property | Value |', '|----------|-------|',
  concat('| Path | `', path, '` |'), '| Analyzed | {GENERATED} |', '']) FROM numbered
UNION ALL SELECT unnest(['| Status | ❌ Error |', '| Error | invalid JSON |']) FROM numbered WHERE broken
UNION ALL SELECT unnest([concat('| Size | ', format('{{:,}}', length(text)), ' bytes |'), concat('| Root type | `', root, '` |'), '| Status | ✅ OK |',
  '', '', '### Schema Tree', '```', '```']) FROM numbered WHERE NOT broken
UNION ALL SELECT concat('**Top-level keys (', len(keys), '):** `', array_to_string(keys, '`, `'), '`') FROM numbered WHERE keys IS NOT NULL
UNION ALL SELECT '**Array length:** 3' FROM numbered WHERE is_list
{_tree_sql(0)}
UNION ALL SELECT concat('**Shared key:** `', key, '`') FROM sets WHERE shared
UNION ALL SELECT concat('- `', key, '` → found only in: *', split_part(path, '/', 2), '*') FROM keyed
  WHERE key IN (SELECT key FROM sets WHERE NOT shared)
UNION ALL SELECT unnest([concat('**`', key, '`**'), '']) FROM (SELECT DISTINCT key FROM mixed)
UNION ALL SELECT concat('- `', name, '` → `', type, '`') FROM mixed) AS lines
""")
def write_schema_report_markdown_query(spark, sf_dir):
    return _report_lines(spark, sf_dir, "markdown")


@query("write_schema_report_json", REPORT_SQL + f"""
SELECT 'summary' AS part, '{GENERATED}' AS key, CAST(NULL AS VARCHAR) AS path, concat_ws(' ', files, compared, all_keys, shared_keys, pct) AS value FROM totals
UNION ALL SELECT 'file', '{GENERATED}', path, CASE WHEN broken THEN 'invalid JSON' ELSE concat(root, ' ', length(text)) END FROM numbered
UNION ALL SELECT 'field', field, path, type FROM fields
UNION ALL SELECT 'key', key, NULL, concat(files, CASE WHEN shared THEN ' true' ELSE ' false' END) FROM sets
UNION ALL SELECT 'unique', key, path, NULL FROM keyed WHERE key IN (SELECT key FROM sets WHERE NOT shared)
UNION ALL SELECT 'conflict', key, path, type FROM mixed
""")
def write_schema_report_json_query(spark, sf_dir):
    """Rows of all tables of the written report."""
    at = new_folder(spark, "schema-report-json")
    write_schema_report(files(spark, sf_dir), at, GENERATED, "json")
    null = F.lit(None).cast("string")

    def part(name: str, schema: str, key, path, value):
        rows = spark.read.schema(schema).json(f"{at}/{name}")
        return rows.select(F.lit(name.rstrip("s") if name != "summary" else name).alias("part"), key.alias("key"), path.alias("path"), value.alias("value"))

    key, path = F.col("key"), F.col("path")
    ok = F.concat_ws(" ", "root_type", F.col("file_size_bytes").cast("string"))
    out = part(
        "summary", "generated string, file_count long, files_compared long, all_keys long, shared_keys long, consistency_pct double",
        F.col("generated"), null, F.concat_ws(" ", "file_count", "files_compared", "all_keys", "shared_keys", "consistency_pct"))
    for more in (
        part("files", "path string, error string, root_type string, file_size_bytes long, analyzed string",
             F.col("analyzed"), path, F.coalesce("error", ok)),
        part("fields", "path string, field string, type string", F.col("field"), path, F.col("type")),
        part("keys", "key string, files long, shared boolean", key, null, F.concat_ws(" ", "files", F.col("shared").cast("string"))),
        part("unique", "key string, path string", key, path, null),
        part("conflicts", "key string, path string, type string", key, path, F.col("type")),
    ):
        out = out.unionByName(more)
    return out
