"""Reconciliation, work planning, ledgers and lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedgemill.functions import extract_post_id, video_filename
from sedgemill.operators import planning as pl, reconcile as rc
from sedgemill.plans.fixtures import fixture, fixture_by_post, nesting_tasks, table, with_views
from sedgemill.plans.registry import query
from sedgemill.plans.render import archive_files, rendered
from sedgemill.session import new_folder
from sedgemill.sinks import append_ledger, write_csv_report
from sedgemill.sinks.folders import write_folders
from sedgemill.sources import lists, read_allow_list, read_archives, read_file_inventory, read_ledger, read_manifest, read_worklist

ROOT = "/archive/data"


def _inventory(spark, sf_dir):
    files = fixture(spark, sf_dir, "f_files")
    return files.select(F.concat(F.lit(f"{ROOT}/"), "source_slug", F.lit("/"), "local_path").alias("path"))


MISSING_SQL = with_views("f_media", "f_files", "f_sources") + f""",
missing AS (
  SELECT m.source_slug AS slug, m.post_id, m.url, concat('{ROOT}/', m.source_slug, '/', m.local_path) AS local_path
  FROM f_media m WHERE m.local_path IS NOT NULL AND NOT EXISTS
    (SELECT 1 FROM f_files f WHERE f.source_slug = m.source_slug AND f.local_path = m.local_path))
"""


def _missing(spark, sf_dir):
    return rc.missing_media(fixture(spark, sf_dir, "f_media"), _inventory(spark, sf_dir), ROOT)


@query("missing_media", MISSING_SQL + "SELECT * FROM missing")
def missing_media_query(spark, sf_dir):
    return _missing(spark, sf_dir)


# Documents of every third source do not say their slug: the name of their folder stands in.
FOLDER_SQL = with_views("f_media", "f_files") + f""",
named AS (SELECT *, CASE WHEN CAST(substr(source_slug, 5) AS BIGINT) % 3 = 0 THEN concat('folder=', source_slug) ELSE source_slug END AS slug FROM f_media)
SELECT m.slug, m.post_id, m.url, concat('{ROOT}/', m.slug, '/', m.local_path) AS local_path
FROM named m WHERE m.local_path IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM f_files f WHERE f.source_slug = m.source_slug AND f.local_path = m.local_path)
"""


@query("missing_document_media", FOLDER_SQL)
def missing_document_media_query(spark, sf_dir):
    """Media named inside the documents of a folder per source."""
    bare = F.substr("source_slug", F.lit(5)).cast("bigint") % 3 == 0
    slug = F.when(~bare, F.col("source_slug"))

    def write(path):
        tasks = nesting_tasks(spark, sf_dir)
        media = fixture_by_post(spark, sf_dir, "f_media", tasks).repartition(tasks, "source_slug")
        posts = media.groupBy("source_slug", "post_id").agg(F.collect_list(F.struct("url", "local_path")).alias("media"))
        docs = posts.groupBy("source_slug").agg(F.collect_list(F.struct(F.col("post_id").alias("id"), "media")).alias("posts"))
        docs = docs.select(F.col("source_slug").alias("folder"), F.struct(slug.alias("slug"), F.lit("n").alias("name")).alias("metadata"), "posts")
        write_folders(docs, "folder", path, "json", alone=True)

    docs = read_archives(spark, rendered(spark, sf_dir, "media-folders", write), prune=("media",))
    name = F.coalesce(slug, F.concat(F.lit("folder="), "source_slug"))
    files = fixture(spark, sf_dir, "f_files").select(F.concat(F.lit(f"{ROOT}/"), name, F.lit("/"), "local_path").alias("path"))
    return rc.missing_document_media(docs, files, ROOT)


@query("missing_media_summary", MISSING_SQL + """
SELECT (SELECT count(*) FROM f_sources) AS files_checked, count(DISTINCT slug) AS files_with_missing, count(*) AS missing_media
FROM missing
""")
def missing_media_summary_query(spark, sf_dir):
    return rc.missing_media_summary(fixture(spark, sf_dir, "f_sources"), _missing(spark, sf_dir))


@query("write_csv_report", MISSING_SQL + "SELECT * FROM missing")
def write_csv_report_query(spark, sf_dir):
    path = new_folder(spark, "report")
    columns = ["slug", "post_id", "url", "local_path"]
    write_csv_report(_missing(spark, sf_dir), path, columns)
    return spark.read.option("header", "true").option("escape", '"').csv(path).select(*columns)


@query("manifest_missing", with_views("f_media", "f_files") + """
SELECT source_slug, local_path FROM f_media WHERE local_path IS NOT NULL EXCEPT SELECT source_slug, local_path FROM f_files
""")
def manifest_missing_query(spark, sf_dir):
    return rc.manifest_missing(fixture(spark, sf_dir, "f_media"), fixture(spark, sf_dir, "f_files"))


@query("read_manifest", with_views("f_files") + """
SELECT source_slug, local_path, false AS skipped FROM f_files
UNION ALL SELECT NULL, NULL, true FROM f_files WHERE local_path LIKE '%video.mp4'
""")
def read_manifest_query(spark, sf_dir):
    """Videos come with a second line that has no slash."""

    def write(path):
        files = fixture(spark, sf_dir, "f_files")
        line = F.concat(F.lit(" "), "source_slug", F.lit("/"), "local_path", F.lit("\t"))
        lines = F.array_compact(F.array(line, F.when(F.col("local_path").endswith("video.mp4"), F.lit("  video"))))
        files.select(F.explode(lines).alias("value")).write.text(path)

    return read_manifest(spark, rendered(spark, sf_dir, "manifest", write))


@query("read_worklist", with_views("f_posts") + """
SELECT CASE WHEN CAST(id AS BIGINT) % 17 = 0 THEN '' WHEN CAST(id AS BIGINT) % 23 = 0 THEN concat('two', chr(10), '"', source_slug, '", b')
  ELSE source_slug END AS page_name, original_url AS url FROM f_posts
""")
def read_worklist_query(spark, sf_dir):
    """Some entries start with an empty cell, some names are quoted over two lines."""

    def write(path):
        posts = fixture(spark, sf_dir, "f_posts")
        number, odd = F.col("id").cast("bigint"), F.concat(F.lit('two\n"'), "source_slug", F.lit('", b'))
        name = F.when(number % 17 == 0, None).when(number % 23 == 0, odd).otherwise(F.concat(F.lit(" "), "source_slug"))
        posts.select(
            name.alias("page_name"), "id", F.concat("original_url", F.lit(" ")).alias("url")
        ).write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option(
            "ignoreTrailingWhiteSpace", "false").option("escape", '"').csv(path)

    return read_worklist(spark, rendered(spark, sf_dir, "worklist", write))


@query("read_ledger", with_views("f_media") + """
SELECT DISTINCT split_part(local_path, '/', 2) AS filename FROM f_media WHERE local_path LIKE '%.mp4'
""")
def read_ledger_query(spark, sf_dir):
    """Names of stored videos, half of them in files with a header, a third without a time."""

    def write(path):
        names = fixture(spark, sf_dir, "f_media").where(F.col("local_path").endswith(".mp4")).select(
            F.when(F.col("post_id").cast("bigint") % 3 != 0, "2026-04-17T12:55:21").alias("timestamp"), F.substring_index("local_path", "/", -1).alias("filename"),
            F.lit(1).alias("filesize"), (F.col("post_id").cast("bigint") % 2 == 0).alias("even"))
        names.where("even").drop("even").write.mode("append").option("header", "true").csv(path)
        names.where("not even").drop("even").write.mode("append").csv(path)

    return read_ledger(spark, rendered(spark, sf_dir, "ledger", write))


@query("append_ledger", with_views("f_errors") + """
SELECT source_slug AS page_name, url, error AS reason FROM f_errors
""")
def append_ledger_query(spark, sf_dir):
    """Two batches appended to a failure ledger and read back."""
    path = new_folder(spark, "failures")
    rows = fixture(spark, sf_dir, "f_errors").select(
        F.lit("2026-04-17T12:55:21").alias("timestamp"), F.col("source_slug").alias("page_name"), "url",
        F.col("error").alias("reason"))
    registered = F.col("reason").contains("registered")
    for batch in (rows.where(registered), rows.where(~registered)):
        append_ledger(batch, path, lists.FAILURE_COLUMNS)
    return spark.read.option("header", "true").csv(path).select("page_name", "url", "reason")


ALLOWED_SQL = with_views("f_sources") + ", allowed AS (SELECT slug FROM f_sources WHERE handler = 'facebook') "


def _allow_list(spark, sf_dir):
    def write(path):
        sources = fixture(spark, sf_dir, "f_sources")
        line = F.when(F.col("handler") == "facebook", F.concat(F.lit(" https://example.org/s/"), "slug", F.lit("  ")))
        sources.select(F.coalesce(line, F.concat(F.lit("# NOT FOUND "), "slug")).alias("value")).write.text(path)

    return read_allow_list(spark, rendered(spark, sf_dir, "allow-list", write), "https://example.org/s/")


@query("read_allow_list", ALLOWED_SQL + "SELECT slug FROM allowed")
def read_allow_list_query(spark, sf_dir):
    return _allow_list(spark, sf_dir)


@query("source_filter", ALLOWED_SQL + "SELECT slug, name, handler FROM f_sources WHERE slug IN (SELECT slug FROM allowed)")
def source_filter_query(spark, sf_dir):
    return pl.source_filter(fixture(spark, sf_dir, "f_sources"), _allow_list(spark, sf_dir)).select(
        "slug", "name", "handler")


@query("read_file_inventory", with_views("f_sources") + """
SELECT slug, true AS stored FROM f_sources UNION ALL SELECT 'broken', true
""")
def read_file_inventory_query(spark, sf_dir):
    """Stored archive files, told apart by the slug each of them holds."""
    folder = archive_files(spark, sf_dir)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    files = read_file_inventory(spark, folder, "*.json", recursive=True).withColumn("path", plain("path"))
    docs = read_archives(spark, folder).select(plain("path").alias("path"), F.col("file_slug").alias("slug"))
    return files.join(docs, "path").groupBy("slug").agg(
        F.bool_and((F.col("size") > 0) & F.col("mtime").isNotNull()).alias("stored"))


@query("downloaded_set", with_views("f_files", "f_media") + """,
ledger AS (SELECT DISTINCT split_part(local_path, '/', 2) AS filename FROM f_media WHERE media_type = 'video' AND local_path IS NOT NULL),
disk AS (SELECT DISTINCT split_part(local_path, '/', 2) AS filename FROM f_files)
SELECT filename, filename NOT IN (SELECT filename FROM ledger) AS unlisted
FROM (SELECT * FROM ledger UNION SELECT * FROM disk)
""")
def downloaded_set_query(spark, sf_dir):
    name = F.substring_index("local_path", "/", -1)
    media = fixture(spark, sf_dir, "f_media").where((F.col("media_type") == "video") & F.col("local_path").isNotNull())
    return rc.downloaded_set(media.select(name.alias("filename")), fixture(spark, sf_dir, "f_files").select(name.alias("name")))


# Ledger and disk of the download runs, by post number.
WORK_SQL = with_views("f_posts") + """,
work AS (
  SELECT source_slug AS page_name, original_url AS url, CAST(id AS BIGINT) AS n,
    CASE WHEN original_url <> '' THEN CAST(CAST(id AS BIGINT) + 10000000 AS VARCHAR) END AS post_id FROM f_posts),
labelled AS (
  SELECT *, CASE WHEN url = '' THEN 'empty_url' WHEN n % 4 = 0 OR n % 7 = 0 THEN 'already' ELSE 'pending' END AS label,
    CASE WHEN url = '' THEN 'empty_url' WHEN n % 4 = 0 AND n % 8 = 0 THEN 'already' ELSE 'pending' END AS strict_label
  FROM work WHERE url = '' OR n % 9 <> 0)
"""


def _worklist(spark, sf_dir):
    posts = fixture(spark, sf_dir, "f_posts")
    return posts.select(F.col("source_slug").alias("page_name"), F.col("original_url").alias("url"), F.col("id").cast("bigint").alias("n"))


def _plan(spark, sf_dir, need_content=False):
    work = _worklist(spark, sf_dir)
    named = work.withColumn("filename", video_filename(F.col("page_name"), extract_post_id(F.col("url")))).where(
        F.col("filename").isNotNull())
    failed = work.where((F.col("n") % 9 == 0) & (F.col("url") != "")).select("url")
    disk = named.where(F.col("n") % 4 == 0).select(
        F.col("filename").alias("name"), F.when(F.col("n") % 8 == 0, 5).otherwise(0).alias("size"))
    ledger = named.where(F.col("n") % 7 == 0).select("filename")
    return pl.worklist_pending(work.drop("n"), failed, ledger, disk, need_content=need_content)


@query("worklist_pending", WORK_SQL + """
SELECT page_name, url, post_id, label, false AS need_content FROM labelled
UNION ALL SELECT page_name, url, post_id, strict_label, true FROM labelled
""")
def worklist_pending_query(spark, sf_dir):
    """Both variants: any file counts as there, or only one that is not empty."""
    parts = [
        _plan(spark, sf_dir, strict).select("page_name", "url", "post_id", "label").withColumn("need_content", F.lit(strict))
        for strict in (False, True)
    ]
    return parts[0].unionByName(parts[1])


@query("download_summary", WORK_SQL + """
SELECT count(*) FILTER (WHERE label <> 'pending' OR n % 5 <> 0) AS succeeded,
  count(*) FILTER (WHERE label = 'pending' AND n % 5 = 0) AS failed, count(*) AS total FROM labelled
""")
def download_summary_query(spark, sf_dir):
    """One attempt in five fails."""
    plan = _plan(spark, sf_dir)
    attempts = plan.where(F.col("label") == "pending").select(
        "filename", ((F.col("post_id").cast("bigint") - 10000000) % 5 != 0).alias("ok"))
    return pl.download_summary(plan, attempts)


@query("media_download_plan", with_views("f_media", "f_errors", "f_files") + """,
planned AS (
  SELECT post_id, source_slug, media_type, url, CASE WHEN media_type = 'video' THEN concat('media/', post_id, '_video.mp4')
    ELSE concat('media/', post_id, '_', split_part(split_part(url, '?', 1), '/', -1)) END AS local_path FROM f_media)
SELECT * FROM planned p
WHERE NOT EXISTS (SELECT 1 FROM f_errors e WHERE e.post_id = p.post_id AND e.url = p.url)
  AND NOT EXISTS (SELECT 1 FROM f_files f WHERE f.source_slug = p.source_slug AND f.local_path = p.local_path)
""")
def media_download_plan_query(spark, sf_dir):
    return pl.media_download_plan(*[fixture(spark, sf_dir, v) for v in ("f_media", "f_errors", "f_files")])


@query("attach_download_errors", with_views("f_posts", "f_errors") + """
SELECT p.id, p.source_slug, count(e.url) AS errors,
  coalesce(string_agg(concat('<', e.url, '> ', e.error), '; ' ORDER BY e.seq, e.url, e.error) FILTER (WHERE e.url IS NOT NULL), '') AS listed
FROM f_posts p LEFT JOIN (SELECT *, regexp_extract(url, '[0-9]+', 0) AS seq FROM f_errors) e ON e.post_id = p.id
GROUP BY p.id, p.source_slug
""")
def attach_download_errors_query(spark, sf_dir):
    """Outcomes of all media: failures from the error relation, successes without text."""
    errors = fixture(spark, sf_dir, "f_errors").select("post_id", "url", "error")
    fine = fixture(spark, sf_dir, "f_media").select("post_id", "url", F.lit(None).cast("string").alias("error"))
    outcomes = errors.unionByName(fine).withColumn("seq", F.regexp_extract("url", "[0-9]+", 0))
    posts = fixture(spark, sf_dir, "f_posts").select("id", "source_slug")
    nested = pl.attach_download_errors(posts, outcomes)
    listed = F.transform("download_errors", lambda e: F.concat(F.lit("<"), e["url"], F.lit("> "), e["error"]))
    return nested.select("id", "source_slug", F.size("download_errors").cast("bigint").alias("errors"), F.array_join(listed, "; ").alias("listed"))


RETRY_SQL = with_views("f_errors", "f_media") + """,
candidates AS (
  SELECT source_slug AS file, url, min(CAST(post_id AS BIGINT)) AS first_post FROM f_errors
  WHERE contains(error, 'This video is only available for registered users') GROUP BY source_slug, url),
succeeded AS (SELECT *, concat(first_post, '_video.mp4') AS filename FROM candidates WHERE first_post % 3 <> 0)
"""


def _retry_errors(spark, sf_dir):
    return fixture(spark, sf_dir, "f_errors").withColumnRenamed("source_slug", "file").withColumn(
        "post_pos", F.col("post_id").cast("bigint"))


def _succeeded(spark, sf_dir):
    """Two attempts in three bring the video."""
    return pl.retry_candidates(_retry_errors(spark, sf_dir)).where(F.col("post_id").cast("bigint") % 3 != 0)


@query("retry_candidates", RETRY_SQL + """
SELECT file, url, CAST(first_post AS VARCHAR) AS post_id, concat(first_post, '_video.mp4') AS filename FROM candidates
""")
def retry_candidates_query(spark, sf_dir):
    return pl.retry_candidates(_retry_errors(spark, sf_dir))


@query("apply_retry_results", RETRY_SQL + """
SELECT source_slug AS file, post_id, url, error FROM f_errors e WHERE NOT (contains(error, 'registered users') AND EXISTS
  (SELECT 1 FROM succeeded s WHERE s.file = e.source_slug AND s.url = e.url))
""")
def apply_retry_results_query(spark, sf_dir):
    errors = _retry_errors(spark, sf_dir)
    return pl.apply_retry_to_errors(errors, _succeeded(spark, sf_dir)).select("file", "post_id", "url", "error")


@query("apply_retry_media", RETRY_SQL + """
SELECT m.source_slug AS file, m.post_id, m.media_type, m.url,
  CASE WHEN m.media_type = 'video' AND m.cleared IS NULL AND s.url IS NOT NULL
    AND EXISTS (SELECT 1 FROM f_errors e WHERE e.post_id = m.post_id AND e.url = m.url AND contains(e.error, 'registered users'))
    THEN concat('media/', s.filename) ELSE m.cleared END AS local_path
FROM (SELECT *, CASE WHEN CAST(post_id AS BIGINT) % 8 = 0 THEN NULL ELSE local_path END AS cleared FROM f_media) m
LEFT JOIN succeeded s ON s.file = m.source_slug AND s.url = m.url
""")
def apply_retry_media_query(spark, sf_dir):
    """Every eighth post has lost the paths of its media."""
    lost = F.col("post_id").cast("bigint") % 8 == 0
    media = fixture(spark, sf_dir, "f_media").withColumnRenamed("source_slug", "file").withColumn(
        "local_path", F.when(~lost, F.col("local_path")))
    rows = pl.apply_retry_to_media(media, _retry_errors(spark, sf_dir), _succeeded(spark, sf_dir))
    return rows.select("file", "post_id", "media_type", "url", "local_path")


AS_OF = "2024-01-16 00:00:00"
SYNC_SQL = f"""
WITH source AS (SELECT concat('v', event_id, '.mp4') AS name, event_id, CAST(round(value * 100) AS BIGINT) AS size, ts AS mtime FROM events),
plan AS (
  SELECT *, CASE WHEN epoch_us(TIMESTAMP '{AS_OF}') // 1000000 - epoch_us(mtime) // 1000000 < 300 THEN 'SKIP'
    WHEN event_id % 3 = 0 THEN 'CLEAN' ELSE 'COPY' END AS action FROM source)
"""


def _sync(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("v"), F.col("event_id").cast("string"), F.lit(".mp4")).alias("name"), "event_id",
        F.round(F.col("value") * 100).cast("bigint").alias("size"), F.col("ts").cast("timestamp").alias("mtime"))
    there = events.where(F.col("event_id") % 3 == 0)
    return events, rc.sync_plan(events, there, F.to_timestamp(F.lit(AS_OF)))


@query("sync_plan", SYNC_SQL + "SELECT name, size, action FROM plan")
def sync_plan_query(spark, sf_dir):
    return _sync(spark, sf_dir)[1].select("name", "size", "action")


@query("copy_verify", SYNC_SQL + """
SELECT name, size, CASE WHEN event_id % 7 = 1 THEN 'MISMATCH' WHEN event_id % 11 = 1 AND size <> 0 THEN 'MISMATCH' ELSE 'OK' END AS result
FROM plan WHERE action = 'COPY'
""")
def copy_verify_query(spark, sf_dir):
    """One file in seven arrives cut short, one in eleven does not arrive."""
    events, plan = _sync(spark, sf_dir)
    arrived = events.where(~((F.col("event_id") % 11 == 1) & (F.col("event_id") % 7 != 1))).select(
        "name", F.when(F.col("event_id") % 7 == 1, F.col("size") - 1).otherwise(F.col("size")).alias("size"))
    return rc.copy_verify(plan, arrived)


MEDIA_SYNC_SQL = with_views("f_sources", "f_files") + """,
states AS (
  SELECT source_slug, CAST(split_part(split_part(local_path, '/', 2), '_', 1) AS BIGINT) AS n FROM f_files),
pages AS (
  SELECT s.slug AS page, count(n) FILTER (WHERE n % 4 <> 0 AND n % 13 <> 0) AS moved,
    count(n) FILTER (WHERE n % 4 = 0) AS deleted, count(n) FILTER (WHERE n % 4 <> 0 AND n % 13 = 0) AS errors
  FROM f_sources s LEFT JOIN states ON states.source_slug = s.slug GROUP BY s.slug)
"""


def _media_sync(spark, sf_dir):
    files = fixture(spark, sf_dir, "f_files").select(
        F.col("source_slug").alias("page"), F.substring_index("local_path", "/", -1).alias("name"))
    n = F.split_part("name", F.lit("_"), F.lit(1)).cast("bigint")
    half_written = files.select("page", F.concat("name", F.lit(".tmp")).alias("name"))
    folders = fixture(spark, sf_dir, "f_sources").select(F.col("slug").alias("page"))
    return rc.media_sync_pages(
        folders, files.unionByName(half_written), files.where(n % 4 == 0), files.where(n % 13 == 0))


@query("media_sync_pages", MEDIA_SYNC_SQL + "SELECT * FROM pages")
def media_sync_pages_query(spark, sf_dir):
    return _media_sync(spark, sf_dir)


@query("media_sync_summary", MEDIA_SYNC_SQL + """
SELECT count(*) FILTER (WHERE errors = 0) AS synced, count(*) FILTER (WHERE errors > 0) AS with_errors,
  CAST(sum(moved) AS BIGINT) AS moved, CAST(sum(deleted) AS BIGINT) AS deleted FROM pages
""")
def media_sync_summary_query(spark, sf_dir):
    return rc.media_sync_summary(_media_sync(spark, sf_dir))


@query("posts_newest_first", with_views("f_posts") + "SELECT id, source_slug, date_iso FROM f_posts")
def posts_newest_first_query(spark, sf_dir):
    return pl.posts_newest_first(fixture(spark, sf_dir, "f_posts").select("id", "source_slug", "date_iso"))


@query("split_group", with_views("f_sources") + """,
r AS (SELECT slug, row_number() OVER (ORDER BY CAST(substr(slug, 5) AS BIGINT)) AS rn, count(*) OVER () AS n FROM f_sources)
SELECT slug, CASE WHEN rn <= (n + 1) // 2 THEN 1 ELSE 2 END AS part FROM r
""")
def split_group_query(spark, sf_dir):
    sources = fixture(spark, sf_dir, "f_sources").withColumn("pos", F.substr("slug", F.lit(5)).cast("bigint"))
    return pl.with_halves(sources, "pos", "part").select("slug", "part")


@query("head_pages", "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 2")
def head_pages_query(spark, sf_dir):
    """The first two addresses of the list, as many as a crawl takes on at a time."""
    return pl.head_pages(table(spark, sf_dir, "pages").select("page_id", "url"), 2, "page_id")


@query("resume_point", with_views("f_posts_dup") + """
SELECT source_slug, min(CAST(nullif(regexp_extract(id, '^([0-9]+)', 1), '') AS BIGINT)) AS resume_id
FROM f_posts_dup GROUP BY source_slug
""")
def resume_point_query(spark, sf_dir):
    return pl.resume_point(fixture(spark, sf_dir, "f_posts_dup"))


APPEND_SQL = with_views("f_posts") + ", dated AS (SELECT *, CAST(date_iso < '1997' AS BOOLEAN) AS later FROM f_posts) "


def _page(spark, sf_dir):
    """Posts before 1997 arrive as the next page of each source."""
    posts = fixture(spark, sf_dir, "f_posts").select("source_slug", "id", F.col("id").cast("bigint").alias("pos"), "date_iso")
    later = F.col("date_iso") < "1997"
    return posts.where(~later).drop("date_iso"), posts.where(later).drop("date_iso")


@query("append_page", APPEND_SQL + "SELECT source_slug, id, CAST(later AS INTEGER) AS batch FROM dated")
def append_page_query(spark, sf_dir):
    return pl.append_page(*_page(spark, sf_dir)).select("source_slug", "id", "batch")


@query("next_cursor", APPEND_SQL + """
SELECT source_slug, CAST(max(CAST(id AS BIGINT)) AS VARCHAR) AS last_id FROM dated WHERE later GROUP BY source_slug
""")
def next_cursor_query(spark, sf_dir):
    return pl.next_cursor(_page(spark, sf_dir)[1])
