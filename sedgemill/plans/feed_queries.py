"""Feed responses, the document index, and their streaming forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedgemill.operators import api_index as api, feed
from sedgemill.plans.fixtures import fixture, with_views
from sedgemill.plans.registry import query
from sedgemill.plans.render import api_captures, chunk_rows, feed_captures
from sedgemill.session import new_folder
from sedgemill.sources import api_items, read_api_pages, read_feed_responses
from sedgemill.streaming import stream_feed_new, upsert_feed_store


def responses(spark, sf_dir, by_page=False) -> DataFrame:
    return read_feed_responses(spark, feed_captures(spark, sf_dir, by_page))


@query("read_feed_responses", with_views("f_feed") + """
SELECT response_id, max(chunk_no) AS last_chunk FROM f_feed GROUP BY response_id
""")
def read_feed_responses_query(spark, sf_dir):
    lines = F.size(F.split("body", "\r\n"))
    return responses(spark, sf_dir).select("response_id", (lines - 1).cast("bigint").alias("last_chunk"))


@query("feed_split_chunks", with_views("f_feed") + """
SELECT response_id, CAST(chunk_no AS INTEGER) AS chunk_no, pid FROM f_feed
UNION ALL SELECT response_id, CAST(max(chunk_no) + 1 AS INTEGER), NULL FROM f_feed GROUP BY response_id
""")
def feed_split_chunks_query(spark, sf_dir):
    chunks = feed.explode_chunks(responses(spark, sf_dir), cut=False)
    pid = F.nullif(F.regexp_extract("chunk", r'"id":"([^"]*)","creation_time"', 1), F.lit(""))
    return chunks.select("response_id", "chunk_no", pid.alias("pid"))


CUT_SQL = with_views("f_feed") + """,
marked AS (SELECT *, min(CASE WHEN is_throttle THEN chunk_no END) OVER (PARTITION BY response_id) AS stop FROM f_feed),
cut AS (SELECT * FROM marked WHERE stop IS NULL OR chunk_no < stop)
"""


@query("feed_throttle_cut", CUT_SQL + """
SELECT response_id, count(*) AS chunks FROM cut GROUP BY response_id
""")
def feed_throttle_cut_query(spark, sf_dir):
    chunks = feed.explode_chunks(responses(spark, sf_dir)).where(F.col("chunk") != "not json")
    return chunks.groupBy("response_id").agg(F.count("*").alias("chunks"))


@query("feed_extract_posts", CUT_SQL + """
SELECT response_id, CAST(chunk_no AS INTEGER) AS chunk_no, pid, text, CAST(epoch(ts) AS BIGINT) AS ts FROM
  (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM cut)
""")
def feed_extract_posts_query(spark, sf_dir):
    posts = feed.extract_posts(feed.explode_chunks(responses(spark, sf_dir)))
    return posts.select("response_id", "chunk_no", "pid", "text", "ts")


MEDIA_SQL = """
numbered AS (SELECT *, response_id * 10 + chunk_no AS n FROM f_feed),
media AS (
  SELECT response_id, chunk_no, page, pid, concat('img_', n) AS media_id, 'image' AS type,
    concat('https://cdn.example.com/f/', n, '.jpg') AS value FROM numbered WHERE n % 3 = 0
  UNION ALL
  SELECT response_id, chunk_no, page, pid, concat('vid_', n), 'video', CAST(n AS VARCHAR) FROM numbered WHERE n % 5 = 0)
"""


@query("feed_extract_media", CUT_SQL + "," + MEDIA_SQL + """
SELECT m.pid, m.media_id, m.type, m.value FROM media m JOIN cut c ON c.response_id = m.response_id AND c.chunk_no = m.chunk_no
""")
def feed_extract_media_query(spark, sf_dir):
    media = feed.extract_media(feed.explode_chunks(responses(spark, sf_dir)))
    return media.select("pid", "media_id", "type", "value")


# Store before the run: the ids of the users whose number is a multiple of three.
STATUS_SQL = with_views("f_feed") + """,
marked AS (SELECT *, min(CASE WHEN is_throttle THEN chunk_no END) OVER (PARTITION BY response_id, page) AS stop FROM f_feed),
arrived AS (
  SELECT *, CAST(split_part(pid, '_', 1) AS BIGINT) % 3 = 0 AS stored, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds,
    row_number() OVER (PARTITION BY page, pid ORDER BY response_id, chunk_no) AS rn
  FROM marked WHERE stop IS NULL OR chunk_no < stop),
statuses AS (
  SELECT page, pid, response_id, chunk_no, text, seconds, CASE WHEN rn > 1 THEN 'IGN-SEEN' WHEN stored THEN 'IGN-DB' ELSE 'NEW' END AS status
  FROM arrived)
"""


def store(spark, sf_dir) -> DataFrame:
    known = fixture(spark, sf_dir, "f_feed").where(F.split_part("pid", F.lit("_"), F.lit(1)).cast("bigint") % 3 == 0)
    return known.select(F.col("pid").alias("id"), "page").distinct()


def chunks_by_page(spark, sf_dir) -> DataFrame:
    return feed.explode_chunks(responses(spark, sf_dir, by_page=True))


def statuses(spark, sf_dir) -> DataFrame:
    return feed.feed_dedupe(feed.extract_posts(chunks_by_page(spark, sf_dir)), store(spark, sf_dir))


@query("feed_dedupe", STATUS_SQL + "SELECT page, pid, response_id, status FROM statuses")
def feed_dedupe_query(spark, sf_dir):
    return statuses(spark, sf_dir).select("page", "pid", "response_id", "status")


@query("feed_counters", STATUS_SQL + "SELECT page, status, count(*) AS posts FROM statuses GROUP BY page, status")
def feed_counters_query(spark, sf_dir):
    return feed.feed_counters(statuses(spark, sf_dir))


@query("feed_media_link", STATUS_SQL + "," + MEDIA_SQL + """
SELECT m.page, m.pid, m.media_id, m.type FROM media m JOIN statuses s
ON s.response_id = m.response_id AND s.chunk_no = m.chunk_no WHERE s.status = 'NEW'
""")
def feed_media_link_query(spark, sf_dir):
    linked = feed.feed_media_link(feed.extract_media(chunks_by_page(spark, sf_dir)), statuses(spark, sf_dir))
    return linked.select("page", "pid", "media_id", "type")


@query("stream_feed_new", STATUS_SQL + "SELECT page, pid, text, seconds AS ts FROM statuses WHERE status = 'NEW'")
def stream_feed_new_query(spark, sf_dir):
    """The stream run to its end over the captured responses, read back from its sink."""
    target, checkpoint = new_folder(spark, "stream-new"), new_folder(spark, "stream-new-state")
    arriving = read_feed_responses(spark, feed_captures(spark, sf_dir, True), stream=True)
    stream_feed_new(arriving, store(spark, sf_dir), target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("page", "pid", "text", "ts")


@query("stream_upsert_store", STATUS_SQL + """,
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY pid ORDER BY response_id, chunk_no) AS r, response_id * 10 + chunk_no AS n FROM arrived)
SELECT pid AS id, page, text, seconds AS ts, left(sha1(pid), 16) AS short_id,
  CASE WHEN n % 3 = 0 THEN concat('img_', n, ' https://cdn.example.com/f/', n, '.jpg') END AS image,
  CASE WHEN n % 5 = 0 THEN concat('vid_', n, ' ', n) END AS video
FROM firsts WHERE r = 1
""")
def stream_upsert_store_query(spark, sf_dir):
    """Store filled by the stream in micro-batches; posts with the media stored for them."""
    target, checkpoint = new_folder(spark, "stream-store"), new_folder(spark, "stream-store-state")
    arriving = read_feed_responses(spark, feed_captures(spark, sf_dir, True), stream=True)
    upsert_feed_store(arriving, target, checkpoint).awaitTermination()
    kind = lambda name: F.max(F.when(F.col("type") == name, F.concat_ws(" ", "id", "path"))).alias(name)
    media = spark.read.parquet(f"{target}/media").groupBy(F.col("post_id").alias("id")).agg(kind("image"), kind("video"))
    posts = spark.read.parquet(f"{target}/posts").select("id", "page", "text", "ts", "short_id")
    return posts.join(media, "id", "left")


@query("short_id", with_views("f_feed") + """
SELECT pid, left(sha1(pid), 16) AS short_id FROM f_feed
""")
def short_id_query(spark, sf_dir):
    return feed.store_rows(fixture(spark, sf_dir, "f_feed")).select(F.col("id").alias("pid"), "short_id")


# ── document index ──────────────────────────────────────────────────────────


def index(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    pages = read_api_pages(spark, api_captures(spark, sf_dir))
    return pages, api_items(pages)


@query("read_api_pages", with_views("f_api") + """
SELECT page, slug, download_url, (SELECT count(*) FROM events) AS items_total FROM f_api
""")
def read_api_pages_query(spark, sf_dir):
    pages, _ = index(spark, sf_dir)
    items = pages.select("page", "items_total", F.explode("data").alias("item"))
    text = lambda k: F.try_variant_get("item", f"$.{k}", "string")
    return items.select("page", text("slug").alias("slug"), text("downloadUrl").alias("download_url"), "items_total")


PAGES_SQL = with_views("f_api") + """,
expected AS (SELECT unnest(range(1, CAST(ceil(count(*) / 18) AS BIGINT) + 1)) AS page FROM events),
failed AS (SELECT page FROM expected WHERE page NOT IN (SELECT page FROM f_api))
"""


@query("api_index", PAGES_SQL + """
SELECT (SELECT count(*) FROM f_api) AS total_items, (SELECT count(*) FROM expected) AS total_pages,
  CAST(18 AS BIGINT) AS items_per_page, (SELECT count(*) FROM failed) AS failed_pages
""")
def api_index_query(spark, sf_dir):
    pages, items = index(spark, sf_dir)
    return api.api_index_meta(items, pages)


@query("api_failed_pages", PAGES_SQL + "SELECT page FROM failed")
def api_failed_pages_query(spark, sf_dir):
    pages, _ = index(spark, sf_dir)
    return api.api_failed_pages(pages)


# The retry brings back the even ones of the failed pages.
RETRY_SQL = PAGES_SQL + """,
recovered AS (
  SELECT event_id // 18 + 1 AS page, concat('doc', event_id) AS slug FROM events
  WHERE (event_id // 18 + 1) % 29 = 0 AND (event_id // 18 + 1) % 2 = 0)
"""


@query("api_retry_merge", RETRY_SQL + """
SELECT page, slug, 0 AS batch FROM f_api UNION ALL SELECT page, slug, 1 FROM recovered
""")
def api_retry_merge_query(spark, sf_dir):
    pages, items = index(spark, sf_dir)
    return api.api_retry_merge(items.select("page", "pos", "slug"), _recovered(spark, sf_dir, pages)).select(
        "page", "slug", "batch")


def _recovered(spark, sf_dir, pages: DataFrame) -> DataFrame:
    number = F.col("event_id")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        (F.floor(number / 18) + 1).alias("page"), (number % 18).cast("int").alias("pos"),
        F.concat(F.lit("doc"), number.cast("string")).alias("slug"))
    failed = api.api_failed_pages(pages)
    return events.join(failed, "page", "left_semi").where(F.col("page") % 2 == 0)


@query("api_still_failing", RETRY_SQL + "SELECT page FROM failed WHERE page NOT IN (SELECT page FROM recovered)")
def api_still_failing_query(spark, sf_dir):
    pages, _ = index(spark, sf_dir)
    return api.still_failing(api.api_failed_pages(pages), _recovered(spark, sf_dir, pages))


# Downloaded archives: one in three groups has a file, one in four of those is empty.
DOCS_SQL = with_views("f_api") + """,
numbered AS (SELECT *, CAST(substr(slug, 4) AS BIGINT) AS n FROM f_api),
states AS (SELECT *, download_url IS NOT NULL AND NOT (n % 3 = 0 AND n % 4 <> 0) AS pending FROM numbered)
"""


def _zips(spark, sf_dir) -> DataFrame:
    n = F.substr("slug", F.lit(4)).cast("bigint")
    have = fixture(spark, sf_dir, "f_api").where(n % 3 == 0)
    return have.select(F.concat("slug", F.lit(".zip")).alias("name"), F.when(n % 4 == 0, 0).otherwise(1).alias("size"))


@query("docs_pending", DOCS_SQL + "SELECT slug, download_url FROM states WHERE pending")
def docs_pending_query(spark, sf_dir):
    _, items = index(spark, sf_dir)
    return api.docs_pending(items.drop("item"), _zips(spark, sf_dir)).select("slug", "download_url")


def _doc_outcomes(spark, sf_dir) -> DataFrame:
    """One attempt in five fails."""
    _, items = index(spark, sf_dir)
    items = items.drop("item")
    pending = api.docs_pending(items, _zips(spark, sf_dir))
    fetched = pending.select("page", "pos", (F.substr("slug", F.lit(4)).cast("bigint") % 5 != 0).alias("ok"))
    return api.docs_outcomes(items, pending, fetched)


@query("docs_summary", DOCS_SQL + """
SELECT count(*) FILTER (WHERE NOT pending OR n % 5 <> 0) AS succeeded,
  count(*) FILTER (WHERE pending AND n % 5 = 0) AS failed, count(*) AS total FROM states
""")
def docs_summary_query(spark, sf_dir):
    return api.docs_summary(_doc_outcomes(spark, sf_dir))


@query("docs_failed", DOCS_SQL + "SELECT slug FROM states WHERE pending AND n % 5 = 0")
def docs_failed_query(spark, sf_dir):
    return _doc_outcomes(spark, sf_dir).where(~F.col("ok")).select("slug")
