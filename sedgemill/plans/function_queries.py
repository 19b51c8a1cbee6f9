"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedgemill import functions as sf
from sedgemill.plans.fixtures import fixture, table, with_views
from sedgemill.plans.registry import query

AS_OF = "2026-04-17T12:55:21.123Z"
SITE = "https://example.org"


@query("clean_text", with_views("f_posts") + "SELECT id, nullif(trim(source_name), '') AS name FROM f_posts")
def clean_text_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_posts").select("id", sf.clean_text(F.col("source_name")).alias("name"))


@query("parse_hu_date", with_views("f_posts") + "SELECT id, date_iso FROM f_posts")
def parse_hu_date_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_posts").select("id", sf.parse_hu_date(F.col("date"), AS_OF, "UTC").alias("date_iso"))


@query("extract_post_id", with_views("f_posts") + """
SELECT id, coalesce(nullif(regexp_extract(original_url, '/(?:reels?|videos?)/([0-9]+)', 1), ''),
  nullif(regexp_extract(original_url, '[?&]v=([0-9]+)', 1), ''), nullif(regexp_extract(original_url, 'story_fbid=([0-9]+)', 1), ''),
  nullif(regexp_extract(original_url, '/posts/([0-9]+)', 1), ''), regexp_extract_all(original_url, '/([0-9]{8,})', 1)[-1]) AS post_id
FROM f_posts
""")
def extract_post_id_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_posts").select("id", sf.extract_post_id(F.col("original_url")).alias("post_id"))


PAGE_SQL = """
WITH named AS (
  SELECT page_id, url, trim(split_part(split_part(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '#', 1), '?', 1), '/') AS name FROM pages)
"""


@query("page_name", PAGE_SQL + "SELECT page_id, name FROM named")
def page_name_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sf.page_name(F.col("url")).alias("name"))


@query("safe_name", PAGE_SQL + """
SELECT page_id, CASE WHEN name = '' THEN left(sha1(url), 16) ELSE left(regexp_replace(name, '[^a-zA-Z0-9._-]', '_', 'g'), 80) END AS folder
FROM named
""")
def safe_name_query(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", sf.safe_name(sf.page_name(url), url).alias("folder"))


@query("media_local_path", with_views("f_media") + """
SELECT post_id, url, CASE WHEN media_type = 'video' THEN concat('media/', post_id, '_video.mp4')
  ELSE concat('media/', post_id, '_', split_part(split_part(url, '?', 1), '/', -1)) END AS local_path FROM f_media
""")
def media_local_path_query(spark, sf_dir):
    path = sf.media_local_path(F.col("post_id"), F.col("media_type"), F.col("url"))
    return fixture(spark, sf_dir, "f_media").select("post_id", "url", path.alias("local_path"))


@query("absolutize_url", with_views("f_posts") + f"""
SELECT id, concat('{SITE}', local_url) AS local, CASE WHEN original_url = '' THEN '{SITE}' ELSE original_url END AS original FROM f_posts
""")
def absolutize_url_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_posts").select(
        "id", sf.absolutize_url(F.col("local_url"), SITE).alias("local"),
        sf.absolutize_url(F.col("original_url"), SITE).alias("original"))


@query("video_filename", with_views("f_posts") + "SELECT id, concat(source_slug, '_', id, '.mp4') AS filename FROM f_posts")
def video_filename_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_posts").select("id", sf.video_filename(F.col("source_slug"), F.col("id")).alias("filename"))


@query("is_video_host", with_views("f_media") + """
SELECT post_id, url, contains(url, 'facebook.com') OR contains(url, 'youtube.com') OR contains(url, 'reel') AS fetched FROM f_media
""")
def is_video_host_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_media").select("post_id", "url", sf.is_video_host(F.col("url")).alias("fetched"))


@query("parse_scraped_at", with_views("f_snap") + """
SELECT side, id, CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 0 ELSE CAST(epoch(CAST(replace(scraped_at, 'Z', '') AS TIMESTAMP)) AS BIGINT) END AS seconds
FROM f_snap
""")
def parse_scraped_at_query(spark, sf_dir):
    """One text in three is damaged."""
    text = F.when(F.col("id").cast("bigint") % 3 == 0, F.concat("scraped_at", F.lit("?"))).otherwise(F.col("scraped_at"))
    return fixture(spark, sf_dir, "f_snap").select("side", "id", F.unix_seconds(sf.parse_scraped_at(text)).alias("seconds"))


@query("content_preview", "SELECT doc_id, replace(left(text, 200), chr(10), ' ') AS preview FROM documents")
def content_preview_query(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sf.content_preview(F.col("text")).alias("preview"))


@query("classify_error", with_views("f_errors") + """
SELECT post_id, url, CASE WHEN contains(error, 'registered users') THEN 'registered_only' ELSE 'other' END AS class FROM f_errors
""")
def classify_error_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_errors").select("post_id", "url", sf.classify_error(F.col("error")).alias("class"))


@query("leading_int", with_views("f_posts_dup") + """
SELECT id, CAST(nullif(regexp_extract(id, '^([0-9]+)', 1), '') AS BIGINT) AS number FROM f_posts_dup
""")
def leading_int_query(spark, sf_dir):
    return fixture(spark, sf_dir, "f_posts_dup").select("id", sf.leading_int(F.col("id")).alias("number"))


@query("json_type", """
SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'null' WHEN 1 THEN 'boolean' WHEN 2 THEN 'integer' WHEN 3 THEN 'integer' WHEN 4 THEN 'float'
  WHEN 5 THEN 'float' WHEN 6 THEN 'string' WHEN 7 THEN 'array' ELSE 'object' END AS type FROM events
""")
def json_type_query(spark, sf_dir):
    n, number = F.col("event_id") % 9, F.col("event_id").cast("string")
    text = (
        F.when(n == 0, F.lit("null")).when(n == 1, F.lit("true")).when(n == 2, number)
        .when(n == 3, F.concat(F.lit("98765432109876543210"), number)).when(n == 4, F.concat(number, F.lit(".0")))
        .when(n == 5, F.concat(number, F.lit("e2"))).when(n == 6, F.concat(F.lit('"'), number, F.lit('"')))
        .when(n == 7, F.concat(F.lit("["), number, F.lit("]"))).otherwise(F.col("props")))
    return table(spark, sf_dir, "events").select("event_id", sf.json_type(F.try_parse_json(text)).alias("type"))


@query("missing_log_line", with_views("f_errors") + """
SELECT post_id, CASE WHEN CAST(post_id AS BIGINT) % 3 <> 0 THEN source_slug END AS context, url, error AS reason FROM f_errors
""")
def missing_log_line_query(spark, sf_dir):
    """Lines as a crawl logs them, one in three without context."""
    named = F.col("post_id").cast("bigint") % 3 != 0
    line = F.concat(
        F.lit("[2026-04-17T12:55:21.000Z] "), F.when(named, F.concat(F.lit("["), "source_slug", F.lit("] "))).otherwise(""),
        "url", F.lit(" | "), "error")
    fields = sf.missing_log_line(F.col("line"))
    lines = fixture(spark, sf_dir, "f_errors").select("post_id", line.alias("line"))
    return lines.select("post_id", *[fields[k].alias(k) for k in ("context", "url", "reason")])
