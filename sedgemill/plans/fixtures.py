"""The relations of a crawl, derived from the star-schema tables in SQL both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sedgemill.operators.shuffles import tasks_for

BASE_TABLES = ["customer", "orders", "lineitem", "events", "documents", "pages"]

SPARK_LINKS = """
SELECT page_id, explode(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS url FROM pages
"""
DUCKDB_LINKS = """
SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS url FROM pages
"""

# name -> (names it reads, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {
    "f_sources": (["customer"], """
SELECT concat('page', CAST(c_custkey AS STRING)) AS slug,
       c_name AS name,
       concat('https://www.facebook.com/page', CAST(c_custkey AS STRING)) AS orig_url,
       CASE WHEN c_custkey % 4 = 0 THEN 'youtube' ELSE 'facebook' END AS handler,
       '2026-04-17T12:55:21.000Z' AS scraped_at
FROM customer
UNION ALL
SELECT concat('page', CAST(900000000 + c_custkey AS STRING)), c_name, concat('https://www.facebook.com/page', CAST(900000000 + c_custkey AS STRING)),
       'facebook', '2026-04-17T12:55:21.000Z'
FROM customer WHERE c_custkey % 10 = 0
"""),
    "f_posts": (["orders"], """
SELECT CAST(o_orderkey AS STRING) AS id,
       concat('page', CAST(o_custkey AS STRING)) AS source_slug,
       CASE WHEN o_orderkey % 19 = 0 THEN '  ' ELSE concat('Page ', CAST(o_custkey AS STRING)) END AS source_name,
       concat(CAST(year(o_orderdate) AS STRING), '. ', CAST(month(o_orderdate) AS STRING), '. ',
              CAST(day(o_orderdate) AS STRING), '. ', CAST(o_orderkey % 24 AS STRING), ':',
              lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')) AS date,
       concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T', lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':',
              lpad(CAST(o_orderkey % 60 AS STRING), 2, '0'), ':00.000Z') AS date_iso,
       CASE WHEN o_orderkey % 11 = 0 THEN ''
            WHEN o_orderkey % 6 = 0 THEN concat('https://www.facebook.com/reel/', CAST(10000000 + o_orderkey AS STRING), '/')
            WHEN o_orderkey % 6 = 1 THEN concat('https://www.facebook.com/p/videos/', CAST(10000000 + o_orderkey AS STRING), '/')
            WHEN o_orderkey % 6 = 2 THEN concat('https://www.facebook.com/watch/?v=', CAST(10000000 + o_orderkey AS STRING))
            WHEN o_orderkey % 6 = 3 THEN concat('https://www.facebook.com/permalink.php?story_fbid=', CAST(10000000 + o_orderkey AS STRING), '&id=9')
            WHEN o_orderkey % 6 = 4 THEN concat('https://www.facebook.com/p/posts/', CAST(10000000 + o_orderkey AS STRING))
            ELSE concat('https://www.facebook.com/p/x/', CAST(10000000 + o_orderkey AS STRING)) END AS original_url,
       concat('/p/', CAST(o_orderkey AS STRING)) AS local_url,
       concat(o_orderpriority, ' ', o_orderstatus, ' ', CAST(o_orderkey AS STRING)) AS content,
       CASE WHEN o_orderkey % 8 = 0 THEN concat('/post/', CAST(o_orderkey AS STRING)) END AS continuation_url
FROM orders
"""),
    "f_media": (["lineitem", "f_posts"], """
SELECT p.id AS post_id, p.source_slug,
       CASE WHEN l_linenumber % 3 = 0 THEN 'video' ELSE 'image' END AS media_type,
       CASE WHEN l_linenumber % 3 = 0
            THEN concat('https://www.facebook.com/watch/?v=', CAST(20000000 + l_partkey AS STRING))
            ELSE concat('https://cdn.example.com/i/', CAST(l_partkey AS STRING), '_', CAST(l_suppkey AS STRING), '.jpg?v=', CAST(l_linenumber AS STRING)) END AS url,
       CASE WHEN l_linenumber = 7 THEN CAST(NULL AS STRING)
            WHEN l_linenumber % 3 = 0 THEN concat('media/', p.id, '_video.mp4')
            ELSE concat('media/', p.id, '_', CAST(l_partkey AS STRING), '_', CAST(l_suppkey AS STRING), '.jpg') END AS local_path
FROM lineitem JOIN f_posts p ON p.id = CAST(l_orderkey AS STRING)
"""),
    "f_errors": (["f_media"], """
SELECT post_id, source_slug, url,
       CASE WHEN media_type = 'video' THEN 'ERROR: This video is only available for registered users'
            ELSE 'Failed to download: Not Found' END AS error
FROM f_media WHERE media_type = 'image' AND CAST(post_id AS BIGINT) % 5 = 0
   OR media_type = 'video' AND CAST(post_id AS BIGINT) % 4 = 0
"""),
    "f_files": (["f_media"], """
SELECT DISTINCT source_slug, local_path FROM f_media
WHERE local_path IS NOT NULL AND CAST(post_id AS BIGINT) % 9 <> 0
"""),
    "f_posts_dup": (["f_posts"], """
SELECT *, 0 AS pos FROM f_posts
UNION ALL SELECT concat(id, 'd'), source_slug, source_name, date, date_iso, original_url, local_url, content, continuation_url, 1
          FROM f_posts WHERE CAST(id AS BIGINT) % 13 = 0
UNION ALL SELECT concat(id, 'x'), 'page0', source_name, date, date_iso, original_url, local_url, content, continuation_url, 2
          FROM f_posts WHERE CAST(id AS BIGINT) % 17 = 0
"""),
    "f_snap": (["f_posts"], """
SELECT 'old' AS side, CASE WHEN CAST(substr(source_slug, 5) AS BIGINT) % 3 = 0 THEN '2026-05-01T00:00:00.000Z' ELSE '2026-03-01T00:00:00.000Z' END AS scraped_at,
       f_posts.* FROM f_posts
WHERE CAST(id AS BIGINT) % 5 <> 0 AND CAST(substr(source_slug, 5) AS BIGINT) % 10 <> 1
UNION ALL
SELECT 'new', '2026-04-01T00:00:00.000Z', id, source_slug, source_name, date, date_iso, original_url, local_url,
       concat(content, ' v2'), continuation_url FROM f_posts
WHERE CAST(id AS BIGINT) % 7 <> 0 AND CAST(substr(source_slug, 5) AS BIGINT) % 10 <> 2
"""),
    "f_snap_media": (["f_snap", "f_media"], """
SELECT s.side, m.post_id, m.source_slug, m.media_type, concat(m.url, CASE WHEN s.side = 'new' THEN '#2' ELSE '' END) AS url, m.local_path
FROM f_media m JOIN f_snap s ON s.id = m.post_id
"""),
    "f_snap_links": (["f_snap", "f_post_links"], """
SELECT s.side, l.post_id, l.source_slug, concat(s.side, ' ', l.text) AS text, l.url
FROM f_post_links l JOIN f_snap s ON s.id = l.post_id
"""),
    "f_links": (["pages"], ""),
    # Links as they hang on posts: the page number is the post's id.
    "f_post_links": (["f_links", "f_posts"], """
SELECT p.id AS post_id, p.source_slug, concat('link ', l.url) AS text, l.url
FROM f_links l JOIN f_posts p ON p.id = CAST(l.page_id AS STRING)
"""),
    "f_feed": (["events"], """
SELECT CAST(floor(event_id / 10) AS BIGINT) AS response_id, event_id % 10 AS chunk_no,
       concat(CAST(user_id AS STRING), '_', event_type, '_', CAST(CAST(floor(value) AS BIGINT) AS STRING)) AS pid,
       concat('page', CAST(user_id % 20 AS STRING)) AS page, props AS text, ts,
       event_id % 97 = 0 AS is_throttle
FROM events
"""),
    "f_api": (["events"], """
SELECT CAST(floor(event_id / 18) AS BIGINT) + 1 AS page, concat('doc', CAST(event_id AS STRING)) AS slug,
       CASE WHEN event_id % 23 = 0 THEN CAST(NULL AS STRING) ELSE concat('https://example.com/z/', CAST(event_id AS STRING)) END AS download_url
FROM events WHERE (CAST(floor(event_id / 18) AS BIGINT) + 1) % 29 <> 0
"""),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    """The named views and all they read, each after what it reads."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done or name not in VIEWS:
            return
        for other in VIEWS[name][0]:
            visit(other)
        done.append(name)

    for name in names:
        visit(name)
    return done


def with_views(*names: str, links: str = DUCKDB_LINKS) -> str:
    """``WITH`` clause that defines the named views."""
    parts = [f"{n} AS ({(links if n == 'f_links' else VIEWS[n][1]).strip()})" for n in _needed(names)]
    return "WITH " + ",\n".join(parts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived relation as a DataFrame; scans read only the columns it uses."""
    bases = ",\n".join(f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in BASE_TABLES)
    views = with_views(name, links=SPARK_LINKS).removeprefix("WITH ")
    return spark.sql(f"WITH {bases},\n{views}\nSELECT * FROM {name}")


def nesting_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that nest media and errors in their posts, by the rows of both tables (counted from file footers)."""
    return tasks_for(spark, 600 * table(spark, sf_dir, "orders").count() + 300 * table(spark, sf_dir, "lineitem").count())


def fixture_by_post(spark: SparkSession, sf_dir: str, name: str, tasks: int) -> DataFrame:
    """A derived relation whose media are joined in ``tasks`` tasks, so that rows of a post stay together for nesting."""
    spread = table(spark, sf_dir, "lineitem").repartition(tasks, F.col("l_orderkey").cast("string"))
    bases = ",\n".join(
        f"{t} AS (SELECT * FROM {'{lines}' if t == 'lineitem' else f'parquet.`{sf_dir}/{t}.parquet`'})" for t in BASE_TABLES)
    views = with_views(name, links=SPARK_LINKS).removeprefix("WITH ")
    return spark.sql(f"WITH {bases},\n{views}\nSELECT * FROM {name}", lines=spread)
