"""De-duplication and the merge of two snapshots."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from sedgemill.operators import dedup, flatten as fl, merge as mg
from sedgemill.plans.fixtures import fixture, with_views
from sedgemill.plans.registry import query
from sedgemill.plans.render import snapshot_docs
from sedgemill.session import new_folder, written
from sedgemill.sinks.archives import archive_records, write_archives
from sedgemill.sources import read_archives


def _dup(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "f_posts_dup").withColumn("file_slug", F.col("source_slug"))


DUP_SQL = with_views("f_posts_dup") + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_slug, trim(original_url), trim(date_iso) ORDER BY pos, id) AS rn
           FROM f_posts_dup)
"""


@query("dedup_posts", DUP_SQL + """
SELECT id, source_slug, original_url, date_iso, content FROM ranked WHERE rn = 1 OR trim(original_url) = ''
""")
def dedup_posts_query(spark, sf_dir):
    kept = dedup.dedup_posts(_dup(spark, sf_dir), ["pos", "id"])
    return kept.select("id", "source_slug", "original_url", "date_iso", "content")


@query("dedup_report", DUP_SQL + """
SELECT source_slug AS file_slug, count(*) FILTER (WHERE rn > 1 AND trim(original_url) <> '') AS removed,
  count(*) FILTER (WHERE rn = 1 OR trim(original_url) = '') AS remaining
FROM ranked GROUP BY source_slug HAVING removed > 0
""")
def dedup_report_query(spark, sf_dir):
    return dedup.dedup_report(_dup(spark, sf_dir), ["pos", "id"])


@query("cross_posts", with_views("f_posts_dup") + """,
pairs AS (SELECT DISTINCT trim(original_url) AS url, trim(source_slug) AS slug FROM f_posts_dup
          WHERE trim(original_url) <> '' AND trim(source_slug) <> '')
SELECT url, count(*) OVER (PARTITION BY url) AS slugs, slug FROM pairs QUALIFY count(*) OVER (PARTITION BY url) > 1
""")
def cross_posts_query(spark, sf_dir):
    return dedup.cross_posts(fixture(spark, sf_dir, "f_posts_dup"))


@dataclass
class Sides:
    """Both snapshots read back from their archives, and how they match.

    The heads of the documents with the ids of their posts are written once per side: matches,
    counts and places come from them. Posts with their texts and lists are parsed only where
    a table needs them, and written only for a merge that builds several tables of them.
    """

    old_docs: DataFrame
    new_docs: DataFrame
    keep_posts: bool = False

    @cached_property
    def old_heads(self) -> DataFrame:
        return written(mg.document_heads(self.old_docs), "merge-old-heads")

    @cached_property
    def new_heads(self) -> DataFrame:
        return written(mg.document_heads(self.new_docs), "merge-new-heads")

    @cached_property
    def old(self) -> DataFrame:
        posts = fl.explode_posts(self.old_docs)
        return written(posts, "merge-old") if self.keep_posts else posts

    @cached_property
    def new(self) -> DataFrame:
        posts = fl.explode_posts(self.new_docs)
        return written(posts, "merge-new") if self.keep_posts else posts

    @cached_property
    def matches(self) -> DataFrame:
        return written(mg.slug_match(self.old_heads, self.new_heads), "merge-matches")

    def groups(self, with_records: bool = True, fields: list[str] | None = None) -> DataFrame:
        """Post groups; counts and places need no post fields and shuffle none. ``fields`` are those wanted of the records, if not all."""
        if not with_records:
            return mg.merge_groups(mg.post_places(self.old_heads), mg.post_places(self.new_heads), self.matches)
        kept = [c for c in self.old.columns if c not in ("media", "links", "download_errors")]
        kept = kept if fields is None else [c for c in kept if c in ("file_slug", "id", "part", "post_pos", *fields)]
        return mg.merge_groups(self.old.select(*kept), self.new.select(*kept), self.matches)

    def children(self, nested: str, fields: dict[str, str]) -> DataFrame:
        """Media or links of the merged posts: those of the record each was taken from, matched as one list per post."""
        lists = [fl.list_rows(posts, nested, fields) for posts in (self.old, self.new)]
        return fl.explode_lists(mg.merge_children(*lists, mg.merge_posts(self.groups(False))))

    def stats(self) -> DataFrame:
        return mg.merge_stats(self.groups(False), self.old_heads, self.new_heads, self.matches)

    def errors(self) -> DataFrame:
        lists = [fl.list_rows(posts, "download_errors", fl.ERROR_FIELDS) for posts in (self.old, self.new)]
        return fl.explode_lists(mg.merge_errors(*lists, self.groups(False), self.matches))


def sides(spark, sf_dir, keep_posts: bool = False) -> Sides:
    old, new = (snapshot_docs(spark, sf_dir, s) for s in ("old", "new"))
    return Sides(old, new, keep_posts)


SLUG_SQL = with_views("f_snap", "f_errors", "f_snap_media", "f_snap_links") + """,
slugs AS (
  SELECT source_slug AS file_slug, max(CASE WHEN side = 'old' THEN scraped_at END) AS old_text,
         max(CASE WHEN side = 'new' THEN scraped_at END) AS new_text
  FROM f_snap GROUP BY source_slug),
matches AS (
  SELECT *, CASE WHEN old_text IS NULL THEN 'new_only' WHEN new_text IS NULL THEN 'old_only' ELSE 'merged' END AS status,
         coalesce(old_text > new_text, false) AS swapped FROM slugs),
sided AS (
  SELECT s.*, m.swapped, (s.side = 'new') <> m.swapped AS newer
  FROM f_snap s JOIN matches m ON m.file_slug = s.source_slug WHERE m.status = 'merged'),
older AS (SELECT * FROM sided WHERE NOT newer),
newer AS (SELECT * FROM sided WHERE newer)
"""


@query("slug_match", SLUG_SQL + "SELECT file_slug, status FROM matches")
def slug_match_query(spark, sf_dir):
    s = sides(spark, sf_dir)
    return mg.slug_match(s.old_docs, s.new_docs).select("file_slug", "status")


@query("orient_snapshots", SLUG_SQL + """
SELECT file_slug, swapped, CASE WHEN swapped THEN old_text ELSE new_text END AS scraped_at,
  replace(CASE WHEN swapped THEN new_text ELSE old_text END, '.000Z', '+00:00') AS old_scraped_at,
  replace(CASE WHEN swapped THEN old_text ELSE new_text END, '.000Z', '+00:00') AS new_scraped_at
FROM matches WHERE status = 'merged'
""")
def orient_snapshots_query(spark, sf_dir):
    return mg.orient_snapshots(sides(spark, sf_dir).matches)


MERGED_SQL = """
SELECT o.source_slug AS file_slug, o.id, o.date_iso, coalesce(n.content, o.content) AS content,
  CASE WHEN n.id IS NULL THEN o.side ELSE n.side END AS side
FROM older o LEFT JOIN newer n ON n.source_slug = o.source_slug AND n.id = o.id
"""


@query("merge_posts", SLUG_SQL + MERGED_SQL)
def merge_posts_query(spark, sf_dir):
    fields = ["date_iso", "content"]
    return mg.merge_posts(sides(spark, sf_dir).groups(fields=fields)).select("file_slug", "id", *fields, "side")


CHOSEN_SQL = SLUG_SQL + """,
chosen AS (SELECT o.source_slug, o.id, coalesce(n.side, o.side) AS side FROM older o
           LEFT JOIN newer n ON n.source_slug = o.source_slug AND n.id = o.id)
"""


@query("merge_media", CHOSEN_SQL + """
SELECT c.source_slug AS file_slug, c.id AS post_id, m.media_type, m.url, m.local_path
FROM chosen c JOIN f_snap_media m ON m.post_id = c.id AND m.side = c.side
""")
def merge_media_query(spark, sf_dir):
    """Media of the merged posts: the newer record brings all its own."""
    return sides(spark, sf_dir).children("media", fl.MEDIA_FIELDS).select("file_slug", "post_id", "media_type", "url", "local_path")


@query("merge_links", CHOSEN_SQL + """
SELECT c.source_slug AS file_slug, c.id AS post_id, l.text, l.url
FROM chosen c JOIN f_snap_links l ON l.post_id = c.id AND l.side = c.side
""")
def merge_links_query(spark, sf_dir):
    return sides(spark, sf_dir).children("links", fl.LINK_FIELDS).select("file_slug", "post_id", "text", "url")


@query("merge_errors", SLUG_SQL + """
SELECT o.source_slug AS file_slug, o.id AS post_id, s.newer, e.url, e.error
FROM older o JOIN sided s ON s.source_slug = o.source_slug AND s.id = o.id JOIN f_errors e ON e.post_id = o.id
""")
def merge_errors_query(spark, sf_dir):
    """Download errors that end up in each merged post."""
    return sides(spark, sf_dir).errors().select("file_slug", "post_id", "newer", "url", "error")


@query("merge_stats", SLUG_SQL + """,
o AS (SELECT source_slug, count(*) AS total_old FROM older GROUP BY 1),
n AS (SELECT source_slug, count(*) AS total_new FROM newer GROUP BY 1),
b AS (SELECT o.source_slug, count(*) AS both_sides FROM older o JOIN newer n ON n.source_slug = o.source_slug AND n.id = o.id
      GROUP BY 1)
SELECT o.source_slug AS file_slug, total_old, total_new, coalesce(both_sides, 0) AS duplicates_updated,
  total_old - coalesce(both_sides, 0) AS only_in_old, total_new - coalesce(both_sides, 0) AS only_in_new,
  total_old AS merged_total
FROM o JOIN n USING (source_slug) LEFT JOIN b USING (source_slug)
""")
def merge_stats_query(spark, sf_dir):
    return sides(spark, sf_dir).stats()


CONSOLIDATED_AT = "2026-05-02T00:00:00Z"


@query("merge_metadata", SLUG_SQL + f"""
SELECT file_slug, file_slug AS slug, concat(CASE WHEN swapped THEN 'old ' ELSE 'new ' END, file_slug) AS name,
  CASE WHEN swapped THEN old_text ELSE new_text END AS scraped_at,
  replace(CASE WHEN swapped THEN new_text ELSE old_text END, '.000Z', '+00:00') AS old_scraped_at,
  replace(CASE WHEN swapped THEN old_text ELSE new_text END, '.000Z', '+00:00') AS new_scraped_at,
  '{CONSOLIDATED_AT}' AS consolidated_at
FROM matches WHERE status = 'merged'
""")
def merge_metadata_query(spark, sf_dir):
    s = sides(spark, sf_dir)
    heads = mg.merge_metadata(s.old_docs, s.new_docs, mg.orient_snapshots(s.matches), CONSOLIDATED_AT)
    return heads.select(
        "file_slug", "slug", "name", "scraped_at", "old_scraped_at", "new_scraped_at", "consolidated_at")


@query("merge_summary", SLUG_SQL + """
SELECT status, count(*) AS slugs,
  CAST(sum(CASE WHEN status = 'merged' THEN (SELECT count(*) FROM older o WHERE o.source_slug = file_slug) ELSE 0 END) AS BIGINT)
    AS total_posts
FROM matches GROUP BY status
""")
def merge_summary_query(spark, sf_dir):
    s = sides(spark, sf_dir)
    return mg.merge_summary(s.matches, s.stats())


OLD_ONLY_SQL = SLUG_SQL + """,
gone AS (SELECT * FROM older o WHERE NOT EXISTS
         (SELECT 1 FROM newer n WHERE n.source_slug = o.source_slug AND n.id = o.id))
"""


def _old_only(s: Sides) -> DataFrame:
    return mg.old_only_posts(s.old, s.new, s.groups(False), s.matches)


@query("old_only_posts", OLD_ONLY_SQL + "SELECT source_slug AS file_slug, id, date_iso, content FROM gone")
def old_only_posts_query(spark, sf_dir):
    return _old_only(sides(spark, sf_dir)).select("file_slug", "id", "date_iso", "content")


@query("old_only_sample", OLD_ONLY_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY source_slug ORDER BY date_iso, id) AS up,
        row_number() OVER (PARTITION BY source_slug ORDER BY date_iso DESC, id DESC) AS down FROM gone)
SELECT source_slug AS file_slug, id, source_slug, nullif(trim(source_name), '') AS source_name, date_iso, date,
  nullif(original_url, '') AS original_url, replace(substr(content, 1, 200), chr(10), ' ') AS content_preview,
  (SELECT CAST(count(*) AS INTEGER) FROM f_snap_media m WHERE m.post_id = r.id AND m.side = r.side) AS media_count,
  (SELECT CAST(count(*) AS INTEGER) FROM f_snap_links l WHERE l.post_id = r.id AND l.side = r.side) AS links_count
FROM r WHERE up <= 10 OR down <= 10
""")
def old_only_sample_query(spark, sf_dir):
    s = sides(spark, sf_dir)
    # Lists and texts are cut to what a sample shows before posts are matched.
    gone = mg.old_only_posts(mg.sample_fields(s.old), mg.sample_fields(s.new), s.groups(False), s.matches)
    return mg.old_only_sample(gone).drop("section", "place")


@query("merge_write_back", CHOSEN_SQL + """
SELECT c.source_slug AS file_slug, c.id, s.date_iso, s.local_url, s.content, c.side,
  CAST(c.id IN (SELECT post_id FROM f_errors) AS INTEGER) AS has_errors,
  (SELECT count(*) FROM f_snap_media m WHERE m.post_id = c.id AND m.side = c.side) AS media,
  (SELECT count(*) FROM f_snap_links l WHERE l.post_id = c.id AND l.side = c.side) AS links
FROM chosen c JOIN f_snap s ON s.id = c.id AND s.side = c.side
""")
def merge_write_back_query(spark, sf_dir):
    """The merged archives written and read back."""
    s = sides(spark, sf_dir, keep_posts=True)
    groups = s.groups()
    posts = mg.merge_posts(groups).withColumn("falling", F.translate("date_iso", "0123456789", "9876543210"))
    posts = posts.withColumn("side_kept", F.col("side")).drop("source_slug")
    heads = mg.merge_metadata(s.old_docs, s.new_docs, mg.orient_snapshots(s.matches), CONSOLIDATED_AT)
    errors = s.errors().withColumn("pos", F.struct("newer", "part", "post_pos", "pos"))
    # Children of a post come together before they are nested.
    children = [rows.drop("file_slug", "side", "part").repartition("post_id")
                for rows in (s.children("media", fl.MEDIA_FIELDS), s.children("links", fl.LINK_FIELDS), errors)]
    records = written(archive_records(posts.withColumn("source_slug", F.col("file_slug")), *children), "merged-records")
    path = new_folder(spark, "merged")
    write_archives(heads, records, path, ["falling", "first_place"], compression="gzip")
    back = fl.explode_posts(read_archives(spark, path, layout="lines"))
    newer = F.col("content").endswith(" v2")
    side = F.when(newer, "new").otherwise("old")
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return back.select("file_slug", "id", "date_iso", "local_url", "content", side.alias("side"), "has_errors",
                       count("media").alias("media"), count("links").alias("links"))
