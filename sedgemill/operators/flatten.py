"""Archive documents to the five relations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sedgemill.functions import clean_text, variant_text
from sedgemill.operators.shuffles import keep_last
from sedgemill.session import written

POST_FIELDS = [
    "source_name", "date", "date_iso", "original_url", "local_url", "content", "continuation_url",
]
SOURCE_COLUMNS = ["slug", "name", "orig_url", "handler", "scraped_at", "source_file"]
POST_COLUMNS = ["id", "source_slug", *POST_FIELDS, "has_media", "has_links", "has_errors"]
MEDIA_COLUMNS = ["post_id", "source_slug", "media_type", "url", "local_path"]
LINK_COLUMNS = ["post_id", "source_slug", "text", "url"]
ERROR_COLUMNS = ["post_id", "source_slug", "url", "error"]
# Where a row was read: input order of repeated posts.
PLACE = ["path", "part", "post_pos"]


def _default_slug() -> Column:
    """Slug of the document; the file name stands in only when the key is absent."""
    absent = F.try_variant_get("metadata", "$.slug", "variant").isNull()
    return F.when(absent, F.col("file_slug")).otherwise(variant_text(F.col("metadata"), "$.slug"))


def _source_fields() -> dict[str, Column]:
    meta = lambda key: clean_text(variant_text(F.col("metadata"), f"$.{key}"))
    return {
        "slug": clean_text(_default_slug()),
        **{key: meta(key) for key in ("name", "orig_url", "handler")},
        "scraped_at": clean_text(variant_text(F.col("scraped_at"), "$")),
        "source_file": F.substring_index("path", "/", -1),
    }


def flatten_sources(docs: DataFrame) -> DataFrame:
    fields = [c.alias(name) for name, c in _source_fields().items()]
    return docs.where(F.col("error").isNull() & (_first_pos(docs) == 0)).select(*fields, "path", "part")


def _first_pos(docs: DataFrame) -> Column:
    """Place of a row's first post in its document, where documents come in several rows."""
    return F.col("first_pos") if "first_pos" in docs.columns else F.lit(0)


def explode_posts(docs: DataFrame, require_id: bool = True, carry: list[str] | None = None) -> DataFrame:
    """One row per post that has an id, cleaned, with its nested lists still attached.

    With ``carry`` every document has a row, with those columns of it, even if it has no posts.
    """
    # Unreadable documents have no posts.
    unnest = F.posexplode if carry is None else F.posexplode_outer
    posts = docs.select(
        "path", "file_slug", "part", *(carry or []), _default_slug().alias("_slug"), _first_pos(docs).alias("_first"),
        unnest("posts").alias("post_pos", "_post")
    ).withColumn("post_pos", (F.col("_first") + F.col("post_pos")).cast("int"))
    field = lambda key: clean_text(variant_text(F.col("_post"), f"$.{key}"))
    items = lambda key: F.try_variant_get("_post", f"$.{key}", "array<variant>")
    absent = F.try_variant_get("_post", "$.source_slug", "variant").isNull()
    slug = F.when(absent, F.col("_slug")).otherwise(variant_text(F.col("_post"), "$.source_slug"))
    filled = lambda name: (F.coalesce(F.size(name), F.lit(0)) > 0).cast("int")
    rows = posts.select(
        "path", "file_slug", "part", "post_pos", *(carry or []),
        field("id").alias("id"),
        clean_text(slug).alias("source_slug"),
        *[field(k).alias(k) for k in POST_FIELDS],
        items("media").alias("media"),
        items("links").alias("links"),
        items("download_errors").alias("download_errors"),
    )
    if require_id:
        rows = rows.where(F.col("id").isNotNull())
    return rows.select(
        "*",
        filled("media").alias("has_media"),
        filled("links").alias("has_links"),
        filled("download_errors").alias("has_errors"),
    )


def flatten_posts(posts: DataFrame) -> DataFrame:
    return posts.select(*POST_COLUMNS, "file_slug", *PLACE)


# Fields of the nested lists, by the column they become.
MEDIA_FIELDS = {"media_type": "type", "url": "url", "local_path": "local_path"}
LINK_FIELDS = {"text": "text", "url": "url"}
ERROR_FIELDS = {"url": "url", "error": "error"}


def _item_fields(item: Column, fields: dict[str, str]) -> list[Column]:
    return [clean_text(variant_text(item, f"$.{key}")).alias(name) for name, key in fields.items()]


def _children(posts: DataFrame, nested: str, fields: dict[str, str]) -> DataFrame:
    items = posts.select(
        F.col("id").alias("post_id"), "source_slug", "file_slug", *PLACE, F.posexplode(nested).alias("pos", "_item")
    )
    return items.select("post_id", "source_slug", *_item_fields(F.col("_item"), fields), "file_slug", *PLACE, "pos")


def list_rows(posts: DataFrame, nested: str, fields: dict[str, str]) -> DataFrame:
    """One row per post that has items of a kind, with their fields in one list ``items``; what joins on posts moves these."""
    items = F.transform(nested, lambda item: F.struct(*_item_fields(item, fields)))
    return posts.where(F.size(nested) > 0).select(
        F.col("id").alias("post_id"), "source_slug", "file_slug", *PLACE, items.alias("items"))


def explode_lists(rows: DataFrame) -> DataFrame:
    """The children in lists of ``list_rows``, one row each."""
    rest = [c for c in rows.columns if c != "items"]
    return rows.select(*rest, F.posexplode("items").alias("pos", "_item")).select(*rest, "_item.*", "pos")


def flatten_media(posts: DataFrame) -> DataFrame:
    return _children(posts, "media", MEDIA_FIELDS)


def flatten_links(posts: DataFrame) -> DataFrame:
    return _children(posts, "links", LINK_FIELDS)


def flatten_errors(posts: DataFrame) -> DataFrame:
    return _children(posts, "download_errors", ERROR_FIELDS)


@dataclass(frozen=True)
class Tables:
    """The five relations of an archive load, each row with the place it came from."""

    sources: DataFrame
    posts: DataFrame
    media: DataFrame
    links: DataFrame
    errors: DataFrame


def flatten(docs: DataFrame, once: bool = False) -> Tables:
    """All five relations. They are lazy: each parses the documents when it is used.

    With ``once`` the documents are parsed now, one time, into a written table of posts that
    carries each document's source on one of its rows; the relations read that.
    """
    if not once:
        sources, posts = flatten_sources(docs), explode_posts(docs)
    else:
        source = F.struct(*[c.alias(name) for name, c in _source_fields().items()])
        rows = explode_posts(docs.where(F.col("error").isNull()).withColumn("_source", source), False, ["_source"])
        heads = F.coalesce("post_pos", F.lit(0)) == 0
        rows = rows.withColumn("_source", F.when(heads, F.col("_source"))).where(heads | F.col("id").isNotNull())
        rows = written(rows, "load-posts")
        sources = rows.where(F.col("_source").isNotNull()).select("_source.*", "path", "part")
        posts = rows.where(F.col("id").isNotNull()).drop("_source")
    return Tables(sources, flatten_posts(posts), flatten_media(posts), flatten_links(posts), flatten_errors(posts))


def _read_order() -> list[Column]:
    # Files are read in the order of their path parts: the lowest character between them gives that order to one text.
    return [F.replace(F.col("path"), F.lit("/"), F.lit("\0")), F.col("part")]


def upsert_sources(sources: DataFrame) -> DataFrame:
    """One row per slug: the last one read."""
    return keep_last(sources, ["slug"], _read_order(), SOURCE_COLUMNS)


def upsert_posts(posts: DataFrame, load_order: str | None = None) -> DataFrame:
    """One row per post id: the last one read, with those of ``POST_COLUMNS`` that ``posts`` has.

    ``load_order`` names a column of earlier/later loads.
    """
    first = [F.col(load_order)] if load_order else []
    columns = [c for c in POST_COLUMNS if c in posts.columns]
    return keep_last(posts, ["id"], [*first, *_read_order(), F.col("post_pos")], columns)


def load_stats(docs: DataFrame, by: str = "path") -> DataFrame:
    """Rows each file contributes, counted before repeated ids are replaced.

    ``by="file_slug"`` counts per archive instead, where archives have several parts.
    """
    named = F.filter("posts", lambda p: clean_text(variant_text(p, "$.id")).isNotNull())

    def items(key: str) -> Column:
        size = lambda p: F.coalesce(F.size(F.try_variant_get(p, f"$.{key}", "array<variant>")), F.lit(0)).cast("bigint")
        return F.aggregate("_named", F.lit(0).cast("bigint"), lambda total, p: total + size(p))

    # Counted inside each document, so posts are never exploded.
    per_file = docs.withColumn("_named", F.coalesce(named, F.array().cast("array<variant>"))).select(
        by, F.col("error").isNull().alias("success"), F.size("_named").cast("bigint").alias("posts"),
        items("media").alias("media"), items("links").alias("links"), items("download_errors").alias("errors_dl"), "error",
    )
    return per_file.groupBy(by).agg(
        F.bool_and("success").alias("success"),
        *[F.sum(c).alias(c) for c in ("posts", "media", "links", "errors_dl")],
        F.max("error").alias("error"),
    )


def load_totals(stats: DataFrame) -> DataFrame:
    """Totals over all files; rows of failed files do not count."""
    good = lambda c: F.coalesce(F.sum(F.when(F.col("success"), F.col(c))), F.lit(0)).alias(c)
    return stats.agg(
        F.count("*").alias("files"),
        F.count_if(~F.col("success")).alias("failed_files"),
        *[good(c) for c in ("posts", "media", "links", "errors_dl")],
    )
