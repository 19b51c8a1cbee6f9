"""Summaries over the five relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def source_stats(sources: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts, flag counts and date span per source, sources without posts included.

    Posts are summed up per slug before they meet the sources, so a source with very
    many posts costs one row per task in the shuffle.
    """
    per_slug = posts.groupBy("source_slug").agg(
        F.count("id").alias("total_posts"),
        F.sum("has_media").alias("posts_with_media"),
        F.sum("has_links").alias("posts_with_links"),
        F.sum("has_errors").alias("posts_with_errors"),
        F.min("date_iso").alias("earliest_post"),
        F.max("date_iso").alias("latest_post"),
    )
    joined = sources.join(per_slug, F.col("slug") == F.col("source_slug"), "left")
    return joined.select(
        "slug", "name", "handler", "scraped_at",
        F.coalesce("total_posts", F.lit(0)).alias("total_posts"),
        "posts_with_media", "posts_with_links", "posts_with_errors", "earliest_post", "latest_post",
    )


def media_types(media: DataFrame) -> DataFrame:
    return media.groupBy("source_slug", "media_type").agg(F.count("*").alias("cnt"))


def failed_downloads(errors: DataFrame, posts: DataFrame) -> DataFrame:
    """Download errors with the post they belong to."""
    p = posts.select(F.col("id").alias("post_id"), "source_slug", "date_iso")
    e = errors.select("post_id", F.col("url").alias("failed_url"), "error")
    return e.join(p, "post_id").select("post_id", "source_slug", "date_iso", "failed_url", "error")


def download_error_totals(posts: DataFrame, errors: DataFrame) -> DataFrame:
    """Posts and download errors per source."""
    p = posts.groupBy("source_slug").agg(F.count("*").alias("posts"))
    e = errors.groupBy("source_slug").agg(F.count("*").alias("errors"))
    return p.join(e, "source_slug", "left").select(
        "source_slug", "posts", F.coalesce("errors", F.lit(0)).alias("errors")
    )


def register_views(sources: DataFrame, posts: DataFrame, media: DataFrame, links: DataFrame, errors: DataFrame) -> None:
    """Temporary views for SQL users: the five tables and the three summaries."""
    frames = {
        "sources": sources, "posts": posts, "posts_media": media, "posts_links": links, "posts_download_errors": errors,
        "v_source_stats": source_stats(sources, posts),
        "v_media_types": media_types(media),
        "v_failed_downloads": failed_downloads(errors, posts),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
