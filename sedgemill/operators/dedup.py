"""Repeated posts inside an archive and the same address under several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sedgemill.functions import clean_text, strip_unicode

KEY_FIELDS = ["source_slug", "original_url", "date_iso"]


def _keys(file: str, order: list[str]) -> dict[str, Column]:
    """Grouping key of equal posts; a post without address is a group of its own."""
    text = lambda c: strip_unicode(F.coalesce(F.col(c), F.lit("")))
    alone = F.when(text("original_url") == "", F.struct(*order))
    return {"_file": F.col(file), **{f"_{c}": text(c) for c in KEY_FIELDS}, "_alone": alone}


def dedup_posts(posts: DataFrame, order: list[str], file: str = "file_slug") -> DataFrame:
    """First post, by ``order``, of each (source, address, date) within a file."""
    keys = [c.alias(n) for n, c in _keys(file, order).items()]
    best = F.min_by(F.struct(*posts.columns), F.struct(*order)).alias("_best")
    return posts.groupBy(*keys).agg(best).select("_best.*")


def dedup_report(posts: DataFrame, order: list[str], file: str = "file_slug") -> DataFrame:
    """Per file with repeats: how many posts go and how many stay."""
    keys = [c.alias(n) for n, c in _keys(file, order).items()]
    groups = posts.groupBy(*keys).agg(F.count("*").alias("_n"))
    per_file = groups.groupBy(F.col("_file").alias(file)).agg(
        (F.sum("_n") - F.count("*")).alias("removed"), F.count("*").alias("remaining"))
    return per_file.where(F.col("removed") > 0)


def cross_posts(posts: DataFrame) -> DataFrame:
    """Addresses posted under more than one source: one row per address and source.

    Rows, not a list per address, so a very common address needs no large cell.
    """
    pairs = posts.select(
        clean_text(F.col("original_url")).alias("url"), clean_text(F.col("source_slug")).alias("slug")
    ).where(F.col("url").isNotNull() & F.col("slug").isNotNull()).distinct()
    shared = pairs.groupBy("url").agg(F.count("*").alias("slugs")).where(F.col("slugs") > 1)
    return pairs.join(shared, "url").select("url", "slugs", "slug")
