"""Work still to do and its outcome: downloads, retries, resume points, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedgemill.functions import extract_post_id, is_video_host, leading_int, media_local_path, video_filename
from sedgemill.functions.worklogs import REGISTERED_ONLY_TEXT
from sedgemill.operators.shuffles import keep_first, lookup_join

#: Rows that the search for the middle sorts, and how far around it a round looks.
SORTED_AT_MOST, NARROWED_BY, PERCENTILE_ACCURACY = 10_000, 0.001, 10_000


def source_filter(sources: DataFrame, allow_list: DataFrame) -> DataFrame:
    """Sources named on the allow-list."""
    return sources.join(allow_list.select("slug"), "slug", "left_semi")


def _value_at_rank(values: DataFrame, name: str, rank: int, size: int):
    """The value of 1-based ``rank`` among ``size`` numbers or times, found by narrowing.

    Each round asks for two approximate percentiles around the rank and counts the rows
    below and between them exactly; only what lies between goes on, and a sort sees no more
    than ``SORTED_AT_MOST`` rows unless equal values leave nothing to narrow.
    """
    v = F.col(name)
    while size > SORTED_AT_MOST:
        share = [max(0.0, (rank - 1) / size - NARROWED_BY), min(1.0, rank / size + NARROWED_BY)]
        low, high = values.agg(F.percentile_approx(v, share, PERCENTILE_ACCURACY)).first()[0]
        below, between = values.agg(F.count_if(v < F.lit(low)), F.count_if(v.between(F.lit(low), F.lit(high)))).first()
        if not below < rank <= below + between or between == size:
            break
        if low == high:
            return low
        values, rank, size = values.where(v.between(F.lit(low), F.lit(high))), rank - below, between
    return values.orderBy(v).offset(rank - 1).limit(1).first()[0]


def with_halves(sources: DataFrame, position: str, name: str = "half") -> DataFrame:
    """``name`` is 1 for the first half in ``position`` order (the larger on odd counts), 2 for the rest.

    Positions are numbers or times without repeats; rows of an equal position stay together,
    rows without one come last. Only the value at the middle is looked for, so nothing is
    moved and the halves are a filter on the source.
    """
    total, placed = sources.agg(F.count("*"), F.count(position)).first()
    rank = min((total + 1) // 2, placed)
    middle = _value_at_rank(sources.select(position).where(F.col(position).isNotNull()), position, rank, placed) if rank else None
    return sources.withColumn(name, F.when(F.col(position) <= F.lit(middle), 1).otherwise(2))


def split_group(sources: DataFrame, group: int, position: str) -> DataFrame:
    """Group 0 is all sources, 1 and 2 are the halves of ``with_halves``."""
    if group == 0:
        return sources
    return with_halves(sources, position, "_half").where(F.col("_half") == group).drop("_half")


def head_pages(pages: DataFrame, n: int, position: str) -> DataFrame:
    return pages.orderBy(position).limit(n)


def resume_point(posts: DataFrame) -> DataFrame:
    """Lowest numeric post id per source; NULL where no id is numeric."""
    return posts.groupBy("source_slug").agg(F.min(leading_int(F.col("id"))).alias("resume_id"))


def append_page(stored: DataFrame, page: DataFrame) -> DataFrame:
    """Stored posts followed by a new page: sort by (``source_slug``, ``batch``, ``pos``)."""
    return stored.withColumn("batch", F.lit(0)).unionByName(page.withColumn("batch", F.lit(1)))


def next_cursor(page: DataFrame) -> DataFrame:
    """Id of the last post on the new page of each source."""
    return page.groupBy("source_slug").agg(F.max_by("id", "pos").alias("last_id"))


def worklist_pending(
    worklist: DataFrame, failed_urls: DataFrame, downloaded: DataFrame, disk: DataFrame,
    retry_failed: bool = False, need_content: bool = False,
) -> DataFrame:
    """Entries of a work list not on the failure ledger, each labelled with what is to happen.

    Labels: empty_url, no_post_id, already, pending. ``disk`` has (name, size); with
    ``need_content`` only files that are not empty count and the ledger is ignored.
    """
    rows = worklist
    if not retry_failed:
        rows = lookup_join(rows, failed_urls.select("url").distinct(), ["url"], "left_anti")
    post_id = extract_post_id(F.col("url"))
    rows = rows.withColumn("post_id", post_id).withColumn("filename", video_filename(F.col("page_name"), post_id))
    if need_content:
        have = disk.where(F.col("size") > 0).select(F.col("name").alias("filename"))
    else:
        have = disk.select(F.col("name").alias("filename")).unionByName(downloaded.select("filename"))
    known = have.distinct().withColumn("_have", F.lit(True))
    rows = lookup_join(rows, known, ["filename"], "left")
    label = (
        F.when(F.col("url") == "", "empty_url").when(F.col("post_id").isNull(), "no_post_id")
        .when(F.col("_have"), "already").otherwise("pending"))
    return rows.select("page_name", "url", "post_id", "filename", label.alias("label"))


def download_summary(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Succeeded and failed entries of a run; ``outcomes`` has (filename, ok) of the attempts.

    An empty address and a file already there count as succeeded, an address without
    post id as failed.
    """
    tried = outcomes.groupBy("filename").agg(F.bool_or("ok").alias("ok"))
    rows = lookup_join(plan, tried, ["filename"], "left")
    good = F.col("label").isin("empty_url", "already") | ((F.col("label") == "pending") & F.coalesce("ok", F.lit(False)))
    return rows.agg(F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"), F.count("*").alias("total"))


def media_download_plan(
    media: DataFrame, errors: DataFrame, files: DataFrame, skip_video: bool = False
) -> DataFrame:
    """Media to fetch: not failed before for the same post, not stored yet, on a host that is fetched."""
    path = media_local_path(F.col("post_id"), F.col("media_type"), F.col("url"), skip_video)
    rows = media.select("post_id", "source_slug", "media_type", "url", path.alias("local_path")).where(
        F.col("local_path").isNotNull() & ((F.col("media_type") == "image") | is_video_host(F.col("url"))))
    rows = rows.join(errors.select("post_id", "url"), ["post_id", "url"], "left_anti")
    return rows.join(files.select("source_slug", "local_path"), ["source_slug", "local_path"], "left_anti").select(
        "post_id", "source_slug", "media_type", "url", "local_path")


def attach_download_errors(posts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Posts with their failed attempts as the list ``download_errors``, in the order of ``seq``.

    ``outcomes`` has (post_id, seq, url, error), error NULL for a success. Errors a post
    already has come first; a post without any has an empty list.
    """
    item = F.struct("seq", "url", "error")
    failed = outcomes.where(F.col("error").isNotNull()).groupBy(F.col("post_id").alias("id")).agg(F.transform(
        F.sort_array(F.collect_list(item)), lambda e: F.struct(e["url"].alias("url"), e["error"].alias("error"))).alias("_failed"))
    rows = lookup_join(posts, failed, ["id"], "left")
    none = F.array().cast("array<struct<url:string,error:string>>")
    before = F.coalesce("download_errors", none) if "download_errors" in posts.columns else none
    return rows.withColumn("download_errors", F.concat(before, F.coalesce("_failed", none))).drop("_failed")


def retry_candidates(errors: DataFrame) -> DataFrame:
    """One attempt per archive and address that failed for registered users only.

    The file is named after the first post with the address. ``errors`` has (file,
    post_id, post_pos, url, error) and, where archives have several parts, ``part``.
    """
    wanted = errors.where(F.col("error").contains(REGISTERED_ONLY_TEXT) & (F.coalesce("url", F.lit("")) != ""))
    place = [c for c in ("part", "post_pos") if c in errors.columns]
    first = keep_first(wanted.select("file", "url", "post_id", *place), ["file", "url"], [*place, "post_id"])
    return first.select("file", "url", "post_id", F.concat("post_id", F.lit("_video.mp4")).alias("filename"))


def apply_retry_to_errors(errors: DataFrame, succeeded: DataFrame) -> DataFrame:
    """Errors that remain: those of addresses fetched after all are removed from every post."""
    retryable = F.col("error").contains(REGISTERED_ONLY_TEXT)
    done = succeeded.select("file", "url").withColumn("_done", F.lit(True))
    rows = lookup_join(errors, done, ["file", "url"], "left")
    return rows.where(~(F.coalesce("_done", F.lit(False)) & F.coalesce(retryable, F.lit(False)))).drop("_done")


def apply_retry_to_media(media: DataFrame, errors: DataFrame, succeeded: DataFrame) -> DataFrame:
    """Media after a retry: a post's video without a path gets the fetched file, where its error is removed."""
    removed = errors.where(F.col("error").contains(REGISTERED_ONLY_TEXT)).select("file", "post_id", "url")
    removed = lookup_join(
        removed, succeeded.select("file", "url", "filename"), ["file", "url"], "inner")
    patch = removed.groupBy("file", "post_id", "url").agg(F.min("filename").alias("_filename"))
    rows = lookup_join(media, patch, ["file", "post_id", "url"], "left")
    empty = F.coalesce("local_path", F.lit("")) == ""
    fill = (F.col("media_type") == "video") & empty & F.col("_filename").isNotNull()
    path = F.when(fill, F.concat(F.lit("media/"), "_filename")).otherwise(F.col("local_path"))
    return rows.withColumn("local_path", path).drop("_filename")


def posts_newest_first(posts: DataFrame) -> DataFrame:
    """Posts of each source, newest first; a missing date sorts last."""
    return posts.orderBy("source_slug", F.coalesce("date_iso", F.lit("")).desc())
