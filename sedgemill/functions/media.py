from __future__ import annotations

from pyspark.sql import Column, functions as F

# Address fragments of hosts whose videos are fetched.
VIDEO_HOST_MARKS = ["facebook.com", "youtube.com", "reel"]


def absolutize_url(url: Column, base: str) -> Column:
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))


def is_video_host(url: Column) -> Column:
    hit = F.lit(False)
    for mark in VIDEO_HOST_MARKS:
        hit = hit | url.contains(mark)
    return hit


def media_local_path(post_id: Column, media_type: Column, url: Column, skip_video: bool = False) -> Column:
    """Where a post's file is stored: images keep their base name, all videos of a post share one."""
    no_query = F.substring_index(url, "?", 1)
    base_name = F.substring_index(F.regexp_replace(no_query, "/+$", ""), "/", -1)
    path = F.when(media_type == "image", F.concat(F.lit("media/"), post_id, F.lit("_"), base_name))
    if skip_video:
        return path
    return path.when(media_type == "video", F.concat(F.lit("media/"), post_id, F.lit("_video.mp4")))


def video_filename(page: Column, post_id: Column) -> Column:
    return F.concat(page, F.lit("_"), post_id, F.lit(".mp4"))
