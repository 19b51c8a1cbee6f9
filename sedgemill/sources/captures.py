"""Captured HTTP responses: feed bodies and pages of the document index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: address fragment of the responses that carry posts.
FEED_URL_MARK = "graphql"
# One captured response per line.
RESPONSE_SCHEMA = "response_id bigint, page string, url string, body string, arrived timestamp"
API_SCHEMA = "page bigint, data array<variant>, meta struct<pagination:struct<itemsTotal:bigint>>"


def feed_responses(captured: DataFrame) -> DataFrame:
    """Responses of the feed endpoint that have a body."""
    wanted = F.col("url").contains(FEED_URL_MARK) & (F.coalesce("body", F.lit("")) != "")
    return captured.where(wanted).drop("url")


def read_feed_responses(
    spark: SparkSession, paths: str | list[str], stream: bool = False, max_files: int | None = None
) -> DataFrame:
    """Captured feed responses; a stream takes at most ``max_files`` files into one micro-batch.

    ``arrived`` is the response's own time, else that of its file.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.schema(RESPONSE_SCHEMA).json(paths)
    return feed_responses(rows.withColumn("arrived", F.coalesce("arrived", "_metadata.file_modification_time")))


def read_api_pages(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """Index pages: (page, data, items_total). ``multi_line`` reads one page per file."""
    rows = spark.read.schema(API_SCHEMA).option("multiLine", str(multi_line).lower()).json(paths)
    return rows.select("page", "data", F.col("meta.pagination.itemsTotal").alias("items_total"))


def api_items(pages: DataFrame) -> DataFrame:
    """One row per listed document group, in page order."""
    rows = pages.select("page", F.posexplode("data").alias("pos", "item"))
    return rows.select(
        "page", "pos",
        F.try_variant_get("item", "$.slug", "string").alias("slug"),
        F.try_variant_get("item", "$.downloadUrl", "string").alias("download_url"),
        "item",
    )
