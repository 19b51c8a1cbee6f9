"""The document index: pages of items, failed pages, recovered items."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed value: items the index puts on a page.
ITEMS_PER_PAGE = 18
# Fixed value: items expected where the first page, which tells, is missing.
ITEMS_EXPECTED = 5_146


def pages_for(items_total, items_per_page: int = ITEMS_PER_PAGE):
    return F.ceil(items_total / F.lit(items_per_page)).cast("bigint")


def expected_pages(pages: DataFrame, fixed_total: int | None = None, default_total: int = ITEMS_EXPECTED) -> DataFrame:
    """Every page number there should be: from a fixed total, or the one the first page reports.

    Without a first page ``default_total`` counts. A total of 0 gives no pages.
    """
    if fixed_total is not None:
        counts = pages.sparkSession.range(1).select(pages_for(F.lit(fixed_total)).alias("n"))
    else:
        counts = pages.where(F.col("page") == 1).agg(
            pages_for(F.coalesce(F.max("items_total"), F.lit(default_total))).alias("n"))
    # The sequence comes as one number per thousand pages, so no row grows with the index.
    blocks = counts.where(F.col("n") > 0).select("n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1000))).alias("b"))
    last = F.least(F.col("n"), F.col("b") * 1000 + 1000)
    return blocks.select(F.explode(F.sequence(F.col("b") * 1000 + 1, last)).alias("page"))


def api_failed_pages(pages: DataFrame, fixed_total: int | None = None, default_total: int = ITEMS_EXPECTED) -> DataFrame:
    """Expected pages without a response."""
    got = pages.select("page").distinct()
    return expected_pages(pages, fixed_total, default_total).join(got, "page", "left_anti")


def api_index_meta(
    items: DataFrame, pages: DataFrame, fixed_total: int | None = None, default_total: int = ITEMS_EXPECTED
) -> DataFrame:
    """Head of the index: items found, pages expected and failed. The failed pages are rows of their own."""
    zero = F.lit(0).cast("bigint")
    counted = items.select(F.lit(1).cast("bigint").alias("i"), zero.alias("p"), zero.alias("f"))
    expected = expected_pages(pages, fixed_total, default_total).select(zero.alias("i"), F.lit(1).cast("bigint").alias("p"), zero.alias("f"))
    failed = api_failed_pages(pages, fixed_total, default_total).select(zero.alias("i"), zero.alias("p"), F.lit(1).cast("bigint").alias("f"))
    return counted.unionByName(expected).unionByName(failed).agg(
        F.coalesce(F.sum("i"), zero).alias("total_items"),
        F.coalesce(F.sum("p"), zero).alias("total_pages"),
        F.lit(ITEMS_PER_PAGE).cast("bigint").alias("items_per_page"),
        F.coalesce(F.sum("f"), zero).alias("failed_pages"),
    )


def api_retry_merge(items: DataFrame, recovered: DataFrame) -> DataFrame:
    """Recovered items come after all others: sort by (``batch``, ``page``, ``pos``)."""
    return items.withColumn("batch", F.lit(0)).unionByName(recovered.withColumn("batch", F.lit(1)))


def still_failing(failed: DataFrame, recovered: DataFrame) -> DataFrame:
    """Failed pages the retry did not bring back."""
    return failed.join(recovered.select("page").distinct(), "page", "left_anti")


def docs_pending(items: DataFrame, archives: DataFrame) -> DataFrame:
    """Groups to download: those with an address and no non-empty ``<slug>.zip`` (name, size)."""
    named = items.withColumn("slug", F.coalesce("slug", F.lit("unknown")))
    wanted = named.where(F.coalesce("download_url", F.lit("")) != "").withColumn("name", F.concat("slug", F.lit(".zip")))
    # Keys of all items compress so well that they would be sent whole through the driver; a merge join never is.
    have = archives.where(F.col("size") > 0).select("name").hint("merge")
    return wanted.join(have, "name", "left_anti")


def docs_outcomes(items: DataFrame, pending: DataFrame, fetched: DataFrame) -> DataFrame:
    """(page, pos, slug, ok) per group; ``fetched`` has (page, pos, ok) of the attempted ones."""
    tried = pending.select("page", "pos").join(fetched.hint("merge"), ["page", "pos"], "left").select(
        "page", "pos", F.coalesce("ok", F.lit(False)).alias("ok"))
    rows = items.join(tried.hint("merge"), ["page", "pos"], "left")
    return rows.select(
        "page", "pos", F.coalesce("slug", F.lit("unknown")).alias("slug"), F.coalesce("ok", F.lit(True)).alias("ok"))


def docs_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.count("*").alias("total"))
