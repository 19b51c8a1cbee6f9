"""Raw forms of the derived relations: JSON archives, HTML, feed bodies, lists.

Each folder is written once per session and data folder, then shared by all queries
that read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sedgemill.plans.fixtures import fixture, fixture_by_post, nesting_tasks, table
from sedgemill.session import new_folder, written
from sedgemill.sinks.archives import archive_records, write_archives
from sedgemill.sources.archives import read_archives

_folders: dict[tuple[str, str, str], str] = {}


def rendered(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Folder of the raw form ``label``, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _folders:
        path = new_folder(spark, label)
        write(path)
        _folders[key] = path
    return _folders[key]


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = nesting_tasks(spark, sf_dir)
    records = archive_records(
        fixture(spark, sf_dir, "f_posts"),
        fixture_by_post(spark, sf_dir, "f_media", tasks),
        fixture(spark, sf_dir, "f_post_links"),
        fixture_by_post(spark, sf_dir, "f_errors", tasks),
    )
    # Readers have to drop posts without an id.
    twice = F.array(F.col("id"), F.lit(None).cast("string"))
    ids = F.when(F.col("continuation_url").isNotNull(), twice).otherwise(F.array("id"))
    return records.withColumn("id", F.explode(ids))


def _stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with their lists, nested once for both archive layouts."""
    path = rendered(spark, sf_dir, "records", lambda p: _records(spark, sf_dir).write.parquet(p, compression="zstd"))
    return spark.read.parquet(path)


def archive_lines(spark: SparkSession, sf_dir: str) -> str:
    """All archives, one document per line, and two lines that are no archives."""

    def write(path: str) -> None:
        write_archives(fixture(spark, sf_dir, "f_sources"), _stored_records(spark, sf_dir), path, ["date_iso"], compression="gzip")
        spark.createDataFrame([('{"metadata": {"slug"',), ('[{"posts": []}]',)], "value string").write.mode(
            "append").text(path)

    return rendered(spark, sf_dir, "archive-lines", write)


def archive_files(spark: SparkSession, sf_dir: str) -> str:
    """All archives as separate files, and one broken file."""

    def write(path: str) -> None:
        write_archives(
            fixture(spark, sf_dir, "f_sources"), _stored_records(spark, sf_dir), path, ["date_iso"], layout="files")
        _add_broken(spark, path)

    return rendered(spark, sf_dir, "archive-files", write)


def archive_bundles(spark: SparkSession, sf_dir: str) -> str:
    """All archives, as many to a file as a task writes, and one broken file."""

    def write(path: str) -> None:
        write_archives(fixture(spark, sf_dir, "f_sources"), _stored_records(spark, sf_dir), path, ["date_iso"])
        _add_broken(spark, path)

    return rendered(spark, sf_dir, "archive-bundles", write)


def _add_broken(spark: SparkSession, path: str) -> None:
    broken = spark.createDataFrame([(("broken",), "no list")], "metadata struct<slug:string>, posts string")
    broken.write.mode("append").json(path)


def archive_whole(spark: SparkSession, sf_dir: str) -> str:
    """Each archive as one document of any size, without the posts that have no id."""

    def write(path: str) -> None:
        records = _stored_records(spark, sf_dir).where(F.col("id").isNotNull())
        write_archives(fixture(spark, sf_dir, "f_sources"), records, path, ["date_iso"], layout="whole")

    return rendered(spark, sf_dir, "archive-whole", write)


def archive_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(spark, archive_lines(spark, sf_dir), layout="lines")


def snapshot_docs(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """One of the two crawl snapshots, written as archives and read back."""

    def write(path: str) -> None:
        snap = fixture(spark, sf_dir, "f_snap").where(F.col("side") == side)
        tasks = nesting_tasks(spark, sf_dir)
        errors = fixture_by_post(spark, sf_dir, "f_errors", tasks)
        sources = snap.groupBy(F.col("source_slug").alias("slug")).agg(
            F.max(F.concat(F.lit(side + " "), "source_slug")).alias("name"),
            F.lit("facebook").alias("handler"),
            F.lit(None).cast("string").alias("orig_url"),
            F.max("scraped_at").alias("scraped_at"),
        )
        own = lambda rows: rows.where(F.col("side") == side).drop("side")
        media, links = fixture_by_post(spark, sf_dir, "f_snap_media", tasks), fixture(spark, sf_dir, "f_snap_links")
        records = archive_records(snap.drop("side", "scraped_at"), own(media), own(links), errors)
        write_archives(sources, written(records, f"records-{side}"), path, ["date_iso"], compression="gzip")

    return read_archives(spark, rendered(spark, sf_dir, f"snapshot-{side}", write), layout="lines")


def escape_html(c: Column) -> Column:
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for char, name in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed chunks as JSON text, one per row of the feed relation.

    Every chunk has a story; some also carry an edge of another type, a story without
    a message object, attachments with an image, a video or both, or the throttle mark.
    """
    feed = fixture(spark, sf_dir, "f_feed")
    n = F.col("response_id") * 10 + F.col("chunk_no")
    ad = F.when(n % 7 == 0, F.lit('{"node":{"__typename":"Ad"}},')).otherwise("")
    mute = F.when(n % 11 == 0, F.lit(
        '{"node":{"__typename":"Story","comet_sections":{"content":{"story":{"id":"mute","message":null}}}}},')).otherwise("")
    kind = F.when(n % 5 == 0, "Video").otherwise("Photo")
    image = F.when(n % 3 == 0, F.concat(F.lit(',"image":{"uri":"https://cdn.example.com/f/'), n.cast("string"), F.lit('.jpg"}'))).otherwise("")
    media = F.concat(F.lit('[{"styles":{"attachment":{"media":{"__typename":"'), kind, F.lit('","id":"'), n.cast("string"), F.lit('"'), image, F.lit("}}}}]"))
    story = F.concat(
        F.lit('{"id":"'), "pid", F.lit('","creation_time":'), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"),
        F.lit(',"message":'), F.to_json(F.struct("text")), F.lit(',"attachments":'), media, F.lit("}"))
    mark = F.when(F.col("is_throttle"), F.lit(',"errors":[{"code":1675004}]')).otherwise("")
    chunk = F.concat(
        F.lit('{"data":{"node":{"timeline_list_feed_units":{"edges":['), ad, mute,
        F.lit('{"node":{"__typename":"Story","comet_sections":{"content":{"story":'), story, F.lit("}}}}]}}}"), mark, F.lit("}"))
    return feed.select("response_id", "chunk_no", "page", chunk.alias("chunk"))


def _bodies(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Response bodies: prefix, numbered lines, a blank line and a line that is no JSON at the end.

    A response has at most ten chunks.
    """
    lines = F.transform(
        F.sort_array(F.collect_list(F.struct("chunk_no", "chunk"))),
        lambda c: F.concat(c["chunk_no"].cast("string"), F.lit(":"), c["chunk"]))
    body = F.concat(F.lit("for (;;);"), F.array_join(F.col("lines"), "\r\n"), F.lit("\n \nnot json"))
    return chunks.groupBy(*keys).agg(lines.alias("lines")).withColumn("body", body).drop("lines")


def feed_captures(spark: SparkSession, sf_dir: str, by_page: bool) -> str:
    """Captured responses, one per line; with ``by_page`` each belongs to one page.

    Every response comes with one from another address that readers have to skip.
    """

    def write(path: str) -> None:
        keys = ["response_id", "page"] if by_page else ["response_id"]
        bodies = _bodies(chunk_rows(spark, sf_dir), keys)
        if not by_page:
            bodies = bodies.withColumn("page", F.lit(None).cast("string"))
        urls = F.array(F.lit("https://www.facebook.com/api/graphql/"), F.lit("https://www.facebook.com/ping"))
        bodies.select("response_id", "page", F.explode(urls).alias("url"), "body").write.json(path)

    return rendered(spark, sf_dir, "feed-by-page" if by_page else "feed", write)


def api_captures(spark: SparkSession, sf_dir: str) -> str:
    """Captured pages of the document index, one per line, at most 18 items each."""

    def write(path: str) -> None:
        total = F.lit(table(spark, sf_dir, "events").count())
        item = F.struct("slug", F.col("download_url").alias("downloadUrl"))
        pages = fixture(spark, sf_dir, "f_api").groupBy("page").agg(
            F.sort_array(F.collect_list(F.struct(F.substr("slug", F.lit(4)).cast("bigint").alias("n"), item.alias("item")))).alias("items"))
        pages.select(
            "page", F.col("items.item").alias("data"),
            F.struct(F.struct(total.alias("itemsTotal")).alias("pagination")).alias("meta"),
        ).write.json(path)

    return rendered(spark, sf_dir, "api-pages", write)
