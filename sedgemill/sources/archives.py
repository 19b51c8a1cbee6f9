"""Archive documents: one JSON object per crawled source, posts nested inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sedgemill.sources.archive_stream import streamed_documents
from sedgemill.sources.many_files import in_few_tasks, listed

# Posts stay separate variants, so no single value has to hold a whole archive.
DOCUMENT_SCHEMA = (
    "metadata variant, scraped_at variant, consolidated_at variant, sources variant, "
    "part bigint, posts array<variant>, _corrupt string"
)


def file_stem(path: Column) -> Column:
    """File name without its last extension, percent escapes decoded."""
    name = F.substring_index(path, "/", -1)
    return F.coalesce(F.try_url_decode(F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), r"\+", "%2B")), name)


def archive_documents(raw: DataFrame) -> DataFrame:
    """Parse rows of (path, file_slug, value): one document each.

    ``error`` is set, and everything else NULL, where the text is not a JSON object or
    its posts are not an array. ``part`` numbers the documents of an archive that was
    written in several parts, ``first_pos`` is the place of a row's first post in its document.
    """
    parsed = raw.withColumn(
        "_doc", F.from_json("value", DOCUMENT_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"})
    )
    whole = F.endswith(F.rtrim(F.col("value"), F.lit(" \t\r\n")), F.lit("}"))
    bad = ~whole | F.col("_doc").isNull() | F.col("_doc._corrupt").isNotNull()
    keep = lambda name: F.when(~bad, F.col(f"_doc.{name}")).alias(name)
    return parsed.select(
        "path",
        "file_slug",
        F.coalesce(F.when(~bad, F.col("_doc.part")), F.lit(0)).alias("part"),
        (F.col("first_pos") if "first_pos" in raw.columns else F.lit(0).cast("bigint")).alias("first_pos"),
        keep("metadata"),
        keep("scraped_at"),
        keep("consolidated_at"),
        keep("sources"),
        F.when(~bad, F.coalesce("_doc.posts", F.array().cast("array<variant>"))).alias("posts"),
        F.when(bad, F.lit("not a JSON object with a list of posts")).alias("error"),
    )


def path_only(path: Column) -> Column:
    """A file's path without scheme and authority, without its name, percent escapes decoded."""
    folder = F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), r"/[^/]*$", "")
    return F.coalesce(F.try_url_decode(F.regexp_replace(folder, r"\+", "%2B")), folder)


def _segments(spark: SparkSession, path: str) -> list[str]:
    """Parts of a given path after it was made absolute."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop)
    return whole.toUri().getPath().rstrip("/").split("/")


def _starts(folders: Column, parts: list[str]) -> Column:
    """Do the folders begin with these parts? A part with a pattern sign fits any name."""
    fits = F.size(folders) >= len(parts)
    for i, part in enumerate(parts):
        if not set(part) & set("*?[{"):
            fits = fits & (folders[i] == part)
    return fits


def read_archives(
    spark: SparkSession, paths: str | list[str], layout: str = "files", prune: tuple[str, ...] = (), pattern: str = "*.json"
) -> DataFrame:
    """Archives below folders, globs or files.

    ``files``: one document per file that fits ``pattern``, in any sub-folder; folders below a given one
    whose name is in ``prune`` are left out.
    ``stream``: the same documents from files of any size: posts leave a file in several rows of
    bounded size with the document's other members on each, while its text passes as a stream.
    ``bundles``: files of any size, walked in the same way, that hold documents one after another, with or
    without line breaks in and between them; for more archives than a store should have files.
    ``lines``: one document per line, which Spark can split; the layout for large data.
    ``file_slug`` names the archive: the file name in the first layout (the slug in the
    metadata for files named by a Spark writer) where a file is a document, else the slug in the metadata.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("recursiveFileLookup", "true")
    path = F.col("_metadata.file_path").alias("path")
    with listed(spark):
        if layout == "files":
            raw = in_few_tasks(reader.option("pathGlobFilter", pattern).text(paths, wholetext=True), path, "value")
        elif layout in ("stream", "bundles"):
            raw = streamed_documents(reader.option("pathGlobFilter", pattern), paths, bundled=layout == "bundles")
        elif layout == "lines":
            raw = reader.text(paths).select(path, "value")
        else:
            raise ValueError(f"unknown layout {layout}")
    if layout != "lines" and prune:
        # Only what lies below a given folder is pruned: its own path may have such a name.
        raw = raw.withColumn("_folders", F.split(path_only(F.col("path")), "/"))
        dropped = F.lit(False)
        for parts in (_segments(spark, p) for p in paths):
            below = F.slice("_folders", F.lit(len(parts) + 1), F.greatest(F.size("_folders"), F.lit(1)))
            dropped = dropped | (_starts(F.col("_folders"), parts) & F.exists(below, lambda f: f.isin(*prune)))
        raw = raw.where(~dropped).drop("_folders")
    if layout in ("files", "stream"):
        # Files named by a Spark writer carry their slug inside only.
        written = F.regexp_like(F.substring_index("path", "/", -1), F.lit(r"^part-\d{5}-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"))
        slug = F.when(written, F.get_json_object("value", "$.metadata.slug")).otherwise(file_stem(F.col("path")))
    else:
        if layout == "lines":
            raw = raw.where(F.trim("value") != "")
        slug = F.get_json_object("value", "$.metadata.slug")
    return archive_documents(raw.withColumn("file_slug", slug))
