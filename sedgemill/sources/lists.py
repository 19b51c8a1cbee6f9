"""Line and CSV lists: file manifests, work lists, ledgers, allow-lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sedgemill.functions import strip_unicode
from sedgemill.operators.shuffles import lookup_join

WORKLIST_COLUMNS = ["page_name", "url"]
LEDGER_COLUMNS = ["timestamp", "filename", "filesize"]
FAILURE_COLUMNS = ["timestamp", "page_name", "url", "reason"]


def manifest_rows(lines: DataFrame) -> DataFrame:
    """Split ``value`` at its first slash; lines without one, or blank, are marked skipped."""
    line = strip_unicode(F.col("value"))
    skipped = ~line.contains("/")
    return lines.select(
        F.when(~skipped, F.substring_index(line, "/", 1)).alias("source_slug"),
        F.when(~skipped, F.regexp_replace(line, "^[^/]*/", "")).alias("local_path"),
        skipped.alias("skipped"),
    )


def read_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return manifest_rows(spark.read.text(paths))


def _first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line) of the first line of every file that has one, without a byte order mark."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.regexp_replace("value", "^\ufeff", "").alias("value"))
    return lines.where("block = 0").groupBy("path").agg(F.min_by("value", "line").alias("line"))


def csv_rows(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Records of CSV files as (path, cells, first, heads): lists with any number of columns, as the CSV reader gives them.

    ``first`` has the cells of the file's first record, on every row; ``heads`` marks that
    record itself. Cells are as many as the widest first line has; records that are shorter
    have NULL in the rest. Quoted cells may hold commas, doubled quotes and line breaks;
    ``multi_line=False`` reads lists without such breaks, whose files can then be split.
    Empty lines are no records.
    """
    width = _first_lines(spark, paths).agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1
    columns = [f"c{i}" for i in range(max(width, 2))]
    reader = spark.read.schema(", ".join(f"{c} string" for c in columns)).options(
        header="false", quote='"', escape='"', multiLine=str(multi_line).lower(), emptyValue="", mode="PERMISSIVE",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", maxColumns=str(max(20480, width + 1)))
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    clean = F.transform(F.array(*columns), lambda c: F.regexp_replace(c, "^\ufeff|\r$", ""))
    rows = reader.csv(paths).select(F.col("_metadata.file_path").alias("path"), place.alias("place"), clean.alias("cells"))
    heads = rows.where(F.col("place.block") == 0).groupBy("path").agg(
        F.min("place").alias("_first"), F.min_by("cells", "place").alias("first"))
    return lookup_join(rows, heads, ["path"], "inner").select(
        "path", "cells", "first", (F.col("place") == F.col("_first")).alias("heads"))


def _named_cells(spark: SparkSession, paths: str | list[str], required: list[str], multi_line: bool) -> DataFrame:
    """The required columns, found by each file's own first record; a file without one of them is refused."""
    rows = csv_rows(spark, paths, multi_line)
    names = F.transform("first", lambda c: F.coalesce(strip_unicode(c), F.lit("")))
    short = rows.where(F.col("heads")).select("path", names.alias("names")).where(
        ~F.forall(F.array(*[F.lit(c) for c in required]), lambda c: F.array_contains("names", c))).take(1)
    if short:
        raise ValueError(f"missing columns {[c for c in required if c not in short[0].names]} in {short[0].path}; found {short[0].names}")
    cell = lambda c: F.try_element_at("cells", F.array_position(names, F.lit(c)).cast("int")).alias(c)
    return rows.where(~F.col("heads")).select(*[cell(c) for c in required])


def read_worklist(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Page name and address of every entry, trimmed, empty where there is none; a list without those columns is refused."""
    rows = _named_cells(spark, paths, WORKLIST_COLUMNS, multi_line)
    return rows.select(*[strip_unicode(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in WORKLIST_COLUMNS])


def read_failures(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Addresses in a failure ledger, once each."""
    rows = _named_cells(spark, paths, ["url"], multi_line).where(F.coalesce("url", F.lit("")) != "")
    return rows.select(strip_unicode(F.col("url")).alias("url")).distinct()


def read_ledger(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Distinct file names of download ledgers, with or without a header line.

    A file whose first record has a ``filename`` cell is read by the place of that cell, however
    many columns there are; in others the second column counts where it ends in ``.mp4``.
    """
    rows = csv_rows(spark, paths, multi_line)
    place = F.array_position(F.transform("first", lambda c: strip_unicode(c)), F.lit("filename")).cast("int")
    second = F.try_element_at("cells", F.lit(2))
    name = F.when(place > 0, F.when(~F.col("heads"), F.try_element_at("cells", place))).when(second.endswith(".mp4"), second)
    return rows.select(strip_unicode(name).alias("filename")).where(F.col("filename") != "").distinct()


def read_allow_list(spark: SparkSession, paths: str | list[str], prefix: str) -> DataFrame:
    """Slugs named by lines that start with ``prefix``."""
    line = strip_unicode(F.col("value"))
    return (
        spark.read.text(paths).where(line.startswith(prefix))
        .select(F.substring_index(line, "/", -1).alias("slug")).distinct()
    )
