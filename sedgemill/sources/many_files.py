"""Scans of very many small files: few tasks list them, and few tasks read them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Small files (of up to so many bytes) that a task reads, and their bytes.
SMALL_FILE, TASK_FILES, TASK_BYTES = 1 << 20, 1 << 10, 32 << 20
#: Tasks for each core.
ROUNDS = 4
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listed(spark: SparkSession) -> Iterator[None]:
    """Files of readers made inside are listed by a few tasks a core, each with many folders; Spark would take a task for each of 10,000."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), ROUNDS * ROUNDS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def in_few_tasks(files: DataFrame, *columns: str | Column) -> DataFrame:
    """Columns of a scan whose small files are dealt to tasks by number and bytes: Spark counts 4 MB for each, so its tasks have a few files."""
    number = len(files._jdf.inputFiles())
    if number <= TASK_FILES:
        return files.select(*columns)
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = max(ROUNDS * files.sparkSession.sparkContext.defaultParallelism, number // TASK_FILES, size // TASK_BYTES)
    small = F.col("_metadata.file_size") <= SMALL_FILE
    return files.where(small).select(*columns).coalesce(tasks).unionByName(files.where(~small).select(*columns))
