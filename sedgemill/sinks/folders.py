"""Text files in a folder per key, for as many keys as there are sources."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import sedgemill

cloudpickle.register_pickle_by_value(sedgemill)  # the writer travels with the job

# Names as Spark gives them to folders of a partition.
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_name(key: str, value: str | None) -> str:
    escape = lambda text: ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", text)
    return f"{escape(key)}={escape(value) if value else NO_VALUE}"


def _local(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder in the local file system; None in other stores, and where the JVM could not list names in UTF-8."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file" or spark._jvm.java.lang.System.getProperty("sun.jnu.encoding") != "UTF-8":
        return None
    return fs.makeQualified(hadoop).toUri().getPath()


def write_folders(rows: DataFrame, key: str, path: str, kind: str, alone: bool = False) -> None:
    """``rows`` in a folder ``key=value`` for each value of ``key``, laid out as by ``write.partitionBy(key)``.

    ``kind`` is ``text`` (the other column has the lines) or ``json`` (an object per row). ``alone`` gives each row a file; else
    rows of a key have to come together, and are a file. The output appears as a whole or not at all.

    For a local folder Hadoop starts a process for the mode of each folder, file and checksum, and moves folders one by one in the
    driver. There the tasks write plain files (without checksums) below a folder that gets its name at the end. Files of a task
    have the same names when it runs again, and appear under them when they are whole.
    """
    spark, others = rows.sparkSession, [c for c in rows.columns if c != key]
    local = _local(spark, path)
    if local is None:
        rows.write.partitionBy(key).option("maxRecordsPerFile", int(alone)).format(kind).save(path)
        return
    value = F.to_json(F.struct(*others)) if kind == "json" else F.col(others[0])
    lines = rows.select(F.col(key).cast("string").alias("key"), value.cast("binary").alias("value"))
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, target = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path(local)
    if fs.exists(target):
        raise FileExistsError(path)
    token, end = str(uuid.uuid4()), {"json": "json", "text": "txt"}[kind]
    staged = f"{os.path.dirname(local)}/_{os.path.basename(local)}-{token}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, attempt, files = TaskContext.get().partitionId(), uuid.uuid4().hex, {}
        file, last = None, None

        def done() -> None:
            if file is not None:
                file.close()
                folder, name = os.path.split(file.name)
                os.replace(file.name, f"{folder}/{name[1:].removesuffix(attempt)}")

        for batch in batches:
            for own, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if alone or file is None or own != last:
                    done()
                    folder, last = f"{staged}/{folder_name(key, own)}", own
                    if folder not in files:
                        os.makedirs(folder, exist_ok=True)
                    files[folder] = files.get(folder, -1) + 1
                    # Files with a leading _ are not read.
                    file = open(f"{folder}/_part-{task:05d}-{token}.c{files[folder]:03d}.{end}{attempt}", "wb")
                file.write((line or b"") + b"\n")
        done()
        yield pa.RecordBatch.from_pydict({"files": pa.array([sum(files.values()) + len(files)], pa.int64())})

    fs.mkdirs(hadoop.Path(staged))
    try:
        lines.mapInArrow(work, "files long").agg(F.sum("files")).collect()
        fs.create(hadoop.Path(staged, "_SUCCESS")).close()
        if not fs.rename(hadoop.Path(staged), target):
            raise OSError(f"{staged} could not be renamed to {local}")
    except BaseException:
        fs.delete(hadoop.Path(staged), True)
        raise
