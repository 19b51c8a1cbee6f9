"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, driver_memory: str = "16g") -> SparkSession:
    """Session for tests and benchmarks; a cluster passes its own settings to spark-submit."""
    return (
        SparkSession.builder.master(master)
        .appName("sedgemill")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A private temporary folder is made only where the setting is missing and the
    session is a local one; a cluster without the setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="sedgemill-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_root(spark)}/sedgemill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes the rows, so later branches see the same data even
    when executors are lost.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
