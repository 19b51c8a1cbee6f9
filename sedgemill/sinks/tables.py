"""The stored relations: Parquet in buckets of sources, replaced on their keys bucket by bucket.

A load writes the buckets it touches under its own version, then adds one row to the commit
log; a bucket's rows are those of its newest committed version, so files of other buckets stay
as they are, all five tables change together, and a failed load changes nothing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sedgemill.operators.flatten import (
    ERROR_COLUMNS, LINK_COLUMNS, MEDIA_COLUMNS, POST_COLUMNS, SOURCE_COLUMNS, Tables, upsert_sources,
)
from sedgemill.operators.shuffles import keep_last, lookup_join
from sedgemill.session import written

CHILDREN = {"media": MEDIA_COLUMNS, "links": LINK_COLUMNS, "errors": ERROR_COLUMNS}
COLUMNS = {"sources": SOURCE_COLUMNS, "posts": POST_COLUMNS, **CHILDREN}
FLAGS = ("has_media", "has_links", "has_errors")


@dataclass(frozen=True)
class State:
    """What is committed: the last version, the number of buckets, and the version of each bucket (0: nothing stored)."""

    version: int
    buckets: int
    versions: list[int]


def store_state(spark: SparkSession, root: str) -> State | None:
    """The committed state, or None where nothing was stored yet. The driver gets one number per bucket."""
    try:
        log = spark.read.schema("version bigint, buckets int, touched array<int>").parquet(f"{root}/committed")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None
    last = log.agg(F.max("version"), F.max("buckets")).first()
    if last[0] is None:
        return None
    versions = [0] * last[1]
    for row in log.select("version", F.explode("touched").alias("b")).groupBy("b").agg(F.max("version").alias("v")).collect():
        versions[row["b"]] = row["v"]
    return State(last[0], last[1], versions)


def _bucket(slug: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(slug), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, root: str, name: str, state: State, only: list[int] | None = None) -> DataFrame:
    """Current rows of a table with their ``bucket``; of the buckets ``only``, where given. Other files are not listed or read."""
    wanted = range(state.buckets) if only is None else only
    versions = sorted({state.versions[b] for b in wanted} - {0})
    columns = ", ".join(f"{c} {'int' if c in FLAGS else 'string'}" for c in COLUMNS[name])
    schema = f"{columns}, version bigint, bucket int"
    if not versions:
        return spark.createDataFrame([], schema).drop("version")
    rows = spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*[f"{root}/{name}/version={v}" for v in versions])
    current = F.col("version") == F.array(*[F.lit(v) for v in state.versions])[F.col("bucket")]
    chosen = F.lit(True) if only is None else F.col("bucket").isin(list(only))
    return rows.where(current & chosen).drop("version")


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame] | None:
    """The committed rows of the five tables, or None where nothing was stored yet."""
    state = store_state(spark, root)
    return state and {name: _stored(spark, root, name, state).select(*COLUMNS[name]) for name in COLUMNS}


def write_tables(tables: Tables, root: str, children: str = "replace", buckets: int = 64) -> int:
    """Merge a load into the stored tables and commit the result as a new version.

    Sources and posts are replaced on their keys. ``children="replace"`` keeps the child
    rows of the winning record of each post only; ``"append"`` adds all of them, so
    loading a file twice doubles its child rows. Rows lie in ``buckets`` by a hash of their
    source's slug (the number is fixed by the first load). Written anew are the buckets of
    the load's sources and posts, and those in which one of its posts was stored before
    under another source; of all others only the ids are read, to find such posts.

    Give it ``flatten(docs, once=True)``: the winners are joined to what was parsed once.
    """
    spark = tables.posts.sparkSession
    state = store_state(spark, root) or State(0, buckets, [0] * buckets)
    version, parts = state.version + 1, state.buckets

    # Of each id the place of the record that wins in this load, narrow and once.
    place = F.struct(F.split("path", "/").alias("p"), "part", "post_pos")
    # The file is small for its rows (equal paths): joins with it are merge joins, which never pass it through the driver.
    winners = written(tables.posts.groupBy("id").agg(F.max(place).alias("_place")), "load-winners").hint("merge")
    ids = winners.select("id")

    slugs = tables.sources.select("slug").unionByName(tables.posts.select(F.col("source_slug").alias("slug")))
    touched = {r["b"] for r in slugs.select(_bucket("slug", parts).alias("b")).distinct().collect()}
    others = [b for b in range(parts) if b not in touched]
    elsewhere = _stored(spark, root, "posts", state, others).select("id", "bucket").join(ids, "id", "left_semi")
    touched |= {r["bucket"] for r in elsewhere.select("bucket").distinct().collect()}
    old = {name: _stored(spark, root, name, state, sorted(touched)) for name in COLUMNS}

    aged = lambda rows, load: rows.select(*SOURCE_COLUMNS).withColumn("_load", F.lit(load))
    sources = aged(old["sources"], 0).unionByName(aged(upsert_sources(tables.sources), 1))

    def winning(rows: DataFrame, key: str) -> DataFrame:
        best = winners.withColumnRenamed("id", key)
        return lookup_join(rows.withColumn("_here", place), best, [key], "inner").where(F.col("_here") == F.col("_place"))

    posts = winning(tables.posts, "id").select(*POST_COLUMNS)
    new = {
        "sources": keep_last(sources, ["slug"], ["_load"]).select(*SOURCE_COLUMNS),
        "posts": lookup_join(old["posts"], ids, ["id"], "left_anti").select(*POST_COLUMNS).unionByName(posts),
    }
    for name, columns in CHILDREN.items():
        rows, kept = getattr(tables, name), old[name]
        if children == "replace":
            rows = winning(rows, "post_id")
            kept = lookup_join(kept, ids.withColumnRenamed("id", "post_id"), ["post_id"], "left_anti")
        new[name] = kept.select(*columns).unionByName(rows.select(*columns))

    def write(name: str) -> None:
        placed = new[name].withColumn("bucket", _bucket("slug" if name == "sources" else "source_slug", parts))
        # Rows of a bucket come together in as few files as their size asks for; a large one is split.
        placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/{name}/version={version}")

    with ThreadPoolExecutor(len(new)) as pool:  # the five jobs share the cluster
        list(pool.map(write, new))

    log = spark.createDataFrame([(version, parts, sorted(touched))], "version bigint, buckets int, touched array<int>")
    log.coalesce(1).write.mode("append").parquet(f"{root}/committed")
    return version

