"""Row choice, row numbers and joins that hold up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sedgemill.session import written

NULL_SALTS = 256
#: Bytes of rows, as held in memory, that a task should sort or nest.
TASK_BYTES = 64 << 20


def tasks_for(spark: SparkSession, size: int) -> int:
    """Tasks for ``size`` bytes of rows: more with more rows, so that what one holds stays the same; never fewer than Spark is set to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def _order(cols: list[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])


def _pick(df: DataFrame, keys: list[str], order: list[str | Column], choose, columns: list[str] | None = None) -> DataFrame:
    columns = df.columns if columns is None else columns
    rest = [c for c in columns if c not in keys]
    best = choose(F.struct(*rest), _order(order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*columns)


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column], columns: list[str] | None = None) -> DataFrame:
    """The row of each key that is last by ``order``, with ``columns`` of it (all of them by default).

    An aggregate, not a window: copies of a key collapse before the shuffle.
    """
    return _pick(df, keys, order, F.max_by, columns)


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row of each key that is first by ``order``."""
    return _pick(df, keys, order, F.min_by)


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join many rows per key with a lookup that has at most one row per key.

    A plain join: adaptive execution splits the fact rows of a hot key, broadcasts a lookup
    that proves small, and no lookup row is copied. Fact rows whose key is NULL match
    nothing; where such rows are kept, they are spread over ``NULL_SALTS`` shuffle keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how} would repeat unmatched lookup rows")
    if how in ("inner", "left_semi"):
        return facts.join(lookup, keys, how)
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    place = F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS)).cast("int") + 1
    spread = facts.withColumn("_salt", F.when(missing, place).otherwise(0))
    return spread.join(lookup.withColumn("_salt", F.lit(0)), [*keys, "_salt"], how).drop("_salt")


def with_row_index(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """Number all rows from 0 in a total order, without bringing them into one task.

    Rows are range-sorted (left as they come where ``order`` is empty) and written; a row's number is its place in its sorted part
    plus the sizes of the parts before it. Only those sizes (one row per part) meet in
    one task. ``order`` must be free of ties for a repeatable numbering.
    """
    placed = (df.orderBy(*order) if order else df).withColumn("_place", F.monotonically_increasing_id())
    placed = written(placed, "row-index").withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(parts), "_part")
        .withColumn(name, F.col("_start") + inside)
        .drop("_part", "_place", "_start")
    )
