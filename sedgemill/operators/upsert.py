from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedgemill.operators.shuffles import keep_first


def insert_or_ignore(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stored rows win over new ones, earlier new rows (by ``order``, columns of ``new``) over later ones."""
    stored = existing.withColumn("_new", F.lit(0))
    added = new.withColumn("_new", F.lit(1))
    both = stored.unionByName(added, allowMissingColumns=True)
    return keep_first(both, keys, ["_new", *order]).select(*existing.columns)
