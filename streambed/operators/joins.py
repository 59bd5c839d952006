"""Outer joins that stay balanced when one key holds a large part of the rows.

A full outer join, or a left join whose right side has a hot key, sends the hot key to one
task: Spark may not split the preserved-null side. Both are written here as a join that
Spark's skew handling can split, plus an anti join against the (pre-aggregated) distinct keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_fan_out(one: DataFrame, many: DataFrame, one_key: str, many_key: str) -> DataFrame:
    """``one LEFT JOIN many`` for a unique ``one_key`` and a ``many_key`` that may be hot."""
    matched = one.join(many, F.col(one_key) == F.col(many_key), "inner")
    keys = many.select(F.col(many_key).alias("_key")).distinct()
    unmatched = one.join(keys, F.col(one_key) == F.col("_key"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def full_join_fan_out(one: DataFrame, many: DataFrame, one_key: str, many_key: str) -> DataFrame:
    """``one FULL OUTER JOIN many`` for a unique ``one_key`` and a ``many_key`` that may be hot."""
    from_many = many.join(one, F.col(many_key) == F.col(one_key), "left")
    keys = many.select(F.col(many_key).alias("_key")).distinct()
    only_one = one.join(keys, F.col(one_key) == F.col("_key"), "left_anti")
    return from_many.unionByName(only_one, allowMissingColumns=True)
