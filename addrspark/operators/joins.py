"""Joins of many rows to one row per key, where one key may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_CHECK = "_key_hash"


def join_splitting(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` so that adaptive execution can split the hot keys of ``many``.

    It splits a join only where both sides come straight from a shuffle. A side
    that was grouped by ``key`` before would be joined in place, and a hot key of
    the other side would stay in one task. Joining on the key and its hash makes
    Spark shuffle both sides for the join. Nothing may follow that relies on the
    partitioning by ``key``. The hash comes first, so that the rows are sorted by a
    number and texts are compared only within it. The result is that of the plain join.
    """
    many, one = many.withColumn(_CHECK, F.xxhash64(key)), one.withColumn(_CHECK, F.xxhash64(key))
    return many.join(one, [_CHECK, key], how).drop(_CHECK)
