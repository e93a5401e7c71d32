"""Assign documents to shards by jump consistent hashing.

The shard of a key is computed from the key and the number of shards alone: no ring,
no table. With one shard more, a key either stays or moves to the new shard, and
the expected share of keys that move is one over the new number.

Rows are numbered in their shard without gathering a shard anywhere: they fall into
bins by another hash of the key, one row per (shard, bin) tells how many rows come before,
and a task numbers the rows of one bin.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from addrspark.llm.tables import table, utf8_bytes

LAW = "key"
SHARDS = 16
#: Bins of a shard for numbering; a bound on the table of offsets, which has shards * bins rows at most.
BINS = 1 << 10


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key, by the published algorithm of Lamping and Veach, on all keys at once."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    key = keys.astype(np.uint64).copy()
    at = np.zeros(len(key), np.int64)
    left = np.arange(len(key))
    while len(left):
        k = key[left] * np.uint64(2862933555777941757) + np.uint64(1)
        key[left] = k
        step = float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1.0)
        jump = np.floor((at[left] + 1) * step)
        inside = jump < shards
        left = left[inside]
        at[left] = jump[inside].astype(np.int64)
    return at


def shard_of(key: Column, shards: int) -> Column:
    """The shard of each value of a long column; null is a key like any other."""

    @pandas_udf("int")
    def jump(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jump(F.xxhash64(F.lit("shard"), key))


def sharded(docs: DataFrame, shards: int = SHARDS, *, key: str = "doc_id", bins: int = BINS, grow_to: int | None = None) -> DataFrame:
    """Every row's key, size, checksum, shard and slot; ``grown_shard`` is its shard with ``grow_to`` shards.

    ``size`` is the bytes of the text plus 1. Slots of a shard run from 0 without a
    gap. Defined cases: a null text has no bytes and the checksum of none, 0; rows with
    the same key are in the same shard with different slots, in order of checksum and
    size, equal rows in any order; a null key is a key like any other; more shards than
    rows leave shards empty; an empty table gives an empty result. Columns other than
    the key and ``text`` are not read, so their names cannot clash.
    """
    rows = docs.select(
        F.col(key).alias("_key"), (utf8_bytes() + 1).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    rows = rows.withColumn("shard", shard_of(F.col("_key"), shards))
    rows = rows.withColumn("grown_shard", shard_of(F.col("_key"), grow_to or shards + 1))
    rows = rows.withColumn("_bin", F.pmod(F.xxhash64(F.lit("slot"), "_key"), F.lit(bins)).cast("int"))
    in_bin = rows.groupBy("shard", "_bin").agg(F.count("*").alias("_rows"))
    up_to = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_bin.select(
        F.col("shard").alias("_shard"), F.col("_bin").alias("_of_bin"), F.coalesce(F.sum("_rows").over(up_to), F.lit(0)).alias("_before"))
    in_order = Window.partitionBy("shard", "_bin").orderBy("_key", "text_crc32", "size")
    rows = rows.withColumn("_in_bin", F.row_number().over(in_order) - 1)
    rows = rows.join(offsets, (F.col("shard") == F.col("_shard")) & (F.col("_bin") == F.col("_of_bin")))
    return rows.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("_before") + F.col("_in_bin")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, *, key: str = "doc_id", files_per_shard: int = 1) -> None:
    """Write the rows of ``docs`` as parquet, a folder for each shard, ``files_per_shard`` files in each."""
    placed = docs.withColumn("shard", shard_of(F.col(key), shards))
    spread = F.pmod(F.xxhash64(F.lit("file"), key), F.lit(files_per_shard))
    placed.repartition(shards * files_per_shard, "shard", spread).write.partitionBy("shard").parquet(path)


def op5(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15, and where one more shard would put them."""
    return sharded(table(spark, sf_dir, "documents"))
