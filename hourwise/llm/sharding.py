"""Sharding by jump consistent hashing.

A row's stable key alone fixes its shard: no ring table, no state. Going from
n to n + 1 shards moves about 1 / (n + 1) of the rows, all into the new shard.

Null keys hash the row's text instead (they spread rather than pile up); equal
rows get equal shards and neighbouring slots in no particular order; an empty
table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

#: Rows of one (shard, bucket) that are numbered in one task, about.
ROWS_PER_BUCKET = 20_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key (Lamping and Veach's jump hash), all keys at once:
    every round advances the keys whose next jump still lands below ``shards``."""
    state = np.array(keys, dtype=np.uint64)
    at = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        with np.errstate(over="ignore"):
            s = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        state[live] = s
        jump = ((at[live] + 1) * (float(1 << 31) / ((s >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        inside = jump < shards
        live = live[inside]
        at[live] = jump[inside]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Column expression: the shard of a 64-bit key."""
    @F.pandas_udf("int")
    def jump(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(dtype=np.int64).view(np.uint64), shards))
    return jump(key)


def stable_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a row: its id's hash, or its text's where the id is null."""
    return F.when(F.col(id_col).isNull(), F.xxhash64(F.lit("no id"), text_or_empty(text_col))) \
        .otherwise(F.xxhash64(F.col(id_col)))


def with_slots(df: DataFrame, shard: str, order: str) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... within each shard. A shard is numbered in buckets of
    the key hash (as many as the row count asks for), each shifted by the count of the buckets before it,
    so no task holds a whole shard."""
    shards = max(1, df.select(shard).distinct().count())
    buckets = max(1, -(-df.count() // (shards * ROWS_PER_BUCKET)))
    rows = df.withColumn("__b", F.pmod(F.xxhash64(F.lit("slot"), F.col(order), F.col("text_crc32")), F.lit(buckets)))
    counts = rows.groupBy(F.col(shard).alias("__s"), F.col("__b").alias("__c")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__s").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__s", "__c", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(shard, "__b").orderBy(order, "text_crc32")
    return (rows.withColumn("__r", F.row_number().over(inside) - 1)
            .join(counts, (F.col(shard) == F.col("__s")) & (F.col("__b") == F.col("__c")))
            .withColumn("slot", (F.col("__before") + F.col("__r")).cast("long"))
            .drop("__b", "__s", "__c", "__before", "__r"))


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes + 8), text_crc32, law ('key'), shard,
    slot, grown_shard (the shard with one more shard). A null text has no bytes."""
    key = stable_key(id_col, text_col)
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_or_empty(text_col)) + 8).cast("long").alias("size"),
        F.crc32(text_or_empty(text_col)).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, shards).alias("shard"),
        shard_of(key, shards + 1).alias("grown_shard"))
    return with_slots(base, "shard", "doc_id").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
