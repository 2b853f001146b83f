"""Sharding by jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayspark.llm.common import others


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of every 64-bit key; growing ``n_shards`` by one moves keys only into the new shard."""
    key = keys.astype(np.uint64)
    b = np.zeros(len(key), dtype=np.int64)
    j = np.zeros(len(key), dtype=np.int64)
    live = np.ones(len(key), dtype=bool)
    while live.any():
        b[live] = j[live]
        # Fixed value: the multiplier of the published generator.
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        j[live] = np.floor((b[live] + 1) * step).astype(np.int64)
        live &= j < n_shards
    return b


def shard_of(key: Column, n_shards: int) -> Column:
    """Shard number (INT) of a 64-bit key column, evaluated in Arrow batches."""

    @F.pandas_udf("int")
    def jump(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(dtype=np.int64).view(np.uint64), n_shards).astype(np.int32))

    return jump(key)


def assign_shards(df: DataFrame, keys: Sequence[str], n_shards: int, name: str = "shard") -> DataFrame:
    """Add the shard of every row, a function of its ``keys`` and ``n_shards`` alone (no shuffle).

    NULL keys hash like any other value, so rows whose keys are NULL share one
    shard.  Repeated rows get the same shard.  An input column called ``name``
    is replaced.  An empty table gives an empty table.
    """
    return df.select(*others(df, [name]), shard_of(F.xxhash64(*[F.col(k) for k in keys]), n_shards).alias(name))


def shard_slots(df: DataFrame, key: str, shard: str, order: Sequence[str], name: str = "slot", n_slices: int = 1024) -> DataFrame:
    """Gapless slot numbers from 0 inside every shard, without one task per shard.

    A hash of the key cuts each shard into ``n_slices`` slices.  Rows are
    numbered inside (shard, slice), and the counts of the earlier slices are
    added from a table of at most shards x ``n_slices`` rows.  ``order`` breaks
    ties of the key; rows equal in key and ``order`` are interchangeable.
    """
    row = F.struct("*")
    cut = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(n_slices)).cast("int")
    d = df.select(row.alias("row"), F.col(shard).alias("sh"), cut.alias("sl"), F.xxhash64(F.col(key)).alias("h"))
    counts = d.groupBy("sh", "sl").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("sh").orderBy("sl").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("sh").alias("osh"), F.col("sl").alias("osl"), F.coalesce(before, F.lit(0)).alias("start"))
    w = Window.partitionBy("sh", "sl").orderBy("h", *[F.col(f"row.`{c}`") for c in [key, *order]])
    numbered = d.withColumn("i", F.row_number().over(w))
    joined = numbered.join(starts, (F.col("sh") == F.col("osh")) & (F.col("sl") == F.col("osl")))
    cols = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c.lower() != name.lower()]
    return joined.select(*cols, (F.col("start") + F.col("i") - 1).alias(name))


def shard_table(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Shard, slot and next-size shard of every document, under the ``key`` law.

    ``size`` is the UTF-8 length of the text plus 1 (NULL text: 1) and
    ``text_crc32`` the unsigned CRC of its bytes (NULL text: 0, the CRC of
    nothing).  A NULL doc_id is a key like any other; repeated rows share a
    shard and take neighbouring slots.  Only doc_id and text are read.
    """
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    placed = assign_shards(assign_shards(narrow, ["doc_id"], n_shards), ["doc_id"], n_shards + 1, "grown_shard")
    placed = placed.withColumn("law", F.lit("key"))
    slotted = shard_slots(placed, "doc_id", "shard", ["text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
