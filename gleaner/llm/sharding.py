"""Jump consistent hashing: a shard for every row from its key and the shard count alone."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import running_total, unit
from gleaner.session import materialised

#: Fixed multiplier of the linear congruential step of the published method.
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key; a key takes about ln(shards) steps."""
    key = keys.astype(np.uint64)
    at = np.zeros(len(key), np.int64)
    upto = np.zeros(len(key), np.int64)
    open_ = np.arange(len(key)) if shards > 0 else np.arange(0)
    while len(open_):
        at[open_] = upto[open_]
        key[open_] = key[open_] * STEP + np.uint64(1)
        leap = float(1 << 31) / ((key[open_] >> np.uint64(33)).astype(np.float64) + 1.0)
        upto[open_] = ((at[open_] + 1) * leap).astype(np.int64)
        open_ = open_[upto[open_] < shards]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a key of any type. With one shard more, a key stays or goes to the new shard.

    A null key hashes like any other value, so all of them share one shard.
    """
    if shards < 1:
        raise ValueError("shards must be positive")

    @F.pandas_udf("int")
    def placed(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return placed(F.xxhash64(key))


def sharded(docs: DataFrame, shards: int = 40, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is 16 plus the UTF-8 bytes of the text, where null counts as empty
    (crc32 0). ``slot`` numbers the rows of a shard from 0 without gaps, in the
    order of a hash of the key; rows that are the same in every returned column
    may swap slots. ``grown_shard`` is the shard under one shard more. Only
    ``key`` and ``text`` are read, and an empty table gives an empty table.
    """
    body = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    placed = materialised(
        docs.select(
            F.col(key),
            (F.octet_length(body) + 16).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            shard_of(F.col(key), shards).alias("shard"),
            shard_of(F.col(key), shards + 1).alias("grown_shard"),
        ),
        "shards",
    )
    lined = placed.withColumn("_line", unit(F.col(key), seed=1)).withColumn("_one", F.lit(1))
    slotted = running_total(lined, "shard", "_line", "_one", "slot", [key, "text_crc32", "size"], few_keys=shards <= 1 << 16)
    return slotted.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
