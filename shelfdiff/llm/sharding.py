"""Sharding by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfdiff.llm.parts import running_total

#: The multiplier of the generator and the seed of the key hash.
JUMP_MULTIPLIER = 2862933555777941757
KEY_SEED = 7


def jump_buckets(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key.

    A key jumps ahead from shard to shard; its jumps do not depend on the number of shards, the last one inside
    counts. With one shard more a key either keeps its shard or jumps into the new one.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    state = keys.astype(np.uint64)
    landed = np.zeros(len(state), np.int64)
    jump = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(active):
            landed[active] = jump[active]
            state[active] = state[active] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
            step = 2.0 ** 31 / ((state[active] >> np.uint64(33)).astype(np.float64) + 1.0)
            jump[active] = np.floor((landed[active] + 1) * step).astype(np.int64)
            active = active[jump[active] < shards]
    return landed.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key column; a null key goes where key 0 goes, and other keys do not notice it."""
    @F.pandas_udf("int")
    def shard(values: pd.Series) -> pd.Series:
        return pd.Series(jump_buckets(values.to_numpy(np.int64).view(np.uint64), shards))
    # nulls are filled before pandas sees them: there they would turn all keys of a batch into floating numbers
    return shard(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")))


def stable_key(*columns: str) -> Column:
    """A 64-bit key that depends on the values alone. Rows with equal values, nulls included, get equal keys."""
    return F.xxhash64(*[F.col(c) for c in columns], F.lit(KEY_SEED))


def assign_shards(df: DataFrame, key: list[str], shards: int) -> DataFrame:
    """``df`` with ``shard``, ``slot`` and ``grown_shard``; columns of these names are replaced.

    ``shard`` depends on the key columns and ``shards`` only, ``grown_shard`` is the shard with one shard more.
    ``slot`` numbers the rows of a shard from 0 without gaps, by ranges of a hash of the row, so a shard is never
    numbered by one task. Rows with equal keys go to one shard and get slots of their own; nulls are values like
    others; an empty table stays empty. Other columns are carried whole, whatever their names. Pass narrow rows:
    ``df`` is shuffled once.
    """
    df = df.drop("shard", "slot", "grown_shard")
    columns = df.columns
    hashed = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), stable_key(*key).alias("key"),
                      F.xxhash64(stable_key(*key), *hashed).alias("spread"))
    placed = keyed.select("row", "spread", jump_shard(F.col("key"), shards).alias("shard"),
                          jump_shard(F.col("key"), shards + 1).alias("grown_shard"))
    slots = running_total(placed, ["shard"], "spread", before="slot", total="total")
    return slots.select(*[F.col("row").getField(c).alias(c) for c in columns], "shard", "slot", "grown_shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder a shard; rows of a shard are spread over files by the rebalance hint."""
    (placed.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path))
