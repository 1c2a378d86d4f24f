"""Fixed-size filters over 64-bit hashes: built by Spark, small enough to broadcast whatever their input's size.

A filter has ``2**bits`` bits. It never misses a hash that was put in; it may pass others, so what passes must be checked
behind it. It is reduced to 64-bit words by an aggregate before any of it reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26


def build(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """At most ``2**(bits - 6)`` rows reach the driver (8 MB for 26 bits)."""
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = hashes.select(F.shiftright(slot, 6).alias("word"), F.expr("1L").alias("one"), slot.alias("slot"))
    bit = F.expr("shiftleft(one, cast(slot & 63 as int))")
    found = words.groupBy("word").agg(F.bit_or(bit).alias("set")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["word"].to_numpy()] = found["set"].to_numpy().view(np.uint64)
    return out


def may_hold(keys: DataFrame, key: str, column: Column, bits: int = BITS) -> Column:
    """Whether ``column`` may be among the keys; never false for one that is."""
    shared = keys.sparkSession.sparkContext.broadcast(build(keys, key, bits))

    @F.arrow_udf("boolean")
    def held(values: pa.Array) -> pa.Array:
        return pa.array(contains(shared.value, values.to_numpy(zero_copy_only=False).view(np.uint64)))

    return held(column)


def without(df: DataFrame, keys: DataFrame, *key: str) -> DataFrame:
    """Rows of ``df`` whose key columns (64-bit hashes, no nulls) are not in ``keys``.

    Rows that the filter on the first column rules out go on at once; only the others are shuffled to meet the keys.
    """
    held = may_hold(keys, key[0], F.col(key[0]))
    return df.where(~held).unionByName(df.where(held).join(keys.select(*key), [*key], "left_anti"))


def contains(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = 6 + int(len(table)).bit_length() - 1
    slot = hashes >> np.uint64(64 - bits)
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
