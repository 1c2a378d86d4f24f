"""Joins of a large, possibly skewed table with a table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

HOT_SHARE = 0.01
HOT_SAMPLE = 0.001
HOT_MIN_ROWS = 10


def hot_keys(df: DataFrame, key: str, sample: float = HOT_SAMPLE, share: float = HOT_SHARE) -> list:
    """Keys that hold at least ``share`` of a sample of the rows; at most 1 / share keys can.

    Only the key column is read, once: the total comes with the counts, as the row without key. A sample too small to
    tell gives no key.
    """
    counts = df.select(key).where(F.col(key).isNotNull()).sample(sample, seed=7).rollup(key).count()
    top = counts.orderBy(F.desc("count"), F.asc_nulls_first(key)).limit(int(1 / share) + 1).collect()
    total = max((r["count"] for r in top if r[key] is None), default=0)
    return [r[key] for r in top if r[key] is not None and r["count"] >= max(HOT_MIN_ROWS, share * total)]


def lookup_join(
    big: DataFrame, unique: DataFrame, key: str, how: str = "inner", sample: float = HOT_SAMPLE
) -> DataFrame:
    """Join ``big`` with the table ``unique`` that has one row per ``key``.

    Rows of hot keys meet the few ``unique`` rows of these keys by broadcast and are not shuffled; all other rows
    take the join that Spark chooses by size. No row is lost or repeated.
    """
    hot = hot_keys(big, key, sample)
    if not hot:
        return big.join(unique, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    spread = big.where(is_hot).join(F.broadcast(unique.where(F.col(key).isin(hot))), key, how)
    return big.where(~is_hot).join(unique, key, how).unionByName(spread)


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = 256 << 20) -> bool:
    """Whether ``df`` is small enough to be held by every worker, by its rows and the bytes of its strings.

    A plain aggregate combines in every task; counting behind a limit would first move up to ``max_rows`` rows of
    every partition into one.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType == StringType()]
    size = sum(texts, F.lit(0)).cast("long")
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes
