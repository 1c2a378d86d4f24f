"""Order-dependent operators that never sort a whole key, or the whole table, in one task.

Spark evaluates a window with one task per partition key. A key that holds a third of the rows, or a window without
a key, would therefore run in one task. The operators here cut the order into blocks, work inside a block, and carry
one small row per block to the blocks behind it: with blocks of 65,536 positions one task handles at most
n / 65,536 carried rows of a key (``levels=2`` blocks these again).

``pos`` must be a non-negative whole number that is unique inside its key. The input is read twice, once for the
carried rows with only the columns they need; materialise an input that is costly to compute.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phonolake.functions.codes import idiv
from phonolake.operators.joins import lookup_join
from phonolake.session import materialise

BLOCK = 65_536
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def index_rows(
    df: DataFrame, order: list, out: str = "row_idx", key: list[str] | None = None
) -> tuple[DataFrame, int]:
    """Contiguous 0-based index in a total order, and the number of rows.

    The rows are range-partitioned and written once, because a repeated run may choose other range bounds. With
    ``key``, columns that identify a row, only these and the order columns take that way and the index is joined
    back, so wide rows are neither sorted nor written. What reaches the driver and is broadcast is one count per
    written partition.
    """
    spark = df.sparkSession
    narrow = df if key is None else df.select(*dict.fromkeys([*order, *key]))
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ordered.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _LOCAL_BITS)
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["count"]
    starts = spark.createDataFrame(offsets, "_part long, _start long")
    indexed = (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_place").bitwiseAND((1 << _LOCAL_BITS) - 1))
        .drop("_part", "_start", "_place")
    )
    if key is not None and set(narrow.columns) != set(df.columns):
        indexed = join_on(df, indexed.select(*key, out), key)
    return indexed, total


def with_row_index(df: DataFrame, order: list, out: str = "row_idx", key: list[str] | None = None) -> DataFrame:
    return index_rows(df, order, out, key)[0]


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys match; the key columns of ``right`` are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _rows_before(keys: list[str], pos: str):
    return Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)


def running_sums(
    df: DataFrame, keys: list[str], pos: str, values: dict[str, Column], width: int = BLOCK, levels: int = 1
) -> DataFrame:
    """For each named value its sum over the rows of the key that come before, 0 for the first row."""
    if levels == 0:
        before = _rows_before(keys, pos)
        return df.withColumns({out: F.coalesce(F.sum(v).over(before), F.lit(0)) for out, v in values.items()})
    block = f"_block{levels}"
    carry = {out: f"_{out}_carry{levels}" for out in values}
    df = df.withColumn(block, idiv(F.col(pos), width))
    sums = df.groupBy(*keys, block).agg(*[F.sum(v).alias(f"_{out}_sum") for out, v in values.items()])
    parts = {carry[out]: F.col(f"_{out}_sum") for out in values}
    carried = running_sums(sums, keys, block, parts, width, levels - 1).select(*keys, block, *carry.values())
    before = _rows_before([*keys, block], pos)
    inside = df.withColumns({out: F.coalesce(F.sum(v).over(before), F.lit(0)) for out, v in values.items()})
    joined = join_on(inside, carried, [*keys, block])
    return joined.withColumns({out: F.col(out) + F.col(c) for out, c in carry.items()}).drop(block, *carry.values())


def running_sum(
    df: DataFrame, keys: list[str], pos: str, value: Column, out: str, width: int = BLOCK, levels: int = 1
) -> DataFrame:
    return running_sums(df, keys, pos, {out: value}, width, levels)


def number_rows(df: DataFrame, keys: list[str], pos: str, out: str, width: int = BLOCK) -> DataFrame:
    """0-based rank of the row inside its key."""
    return running_sum(df, keys, pos, F.lit(1).cast("long"), out, width)


def carry_forward(
    df: DataFrame,
    keys: list[str],
    pos: str,
    cols: list[str],
    include_self: bool = True,
    width: int = BLOCK,
    levels: int = 1,
) -> DataFrame:
    """Replace each column by its last non-null value up to the row, or before it (``include_self=False``)."""
    frame = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0 if include_self else -1)
    if levels == 0:
        return df.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in cols})
    block = f"_block{levels}"
    df = df.withColumn(block, idiv(F.col(pos), width))
    carried_names = {c: f"_{c}_carry{levels}" for c in cols}
    # max_by skips rows whose ordering value is null, so the last non-null value of the block wins.
    lasts = df.groupBy(*keys, block).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(pos))).alias(n) for c, n in carried_names.items()]
    )
    carried = carry_forward(lasts, keys, block, list(carried_names.values()), False, width, levels - 1)
    inside = Window.partitionBy(*keys, block).orderBy(pos)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0 if include_self else -1)
    local = df.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols})
    joined = join_on(local, carried, [*keys, block])
    return joined.withColumns({c: F.coalesce(c, n) for c, n in carried_names.items()}).drop(
        block, *carried_names.values()
    )


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row per key in ``order``: a combining aggregate, so a hot key is reduced before the shuffle.

    Rows without order value come last; of rows with equal ones the smallest by the other columns is taken.
    """
    rest = [c for c in df.columns if c != key]
    place = F.struct(F.col(order).isNull().alias("_lacks"), F.col(order).alias("_order"), *[F.col(c) for c in rest if c != order])
    best = df.groupBy(key).agg(F.min(place).alias("_first"))
    return best.select(key, "_first.*").withColumnRenamed("_order", order).select(*df.columns)


def first_wide_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """``first_per_key`` for wide rows; rows without key are left out.

    A minimum of texts is found by sorting whole rows, in the tasks that read them and again behind the shuffle. Here the
    order alone is reduced first, and rows are sorted once, behind the shuffle, in partitions that Spark sizes. Of a hot
    key the rows that are not first go before the shuffle.
    """
    df = df.where(F.col(key).isNotNull())
    best = df.groupBy(key).agg(F.min(order).alias("_best")).hint("merge")
    # Not as an equality, by which Spark would deal out rows too: the partitions by key serve the join and what follows.
    first = F.coalesce(F.col(order) <= F.col("_best"), F.col("_best").isNull())
    rows = lookup_join(df, best, key).where(first)
    return first_per_key(rows.drop("_best"), key, order).select(*df.columns)
