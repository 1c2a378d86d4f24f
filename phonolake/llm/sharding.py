"""Sharding by extendible hashing.

Every row has 60 hash bits of its key. A bucket is a prefix of these bits; it is split on one more bit only while it
holds more bytes than the limit and more than one row, so the directory is deep only where the data is heavy. The
directory is found from a histogram over prefixes, not by inserting rows: bytes shrink from a bucket to its halves, so
the depth of a prefix is the number of full buckets on its path. The histogram is rolled up ten bits at a time, each
step over groups of at most 1024 rows, and bins that are still full at its finest prefix are split again by their own
rows only.

Rows of one key have the same bits. Where a bucket over the limit holds a single hash value, it gets an overflow
directory over hash bits of a row number instead; its shards are named ``prefix + "+" + bits``.

Defined results: a null key hashes like an empty one; null and empty values have size 0; a single row over the limit, a
very long text, is a shard of its own; equal keys share a shard while they fit, and equal rows go to any of their key's
shards; an empty table gives an empty table. All other columns are kept, whatever their names; columns of the names
that are added are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phonolake.llm.columns import ALL, pack, unpack
from phonolake.llm.registry import query, table
from phonolake.session import materialise, scratch_dir

BITS = 60
STEP = 10
SPARE = 4
LIMIT = 128 << 20


def hash_bits(*keys: Column) -> Column:
    """60 bits of the MD5 of the keys; without a key, 60 zero bits."""
    text = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _stats(limit: int):
    sums = [
        F.sum("_b").alias("_b"), F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    ]
    return sums, (F.col("_b") > limit) & (F.col("_n") > 1)


def _depths(nodes: DataFrame, bits: int, limit: int) -> DataFrame:
    """``nodes`` (_group, _p: prefix of ``bits`` bits, sums) with the number of full buckets from root to node."""
    sums, full = _stats(limit)
    if bits == 0:
        return nodes.withColumn("_full", full.cast("int"))
    step = min(STEP, bits)
    parent = F.shiftright("_p", step)
    above = _depths(nodes.groupBy("_group", parent.alias("_p")).agg(*sums), bits - step, limit)
    path = nodes.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(step))))
    path = path.withColumn("_a", F.expr(f"shiftright(_p, {step} - _k)"))
    crowded = path.groupBy("_group", "_k", "_a").agg(*sums).where(full).select("_group", "_k", "_a")
    inside = path.join(crowded, ["_group", "_k", "_a"]).groupBy("_group", "_p").agg(F.count("*").alias("_inside"))
    above = above.select("_group", F.col("_p").alias("_up"), F.col("_full").alias("_above"))
    joined = nodes.join(inside, ["_group", "_p"], "left").withColumn("_up", parent).join(above, ["_group", "_up"])
    full_nodes = F.col("_above") + F.coalesce("_inside", F.lit(0))
    return joined.withColumn("_full", full_nodes.cast("int")).drop("_inside", "_up", "_above")


def _split(rows: DataFrame, have: int, limit: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose bucket is found within ``bits`` more bits, and the rows of buckets that are still full."""
    bin_of = F.shiftright("_h", have - bits)
    ones = [
        F.sum("row_bytes").alias("_b"), F.count("*").alias("_n"), F.min("_h").alias("_lo"), F.max("_h").alias("_hi")
    ]
    bins = materialise(rows.groupBy("_group", bin_of.alias("_p")).agg(*ones))
    directory = _depths(bins, bits, limit).select("_group", "_p", "_full", "_lo", "_hi")
    found = rows.withColumn("_p", bin_of).join(directory, ["_group", "_p"])
    leaves = found.where(F.col("_full") <= bits)
    path = F.lpad(F.bin(F.expr(f"shiftright(_h, {have} - _full)")), F.col("_full"), "0")
    done = leaves.withColumn("shard", F.concat("_group", F.when(F.col("_full") > 0, path).otherwise("")))
    return done, found.where(F.col("_full") > bits)


def add_shards(df: DataFrame, keys: list[str], limit: int = LIMIT, size: Column | None = None) -> DataFrame:
    """``df`` with row_bytes, shard (hash-prefix bits) and shard_depth, so that no shard is over ``limit`` bytes.

    ``size`` gives a row's bytes; by default the bytes of its string and binary columns.
    """
    texts = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    if size is None:
        size = reduce(lambda a, b: a + b, [F.coalesce(t, F.lit(0)) for t in texts], F.lit(0))
    own = {"_h": hash_bits(*[F.col(f"`{k}`") for k in keys]), "row_bytes": F.coalesce(size, F.lit(0)).cast("long")}
    rows = pack(df, **own, _group=F.lit(""))
    total = rows.agg(F.sum("row_bytes")).first()[0] or 0
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, total) / limit))) + SPARE)
    parts, have = [], BITS
    plain = [ALL, "row_bytes", "_h", "_group"]
    while True:
        done, rest = _split(rows, have, limit, bits)
        parts.append(done.select(ALL, "row_bytes", "shard"))
        rest = materialise(rest)
        if rest.isEmpty():
            break
        prefix = F.concat("_group", F.lpad(F.bin("_p"), bits, "0"))
        alike = F.col("_lo") == F.col("_hi")
        left = have - bits
        numbered = hash_bits(F.monotonically_increasing_id())
        deeper = rest.where(~alike).withColumns(
            {"_group": prefix, "_h": F.shiftleft(F.col("_h").bitwiseAND((1 << left) - 1), BITS - left)}
        )
        copies = rest.where(alike).withColumns({"_group": F.concat(prefix, F.lit("+")), "_h": numbered})
        rows = materialise(deeper.select(*plain).unionByName(copies.select(*plain)))
        have, bits = BITS, STEP
    out = reduce(DataFrame.unionByName, parts)
    depth = F.length(F.regexp_replace("shard", r"\+", ""))
    return unpack(out, df.columns, row_bytes=F.col("row_bytes"), shard=F.col("shard"), shard_depth=depth)


def directory(sharded: DataFrame) -> DataFrame:
    """One row per shard: shard, shard_depth, rows, bytes."""
    return sharded.groupBy("shard", "shard_depth").agg(
        F.count("*").alias("shard_rows"), F.sum("row_bytes").alias("shard_bytes")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, written by the task that received the whole shard."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of ``write_shards`` with their shards, which folder names tell; ``schema`` is that of the rows with ``shard``."""
    rows = spark.read.schema(schema).parquet(path)
    return rows.withColumn("shard", F.coalesce("shard", F.lit("")))


OP1_SQL = f"""
with d as (
  select doc_id, coalesce(strlen(text), 0) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0) row_bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint h
  from documents),
full_buckets as (
  select k, h >> (60 - k) p from d, range(0, 45) t(k)
  group by all having sum(row_bytes) > {LIMIT} and count(*) > 1),
deep as (
  select doc_id, row_bytes, h, (select count(*) from full_buckets f where f.p = (d.h >> (60 - f.k))) depth from d)
select doc_id, row_bytes::bigint row_bytes, depth::int shard_depth,
       case when depth = 0 then '' else lpad(bin(h >> (60 - depth)), depth::int, '0') end shard
from deep
"""


@query("op1_extendible_shards", OP1_SQL)
def op1_extendible_shards(spark, sf_dir):
    """Whole documents written as shards of at most ``LIMIT`` bytes, and each document's shard as read back."""
    sharded = add_shards(table(spark, sf_dir, "documents"), ["doc_id"])
    path = scratch_dir(spark)
    write_shards(sharded, path)
    return read_shards(spark, path, sharded.schema).select("doc_id", "row_bytes", "shard_depth", "shard")
