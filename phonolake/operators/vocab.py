"""Vocabulary tables, token lookups and vectors of new tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from phonolake.functions import tokens as T
from phonolake.operators.joins import fits_broadcast, lookup_join
from phonolake.operators.ordered import index_rows, with_row_index
from phonolake.session import bound_batches, materialise

MAX_BROADCAST_TOKENS = 1_000_000
#: Entries after which rows are numbered anew in a lookup by join.
CHUNK = 1 << 21
UNKNOWN_ID = -1
UNKNOWN_TOKEN = "\ufffd"


def build_vocab(tokens: DataFrame, col: str = "token") -> DataFrame:
    """Distinct tokens with contiguous ids in token order."""
    distinct = tokens.select(F.col(col).alias("token")).where(F.col(col).isNotNull()).distinct()
    indexed = with_row_index(distinct, ["token"], "id")
    return indexed.select("token", F.col("id").cast("int").alias("id"))


def _lookup(
    df: DataFrame, table: DataFrame, id_col: str, arr: str, out: str, unknown, keep: list[str], most: int
) -> DataFrame:
    """Replace each entry of ``arr`` by its value in ``table`` (_entry, _value), order kept; gives (id, keep, out).

    Entries that the table lacks, null ones too, become ``unknown``; an entry that it has twice has the smaller value;
    a null array becomes empty. Every row stays a row, whatever its id. Tables of up to ``most`` rows are looked
    up in place, larger ones by a join, with the same result.
    """
    bound_batches(df.sparkSession)
    table = table.where(F.col("_entry").isNotNull())
    small = fits_broadcast(table, most)
    table = table.groupBy("_entry").agg(F.min("_value").alias("_value"))
    if small:
        return df.select(id_col, *keep, _lookup_udf(table, unknown)(arr).alias(out))
    return _lookup_by_join(df, table, id_col, arr, out, unknown, keep)


def _lookup_udf(table: DataFrame, unknown):
    """Lookup of whole Arrow batches against a table of checked size that every Python worker holds.

    Nothing is shuffled and no row is taken apart. The hash table is built once per task, and only the distinct entries
    of a batch are looked up in it.
    """
    spark, kind = table.sparkSession, table.schema["_value"].dataType
    local = table.toArrow()
    shared = spark.sparkContext.broadcast((local["_entry"].combine_chunks(), local["_value"].combine_chunks()))

    @F.arrow_udf(ArrayType(kind))
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        entries, values = shared.value
        known = dict(zip(entries.to_pylist(), values.to_pylist(), strict=True))
        for rows in batches:
            distinct = rows.flatten().dictionary_encode()
            found = pa.array([known.get(x, unknown) for x in distinct.dictionary.to_pylist()], values.type)
            flat = found.take(distinct.indices).fill_null(unknown)
            yield pa.ListArray.from_arrays(_ends(rows), flat)

    return lookup


def _lookup_by_join(
    df: DataFrame, table: DataFrame, id_col: str, arr: str, out: str, unknown, keep: list[str]
) -> DataFrame:
    """Lookup in a table of any size: chunks of rows send each entry that they hold to the join once.

    A row keeps the places of its entries among the distinct ones of its chunk, so the join moves distinct entries, a
    frequent one once a chunk, and the values found meet their rows by chunk. A chunk ends behind the batch that
    brings it to ``CHUNK`` entries, which bounds what a task holds.
    """
    whole = df.select(id_col, *keep, arr)
    fields, kind = whole.schema.fields[:-1], whole.schema[arr].dataType.elementType
    ints = ArrayType(IntegerType())
    numbered = StructType([*fields, StructField("_at", ints), StructField("_chunk", LongType()),
                           StructField("_before", IntegerType()), StructField("_new", ArrayType(kind))])
    rows = materialise(whole.mapInArrow(_numbered(to_arrow_type(kind), CHUNK), numbered))
    new = rows.select(F.col("_chunk").alias("_of"), "_before", F.posexplode("_new").alias("_pos", "_entry"))
    entries = new.select("_of", (F.col("_before") + F.col("_pos")).alias("_place"), "_entry")
    found = entries.join(table, "_entry").select("_of", "_place", "_value")
    narrow = rows.select(id_col, *keep, "_at", "_chunk")
    values = StructType([*fields, StructField(out, ArrayType(table.schema["_value"].dataType))])
    return narrow.groupBy("_chunk").cogroup(found.groupBy("_of")).applyInArrow(_answered(out, unknown), values)


def _numbered(kind: pa.DataType, most: int):
    """Rows with the places of their entries among the distinct ones of the chunk; new entries go with a batch's first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, known = TaskContext.get().partitionId() << 32, 0, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(batch.num_columns - 1)
            distinct = rows.flatten().dictionary_encode()
            before, size = len(known), batch.num_rows
            names = distinct.dictionary.to_pylist()
            places = pa.array([known.setdefault(x, len(known)) for x in names], pa.int32())
            new = distinct.dictionary.filter(pa.array(np.asarray(places) >= before, pa.bool_())).cast(kind)
            first = pa.array(np.minimum(np.arange(size + 1), 1) * len(new), pa.int32())
            columns = [
                *batch.columns[:-1],
                pa.ListArray.from_arrays(_ends(rows), places.take(distinct.indices)),
                pa.array(np.full(size, chunk)),
                pa.array(np.full(size, before, np.int32)),
                pa.ListArray.from_arrays(first, new),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "_at", "_chunk", "_before", "_new"])
            held += len(distinct)
            if held >= most:
                chunk, held, known = chunk + 1, 0, {}

    return run


def _answered(out: str, unknown):
    """Rows of a chunk with the values that were found for its entries."""

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows, found = rows.combine_chunks(), found.combine_chunks()
        at = rows["_at"].combine_chunks()
        flat = at.flatten()
        places = found["_place"].to_numpy()
        where = np.full(max(pc.max(flat).as_py() or 0, places.max(initial=0)) + 1, -1)
        where[places] = np.arange(len(places))
        picked = where[flat.fill_null(0).to_numpy(zero_copy_only=False)]
        lost = (picked < 0) | flat.is_null().to_numpy(zero_copy_only=False)
        values = found["_value"].combine_chunks().take(pa.array(picked, mask=lost)).fill_null(unknown)
        return rows.drop_columns(["_at", "_chunk"]).append_column(out, pa.ListArray.from_arrays(_ends(at), values))

    return run


def _ends(rows: pa.Array) -> pa.Array:
    """Offsets of lists in their flattened entries; a null list is empty."""
    sizes = pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def vocab_encode(
    df: DataFrame,
    vocab: DataFrame,
    id_col: str,
    arr: str,
    out: str = "ids",
    unknown: int = UNKNOWN_ID,
    keep: list[str] | None = None,
    most: int = MAX_BROADCAST_TOKENS,
) -> DataFrame:
    """Ids of the tokens of each row; unknown tokens get ``unknown``."""
    table = vocab.select(F.col("token").alias("_entry"), F.col("id").alias("_value"))
    return _lookup(df, table, id_col, arr, out, unknown, keep or [], most)


def vocab_decode(
    df: DataFrame,
    vocab: DataFrame,
    id_col: str,
    arr: str,
    out: str = "tokens",
    unknown: str = UNKNOWN_TOKEN,
    keep: list[str] | None = None,
    most: int = MAX_BROADCAST_TOKENS,
) -> DataFrame:
    """Tokens of the ids of each row; unknown ids get ``unknown``."""
    table = vocab.select(F.col("id").alias("_entry"), F.col("token").alias("_value"))
    return _lookup(df, table, id_col, arr, out, unknown, keep or [], most)


def extend_vocab(vocab: DataFrame, new_tokens: DataFrame, order: str = "ord") -> DataFrame:
    """Vocabulary with the new tokens appended in order; ``status`` tells base, added and skipped tokens apart.

    A new token that is in the vocabulary keeps its id and is reported as skipped, a repeated one counts once.
    """
    vocab = materialise(vocab.select("token", "id"))
    wanted = new_tokens.groupBy("token").agg(F.min(order).alias("ord"))
    known = wanted.join(vocab, "token").select("token", "id", F.lit("skipped").alias("status"))
    fresh, _ = index_rows(wanted.join(vocab, "token", "left_anti"), ["ord", "token"], "_k")
    first_free = vocab.agg(F.coalesce(F.max("id"), F.lit(-1)) + 1).scalar()
    added = fresh.select("token", (first_free + F.col("_k")).cast("int").alias("id"), F.lit("added").alias("status"))
    base = vocab.join(known.select("token"), "token", "left_anti").withColumn("status", F.lit("base"))
    return base.unionByName(known).unionByName(added)


def custom_tokens(spark: SparkSession, count: int = T.CUSTOM_TOKEN_COUNT) -> DataFrame:
    """The custom tokens that a base vocabulary is extended with, in order."""
    name = F.concat(F.lit("<custom_token_"), F.col("id").cast("string"), F.lit(">"))
    return spark.range(count).select(name.alias("token"), F.col("id").alias("ord"))


def mean_embedding(members: DataFrame, table: DataFrame) -> DataFrame:
    """Mean vector per new token over its member ids; a token without member gets the mean of the whole table.

    ``members`` has (token, id) with a null id for a token without members, ``table`` has (id, embedding), vectors of one
    length. A vector is added up as a whole, and sums are combined before the shuffle, so a token with very many members
    is no bottleneck and no row is taken apart. Null vectors do not count.
    """
    vector = F.col("embedding").cast("array<double>")
    vectors = table.where(F.col("embedding").isNotNull()).select("id", array_to_vector(vector).alias("v"))
    linked = lookup_join(members.where(F.col("id").isNotNull()), vectors, "id")
    own = linked.groupBy("token").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("embedding"))
    # One vector of the table's width.
    overall = vectors.agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("embedding")).where(F.size("embedding") > 0)
    tokens = members.select("token").distinct().join(own, "token", "left")
    return tokens.select("token", F.coalesce(F.col("embedding"), overall.scalar()).alias("embedding"))
