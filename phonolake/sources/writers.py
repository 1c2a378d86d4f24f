"""Writers of training shards, typed sets, statistics and pointers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import tokens as T
from phonolake.functions.schema import struct
from phonolake.operators.corpus import require_columns
from phonolake.operators.ordered import index_rows

# Every input row of format B has these columns and types.
FORMAT_B = struct(
    input_ids="array<int>",
    labels="array<int>",
    attention_mask="array<tinyint>",
    speaker_id="string",
    text="string",
    duration_s="float",
    audio_token_count="int",
    sequence_length="int",
)


def write_shards(
    df: DataFrame,
    path: str,
    order: list,
    rows_per_shard: int = T.ROWS_PER_SHARD,
    mode: str = "errorifexists",
    key: list[str] | None = None,
    shards_per_task: int = T.SHARDS_PER_TASK,
) -> int:
    """Write shards of exactly ``rows_per_shard`` consecutive rows each, the last may be short, as files of ``path/parquet``.

    Returns the number of shards. The index of a row gives its task directly, ``shards_per_task`` shards after the other
    to each, so a task writes its sorted rows as one zstd file after the other and needs no folder per shard. A file's
    name holds the task's and the file's number, and with them the shard's, see ``readers.read_shards``. ``key`` names
    columns that identify a row, see ``index_rows``.
    """
    indexed, total = index_rows(df, order, "_row", key)
    return write_indexed(indexed, total, path, rows_per_shard, mode, shards_per_task)


def write_indexed(
    indexed: DataFrame,
    total: int,
    path: str,
    rows_per_shard: int = T.ROWS_PER_SHARD,
    mode: str = "errorifexists",
    shards_per_task: int = T.SHARDS_PER_TASK,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """``write_shards`` of ``total`` rows whose index ``_row`` is known.

    ``finish`` works row by row on rows that are in place, so what it derives is not moved.
    """
    shards = -(-total // rows_per_shard)
    tasks = max(1, -(-shards // shards_per_task))
    task = F.expr(f"cast(_row div {rows_per_shard * shards_per_task} as int)")
    placed = finish(indexed.repartitionById(tasks, task).sortWithinPartitions("_row").drop("_row"))
    writer = placed.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows_per_shard)
    writer.parquet(f"{path}/parquet")
    return shards


def write_rows(df: DataFrame, path: str, max_rows_per_file: int = T.ROWS_PER_SHARD, mode: str = "errorifexists") -> None:
    """Files of at most ``max_rows_per_file`` rows without any shuffle, for when the row-to-file map is free."""
    writer = df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(f"{path}/parquet")


def to_format_b(df: DataFrame) -> DataFrame:
    """Cast to the fixed column types of format B."""
    require_columns(df, FORMAT_B.names)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FORMAT_B])


def write_typed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write format B with its fixed column types; ``mode="ignore"`` keeps an existing set, ``"overwrite"`` forces."""
    to_format_b(df).write.mode(mode).option("compression", "zstd").parquet(path)


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Statistics as JSON lines, one per row of the table."""
    stats.write.mode(mode).json(path)


def write_pointer(spark, path: str, num_shards: int, mode: str = "overwrite") -> None:
    """Where the shards are and how many."""
    row = [("parquet", f"{path}/parquet", num_shards)]
    write_stats(spark.createDataFrame(row, "format string, data_dir string, num_shards long"), f"{path}/pointer", mode)
