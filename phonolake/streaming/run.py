"""Run a streaming query to the end of its input and read its result as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.session import scratch_dir


def run_to_table(stream: DataFrame) -> DataFrame:
    """Append-mode result of ``stream`` over all input that is there now."""
    spark = stream.sparkSession
    out = scratch_dir(spark)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def run_updates_to_table(stream: DataFrame, key: str) -> DataFrame:
    """Update-mode result of ``stream``: the last row of each key.

    Every micro-batch is written below its own number, so a repeated batch replaces itself.
    """
    spark = stream.sparkSession
    out = scratch_dir(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{out}/checkpoint")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    rest = [c for c in stream.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch_id").alias("last"))
    return last.select(key, "last.*")
