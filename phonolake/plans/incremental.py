"""Preparation of what is new only: a ledger says which input files a training set holds.

A run prepares new input files into a folder of its own and then adds its files to the ledger. That is the only step that
changes the set: the entries of a run are one file, which Spark's committer moves to its place as a whole, and readers
take the folders of runs that the ledger names. A run that dies before leaves the old set as it is. An input is known by its path,
length and time. If an input of an earlier run has changed or gone, that run is retired in the same step and what is left
of its inputs is prepared with the new ones. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonolake.sources.readers import list_files

LEDGER = "run string, path string, length long, modified timestamp, num_shards long, retires array<string>"
INPUT = ["path", "length", "modified"]


def ledger(spark: SparkSession, out_dir: str) -> DataFrame:
    """Entries of the runs in force, one per input file; a run without files has one entry without path."""
    try:
        entries = spark.read.schema(LEDGER).parquet(f"{out_dir}/ledger")
        retired = entries.select(F.explode("retires").alias("run")).distinct()
        return entries.join(retired, "run", "left_anti")
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def runs(spark: SparkSession, out_dir: str) -> list[str]:
    """Runs in force that hold files."""
    found = ledger(spark, out_dir).where(F.col("path").isNotNull()).select("run").distinct().orderBy("run")
    return [r["run"] for r in found.collect()]


def run_folder(out_dir: str, run: str) -> str:
    return f"{out_dir.rstrip('/')}/runs/{run}"


def prepare_new(
    spark: SparkSession, in_dir: str, out_dir: str, prepare: Callable[[DataFrame, str], int | None], pattern: str = "*.parquet"
) -> str | None:
    """Prepare the Parquet files below ``in_dir`` that the set in ``out_dir`` does not hold; the run's name, None without work.

    ``prepare`` takes the rows of the new files and an empty folder, writes its shards to ``<folder>/parquet``, and returns their number.
    What reaches the driver are paths of new files, which Spark needs there to plan the scan.
    """
    files = list_files(spark, in_dir, pattern)
    files = spark.createDataFrame([], "path string, length long, modified timestamp") if files is None else files
    held = ledger(spark, out_dir)
    inputs = held.where(F.col("path").isNotNull())
    stale = [r["run"] for r in inputs.join(files, INPUT, "left_anti").select("run").distinct().collect()]
    kept = inputs.where(~F.col("run").isin(stale)) if stale else inputs
    new = files.join(kept, INPUT, "left_anti").select(*INPUT).orderBy("path").collect()
    if not new and not stale:
        return None
    run = uuid.uuid4().hex
    shards = prepare(spark.read.parquet(*[r["path"] for r in new]), run_folder(out_dir, run)) if new else 0
    entries = spark.createDataFrame(new or [(None, None, None)], "path string, length long, modified timestamp")
    retires = F.array(*[F.lit(r) for r in stale]).cast("array<string>")
    entries = entries.select(F.lit(run).alias("run"), *INPUT, F.lit(shards).cast("long").alias("num_shards"), retires.alias("retires"))
    entries.coalesce(1).write.mode("append").parquet(f"{out_dir}/ledger")
    return run


def read_prepared(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows of all runs in force; an error if there are none."""
    folders = [f"{run_folder(out_dir, run)}/parquet" for run in runs(spark, out_dir)]
    if not folders:
        raise ValueError(f"nothing is prepared in {out_dir}")
    return spark.read.parquet(*folders)
