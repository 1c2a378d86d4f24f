"""Session construction for local runs, and the shared scratch folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int | str = 8, app: str = "phonolake") -> SparkSession:
    """Session used by the tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("PHONOLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Rows that Spark hands to Python at once: a batch of long texts must fit into a worker's memory.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key, None)
        if now is None or not 0 < int(now.rstrip("bB")) <= most:
            spark.conf.set(key, str(most))


def scratch_dir(spark: SparkSession) -> str:
    """New folder below ``spark.checkpoint.dir``.

    Written intermediates must outlive executors, so on a cluster the folder has to be shared and is taken from
    the session. Only a local session may use a folder of this machine, and gets one if nothing is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="phonolake-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if not local and root.startswith(("/tmp", "file:/tmp", "file:///tmp")):
        raise ValueError(f"{root} is a folder of one machine; set spark.checkpoint.dir to one that all executors share")
    return f"{root.rstrip('/')}/phonolake-{uuid.uuid4().hex}"


def materialise_observed(df: DataFrame, *totals: Column) -> tuple[DataFrame, DataFrame]:
    """``materialise``, and a row of ``totals`` over ``df`` that the write itself has added up: nothing is read for it."""
    seen = Observation()
    written = materialise(df.observe(seen, *totals))
    schema = df.limit(0).agg(*totals).schema
    return written, df.sparkSession.createDataFrame([tuple(seen.get[f.name] for f in schema)], schema)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it back: lineage ends here."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
