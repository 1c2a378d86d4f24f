"""Queries of this subpackage and, where SQL can express them, the SQL that must give the same rows."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

from phonolake.session import bound_batches

QUERIES: dict = {}
SQL: dict[str, str] = {}
MODULES = ["sharding", "packing", "warc", "language", "quality", "decontamination", "secrets", "lines", "neardup", "phrases", "runs", "repair", "hmm"]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"phonolake.llm.{module}")
