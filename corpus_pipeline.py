"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Every stage works on all that its predecessor kept. The first four return the columns of ``documents``; a stage that
changes texts brings ``n_chars`` up to date.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonolake.llm import decontamination, language, lines, neardup, packing
from phonolake.llm.registry import bound_batches, table
from phonolake.session import materialise


SIMILAR = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected: no letters, or no learned language fits."""
    bound_batches(spark)
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.predict(docs, model)
    return found.where(~F.col("rejected")).select(*docs.columns)


def without_template_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines whose template recurs across documents, but for the first, so that no text is lost altogether."""
    kept = lines.drop_lines(docs, keep_first=True)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: similarity of ``SIMILAR`` percent or more."""
    return neardup.keep_one(docs, percent=SIMILAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, neighbours along the curve together."""
    bound_batches(spark)
    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language", known_language),
    ("lines", without_template_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The learned model and the token ids have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
