"""Sentence, phoneme and tag operators over text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import text as X
from phonolake.functions import tokens as T


def split_sentences(df: DataFrame, text: str = "text", granularity: str = "sentence") -> DataFrame:
    """One row per sentence with its 0-based index."""
    rest = [c for c in df.columns if c != text]
    pieces = X.sentences(F.col(text), granularity)
    return df.select(*rest, F.posexplode(pieces).alias("sentence_index", "sentence_text"))


def phonemes(df: DataFrame, ipa: str = "ipa", out: str = "phoneme_text") -> DataFrame:
    return df.withColumn(out, X.ipa_to_tokens(F.col(ipa)))


def phoneme_vocab(first_id: int = 0) -> dict[str, int]:
    """Phoneme tokens in sorted order with contiguous ids."""
    return {token: first_id + i for i, token in enumerate(sorted(set(T.PHONEMES.values())))}


def phoneme_ids(df: DataFrame, ipa: str = "ipa", out: str = "phoneme_ids", first_id: int = 0) -> DataFrame:
    """One id per phoneme of an IPA text; the vocabulary is a constant of 41 entries."""
    ids = phoneme_vocab(first_id)
    return df.withColumn(out, X.ipa_lookup(F.col(ipa), {s: ids[token] for s, token in T.PHONEMES.items()}))


def emotive_tags(df: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """Emotive tags and style words per row, with their number."""
    tags = F.regexp_extract_all(F.lower(F.col(text)), F.lit(f"<({'|'.join(T.EMOTIVE_TAGS)})>"), F.lit(1))
    style = F.filter(X.words(F.col(text)), lambda w: w.isin(T.STYLE_WORDS))
    found = F.concat(
        F.transform(tags, lambda t: F.struct(F.lit("tag").alias("kind"), t.alias("word"))),
        F.transform(style, lambda w: F.struct(F.lit("style").alias("kind"), w.alias("word"))),
    )
    return df.select(id_col, F.inline(found)).groupBy(id_col, "kind", "word").agg(F.count("*").alias("n"))


def request_plan(runs: DataFrame, prompts: list, save_below: int = 3) -> DataFrame:
    """Load-test requests: each run with each prompt, given as texts or as columns of ``runs``.

    ``runs`` has (offset, run_id) with the first run of each worker in ``offset``. Besides its runs every worker
    sends one warm-up request with run 90 + offset.
    """
    types = ["short", "medium", "long"]
    if len(prompts) > len(types):
        raise ValueError(f"at most {len(types)} prompts, got {len(prompts)}")
    planned = F.array(
        *[F.struct(F.lit(t).alias("type"), F.lit(p).alias("prompt")) for t, p in zip(types, prompts, strict=False)]
    )
    main = runs.select("offset", "run_id", F.inline(planned))
    warm = runs.select("offset").distinct().select(
        "offset",
        (F.col("offset") + 90).alias("run_id"),
        F.lit("warmup").alias("type"),
        F.lit("warmup").alias("prompt"),
    )
    return main.unionByName(warm).select(
        "offset",
        "run_id",
        F.concat("type", F.lit("_run"), F.col("run_id").cast("string")).alias("label"),
        F.concat(F.lit("Chapter "), F.col("run_id").cast("string"), F.lit(": "), F.col("prompt")).alias("prompt"),
        (F.col("run_id") < save_below).alias("saved"),
    )


def request_runs(spark, workers: int = 8, runs_per_worker: int = 5000) -> DataFrame:
    """Runs of all workers; worker w starts at w * runs_per_worker."""
    ids = spark.range(workers * runs_per_worker)
    return ids.select((F.col("id") - F.col("id") % runs_per_worker).alias("offset"), F.col("id").alias("run_id"))
