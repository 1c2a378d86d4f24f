"""Reports over request telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import tokens as T

MICROS = 1_000_000


def join_telemetry(engine: DataFrame, decoder: DataFrame, transport: DataFrame) -> DataFrame:
    """The three documents of each request side by side; a missing one leaves nulls."""
    kinds = {"engine": engine, "decoder": decoder, "transport": transport}
    joined = None
    for kind, df in kinds.items():
        named = df.select("request_id", *[F.col(c).alias(f"{kind}_{c}") for c in df.columns if c != "request_id"])
        named = named.withColumn(f"has_{kind}", F.lit(True))
        joined = named if joined is None else joined.join(named, "request_id", "full")
    return joined.na.fill(False, [f"has_{k}" for k in kinds])


def session_totals(sentences: DataFrame) -> DataFrame:
    """Totals per session over chunk rows (session_id, sentence_index, bytes, error).

    An error marks its sentence only; the sentences behind it count as usual.
    """
    per_sentence = sentence_totals(sentences)
    return per_sentence.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("total_sentences"),
        F.sum("total_bytes").alias("total_bytes"),
        F.count_if("error").alias("failed_sentences"),
    )


def sentence_totals(sentences: DataFrame) -> DataFrame:
    return sentences.groupBy("session_id", "sentence_index").agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.bool_or("error").alias("error")
    )


def throughput(requests: DataFrame) -> DataFrame:
    """Audio seconds, elapsed time, real-time factor and first-chunk latency of each request.

    ``requests``: request_id, start_us, first_chunk_us, end_us, bytes (16-bit mono).
    """
    elapsed = (F.col("end_us") - F.col("start_us")) / MICROS
    audio = F.col("bytes") / (2 * T.SAMPLE_RATE)
    return requests.select(
        "request_id",
        audio.alias("audio_s"),
        elapsed.alias("elapsed_s"),
        F.when(audio > 0, elapsed / audio).alias("real_time_factor"),
        ((F.col("first_chunk_us") - F.col("start_us")) / MICROS).alias("first_chunk_s"),
    )


def throughput_report(requests: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Totals and latency quantiles over all requests."""
    latency = lambda q: F.percentile_approx("first_chunk_s", q, accuracy)
    return throughput(requests).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("audio_s").alias("audio_s"),
        F.sum("elapsed_s").alias("elapsed_s"),
        (F.sum("elapsed_s") / F.sum("audio_s")).alias("real_time_factor"),
        latency(0.5).alias("first_chunk_p50_s"),
        latency(0.95).alias("first_chunk_p95_s"),
    )


def progress_report(done: DataFrame, total: int) -> DataFrame:
    """Rate and remaining time from finished items (finished_us) of ``total``."""
    span = F.greatest((F.max("finished_us") - F.min("finished_us")) / MICROS, F.lit(1e-6))
    out = done.agg(F.count(F.lit(1)).alias("completed"), span.alias("elapsed_s"))
    out = out.withColumns({"total": F.lit(total).cast("long"), "rate": F.col("completed") / F.col("elapsed_s")})
    return out.withColumn(
        "eta_s", F.when(F.col("rate") > 0, (F.col("total") - F.col("completed")) / F.col("rate")).otherwise(0.0)
    )


#: Sketches of 200 items per level: a quantile is off by at most about 1.65 % of the ranks, in 99 of 100 cases.
SKETCH_ITEMS = 200
SKETCH_ERROR = 0.0165


def latency_sketches(requests: DataFrame, *groups: str, value: str = "first_chunk_s", items: int = SKETCH_ITEMS) -> DataFrame:
    """Per group the number of requests with a value and a mergeable KLL sketch of it: a few kilobytes, whatever the number.

    Written once a day, they answer for any span of days without the requests.
    """
    known = requests.where(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(items))
    return known.groupBy(*groups).agg(F.count(F.lit(1)).alias("requests"), sketch.alias("sketch"))


def sketched_quantiles(sketches: DataFrame, *groups: str, quantiles: tuple = (0.5, 0.95)) -> DataFrame:
    """Quantiles over merged sketches per group, as columns p50, p95, …; they read sketches only."""
    merged = sketches.groupBy(*groups).agg(
        F.sum("requests").alias("requests"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    columns = {f"p{round(100 * q)}": F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for q in quantiles}
    return merged.select(*groups, "requests", *[c.alias(name) for name, c in columns.items()])
