"""Corpus preparation: cleaning, filters, prompts, training sequences and statistics.

Operators that may reject a row have a ``tag_*`` form, which keeps the row and names the reason in ``drop_reason``
(the first reason wins), and a filter form. Data and statistics can so come from one tagged table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.operators.joins import lookup_join
from phonolake.operators.ordered import first_wide_per_key


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail before any job when a column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def tag(df: DataFrame, bad: Column, reason: str) -> DataFrame:
    """Name ``reason`` on rows where ``bad`` holds and no earlier reason stands."""
    earlier = F.col("drop_reason") if "drop_reason" in df.columns else F.lit(None).cast("string")
    return df.withColumn("drop_reason", F.coalesce(earlier, F.when(bad, F.lit(reason))))


def kept(df: DataFrame) -> DataFrame:
    return df.where(F.col("drop_reason").isNull()).drop("drop_reason")


def tag_clean(
    df: DataFrame, default_speaker: str = T.DEFAULT_SPEAKER, text: str = "text", speaker: str = "speaker"
) -> DataFrame:
    """Trim text and speaker, fill a missing speaker, reject rows where either is empty."""
    named = F.coalesce(X.strip(F.col(speaker)), F.lit(default_speaker)) if speaker in df.columns else F.lit(
        default_speaker
    )
    df = df.withColumns({text: X.strip(F.col(text)), speaker: named})
    return tag(
        tag(df, F.coalesce(F.col(text), F.lit("")) == "", "empty_text"), F.col(speaker) == "", "empty_speaker"
    )


def clean_rows(df: DataFrame, default_speaker: str = T.DEFAULT_SPEAKER, **names) -> DataFrame:
    return kept(tag_clean(df, default_speaker, **names))


def with_duration(df: DataFrame) -> DataFrame:
    """Duration at the original rate, before any resampling."""
    return df.withColumn("duration_s", F.col("n_samples") / F.col("sample_rate"))


def tag_duration(df: DataFrame, lo: float = T.MIN_DURATION_S, hi: float = T.MAX_DURATION_S) -> DataFrame:
    return tag(with_duration(df), ~F.col("duration_s").between(lo, hi), "duration")


def duration_filter(df: DataFrame, lo: float = T.MIN_DURATION_S, hi: float = T.MAX_DURATION_S) -> DataFrame:
    return kept(tag_duration(df, lo, hi))


def tag_length(df: DataFrame, length: Column, max_len: int) -> DataFrame:
    """Reject sequences longer than ``max_len``; 0 turns the check off."""
    return tag(df, length > max_len if max_len else F.lit(False), "over_length")


def length_filter(df: DataFrame, length: Column, max_len: int) -> DataFrame:
    return kept(tag_length(df, length, max_len))


def length_a(prompt: Column, n_samples: Column) -> Column:
    """Length of a format-A sequence, known before its arrays are built."""
    return F.size(prompt) + T.SLOTS * C.frames_of_samples(n_samples) + 6


def expected_lengths(df: DataFrame) -> DataFrame:
    """Padded sample count and the three layer lengths."""
    frames = C.frames_of_samples(F.col("n_samples"))
    return df.withColumns(
        {
            "padded_samples": frames * T.FRAME_SAMPLES,
            "len_l0": frames,
            "len_l1": frames * 2,
            "len_l2": frames * 4,
        }
    )


def check_voice(df: DataFrame, voices: list[str] | None = None, voice: str = "voice") -> DataFrame:
    """Error text on rows with a voice outside the list; an empty voice passes."""
    allowed = T.VOICES if voices is None else voices
    bad = (F.coalesce(F.col(voice), F.lit("")) != "") & ~F.col(voice).isin(allowed)
    return df.withColumn("error", F.when(bad, F.concat(F.lit("unknown voice: "), F.col(voice))))


def normalise_requests(df: DataFrame, default_voice: str = T.DEFAULT_VOICE) -> DataFrame:
    """Text and voice of a request from its alternative fields; blank text is an error row."""
    chosen = F.coalesce(X.first_filled(F.col("text"), F.col("prompt")), F.lit(""))
    voice = F.coalesce(X.first_filled(F.col("speaker"), F.col("voice")), F.lit(default_voice))
    blank = X.strip(chosen) == ""
    return df.withColumns(
        {
            "chosen_text": chosen,
            "chosen_voice": voice,
            "status": F.when(blank, 400).otherwise(200),
            "error": F.when(blank, F.lit("text is required")),
        }
    )


def attach_text(audio: DataFrame, meta: DataFrame, order: str = "ord") -> DataFrame:
    """Audio rows with the first metadata text of their file; rows without one are left out."""
    first = first_wide_per_key(meta, "filename", order).select(F.col("filename").alias("filepath"), "text")
    return lookup_join(audio, first.where(F.col("text").isNotNull()), "filepath")


def unmatched_audio(audio: DataFrame, meta: DataFrame, order: str = "ord") -> DataFrame:
    first = first_wide_per_key(meta, "filename", order).where(F.col("text").isNotNull())
    return lookup_join(audio, first.select(F.col("filename").alias("filepath")), "filepath", "left_anti")


def assemble_a(df: DataFrame, max_len: int = T.MAX_LEN_A) -> DataFrame:
    """Format-A sequences from ``prompt_ids``, ``n_samples`` and the layers; over-long rows go before arrays are built."""
    df = length_filter(df, length_a(F.col("prompt_ids"), F.col("n_samples")), max_len)
    audio = C.interleave(F.col("l0"), F.col("l1"), F.col("l2"))
    df = df.withColumn("input_ids", C.sequence_a(F.col("prompt_ids"), audio))
    size = F.size("input_ids")
    return df.withColumns({"attention_mask": F.array_repeat(F.lit(1), size), "seq_len": size}).drop(
        "l0", "l1", "l2", "prompt_ids"
    )


def tag_audio_tokens(df: DataFrame) -> DataFrame:
    """Frames to keep (``frames``) and the number of tokens they give; rows without any are rejected."""
    df = df.withColumn("frames", C.changed_frames(F.col("l0"), F.col("l1"), F.col("l2")))
    df = df.withColumn("audio_token_count", F.size("frames") * T.SLOTS)
    return tag(df, F.col("audio_token_count") == 0, "no_audio_tokens")


def tag_length_b(df: DataFrame, max_len: int = T.MAX_LEN_B) -> DataFrame:
    """Length of a format-B sequence from its parts, checked before any token array is built."""
    df = df.withColumn("sequence_length", F.size("prompt_ids") + F.col("audio_token_count") + 7)
    return tag_length(df, F.col("sequence_length"), max_len)


def assemble_b(df: DataFrame) -> DataFrame:
    """Format-B sequences with labels from ``prompt_ids``, the layers and the ``frames`` to keep."""
    audio = C.interleave_frames(F.col("l0"), F.col("l1"), F.col("l2"), F.col("frames"))
    df = df.withColumn("input_ids", C.sequence_b(F.col("prompt_ids"), audio))
    return df.withColumns(
        {
            "labels": C.labels_b(F.col("input_ids"), F.size("prompt_ids")),
            "attention_mask": F.array_repeat(F.lit(1).cast("byte"), F.size("input_ids")),
        }
    ).drop("prompt_ids", "frames", "l0", "l1", "l2")


def corpus_totals(length: str = "seq_len") -> list[Column]:
    """Totals of a tagged table; lengths are of kept rows, 0 when there is none."""
    keep = F.col("drop_reason").isNull()
    of_kept = F.when(keep, F.col(length))
    return [
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(keep).alias("rows_written"),
        F.count_if(F.col("drop_reason") == "over_length").alias("rows_skipped_over_length"),
        F.coalesce(F.min(of_kept), F.lit(0)).cast("long").alias("min_seq_len"),
        F.coalesce(F.max(of_kept), F.lit(0)).cast("long").alias("max_seq_len"),
        F.coalesce(F.avg(of_kept), F.lit(0.0)).alias("mean_seq_len"),
    ]


def corpus_stats(df: DataFrame, length: str = "seq_len") -> DataFrame:
    """One row of totals over a tagged table."""
    return df.agg(*corpus_totals(length))


def speaker_stats(df: DataFrame, length: str | None = None) -> DataFrame:
    """Kept examples and hours per speaker, dropped rows, and a total row with a null speaker.

    ``length`` names a column whose maximum and mean over the kept rows are added, 0 without any.
    """
    keep = F.col("drop_reason").isNull()
    out = [
        F.grouping("speaker").cast("int").alias("is_total"),
        F.count_if(keep).alias("examples"),
        F.count_if(~keep).alias("dropped"),
        (F.coalesce(F.sum(F.when(keep, F.col("duration_s"))), F.lit(0.0)) / 3600).alias("hours"),
    ]
    if length:
        of_kept = F.when(keep, F.col(length))
        out += [
            F.coalesce(F.max(of_kept), F.lit(0)).alias("max_sequence_length"),
            F.coalesce(F.avg(of_kept), F.lit(0.0)).alias("avg_sequence_length"),
        ]
    return df.rollup("speaker").agg(*out)


def distinct_sorted(df: DataFrame, col: str, limit: int | None = None) -> DataFrame:
    """Distinct non-null values in order; ``limit`` gives the first few."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
    return values if limit is None else values.limit(limit)


def length_sorted(df: DataFrame, length: str, tie_break: str) -> DataFrame:
    return df.orderBy(length, tie_break)


def first_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in order; 0 means all."""
    return df.orderBy(*order).limit(n) if n else df


def sample_grid(speakers: DataFrame, texts: list[str]) -> DataFrame:
    """Each speaker with each sample text, numbered from 1."""
    rows = F.array(*[F.struct(F.lit(i).alias("sample"), F.lit(t).alias("text")) for i, t in enumerate(texts, 1)])
    return speakers.select("*", F.inline(rows))


def normalise_waveform(df: DataFrame) -> DataFrame:
    """Mono mix of ``channels`` (one sample array per channel), scaled down only when its peak is above 1."""

    def mix(ch: Column) -> Column:
        added = F.aggregate(
            F.slice(ch, 2, F.greatest(F.size(ch) - 1, F.lit(0))),
            F.get(ch, F.lit(0)),
            lambda acc, more: F.zip_with(acc, more, lambda a, b: a + b),
        )
        return F.when(F.size(ch) > 1, F.transform(added, lambda x: x / F.size(ch))).otherwise(F.get(ch, F.lit(0)))

    def scale(v: Column) -> Column:
        return F.when(v["peak"] > 1.0, F.transform(v["mono"], lambda x: x / v["peak"])).otherwise(v["mono"])

    df = df.withColumn("mono", C.let(F.col("channels").cast("array<array<double>>"), mix))
    df = df.withColumn("peak", F.array_max(F.transform("mono", lambda x: F.abs(x))))
    return df.withColumn("samples", C.let(F.struct("mono", "peak"), scale)).drop("mono", "channels")


def to_pcm16(samples: Column) -> Column:
    """Samples in [-1, 1] times 32767, cut toward zero; values outside the range are held at its ends."""
    return F.transform(
        samples, lambda x: F.greatest(F.least(x * 32767, F.lit(32767.0)), F.lit(-32768.0)).cast("int").cast("short")
    )
