"""Per-utterance token arrays: layout, validity and repeated frames. No operator here shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import frames as R
from phonolake.functions import tokens as T
from phonolake.session import bound_batches

# Code ranges by mode: strict is the codebook, lenient also lets the codebook size pass, parse excludes 0.
CODE_RANGES = {"strict": (0, T.CODEBOOK - 1), "lenient": (0, T.CODEBOOK), "parse": (1, T.CODEBOOK)}


def in_range(code: Column, mode: str) -> Column:
    return code.between(*CODE_RANGES[mode])


def interleave_codes(df: DataFrame, mode: str = "trim", base: int = T.AUDIO_BASE) -> DataFrame:
    """Layers ``l0, l1, l2`` to ``audio_ids``.

    ``trim`` uses the frames that all layers fill. ``strict`` wants lengths of ratio 1:2:4 and codes in 0..4096 and
    gives an error row otherwise.
    """
    bound_batches(df.sparkSession)
    layers = ("l0", "l1", "l2")
    if mode == "trim":
        return df.withColumn("audio_ids", R.interleave(*map(F.col, layers), base))
    lengths = (F.size("l1") == F.size("l0") * 2) & (F.size("l2") == F.size("l0") * 4)
    low, high = CODE_RANGES["lenient"]
    codes = F.lit(True)
    for layer in layers:
        codes = codes & (F.array_min(layer) >= low) & (F.array_max(layer) <= high)
    df = df.withColumn("error", F.when(~lengths, "layer_lengths").when(~codes, "code_range"))
    valid = F.col("error").isNull()
    return df.withColumn("audio_ids", F.when(valid, R.interleave(*[F.when(valid, F.col(x)) for x in layers], base)))


def deinterleave_codes(df: DataFrame, ids: str = "audio_ids", base: int = T.AUDIO_BASE) -> DataFrame:
    """``ids`` to layers ``l0, l1, l2``; out-of-range codes are kept for reports."""
    bound_batches(df.sparkSession)
    df = df.withColumn("_layers", R.layers(F.col(ids), base))
    return df.withColumns({f"l{n}": F.col(f"_layers.l{n}") for n in range(3)}).drop("_layers")


def dedup_frames(df: DataFrame, ids: str = "audio_ids") -> DataFrame:
    """Drop frames that repeat the first token of the frame before; a partial frame is an error row."""
    whole = F.size(ids) % T.SLOTS == 0
    return df.withColumns(
        {
            "error": F.when(~whole, "length_not_divisible"),
            "deduped_ids": C.drop_repeated_frames(F.col(ids)),
        }
    )


def audio_token_split(df: DataFrame, ids: str = "ids", report: int = 20) -> DataFrame:
    """Tokens in the audio range, and the first others."""
    audio = lambda t: t.between(T.AUDIO_BASE, T.MAX_AUDIO_TOKEN)
    return df.withColumns(
        {
            "audio_ids": F.filter(ids, audio),
            "stray_count": C.count_where(F.col(ids), lambda t: ~audio(t)),
            "stray_ids": C.first_n(F.filter(ids, lambda t: ~audio(t)), report),
        }
    )


def trim_at_eos(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Cut before the first END_OF_SPEECH and tell whether there was one."""
    return df.withColumns(
        {
            "trimmed_ids": C.before_first(F.col(ids), T.END_OF_SPEECH),
            "has_eos": F.array_contains(ids, T.END_OF_SPEECH),
        }
    )


def min_tokens_filter(df: DataFrame, ids: str, n: int = T.SLOTS) -> DataFrame:
    return df.where(F.size(ids) >= n)


def validate_codes(df: DataFrame, mode: str = "strict") -> DataFrame:
    """Invalid codes per layer and whether the row is valid."""
    bad = {f"invalid_l{n}": C.count_where(F.col(f"l{n}"), lambda c: ~in_range(c, mode)) for n in range(3)}
    df = df.withColumns(bad)
    return df.withColumn("valid", sum((F.col(c) for c in bad), F.lit(0)) == 0)


def roundtrip_check(df: DataFrame) -> DataFrame:
    """Whether de-interleaving gives back the interleaved layers, per row."""
    there = interleave_codes(df.withColumnsRenamed({f"l{n}": f"in{n}" for n in range(3)}).withColumns(
        {f"l{n}": F.col(f"in{n}") for n in range(3)}
    ))
    back = deinterleave_codes(there.drop("l0", "l1", "l2"))
    same = F.lit(True)
    for n in range(3):
        same = same & (F.col(f"l{n}") == F.col(f"in{n}"))
    return back.withColumn("same", same)


def token_report(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Counts, ends, range and special tokens of each generation."""
    arr = F.col(ids)
    out = {
        "n_tokens": F.size(ids),
        "first_14": C.join_ints(C.first_n(arr, 14)),
        "last_14": C.join_ints(C.last_n(arr, 14)),
        "min_token": F.array_min(ids),
        "max_token": F.array_max(ids),
    }
    special = {
        "eos": T.END_OF_SPEECH,
        "eoai": T.END_OF_AI,
        "sos": T.START_OF_SPEECH,
        "pad": T.PAD,
    }
    for name, value in special.items():
        out[f"{name}_count"] = C.count_value(arr, value)
        out[f"{name}_first"] = C.first_position(arr, value)
    return df.withColumns(out)


def layer_report(df: DataFrame) -> DataFrame:
    """Length, range and invalid codes (strict) of each layer."""
    out = {}
    for n in range(3):
        out[f"n_l{n}"] = F.size(f"l{n}")
        out[f"min_l{n}"] = F.array_min(f"l{n}")
        out[f"max_l{n}"] = F.array_max(f"l{n}")
    return validate_codes(df.withColumns(out), "strict")


def inference_report(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Trim, token report, layers, layer report and duration; fewer than seven tokens is an error row."""
    df = trim_at_eos(token_report(df, ids), ids)
    df = audio_token_split(df, ids)
    df = df.withColumn("n_trimmed", F.size("trimmed_ids"))
    df = df.withColumn("error", F.when(F.col("n_trimmed") < T.SLOTS, "too_short"))
    df = layer_report(deinterleave_codes(df, "trimmed_ids"))
    seconds = F.col("n_l0") * T.FRAME_SAMPLES / T.SAMPLE_RATE
    return df.withColumn("duration_s", F.when(F.col("error").isNull() & F.col("valid"), seconds))
