"""End-to-end corpus preparation: tables in, training set with statistics out.

Neural parts stay outside: layer codes come as a table (utt_id, l0, l1, l2). Rows are accepted or dropped on narrow
columns first; the layers, by far the largest table, meet only the accepted rows, once, and are written as sequences.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.operators import corpus
from phonolake.operators.joins import fits_broadcast
from phonolake.operators.ordered import index_rows
from phonolake.operators.subwords import encode_prompts
from phonolake.operators.vocab import vocab_encode
from phonolake.session import materialise, materialise_observed
from phonolake.sources import writers

#: Ids of rows that are sent to every executor, 8 bytes each, so that only their layers move.
MOST_IDS = 4_000_000


def with_prompt_ids(rows: DataFrame, prompt, vocab: DataFrame, keep: list[str]) -> DataFrame:
    """Rows with the ids of their prompts by a vocabulary or a rank table; only ``keep`` columns go along."""
    return encode_prompts(rows, prompt, vocab, "utt_id", "prompt_ids", keep)


def prepare_format_a(
    audio: DataFrame,
    meta: DataFrame,
    layers: DataFrame,
    vocab: DataFrame,
    out_dir: str,
    max_len: int = T.MAX_LEN_A,
    rows_per_shard: int = T.ROWS_PER_SHARD,
    mode: str = "errorifexists",
) -> DataFrame | None:
    """Recordings with text to format-A shards below ``out_dir``; returns the statistics row that is also written.

    With ``mode="ignore"`` an existing set, its statistics and its pointer are kept and nothing is computed.

    ``audio``: utt_id, filepath, speaker, n_samples; ``meta``: filename, text, ord.
    """
    corpus.require_columns(audio, ["utt_id", "filepath", "speaker", "n_samples"])
    if mode == "ignore" and _has_rows(audio, f"{out_dir}/parquet"):
        return None
    rows = corpus.attach_text(audio.select("utt_id", "filepath", "speaker", "n_samples"), meta)
    return _write_format_a(rows, layers, vocab, out_dir, ["utt_id"], max_len, rows_per_shard, mode)


def prepare_manifest(
    manifest: DataFrame,
    layers: DataFrame,
    vocab: DataFrame,
    out_dir: str,
    sort_by_length: bool = True,
    max_len: int = T.MAX_LEN_A,
    rows_per_shard: int = T.ROWS_PER_SHARD,
    mode: str = "errorifexists",
) -> DataFrame | None:
    """Manifest rows, which carry their text, to format-A shards, by default in the order of their frames.

    ``manifest``: utt_id, wav_path, speaker, text, frames. With ``mode="ignore"`` an existing set is kept.
    """
    corpus.require_columns(manifest, ["utt_id", "wav_path", "speaker", "text", "frames"])
    if mode == "ignore" and _has_rows(manifest, f"{out_dir}/parquet"):
        return None
    rows = manifest.where(F.col("text").isNotNull())
    rows = rows.select("utt_id", F.col("wav_path").alias("filepath"), "speaker", "text", F.col("frames").cast("long").alias("n_samples"))
    order = ["n_samples", "utt_id"] if sort_by_length else ["utt_id"]
    return _write_format_a(rows, layers, vocab, out_dir, order, max_len, rows_per_shard, mode)


def _write_format_a(rows, layers, vocab, out_dir: str, order: list[str], max_len: int, rows_per_shard: int, mode: str):
    prompt = X.voice_prompt(F.col("speaker"), F.col("text"))
    rows = with_prompt_ids(rows, prompt, vocab, ["filepath", "speaker", "n_samples"])
    length = corpus.length_a(F.col("prompt_ids"), F.col("n_samples")).cast("int")
    tagged = corpus.tag_length(rows.withColumn("seq_len", length), length, max_len)
    tagged, stats = materialise_observed(tagged, *corpus.corpus_totals())

    # Places are found on narrow columns: layers move once to meet their row and once to its shard, where sequences are built.
    accepted = corpus.kept(tagged).drop("seq_len")
    there = accepted.select("utt_id", *[c for c in order if c != "utt_id"]).join(layers.select("utt_id"), "utt_id", "left_semi")
    places, total = index_rows(there, order, "_row")
    wide = with_layers(accepted.join(places.select("utt_id", "_row"), "utt_id"), layers, places.select("utt_id"))

    def sequences(rows: DataFrame) -> DataFrame:
        rows = corpus.assemble_a(rows, 0).withColumnRenamed("filepath", "filename")
        return rows if "n_samples" in order else rows.drop("n_samples")

    shards = writers.write_indexed(wide, total, out_dir, rows_per_shard, mode, finish=sequences)
    writers.write_stats(stats, f"{out_dir}/stats")
    writers.write_pointer(rows.sparkSession, out_dir, shards)
    return stats


def prepare_format_b(
    source: DataFrame,
    layers: DataFrame,
    vocab: DataFrame,
    out_dir: str,
    template: str | None = None,
    default_speaker: str = T.DEFAULT_SPEAKER,
    min_duration_s: float = T.MIN_DURATION_S,
    max_duration_s: float = T.MAX_DURATION_S,
    max_len: int = T.MAX_LEN_B,
    phonemize: str | None = None,
    mode: str = "errorifexists",
) -> DataFrame | None:
    """Labelled source rows to typed format-B sequences in ``out_dir/parquet``; returns statistics per speaker.

    ``source``: utt_id, text, n_samples, sample_rate and optionally speaker. ``phonemize`` names a column with the
    text in IPA, whose phonemes replace the words of the prompt. With ``mode="ignore"`` an existing set is kept and
    nothing is computed.
    """
    corpus.require_columns(source, ["utt_id", "text", "n_samples", "sample_rate"])
    if mode == "ignore" and _has_rows(source, f"{out_dir}/parquet"):
        return None
    rows = corpus.tag_duration(corpus.tag_clean(source, default_speaker), min_duration_s, max_duration_s)
    said = F.col("text") if phonemize is None else X.ipa_to_tokens(F.col(phonemize))
    prompt = X.template_prompt(template, F.col("speaker"), said)
    keep = ["speaker", "duration_s", "drop_reason"]
    if phonemize is None:
        prompts = with_prompt_ids(rows, prompt, vocab, keep)
    else:
        narrow = rows.select("utt_id", *keep, X.phoneme_array(prompt).alias("words"))
        prompts = vocab_encode(narrow, vocab, "utt_id", "words", "prompt_ids", keep=keep)

    # The first layer alone tells which frames stay, so lengths are known before any token array is built.
    frames = layers.select("utt_id", C.changed_frames(F.col("l0"), F.col("l1"), F.col("l2")).alias("frames"))
    counted = prompts.join(frames.hint("merge"), "utt_id", "left")
    counted = counted.withColumn("audio_token_count", F.coalesce(F.size("frames"), F.lit(0)) * T.SLOTS)
    counted = corpus.tag(counted, F.col("audio_token_count") == 0, "no_audio_tokens")
    tagged = materialise(corpus.tag_length_b(counted, max_len))

    texts = source.select("utt_id", X.strip(F.col("text")).alias("text"))
    accepted = with_layers(corpus.kept(tagged).join(texts, "utt_id"), layers, corpus.kept(tagged).select("utt_id"))
    sequences = corpus.assemble_b(accepted).withColumnRenamed("speaker", "speaker_id")
    writers.write_typed(sequences, f"{out_dir}/parquet", "overwrite" if mode == "ignore" else mode)
    stats = materialise(corpus.speaker_stats(tagged, "sequence_length"))
    writers.write_stats(stats, f"{out_dir}/stats")
    return stats


def with_layers(rows: DataFrame, layers: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows with their layers. Layers without one of the ids stay where they are if these are few enough to send out."""
    if fits_broadcast(ids, MOST_IDS):
        layers = layers.join(F.broadcast(ids), "utt_id", "left_semi")
    return rows.join(layers.hint("merge"), "utt_id")


def _has_rows(df: DataFrame, path: str) -> bool:
    try:
        return not df.sparkSession.read.parquet(path).isEmpty()
    except AnalysisException:
        return False
