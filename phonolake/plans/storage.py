"""Queries that write a set and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.operators import corpus
from phonolake.plans import corpus as PC
from phonolake.plans import incremental
from phonolake.plans import inputs as I
from phonolake.plans import jobs
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query
from phonolake.session import scratch_dir
from phonolake.sources import readers, writers


@query(
    "write_shards",
    with_inputs(
        """SELECT i // 100 AS shard, count(*) AS rows, min(utt_id) AS first_utt, max(utt_id) AS last_utt,
             sum(length)::BIGINT AS total_length
           FROM (SELECT *, row_number() OVER (ORDER BY utt_id) - 1 AS i FROM lengths) GROUP BY 1"""
    ),
)
def write_shards(spark, sf_dir):
    path = scratch_dir(spark)
    writers.write_shards(I.lengths(spark, sf_dir), path, ["utt_id"], 100, shards_per_task=4)
    return readers.read_shards(spark, path, 4).groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("utt_id").alias("first_utt"),
        F.max("utt_id").alias("last_utt"),
        F.sum("length").alias("total_length"),
    )


VOICE_IDS_SQL = """
    SELECT utt_id, list(coalesce(v.id, -1) ORDER BY pos) AS ids FROM
      (SELECT utt_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM
        (SELECT utt_id, regexp_extract_all(CASE WHEN coalesce(speaker, '') <> ''
           THEN speaker || ': ' || text ELSE text END, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]') AS words FROM attached))
      LEFT JOIN vocab v USING (token) GROUP BY utt_id"""


@query(
    "prepare_format_a_job",
    with_inputs(
        """SELECT filename, speaker, len(ids)::INTEGER AS seq_len, md5(array_to_string(ids, ',')) AS ids_md5,
             (row_number() OVER (ORDER BY utt_id) - 1) // 512 AS shard
           FROM (SELECT a.utt_id, a.filepath AS filename, a.speaker, list_concat(list_concat(list_concat([128259],
                   coalesce(p.ids, [])), [128009, 128260, 128261, 128257]), list_concat(flatten(fr), [128258])) AS ids
                 FROM attached a LEFT JOIN voice_ids p USING (utt_id) JOIN frames f USING (utt_id))
           WHERE len(ids) <= 8192""",
        **PC.PREPARED_SQL,
        voice_ids=VOICE_IDS_SQL,
    ),
)
def prepare_format_a_job(spark, sf_dir):
    """Shards of the whole corpus, read back with their shard numbers."""
    path = scratch_dir(spark)
    layers = I.codes(spark, sf_dir).drop("n_samples")
    audio, meta, words = I.audio_rows(spark, sf_dir), I.metadata(spark, sf_dir), I.vocab(spark, sf_dir)
    jobs.prepare_format_a(audio, meta, layers, words, path)
    rows = readers.read_shards(spark, path)
    return rows.select("filename", "speaker", "seq_len", C.digest(F.col("input_ids")).alias("ids_md5"), "shard")


SEQUENCES_SQL = """
    SELECT a.filepath AS filename, a.speaker, list_concat(list_concat(list_concat([128259],
      coalesce(p.ids, [])), [128009, 128260, 128261, 128257]), list_concat(flatten(fr), [128258])) AS ids
    FROM attached a LEFT JOIN voice_ids p USING (utt_id) JOIN frames f USING (utt_id)"""


@query(
    "prepare_incremental",
    with_inputs(
        """SELECT filename, speaker, len(ids)::INTEGER AS seq_len, md5(array_to_string(ids, ',')) AS ids_md5
           FROM sequences_a WHERE len(ids) <= 8192""",
        **PC.PREPARED_SQL,
        sequences_a=SEQUENCES_SQL,
        voice_ids=VOICE_IDS_SQL,
    ),
)
def prepare_incremental(spark, sf_dir):
    """Recordings prepared in three runs, as their files come, one of which comes again with other rows."""
    path = scratch_dir(spark)
    audio, meta, words = I.audio_rows(spark, sf_dir), I.metadata(spark, sf_dir), I.vocab(spark, sf_dir)
    layers = I.codes(spark, sf_dir).drop("n_samples")
    part = F.col("utt_id") % 4

    def prepare(rows: DataFrame, folder: str) -> int:
        jobs.prepare_format_a(rows, meta, layers, words, folder)
        return spark.read.schema("num_shards long").json(f"{folder}/pointer").scalar()

    def run() -> None:
        incremental.prepare_new(spark, f"{path}/in/*", f"{path}/out", prepare)

    audio.where(part < 2).write.parquet(f"{path}/in/first")
    audio.where((part == 2) & (F.col("utt_id") < 100)).write.parquet(f"{path}/in/second")
    run()
    audio.where(part == 3).write.parquet(f"{path}/in/third")
    run()
    audio.where(part == 2).write.mode("overwrite").parquet(f"{path}/in/second")
    run()
    rows = incremental.read_prepared(spark, f"{path}/out")
    return rows.select("filename", "speaker", "seq_len", C.digest(F.col("input_ids")).alias("ids_md5"))


FORMAT_B_SQL = {
    "b_clean": f"""
        SELECT utt_id, n_samples, n_samples / sample_rate AS duration_s, trim(text, {PC.WS_SQL}) AS text,
          coalesce(trim(speaker, {PC.WS_SQL}), 'speaker') AS speaker FROM source_rows""",
    "b_ids": """
        SELECT utt_id, list(coalesce(v.id, -1) ORDER BY pos) AS ids FROM
          (SELECT utt_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM
            (SELECT utt_id, regexp_extract_all(speaker || ': ' || text, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]') AS words FROM b_clean))
          LEFT JOIN vocab v USING (token) GROUP BY utt_id""",
    "b_rows": """
        SELECT c.*, coalesce(p.ids, []) AS ids, d.audio_ids, CASE WHEN text = '' THEN 'empty_text'
          WHEN speaker = '' THEN 'empty_speaker' WHEN duration_s NOT BETWEEN 0.5 AND 20.0 THEN 'duration'
          WHEN len(d.audio_ids) = 0 THEN 'no_audio_tokens'
          WHEN len(coalesce(p.ids, [])) + len(d.audio_ids) + 7 > 4096 THEN 'over_length' END AS drop_reason
        FROM b_clean c LEFT JOIN b_ids p USING (utt_id) JOIN deduped d USING (utt_id)""",
}


def run_format_b(spark, sf_dir) -> tuple[str, DataFrame]:
    path = scratch_dir(spark)
    layers = I.codes(spark, sf_dir).drop("n_samples")
    stats = jobs.prepare_format_b(
        I.source_rows(spark, sf_dir), layers, I.vocab(spark, sf_dir), path, template=I.TEMPLATE
    )
    return path, stats


@query(
    "write_typed",
    with_inputs(
        """SELECT speaker AS speaker_id, md5(text) AS text_md5, len(audio_ids)::INTEGER AS audio_token_count,
             (len(ids) + len(audio_ids) + 7)::INTEGER AS sequence_length, round(duration_s, 4) AS duration_s,
             md5(array_to_string(list_concat(list_concat(list_concat([128259], ids), [128009, 128260, 128261, 128257]),
               list_concat(audio_ids, [128258, 128262])), ',')) AS ids_md5
           FROM b_rows WHERE drop_reason IS NULL""",
        **FORMAT_B_SQL,
    ),
)
def write_typed(spark, sf_dir):
    """Format-B sequences with their text, written with fixed types and read as a training set."""
    path, _ = run_format_b(spark, sf_dir)
    back = readers.read_training_set(spark, path)
    return back.select(
        "speaker_id",
        F.md5("text").alias("text_md5"),
        "audio_token_count",
        "sequence_length",
        F.round(F.col("duration_s").cast("double"), 4).alias("duration_s"),
        C.digest(F.col("input_ids")).alias("ids_md5"),
    )


@query(
    "prepare_format_b_job",
    with_inputs(
        """SELECT speaker, grouping(speaker)::INTEGER AS is_total, count(*) FILTER (drop_reason IS NULL) AS examples,
             count(*) FILTER (drop_reason IS NOT NULL) AS dropped,
             round(coalesce(sum(duration_s) FILTER (drop_reason IS NULL), 0) / 3600, 6) AS hours,
             coalesce(max(n) FILTER (drop_reason IS NULL), 0)::INTEGER AS max_sequence_length,
             round(coalesce(avg(n) FILTER (drop_reason IS NULL), 0), 6) AS avg_sequence_length
           FROM (SELECT *, len(ids) + len(audio_ids) + 7 AS n FROM b_rows) GROUP BY ROLLUP (speaker)""",
        **FORMAT_B_SQL,
    ),
)
def prepare_format_b_job(spark, sf_dir):
    """Statistics of the format-B set."""
    _, stats = run_format_b(spark, sf_dir)
    return stats.withColumns(
        {"hours": F.round("hours", 6), "avg_sequence_length": F.round("avg_sequence_length", 6)}
    )


@query(
    "write_stats",
    with_inputs(
        """SELECT speaker, grouping(speaker)::INTEGER AS is_total, count(*) FILTER (drop_reason IS NULL) AS examples,
             count(*) FILTER (drop_reason IS NOT NULL) AS dropped,
             round(coalesce(sum(duration_s) FILTER (drop_reason IS NULL), 0) / 3600, 6) AS hours
           FROM tagged GROUP BY ROLLUP (speaker)""",
        **PC.TAGGED_SQL,
    ),
)
def write_stats(spark, sf_dir):
    """Per-speaker statistics written as JSON lines and read back."""
    path = scratch_dir(spark)
    writers.write_stats(corpus.speaker_stats(PC.tagged(spark, sf_dir)), path)
    schema = "speaker string, is_total int, examples long, dropped long, hours double"
    return spark.read.schema(schema).json(path).withColumn("hours", F.round("hours", 6))


@query(
    "manifest_roundtrip",
    """SELECT 'd' || doc_id AS filename, source AS speaker, md5(text) AS text_md5, (n_chars // 2)::INTEGER AS frames,
         n_chars / 100 AS duration_sec FROM documents""",
)
def manifest_roundtrip(spark, sf_dir):
    """Documents written as a manifest CSV and read through the manifest reader."""
    docs = I.table(spark, sf_dir, "documents")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    rows = docs.select(
        name.alias("filename"),
        F.concat(name, F.lit(".wav")).alias("wav_path"),
        F.col("source").alias("speaker"),
        "text",
        (F.col("n_chars") / 2).cast("string").alias("frames"),
        (F.col("n_chars") / 100).cast("string").alias("duration_sec"),
    )
    path = scratch_dir(spark)
    rows.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    back = readers.read_manifest(spark, path)
    return back.select("filename", "speaker", F.md5("text").alias("text_md5"), "frames", "duration_sec")
