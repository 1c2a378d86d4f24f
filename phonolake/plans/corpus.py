"""Queries over corpus preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.operators import codes as code_ops
from phonolake.operators import corpus as ops
from phonolake.operators.ordered import first_per_key
from phonolake.operators.vocab import vocab_encode
from phonolake.plans import inputs as I
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query

WS_SQL = " || ".join(f"chr({ord(c)})" for c in T.WHITESPACE)
CLEAN_SQL = f"""
    SELECT * FROM (SELECT * REPLACE (trim(text, {WS_SQL}) AS text, coalesce(trim(speaker, {WS_SQL}), 'speaker') AS speaker)
    FROM source_rows) WHERE text <> '' AND speaker <> ''"""
PREPARED_SQL = {
    "attached": """
        SELECT a.*, m.text FROM audio_rows a JOIN first_metadata m ON m.filename = a.filepath
        WHERE m.text IS NOT NULL""",
    "cleaned": f"""
        SELECT * FROM (SELECT utt_id, filepath, n_samples, n_samples / sample_rate AS duration_s,
            trim(text, {WS_SQL}) AS text, coalesce(trim(speaker, {WS_SQL}), 'speaker') AS speaker FROM attached)
        WHERE text <> '' AND speaker <> '' AND duration_s BETWEEN 0.5 AND 20.0""",
    "prompt_words": """
        SELECT utt_id, regexp_extract_all(speaker || ': ' || text, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]') AS words FROM cleaned""",
    "prompt_ids": """
        SELECT utt_id, list(coalesce(v.id, -1) ORDER BY pos) AS ids FROM
          (SELECT utt_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM prompt_words)
          LEFT JOIN vocab v USING (token) GROUP BY utt_id""",
    "prepared": """
        SELECT c.*, coalesce(p.ids, []) AS ids, d.audio_ids,
          list_concat(list_concat(list_concat([128259], coalesce(p.ids, [])), [128009, 128260, 128261, 128257]),
            list_concat(d.audio_ids, [128258, 128262])) AS input_ids
        FROM cleaned c LEFT JOIN prompt_ids p USING (utt_id) JOIN deduped d USING (utt_id)
        WHERE len(d.audio_ids) > 0 AND len(coalesce(p.ids, [])) + len(d.audio_ids) + 7 <= 4096""",
}


def cleaned_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings with text, cleaned and of allowed duration; without the code arrays, which join last."""
    rows = ops.attach_text(I.audio_rows(spark, sf_dir), I.metadata(spark, sf_dir))
    return ops.clean_rows(ops.duration_filter(rows))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned utterances with the word ids of their prompt."""
    rows = cleaned_utterances(spark, sf_dir)
    prompt = X.template_prompt(I.TEMPLATE, F.col("speaker"), F.col("text"))
    rows = rows.withColumn("words", X.text_tokens(prompt))
    keep = ["filepath", "speaker", "duration_s", "n_samples"]
    return vocab_encode(rows, I.vocab(spark, sf_dir), "utt_id", "words", "prompt_ids", keep=keep)


def with_layers(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join the layers by utterance; both sides are large, and derived arrays are larger than Spark can estimate."""
    return rows.join(I.codes(spark, sf_dir).drop("n_samples").hint("merge"), "utt_id")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format-B sequences of the corpus."""
    rows = with_layers(prompts(spark, sf_dir), spark, sf_dir)
    rows = ops.kept(ops.tag_length_b(ops.tag_audio_tokens(rows)))
    return ops.assemble_b(rows)


@query(
    "prepare_corpus_stats",
    with_inputs(
        """SELECT speaker, count(*) AS examples, sum(n_samples)::BIGINT AS n_samples,
             round(sum(n_samples) / 24000 / 3600, 6) AS hours, sum(len(input_ids))::BIGINT AS tokens,
             sum(len(audio_ids))::BIGINT AS audio_tokens, max(len(input_ids))::BIGINT AS max_seq_len,
             sum(list_sum(input_ids[len(ids) + 4:]) - 100 * (len(ids) + 3))::BIGINT AS label_sum
           FROM prepared GROUP BY speaker""",
        **PREPARED_SQL,
    ),
)
def prepare_corpus_stats(spark, sf_dir):
    label_sum = F.aggregate("labels", F.lit(0).cast("long"), lambda a, x: a + x)
    return prepared(spark, sf_dir).groupBy("speaker").agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum("n_samples").alias("n_samples"),
        F.round(F.sum("n_samples") / T.SAMPLE_RATE / 3600, 6).alias("hours"),
        F.sum(F.size("input_ids")).alias("tokens"),
        F.sum("audio_token_count").alias("audio_tokens"),
        F.max(F.size("input_ids")).cast("long").alias("max_seq_len"),
        F.sum(label_sum).alias("label_sum"),
    )


@query("clean_rows", with_inputs(f"SELECT utt_id, speaker, md5(text) AS text_md5 FROM ({CLEAN_SQL})"))
def clean_rows(spark, sf_dir):
    rows = ops.clean_rows(I.source_rows(spark, sf_dir))
    return rows.select("utt_id", "speaker", F.md5("text").alias("text_md5"))


@query(
    "duration_filter",
    with_inputs(
        """SELECT utt_id, filepath, n_samples / sample_rate AS duration_s FROM audio_rows
           WHERE n_samples / sample_rate BETWEEN 0.5 AND 20.0"""
    ),
)
def duration_filter(spark, sf_dir):
    return ops.duration_filter(I.audio_rows(spark, sf_dir)).select("utt_id", "filepath", "duration_s")


@query(
    "length_filter",
    with_inputs(
        """SELECT utt_id, (len(words) + 7 * ((n_samples + 2047) // 2048) + 6)::INTEGER AS seq_len,
             CASE WHEN len(words) + 7 * ((n_samples + 2047) // 2048) + 6 > 8192 THEN 'over_length' END AS drop_reason
           FROM (SELECT *, regexp_extract_all(text, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]') AS words FROM source_rows)"""
    ),
)
def length_filter(spark, sf_dir):
    rows = I.source_rows(spark, sf_dir, spread=True)
    rows = rows.withColumn("seq_len", ops.length_a(X.text_tokens(F.col("text")), F.col("n_samples")).cast("int"))
    return ops.tag_length(rows, F.col("seq_len"), T.MAX_LEN_A).select("utt_id", "seq_len", "drop_reason")


@query(
    "expected_lengths",
    with_inputs(
        """SELECT utt_id, n_samples, f * 2048 AS padded_samples, f AS len_l0, 2 * f AS len_l1, 4 * f AS len_l2
           FROM (SELECT *, ceil(n_samples / 2048)::BIGINT AS f FROM audio_rows)"""
    ),
)
def expected_lengths(spark, sf_dir):
    rows = ops.expected_lengths(I.audio_rows(spark, sf_dir))
    return rows.select("utt_id", "n_samples", "padded_samples", "len_l0", "len_l1", "len_l2")


@query(
    "attach_text",
    with_inputs(
        """SELECT a.utt_id, a.filepath, a.speaker, md5(m.text) AS text_md5 FROM audio_rows a
           JOIN first_metadata m ON m.filename = a.filepath"""
    ),
)
def attach_text(spark, sf_dir):
    rows = ops.attach_text(I.audio_rows(spark, sf_dir), I.metadata(spark, sf_dir))
    return rows.select("utt_id", "filepath", "speaker", F.md5("text").alias("text_md5"))


@query(
    "unmatched_audio",
    with_inputs(
        "SELECT utt_id, filepath FROM audio_rows WHERE filepath NOT IN (SELECT filename FROM first_metadata)"
    ),
)
def unmatched_audio(spark, sf_dir):
    rows = ops.unmatched_audio(I.audio_rows(spark, sf_dir), I.metadata(spark, sf_dir))
    return rows.select("utt_id", "filepath")


@query("first_per_key", with_inputs("SELECT filename, md5(text) AS text_md5, ord FROM first_metadata"))
def first_metadata(spark, sf_dir):
    rows = first_per_key(I.metadata(spark, sf_dir), "filename", "ord")
    return rows.select("filename", F.md5("text").alias("text_md5"), "ord")


@query(
    "voice_prompt",
    with_inputs(
        """SELECT utt_id, md5(CASE WHEN coalesce(speaker, '') <> '' THEN speaker || ': ' || text ELSE text END)
           AS prompt_md5 FROM source_rows"""
    ),
)
def voice_prompt(spark, sf_dir):
    prompt = X.voice_prompt(F.col("speaker"), F.col("text"))
    return I.source_rows(spark, sf_dir).select("utt_id", F.md5(prompt).alias("prompt_md5"))


@query(
    "template_prompt",
    with_inputs(
        f"""SELECT utt_id, md5('<' || speaker || '> ' || text) AS prompt_md5 FROM ({CLEAN_SQL})""",
    ),
)
def template_prompt(spark, sf_dir):
    prompt = X.template_prompt("<{speaker_id}> {text}", F.col("speaker"), F.col("text"))
    return ops.clean_rows(I.source_rows(spark, sf_dir)).select("utt_id", F.md5(prompt).alias("prompt_md5"))


@query(
    "bracket_prompt",
    with_inputs(
        """SELECT utt_id, md5('<custom_token_3>' || text || CASE WHEN speaker IS NULL THEN '' ELSE '[' || speaker || ']'
           END || '<custom_token_4><custom_token_5>') AS prompt_md5 FROM source_rows"""
    ),
)
def bracket_prompt(spark, sf_dir):
    prompt = X.bracket_prompt(F.col("speaker"), F.col("text"))
    return I.source_rows(spark, sf_dir).select("utt_id", F.md5(prompt).alias("prompt_md5"))


def voiced_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as requests: users fill `text`, assistants `prompt`, system turns neither."""
    turns = I.table(spark, sf_dir, "conversations")
    names = F.array(*[F.lit(v) for v in [*T.VOICES, "tara", ""]])
    chosen = F.get(names, ((F.col("conv_id") * 7 + F.col("turn")) % 9).cast("int"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", F.col("text")).alias("text"),
        F.when(F.col("role") == "assistant", F.col("text")).otherwise("").alias("prompt"),
        F.when(F.col("role") == "assistant", chosen).alias("speaker"),
        F.when(F.col("role") == "user", chosen).alias("voice"),
    )


VOICED_SQL = {
    "voiced_turns": """
        SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS text,
          CASE WHEN role = 'assistant' THEN text ELSE '' END AS prompt,
          CASE WHEN role = 'assistant' THEN chosen END AS speaker, CASE WHEN role = 'user' THEN chosen END AS voice
        FROM (SELECT *, ['zoe', 'zac', 'jess', 'leo', 'mia', 'julia', 'leah', 'tara', ''][(conv_id * 7 + turn) % 9 + 1]
              AS chosen FROM conversations)"""
}


@query(
    "normalise_requests",
    with_inputs(
        f"""SELECT conv_id, turn, md5(t) AS text_md5, v AS chosen_voice,
              CASE WHEN trim(t, {WS_SQL}) = '' THEN 400 ELSE 200 END AS status,
              CASE WHEN trim(t, {WS_SQL}) = '' THEN 'text is required' END AS error
            FROM (SELECT *, coalesce(nullif(text, ''), nullif(prompt, ''), '') AS t,
                    coalesce(nullif(speaker, ''), nullif(voice, ''), 'Metin') AS v FROM voiced_turns)""",
        **VOICED_SQL,
    ),
)
def normalise_requests(spark, sf_dir):
    rows = ops.normalise_requests(voiced_turns(spark, sf_dir))
    return rows.select("conv_id", "turn", F.md5("chosen_text").alias("text_md5"), "chosen_voice", "status", "error")


@query(
    "check_voice",
    with_inputs(
        """SELECT conv_id, turn, v AS voice, CASE WHEN v <> '' AND v NOT IN
             ('zoe', 'zac', 'jess', 'leo', 'mia', 'julia', 'leah') THEN 'unknown voice: ' || v END AS error
           FROM (SELECT *, coalesce(speaker, voice, '') AS v FROM voiced_turns)""",
        **VOICED_SQL,
    ),
)
def check_voice(spark, sf_dir):
    rows = voiced_turns(spark, sf_dir).withColumn("voice", F.coalesce("speaker", "voice", F.lit("")))
    return ops.check_voice(rows).select("conv_id", "turn", "voice", "error")


TAGGED_SQL = {
    "tagged": f"""
        SELECT *, CASE WHEN text = '' THEN 'empty_text' WHEN speaker = '' THEN 'empty_speaker'
            WHEN duration_s NOT BETWEEN 0.5 AND 20.0 THEN 'duration' WHEN seq_len > 8192 THEN 'over_length' END
            AS drop_reason
        FROM (SELECT utt_id, n_samples / sample_rate AS duration_s,
                trim(text, {WS_SQL}) AS text, coalesce(trim(speaker, {WS_SQL}), 'speaker') AS speaker,
                len(regexp_extract_all(text, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]')) + 7 * ((n_samples + 2047) // 2048) + 6 AS seq_len
              FROM source_rows)"""
}


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows with the reason why they are dropped."""
    rows = I.source_rows(spark, sf_dir, spread=True)
    rows = rows.withColumn("seq_len", ops.length_a(X.text_tokens(F.col("text")), F.col("n_samples")))
    return ops.tag_length(ops.tag_duration(ops.tag_clean(rows)), F.col("seq_len"), T.MAX_LEN_A)


@query(
    "corpus_stats",
    with_inputs(
        """SELECT count(*) AS rows_seen, count(*) FILTER (drop_reason IS NULL) AS rows_written,
             count(*) FILTER (drop_reason = 'over_length') AS rows_skipped_over_length,
             coalesce(min(seq_len) FILTER (drop_reason IS NULL), 0)::BIGINT AS min_seq_len,
             coalesce(max(seq_len) FILTER (drop_reason IS NULL), 0)::BIGINT AS max_seq_len,
             round(coalesce(avg(seq_len) FILTER (drop_reason IS NULL), 0), 6) AS mean_seq_len FROM tagged""",
        **TAGGED_SQL,
    ),
)
def corpus_stats(spark, sf_dir):
    return ops.corpus_stats(tagged(spark, sf_dir)).withColumn("mean_seq_len", F.round("mean_seq_len", 6))


@query(
    "speaker_stats",
    with_inputs(
        """SELECT speaker, grouping(speaker)::INTEGER AS is_total, count(*) FILTER (drop_reason IS NULL) AS examples,
             count(*) FILTER (drop_reason IS NOT NULL) AS dropped,
             round(coalesce(sum(duration_s) FILTER (drop_reason IS NULL), 0) / 3600, 6) AS hours
           FROM tagged GROUP BY ROLLUP (speaker)""",
        **TAGGED_SQL,
    ),
)
def speaker_stats(spark, sf_dir):
    return ops.speaker_stats(tagged(spark, sf_dir)).withColumn("hours", F.round("hours", 6))


@query("distinct_speakers", "SELECT DISTINCT source AS speaker FROM documents WHERE source IS NOT NULL")
def distinct_speakers(spark, sf_dir):
    rows = I.table(spark, sf_dir, "documents").withColumnRenamed("source", "speaker")
    return ops.distinct_sorted(rows, "speaker")


@query(
    "top_speakers",
    "SELECT DISTINCT source AS speaker FROM documents WHERE source IS NOT NULL ORDER BY speaker LIMIT 2",
)
def top_speakers(spark, sf_dir):
    rows = I.table(spark, sf_dir, "documents").withColumnRenamed("source", "speaker")
    return ops.distinct_sorted(rows, "speaker", 2)


@query(
    "length_sorted",
    with_inputs(
        """SELECT utt_id, length, row_number() OVER (ORDER BY length, utt_id) - 1 AS place FROM lengths"""
    ),
)
def length_sorted(spark, sf_dir):
    from phonolake.operators.ordered import with_row_index

    rows = with_row_index(I.lengths(spark, sf_dir), ["length", "utt_id"], "place")
    return ops.length_sorted(rows, "length", "utt_id")


@query("first_rows", with_inputs("SELECT utt_id, length FROM lengths ORDER BY length DESC, utt_id LIMIT 25"))
def first_rows(spark, sf_dir):
    return ops.first_rows(I.lengths(spark, sf_dir), [F.desc("length"), "utt_id"], 25)


SAMPLE_TEXTS = ["Good morning.", "It is raining today.", "The meeting starts at nine."]


@query(
    "sample_grid",
    f"""SELECT s.speaker, t.sample, t.text FROM
          (SELECT DISTINCT source AS speaker FROM documents WHERE source IS NOT NULL ORDER BY 1 LIMIT 2) s
          CROSS JOIN (VALUES (1, '{SAMPLE_TEXTS[0]}'), (2, '{SAMPLE_TEXTS[1]}'), (3, '{SAMPLE_TEXTS[2]}'))
          t(sample, text)""",
)
def sample_grid(spark, sf_dir):
    return ops.sample_grid(top_speakers(spark, sf_dir), SAMPLE_TEXTS)


@query(
    "assemble_format_a",
    with_inputs(
        """SELECT utt_id, filepath AS filename, speaker, len(ids)::INTEGER AS seq_len, md5(array_to_string(ids, ','))
             AS ids_md5
           FROM (SELECT c.utt_id, c.filepath, c.speaker, list_concat(list_concat(list_concat([128259],
                   coalesce(p.ids, [])), [128009, 128260, 128261, 128257]), list_concat(flatten(fr), [128258])) AS ids
                 FROM cleaned c LEFT JOIN prompt_ids p USING (utt_id) JOIN frames f USING (utt_id))
           WHERE len(ids) <= 8192""",
        **PREPARED_SQL,
    ),
)
def assemble_format_a(spark, sf_dir):
    out = ops.assemble_a(with_layers(prompts(spark, sf_dir), spark, sf_dir))
    return out.select(
        "utt_id",
        F.col("filepath").alias("filename"),
        "speaker",
        F.col("seq_len").cast("int").alias("seq_len"),
        C.digest(F.col("input_ids")).alias("ids_md5"),
    )


@query(
    "assemble_format_b",
    with_inputs(
        """SELECT utt_id, speaker, len(audio_ids)::INTEGER AS audio_token_count,
             len(input_ids)::INTEGER AS sequence_length, md5(array_to_string(input_ids, ',')) AS ids_md5,
             md5(array_to_string(list_concat(list_transform(range(len(ids) + 3), lambda i: -100::BIGINT),
               input_ids[len(ids) + 4:]), ',')) AS labels_md5, duration_s
           FROM prepared""",
        **PREPARED_SQL,
    ),
)
def assemble_format_b(spark, sf_dir):
    return prepared(spark, sf_dir).select(
        "utt_id",
        "speaker",
        "audio_token_count",
        "sequence_length",
        C.digest(F.col("input_ids")).alias("ids_md5"),
        C.digest(F.col("labels")).alias("labels_md5"),
        "duration_s",
    )


@query(
    "generation_prompt_ids",
    with_inputs(
        """SELECT utt_id, md5(array_to_string(list_concat(list_concat([128259], coalesce(p.ids, [])),
             [128009, 128260, 128261, 128257]), ',')) AS prompt_md5, (len(coalesce(p.ids, [])) + 5)::INTEGER AS n
           FROM cleaned LEFT JOIN prompt_ids p USING (utt_id)""",
        **PREPARED_SQL,
    ),
)
def generation_prompt_ids(spark, sf_dir):
    ids = C.prompt_a(F.col("prompt_ids"))
    return prompts(spark, sf_dir).select("utt_id", C.digest(ids).alias("prompt_md5"), F.size(ids).alias("n"))


WAVE_SQL = {
    "waves": """
        SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE * CASE WHEN label < 5 THEN 4 ELSE 1 END) AS a,
          list_transform(embedding, lambda x: x::DOUBLE * 6) AS b, label >= 7 AS stereo FROM embeddings""",
    "mono": """
        SELECT vec_id, CASE WHEN stereo THEN list_transform(a, lambda x, i: (x + b[i]) / 2) ELSE a END AS m FROM waves""",
    "peaks": """SELECT vec_id, m, list_max(list_transform(m, lambda x: abs(x))) AS peak FROM mono""",
    "normal": """SELECT vec_id, peak, CASE WHEN peak > 1 THEN list_transform(m, lambda x: x / peak) ELSE m END AS s
        FROM peaks""",
}


def waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as sample arrays, scaled by label so that some peaks exceed 1; some labels have two channels."""
    first = F.transform("embedding", lambda x: x.cast("double") * F.when(F.col("label") < 5, 4).otherwise(1))
    second = F.transform("embedding", lambda x: x.cast("double") * 6)
    channels = F.when(F.col("label") >= 7, F.array(first, second)).otherwise(F.array(first))
    return I.table(spark, sf_dir, "embeddings").select("vec_id", channels.alias("channels"))


@query(
    "normalise_waveform",
    with_inputs(
        """SELECT vec_id, round(peak, 6) AS peak, round(list_sum(list_transform(s, lambda x: abs(x))), 6) AS sum_abs,
             round(list_max(list_transform(s, lambda x: abs(x))), 6) AS new_peak FROM normal""",
        **WAVE_SQL,
    ),
)
def normalise_waveform(spark, sf_dir):
    rows = ops.normalise_waveform(waveforms(spark, sf_dir))
    total = F.aggregate("samples", F.lit(0.0), lambda a, x: a + F.abs(x))
    top = F.array_max(F.transform("samples", lambda x: F.abs(x)))
    return rows.select(
        "vec_id", F.round("peak", 6).alias("peak"), F.round(total, 6).alias("sum_abs"), F.round(top, 6).alias("new_peak")
    )


@query(
    "to_pcm16",
    with_inputs(
        """SELECT vec_id, array_to_string(list_transform(s, lambda x: trunc(x * 32767)::INTEGER), ',') AS pcm
           FROM normal""",
        **WAVE_SQL,
    ),
)
def to_pcm16(spark, sf_dir):
    rows = ops.normalise_waveform(waveforms(spark, sf_dir))
    return rows.select("vec_id", C.join_ints(ops.to_pcm16(F.col("samples"))).alias("pcm"))
