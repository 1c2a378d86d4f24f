"""Queries that write whole tables in an input form and read them back, and jobs over what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import tokens as T
from phonolake.functions.sql import register
from phonolake.operators import telemetry
from phonolake.plans import corpus as PC
from phonolake.plans import inputs as I
from phonolake.plans import jobs
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query
from phonolake.plans.text import sentences_sql
from phonolake.session import scratch_dir
from phonolake.sources import readers, writers

AS_WRITTEN = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "header": True}


@query(
    "metadata_roundtrip",
    """SELECT 'd' || doc_id || '.wav' AS filename, md5(replace(text, chr(10), ' ')) AS text_md5 FROM documents""",
)
def metadata_roundtrip(spark, sf_dir):
    """Documents as pipe-separated file names and texts of one line."""
    docs = I.table(spark, sf_dir, "documents")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".wav"))
    path = scratch_dir(spark)
    rows = docs.select(name.alias("filename"), F.translate("text", "\n", " ").alias("text"))
    rows.write.options(sep="|", **AS_WRITTEN).csv(path)
    return readers.read_metadata(spark, path).select("filename", F.md5("text").alias("text_md5"))


@query(
    "audio_shards",
    """SELECT 'd' || doc_id AS filepath, md5(text) AS audio_md5, source AS speaker, lang AS speaker_id FROM documents""",
)
def audio_shards(spark, sf_dir):
    """The bytes of each text as audio, in shards with a column that is not used."""
    docs = I.table(spark, sf_dir, "documents")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    path = scratch_dir(spark)
    rows = docs.select(
        name.alias("filepath"),
        F.encode("text", "UTF-8").alias("audio"),
        F.col("source").alias("speaker"),
        F.col("lang").alias("speaker_id"),
        "n_chars",
    )
    rows.write.parquet(path)
    return readers.read_audio_shards(spark, path).select("filepath", F.md5("audio").alias("audio_md5"), "speaker", "speaker_id")


@query("dataset_split", "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id % 10 <> 0")
def dataset_split(spark, sf_dir):
    """The training split of the documents; every tenth is of the test split."""
    docs = I.table(spark, sf_dir, "documents")
    path = scratch_dir(spark)
    split = F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train")
    docs.withColumn("split", split).write.partitionBy("split").parquet(path)
    return readers.read_split(spark, path).select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "telemetry_documents",
    """SELECT coalesce(e.request_id, d.request_id, t.request_id) AS request_id, e.callback_count, d.invalid_events,
         t.total_bytes
       FROM (SELECT 'req-' || conv_id AS request_id, count(*) AS callback_count FROM conversations
             WHERE role = 'user' GROUP BY 1) e
       FULL JOIN (SELECT 'req-' || conv_id AS request_id, count(*) AS invalid_events FROM conversations
                  WHERE role = 'system' GROUP BY 1) d ON e.request_id = d.request_id
       FULL JOIN (SELECT 'req-' || conv_id AS request_id, sum(length(text))::BIGINT AS total_bytes FROM conversations
                  WHERE role = 'assistant' GROUP BY 1) t ON coalesce(e.request_id, d.request_id) = t.request_id""",
)
def telemetry_documents(spark, sf_dir):
    """Documents of the three kinds from all turns, by role, written as JSON, read and joined."""
    turns = I.table(spark, sf_dir, "conversations")
    name = F.concat(F.lit("req-"), F.col("conv_id").cast("string")).alias("request_id")
    path = scratch_dir(spark)
    kinds = {
        "engine": ("user", F.count("*").alias("callback_count")),
        "decoder": ("system", F.count("*").alias("invalid_events")),
        "transport": ("assistant", F.sum(F.length("text")).alias("total_bytes")),
    }
    for kind, (role, value) in kinds.items():
        turns.where(F.col("role") == role).groupBy(name).agg(value).write.json(f"{path}/{kind}")
    joined = telemetry.join_telemetry(**readers.read_telemetry(spark, path, collected=True))
    return joined.select(
        "request_id",
        F.col("engine_callback_count").alias("callback_count"),
        F.col("decoder_invalid_events").alias("invalid_events"),
        F.col("transport_total_bytes").alias("total_bytes"),
    )


@query(
    "telemetry_further_fields",
    """SELECT 'engine' AS kind, 'model' AS field, count(*) AS documents, sum(n)::BIGINT AS total FROM
         (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY 1) WHERE conv_id % 3 = 0
       HAVING count(*) > 0
       UNION ALL SELECT 'decoder', 'gpu', count(*), sum(2 * n)::BIGINT FROM
         (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'system' GROUP BY 1) WHERE conv_id % 2 = 0
       HAVING count(*) > 0""",
)
def telemetry_further_fields(spark, sf_dir):
    """Documents of which some have fields that no schema knows; their values come out of the whole documents."""
    turns = I.table(spark, sf_dir, "conversations")
    path, conv, n = scratch_dir(spark), F.col("conv_id"), F.count("*")
    name = F.concat(F.lit("req-"), conv.cast("string")).alias("request_id")
    of = lambda role: turns.where(F.col("role") == role).groupBy("conv_id")
    model = F.when(conv % 3 == 0, F.struct(F.col("n").alias("layers")))
    of("user").agg(n.alias("n")).select(name, F.col("n").alias("callback_count"), model.alias("model")).write.json(f"{path}/engine")
    gpu = F.when(conv % 2 == 0, 2 * F.col("n"))
    of("system").agg(n.alias("n")).select(name, F.col("n").alias("invalid_events"), gpu.alias("gpu")).write.json(f"{path}/decoder")
    of("assistant").agg(n.alias("total_bytes")).select(name, "total_bytes").write.json(f"{path}/transport")
    documents = readers.read_documents(spark, path, collected=True)
    counts = readers.further_fields(documents)
    values = {"engine": "$.model.layers", "decoder": "$.gpu", "transport": "$.none"}
    totals = [
        df.agg(F.sum(F.try_variant_get("document", values[kind], "long")).alias("total")).withColumn("kind", F.lit(kind))
        for kind, df in documents.items()
    ]
    return counts.join(totals[0].unionByName(totals[1]).unionByName(totals[2]), "kind").select("kind", "field", "documents", "total")


@query("write_pointer", "SELECT 'parquet' AS format, ceil(count(*) / 100)::BIGINT AS num_shards FROM documents")
def write_pointer(spark, sf_dir):
    """The pointer of a sharded set, and the shards that it stands for."""
    path = scratch_dir(spark)
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text")
    writers.write_pointer(spark, path, writers.write_shards(docs, path, ["doc_id"], 100))
    there = readers.read_shards(spark, path).agg(F.count_distinct("shard").alias("there"))
    pointer = spark.read.schema("format string, data_dir string, num_shards long").json(f"{path}/pointer")
    return pointer.join(there, F.col("num_shards") == F.col("there")).select("format", "num_shards")


@query("write_mode_ignore", "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE doc_id % 2 = 0")
def write_mode_ignore(spark, sf_dir):
    """A typed set that is there stays as it is when it is written again."""
    docs = I.table(spark, sf_dir, "documents")
    ids = F.array(F.col("doc_id").cast("int"))
    rows = docs.select(
        ids.alias("input_ids"), ids.alias("labels"), F.array(F.lit(1)).alias("attention_mask"), "doc_id", "text",
        F.col("source").alias("speaker_id"), F.lit(1.0).alias("duration_s"), F.lit(7).alias("audio_token_count"),
        F.lit(1).alias("sequence_length"),
    )
    path = scratch_dir(spark)
    for rest in (0, 1):
        writers.write_typed(rows.where(F.col("doc_id") % 2 == rest).drop("doc_id"), path, "ignore")
    back = readers.read_training_set(spark, path)
    return back.select(F.col("input_ids")[0].cast("long").alias("doc_id"), F.md5("text").alias("text_md5"))


@query(
    "sql_token_functions",
    with_inputs(
        """SELECT request_id, seq, try_cast(nullif(regexp_extract(text, '<custom_token_([0-9+-]+)>$', 1), '') AS BIGINT)
             AS number, (seq // 7)::INTEGER AS frames,
             CASE WHEN seq >= 7 THEN array_to_string(range(7 * (seq // 7) - 7, 7 * (seq // 7)), ',') END AS last_frame
           FROM token_events"""
    ),
)
def sql_token_functions(spark, sf_dir):
    """Number of every token text, and the frames of as many tokens as came before it."""
    register(spark)
    I.token_events(spark, sf_dir).createOrReplaceTempView("phonolake_token_events")
    rows = spark.sql(
        """SELECT request_id, seq, token_number(text) AS number,
             token_frames(transform(slice(sequence(0, cast(seq as int)), 1, cast(seq as int)), x -> x)) AS framed
           FROM phonolake_token_events"""
    )
    last = F.when(F.size("framed") > 0, F.array_join(F.element_at("framed", -1), ","))
    whole = F.filter("framed", lambda f: F.size(f) == T.SLOTS)
    return rows.select("request_id", "seq", "number", F.size(whole).alias("frames"), last.alias("last_frame"))


@query(
    "sql_table_functions",
    f"""SELECT conv_id, turn, 'sentence' AS kind, (generate_subscripts(s, 1) - 1)::INTEGER AS n, unnest(s) AS item
        FROM (SELECT conv_id, turn, {sentences_sql("text", "sentence")} AS s FROM conversations)
        UNION ALL SELECT conv_id, turn, 'clause', (generate_subscripts(s, 1) - 1)::INTEGER, unnest(s)
        FROM (SELECT conv_id, turn, {sentences_sql("text", "clause")} AS s FROM conversations)
        UNION ALL SELECT conv_id, turn, 'frame', f::INTEGER, array_to_string(range(7 * f, least(7 * f + 7, turn * 9 + 8)), ',')
        FROM (SELECT conv_id, turn, unnest(range((turn * 9 + 8) // 7)) AS f FROM conversations)""",
)
def sql_table_functions(spark, sf_dir):
    """One statement without DataFrame code: rows of sentences, clauses and frames of every turn."""
    register(spark)
    I.table(spark, sf_dir, "conversations").createOrReplaceTempView("phonolake_turns")
    return spark.sql(
        """SELECT conv_id, turn, 'sentence' AS kind, sentence_index AS n, sentence_text AS item
           FROM phonolake_turns, LATERAL sentence_rows(text)
           UNION ALL SELECT conv_id, turn, 'clause', sentence_index, sentence_text
           FROM phonolake_turns, LATERAL clause_rows(text)
           UNION ALL SELECT conv_id, turn, 'frame', frame, array_join(cast(tokens AS array<string>), ',')
           FROM phonolake_turns, LATERAL frame_rows(sequence(0, cast(turn * 9 + 7 AS int)))"""
    )


@query(
    "prepare_manifest_job",
    with_inputs(
        """SELECT filename, speaker, len(ids)::INTEGER AS seq_len, md5(array_to_string(ids, ',')) AS ids_md5,
             (row_number() OVER (ORDER BY n_samples, utt_id) - 1) // 512 AS shard
           FROM (SELECT a.utt_id, a.filepath AS filename, a.speaker, a.n_samples, list_concat(list_concat(
                   list_concat([128259], coalesce(p.ids, [])), [128009, 128260, 128261, 128257]),
                   list_concat(flatten(fr), [128258])) AS ids
                 FROM attached a LEFT JOIN manifest_ids p USING (utt_id) JOIN frames f USING (utt_id))
           WHERE len(ids) <= 8192""",
        **PC.PREPARED_SQL,
        manifest_ids="""
            SELECT utt_id, list(coalesce(v.id, -1) ORDER BY pos) AS ids FROM
              (SELECT utt_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM
                (SELECT utt_id, regexp_extract_all(CASE WHEN coalesce(speaker, '') <> '' THEN speaker || ': ' || text
                   ELSE text END, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]') AS words FROM attached))
              LEFT JOIN vocab v USING (token) GROUP BY utt_id""",
    ),
)
def prepare_manifest_job(spark, sf_dir):
    """Recordings with text as a manifest, prepared in the order of their length."""
    path = scratch_dir(spark)
    rows = PC.ops.attach_text(I.audio_rows(spark, sf_dir), I.metadata(spark, sf_dir))
    manifest = rows.select("utt_id", F.col("filepath").alias("wav_path"), "speaker", "text", F.col("n_samples").alias("frames"))
    layers = I.codes(spark, sf_dir).drop("n_samples")
    jobs.prepare_manifest(manifest, layers, I.vocab(spark, sf_dir), path)
    ids = C.digest(F.col("input_ids")).alias("ids_md5")
    return readers.read_shards(spark, path).select("filename", "speaker", "seq_len", ids, "shard")
