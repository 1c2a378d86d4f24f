"""Inputs of the registered queries, derived by Spark from the test tables, and the same inputs as SQL.

Every derivation uses whole tables and whole texts. The SQL parts are named sub-queries; ``with_inputs`` puts those a
statement needs in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import frames as R
from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.operators.ordered import running_sums
from phonolake.operators.vocab import build_vocab
from phonolake.session import bound_batches, materialise
from phonolake.sources.readers import read_table

SAMPLES_PER_CHAR = 240
PAGE_SPEAKER = "page"
TEMPLATE = "{speaker_id}: {text}"


KEYS = {
    "documents": ["doc_id"],
    "events": ["event_id"],
    "pages": ["page_id"],
    "conversations": ["conv_id", "turn"],
    "embeddings": ["vec_id"],
}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A test table; ``spread`` for one that feeds costly work per row."""
    return read_table(spark, f"{sf_dir}/{name}.parquet", KEYS[name] if spread else None)


def audio_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings: one per document, and one per page; pages have no transcript."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("utt_id"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("filepath"),
        F.nullif("source", F.lit("src7")).alias("speaker"),
        (F.col("n_chars") * SAMPLES_PER_CHAR).alias("n_samples"),
        F.lit(T.SAMPLE_RATE).alias("sample_rate"),
    )
    pages = table(spark, sf_dir, "pages").select(
        (-1 - F.col("page_id")).alias("utt_id"),
        F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".wav")).alias("filepath"),
        F.lit(PAGE_SPEAKER).alias("speaker"),
        (F.length("html").cast("long") * SAMPLES_PER_CHAR).alias("n_samples"),
        F.lit(T.SAMPLE_RATE).alias("sample_rate"),
    )
    return docs.unionByName(pages)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts by file; labelled documents have a second, later entry."""
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("filename")
    docs = table(spark, sf_dir, "documents").select(name, "text", F.lit(0).alias("ord"))
    again = table(spark, sf_dir, "labels").select(name, F.lit("second copy").alias("text"), F.lit(1).alias("ord"))
    return docs.unionByName(again)


def source_rows(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Documents as labelled source rows: text, speaker (null for one source), samples and rate."""
    return table(spark, sf_dir, "documents", spread).select(
        F.col("doc_id").alias("utt_id"),
        "text",
        "lang",
        F.nullif("source", F.lit("src7")).alias("speaker"),
        (F.col("n_chars") * SAMPLES_PER_CHAR).alias("n_samples"),
        F.lit(T.SAMPLE_RATE).alias("sample_rate"),
    )


#: Frames whose codes are made at once.
FRAMES = 1 << 16


@F.arrow_udf(R.LAYERS)
def _layers(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for numbers, frames in batches:
        known = numbers.is_valid().to_numpy(zero_copy_only=False)
        u = numbers.fill_null(0).to_numpy().astype(np.int64)
        n = np.maximum(frames.fill_null(0).to_numpy().astype(np.int64), 0)
        at = 0
        while at < len(n):
            stop = max(at + 1, at + int(np.searchsorted(np.cumsum(n[at:]), FRAMES, "right")))
            layers = []
            for stride, by, step in ((1, 31, 17), (2, 37, 19), (4, 41, 23)):
                sizes = n[at:stop] * stride
                i = R.within(sizes)
                if stride == 1:
                    i = i // np.repeat(1 + u[at:stop] % 3, sizes)
                codes = (np.repeat(u[at:stop] % T.CODEBOOK * by, sizes) + i * step) % T.CODEBOOK
                layers.append(R.lists_of(sizes, codes, None if known[at:stop].all() else ~np.repeat(known[at:stop], sizes)))
            yield pa.StructArray.from_arrays(layers, ["l0", "l1", "l2"])
            at = stop


def add_codes(df: DataFrame) -> DataFrame:
    """Layer codes by formula from utt_id and the number of frames; the first layer has runs of equal codes."""
    bound_batches(df.sparkSession)
    n = C.frames_of_samples(F.col("n_samples"))
    df = df.withColumn("_layers", _layers(F.abs("utt_id"), n.cast("int")))
    return df.withColumns({f"l{k}": F.col(f"_layers.l{k}") for k in range(3)}).drop("_layers")


def codes(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return add_codes(source_rows(spark, sf_dir, spread=True).select("utt_id", "n_samples", *more))


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents, numbered in word order."""
    docs = table(spark, sf_dir, "documents", spread=True)
    return build_vocab(docs.select(F.explode(X.text_tokens(F.col("text"))).alias("token")))


def token_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token stream per user: errors are noise, sign-ups are numbers without a positive code, the others are codes
    whose slot follows from the number of codes before them."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("request_id"), "event_id", "event_type")
    is_code = ~F.col("event_type").isin("error", "signup")
    counts = {"seq": F.lit(1).cast("long"), "k": is_code.cast("long")}
    events = running_sums(events, ["request_id"], "event_id", counts)
    code = F.when(is_code, (F.col("event_id") * 37) % T.CODEBOOK).otherwise(-3)
    number = F.lit(T.CUSTOM_TOKEN_SHIFT) + (F.col("k") % T.SLOTS) * T.CODEBOOK + code
    text = F.when(F.col("event_type") == "error", "noise").otherwise(
        F.concat(F.lit("<custom_token_"), number.cast("string"), F.lit(">"))
    )
    return events.select("request_id", "seq", text.alias("text"))


def changing_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as sessions in which a configuration precedes every text; sessions of odd number cut at clauses."""
    turns = table(spark, sf_dir, "conversations")
    turn, conv = F.col("turn"), F.col("conv_id")
    granularity = F.when(conv % 2 == 1, "clause")
    fields = {f: F.lit(None).cast(k) for f, k in (("speaker", "string"), ("stream_audio", "boolean"),
              ("repetition_penalty", "double"), ("temperature", "double"), ("top_p", "double"))}
    config = turns.select(
        conv.alias("session_id"),
        (2 * turn).alias("seq"),
        F.lit("session.config").alias("type"),
        F.lit(None).cast("string").alias("text"),
        F.when(turn % 3 != 1, F.concat(F.lit("voice"), turn.cast("string"))).alias("voice"),
        granularity.alias("split_granularity"),
        F.when(turn % 2 == 0, "wav").alias("response_format"),
        F.when(turn % 3 == 2, (1000 + turn).cast("int")).alias("max_tokens"),
        *[c.alias(f) for f, c in fields.items()],
    )
    said = turns.select(conv.alias("session_id"), (2 * turn + 1).alias("seq"), F.lit("input.text").alias("type"), F.concat("text", F.lit(" and")).alias("text"))
    ends = turns.groupBy(conv.alias("session_id")).agg((2 * F.max("turn") + 2).alias("seq"))
    ends = ends.withColumn("type", F.lit("input.done"))
    return config.unionByName(said, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a granularity that changes from turn to turn, and every text in two messages."""
    rows = changing_messages(spark, sf_dir)
    number = F.floor(F.col("seq") / 2)
    clause = (F.col("type") == "session.config") & ((F.col("session_id") + number) % 3 == 1)
    rows = rows.withColumns({"split_granularity": F.when(clause, "clause"), "seq": 3 * number + F.col("seq") % 2})
    said = F.col("type") == "input.text"
    half = F.floor(F.length("text") / 2).cast("int")
    second = rows.where(said).withColumns({"text": F.substr("text", half + 1), "seq": F.col("seq") + 1})
    return rows.withColumn("text", F.substr("text", F.lit(1), half)).unionByName(second)


def uneven_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token stream with gaps, where sign-ups, one seq in thirteen and a run of them are left out, and with
    repeats: every fifth event comes twice, every eleventh again as noise."""
    events = token_events(spark, sf_dir)
    seq = F.col("seq")
    events = events.where(~F.col("text").endswith("-3>") & ~((seq % 13 == 4) | seq.between(12, 29)))
    again = events.where(seq % 5 == 0)
    noise = events.where(seq % 11 == 0).withColumn("text", F.lit("noise"))
    return events.unionByName(again).unionByName(noise)


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations: the audio tokens of a document, stray ids in front for one language, END_OF_SPEECH behind
    unless the document has no label."""
    rows = add_codes(
        table(spark, sf_dir, "documents", spread=True).select(
            F.col("doc_id").alias("utt_id"), "lang", (F.col("n_chars") * SAMPLES_PER_CHAR).alias("n_samples")
        )
    )
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("utt_id"), F.lit(True).alias("ended"))
    rows = rows.join(labelled, "utt_id", "left")
    stray = F.when(F.col("lang") == "de", F.array(F.lit(1000), F.lit(T.PAD))).otherwise(C.empty_ints())
    end = F.when(F.col("ended"), F.array(F.lit(T.END_OF_SPEECH), F.lit(T.END_OF_AI))).otherwise(C.empty_ints())
    audio = C.interleave(F.col("l0"), F.col("l1"), F.col("l2"))
    return rows.select("utt_id", F.concat(stray, audio, end).alias("ids"))


def session_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as sessions: system turns configure, other turns are text, one message at the end closes."""
    turns = table(spark, sf_dir, "conversations")
    is_config = F.col("role") == "system"
    null = F.lit(None)
    fields = {
        "voice": F.when(is_config, F.concat(F.lit("voice"), (F.col("conv_id") % 5).cast("string"))),
        "speaker": null.cast("string"),
        "split_granularity": null.cast("string"),
        "response_format": F.when(is_config, F.lit("wav")),
        "stream_audio": null.cast("boolean"),
        "repetition_penalty": null.cast("double"),
        "max_tokens": F.when(is_config, (1000 + F.length("text")).cast("int")),
        "temperature": null.cast("double"),
        "top_p": null.cast("double"),
    }
    said = turns.select(
        F.col("conv_id").alias("session_id"),
        F.col("turn").alias("seq"),
        F.when(is_config, "session.config").otherwise("input.text").alias("type"),
        F.when(~is_config, F.concat("text", F.lit(" "))).alias("text"),
        *[c.alias(n) for n, c in fields.items()],
    )
    ends = turns.groupBy(F.col("conv_id").alias("session_id")).agg((F.max("turn") + 1).alias("seq"))
    return said.unionByName(ends.withColumn("type", F.lit("input.done")), allowMissingColumns=True)


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("utt_id"), F.col("n_chars").alias("length"))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table of one sequence per document, as long as its text; ids by formula. Labels only where the document is
    labelled."""
    docs = table(spark, sf_dir, "documents", spread=True)
    labelled = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("has_labels"))
    rows = docs.select("doc_id", "n_chars").join(labelled, "doc_id", "left")
    ids = F.transform(
        C.index_range(F.col("n_chars")), lambda i: ((F.col("doc_id") * 13 + i * 7) % T.END_OF_TEXT).cast("int")
    )
    rows = rows.select(F.col("doc_id").alias("utt_id"), ids.alias("input_ids"), "has_labels")
    half = C.idiv(F.size("input_ids"), 2).cast("int")
    rest = F.slice("input_ids", half + 1, F.size("input_ids"))
    masked = F.concat(F.array_repeat(F.lit(T.IGNORE_LABEL), half), rest)
    return materialise(rows.select("utt_id", "input_ids", F.when(F.col("has_labels"), masked).alias("labels")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: first and last event, first view, and one 4096-byte chunk per view, in microseconds."""
    view = F.col("event_type") == "view"
    us = lambda c: F.timestamp_diff("MICROSECOND", F.lit("2024-01-01").cast("timestamp_ntz"), c)
    stamped = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("request_id"), us(F.col("ts").cast("timestamp_ntz")).alias("us"), view.alias("view")
    )
    return stamped.groupBy("request_id").agg(
        F.min("us").alias("start_us"),
        F.min(F.when(F.col("view"), F.col("us"))).alias("first_chunk_us"),
        F.max("us").alias("end_us"),
        F.count_if("view").alias("chunks"),
        (F.count_if("view") * 4096).alias("bytes"),
    )


# The same inputs in SQL. Lists count from 1 here.
INPUT_SQL = {
    "audio_rows": """
        SELECT doc_id AS utt_id, 'd' || doc_id || '.wav' AS filepath, nullif(source, 'src7') AS speaker,
               n_chars * 240 AS n_samples, 24000 AS sample_rate FROM documents
        UNION ALL
        SELECT -1 - page_id, 'p' || page_id || '.wav', 'page', length(html) * 240, 24000 FROM pages""",
    "metadata": """
        SELECT 'd' || doc_id || '.wav' AS filename, text, 0 AS ord FROM documents
        UNION ALL SELECT 'd' || doc_id || '.wav', 'second copy', 1 FROM labels""",
    "first_metadata": """
        SELECT filename, text, ord FROM
          (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY ord) AS rn FROM metadata) WHERE rn = 1""",
    "source_rows": """
        SELECT doc_id AS utt_id, text, nullif(source, 'src7') AS speaker, n_chars * 240 AS n_samples,
               24000 AS sample_rate FROM documents""",
    "codes": """
        SELECT utt_id, n_samples, f,
          list_transform(range(f), lambda i: (utt_id * 31 + (i // (1 + utt_id % 3)) * 17) % 4096) AS l0,
          list_transform(range(2 * f), lambda i: (utt_id * 37 + i * 19) % 4096) AS l1,
          list_transform(range(4 * f), lambda i: (utt_id * 41 + i * 23) % 4096) AS l2
        FROM (SELECT *, (n_samples + 2047) // 2048 AS f FROM source_rows)""",
    "frames": """
        SELECT utt_id, n_samples, f, l0, l1, l2, list_transform(range(f), lambda i: [
          l0[i + 1] + 128266, l1[2 * i + 1] + 132362, l2[4 * i + 1] + 136458, l2[4 * i + 2] + 140554,
          l1[2 * i + 2] + 144650, l2[4 * i + 3] + 148746, l2[4 * i + 4] + 152842]) AS fr FROM codes""",
    "deduped": """
        SELECT utt_id, n_samples,
          flatten(list_filter(fr, lambda x, i: i = 1 OR x[1] <> fr[i - 1][1])) AS audio_ids FROM frames""",
    "vocab": """
        SELECT token, (row_number() OVER (ORDER BY token) - 1)::INTEGER AS id FROM
          (SELECT DISTINCT unnest(regexp_extract_all(text, '[\\pL\\pM]+|\\pN+|[^\\x09-\\x0D\\x20\\pL\\pM\\pN]')) AS token FROM documents)""",
    "token_events": """
        SELECT request_id, seq, CASE WHEN event_type = 'error' THEN 'noise' ELSE '<custom_token_' ||
          (10 + (k % 7) * 4096 + CASE WHEN event_type = 'signup' THEN -3 ELSE (event_id * 37) % 4096 END) || '>'
          END AS text
        FROM (SELECT user_id AS request_id, event_id, event_type, row_number() OVER w - 1 AS seq,
                count(*) FILTER (event_type NOT IN ('error', 'signup')) OVER (PARTITION BY user_id ORDER BY event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS k
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))""",
    "changing_messages": """
        SELECT conv_id AS session_id, 2 * turn AS seq, 'session.config' AS type, NULL AS text,
          CASE WHEN turn % 3 <> 1 THEN 'voice' || turn END AS voice,
          CASE WHEN turn % 2 = 0 THEN 'wav' ELSE 'pcm' END AS response_format,
          CASE WHEN turn % 3 = 2 THEN 1000 + turn END AS max_tokens FROM conversations
        UNION ALL SELECT conv_id, 2 * turn + 1, 'input.text', text || ' and', NULL, NULL, NULL FROM conversations
        UNION ALL SELECT conv_id, 2 * max(turn) + 2, 'input.done', NULL, NULL, NULL, NULL FROM conversations
        GROUP BY 1""",
    "uneven_events": """
        SELECT * FROM (
          SELECT * FROM token_events UNION ALL SELECT * FROM token_events WHERE seq % 5 = 0
          UNION ALL SELECT request_id, seq, 'noise' FROM token_events
          WHERE seq % 11 = 0 AND NOT suffix(text, '-3>'))
        WHERE NOT suffix(text, '-3>') AND seq % 13 <> 4 AND NOT seq BETWEEN 12 AND 29""",
    "generated": """
        SELECT utt_id, list_concat(list_concat(
            CASE WHEN lang = 'de' THEN [1000, 128263] ELSE []::BIGINT[] END, flatten(fr)),
            CASE WHEN l.doc_id IS NOT NULL THEN [128258, 128262] ELSE []::BIGINT[] END) AS ids
        FROM frames JOIN documents d ON d.doc_id = utt_id LEFT JOIN labels l ON l.doc_id = utt_id""",
    "session_messages": """
        SELECT conv_id AS session_id, turn AS seq,
          CASE WHEN role = 'system' THEN 'session.config' ELSE 'input.text' END AS type,
          CASE WHEN role <> 'system' THEN text || ' ' END AS text,
          CASE WHEN role = 'system' THEN 'voice' || (conv_id % 5) END AS voice,
          CASE WHEN role = 'system' THEN 'wav' END AS response_format,
          CASE WHEN role = 'system' THEN 1000 + length(text) END AS max_tokens
        FROM conversations
        UNION ALL SELECT conv_id, max(turn) + 1, 'input.done', NULL, NULL, NULL, NULL FROM conversations GROUP BY 1""",
    "lengths": "SELECT doc_id AS utt_id, n_chars AS length FROM documents",
    "sequences": """
        SELECT utt_id, input_ids, CASE WHEN labelled THEN list_concat(
            list_transform(range(len(input_ids) // 2), lambda i: -100::BIGINT),
            input_ids[len(input_ids) // 2 + 1:]) END AS labels
        FROM (SELECT d.doc_id AS utt_id, l.doc_id IS NOT NULL AS labelled,
                list_transform(range(n_chars), lambda i: (d.doc_id * 13 + i * 7) % 128009) AS input_ids
              FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)""",
    "requests": """
        SELECT user_id AS request_id, min(us) AS start_us, min(us) FILTER (event_type = 'view') AS first_chunk_us,
          max(us) AS end_us, count(*) FILTER (event_type = 'view') AS chunks,
          4096 * count(*) FILTER (event_type = 'view') AS bytes
        FROM (SELECT *, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS us FROM events) GROUP BY 1""",
}


def with_inputs(statement: str, **more: str) -> str:
    """``statement`` behind the named inputs it uses, directly, through other inputs, or through themselves."""
    known = INPUT_SQL | more
    needed: list[str] = []
    opened: set[str] = set()
    recursive = False

    def visit(sql: str, within: str = "") -> None:
        nonlocal recursive
        for name, body in known.items():
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                recursive |= name == within
                if name not in opened:
                    opened.add(name)
                    visit(body, name)
                    needed.append(name)

    visit(statement)
    head = ",\n".join(f"{name} AS ({known[name]})" for name in needed)
    return f"WITH {'RECURSIVE ' * recursive}{head}\n{statement}" if needed else statement
