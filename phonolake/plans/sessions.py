"""Queries over text sessions, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import text as X
from phonolake.operators import sessions as ops
from phonolake.operators import telemetry
from phonolake.plans import inputs as I
from phonolake.plans.generated import WINDOWS_SQL, _pick
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query
from phonolake.plans.text import WS_SQL, sentences_sql, sql_text
from phonolake.session import scratch_dir
from phonolake.sources import streams
from phonolake.streaming.run import run_to_table, run_updates_to_table
from phonolake.streaming.sessions import segment_sessions, stream_session_totals
from phonolake.streaming.windows import stream_windows

SENTENCES_SQL = {
    "session_pieces": f"""
        SELECT session_id, {sentences_sql("string_agg(text, '' ORDER BY seq)", "sentence")} AS s FROM session_messages
        WHERE type = 'input.text' GROUP BY session_id""",
    "session_sentences": """
        SELECT session_id, generate_subscripts(s, 1) - 1 AS sentence_index, unnest(s) AS sentence_text
        FROM session_pieces""",
    "final_config": """
        SELECT session_id, coalesce(max_by(voice, seq) FILTER (voice IS NOT NULL), 'Metin') AS voice,
          coalesce(max_by(max_tokens, seq) FILTER (max_tokens IS NOT NULL), 2000)::INTEGER AS max_tokens,
          coalesce(max_by(response_format, seq) FILTER (response_format IS NOT NULL), 'pcm') AS response_format
        FROM session_messages GROUP BY session_id""",
}


@query(
    "session_sentences",
    with_inputs("SELECT session_id, sentence_index, sentence_text FROM session_sentences", **SENTENCES_SQL),
)
def session_sentences(spark, sf_dir):
    return ops.session_sentences(I.session_messages(spark, sf_dir))


@query(
    "fold_session_config",
    with_inputs(
        """SELECT session_id, seq, type, coalesce(last_value(voice IGNORE NULLS) OVER w, 'Metin') AS voice,
             coalesce(last_value(max_tokens IGNORE NULLS) OVER w, 2000)::INTEGER AS max_tokens,
             coalesce(last_value(response_format IGNORE NULLS) OVER w, 'pcm') AS response_format,
             1.1::DOUBLE AS repetition_penalty, 0.4::DOUBLE AS temperature, 0.5::DOUBLE AS top_p,
             'sentence' AS split_granularity, true AS stream_audio
           FROM session_messages
           WINDOW w AS (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    ),
)
def fold_session_config(spark, sf_dir):
    return ops.fold_session_config(I.session_messages(spark, sf_dir))


# A sentence belongs to the first text message that reaches behind its end, else to the end of the session.
REQUESTS_SQL = {
    "config_at": """
        SELECT session_id, seq, coalesce(last_value(voice IGNORE NULLS) OVER w, 'Metin') AS voice,
          coalesce(last_value(max_tokens IGNORE NULLS) OVER w, 2000)::INTEGER AS max_tokens,
          coalesce(last_value(response_format IGNORE NULLS) OVER w, 'pcm') AS response_format
        FROM changing_messages
        WINDOW w AS (PARTITION BY session_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "session_granularity": """
        SELECT session_id, max(seq) AS done_seq, string_agg(text, '' ORDER BY seq) AS text,
          session_id % 2 = 1 AS by_clause FROM changing_messages GROUP BY 1""",
    "raw_pieces": f"""
        SELECT session_id, done_seq, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM
          (SELECT session_id, done_seq, CASE WHEN by_clause
             THEN regexp_extract_all(text, {sql_text(X.piece_pattern("clause"))})
             ELSE regexp_extract_all(text, {sql_text(X.piece_pattern("sentence"))}) END AS p
           FROM session_granularity)""",
    "piece_ends": f"""
        SELECT session_id, done_seq, k, trim(piece, {WS_SQL}) AS sentence_text,
          sum(length(piece)) OVER (PARTITION BY session_id ORDER BY k) AS piece_end FROM raw_pieces""",
    "message_ends": """
        SELECT session_id, seq, sum(length(text)) OVER (PARTITION BY session_id ORDER BY seq) AS message_end
        FROM changing_messages WHERE type = 'input.text'""",
    "requests_at": """
        SELECT p.session_id, k, sentence_text, coalesce(min(m.seq), any_value(done_seq)) AS seq
        FROM piece_ends p LEFT JOIN message_ends m ON m.session_id = p.session_id AND m.message_end > p.piece_end
        WHERE sentence_text <> '' GROUP BY ALL""",
}


@query(
    "sentence_requests",
    with_inputs(
        """SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY k) - 1 AS sentence_index,
             sentence_text, voice, max_tokens, response_format
           FROM requests_at JOIN config_at USING (session_id, seq)""",
        **REQUESTS_SQL,
    ),
)
def sentence_requests(spark, sf_dir):
    """Sessions that are configured again between their texts, half of them with clauses from the start."""
    rows = ops.sentence_requests(I.changing_messages(spark, sf_dir))
    return rows.select("session_id", "sentence_index", "sentence_text", "voice", "max_tokens", "response_format")


# The buffer's fold, message by message: pieces but the last one are certain, the end of the session makes that certain too.
_PIECES = f"""CASE WHEN x.g THEN regexp_extract_all(a.r || x.t, {sql_text(X.piece_pattern("clause"))})
  ELSE regexp_extract_all(a.r || x.t, {sql_text(X.piece_pattern("sentence"))}) END"""
MIXED_SQL = {
    "mixed_said": """
        SELECT conv_id AS session_id, 3 * turn + 1 + h AS seq, (conv_id + turn) % 3 = 1 AS g, false AS d,
          CASE WHEN h = 0 THEN left(text || ' and', length(text || ' and') // 2)
            ELSE substr(text || ' and', length(text || ' and') // 2 + 1) END AS t, turn
        FROM conversations, (VALUES (0), (1)) v(h)
        UNION ALL SELECT conv_id, 3 * max(turn) + 3, (conv_id + max(turn)) % 3 = 1, true, '', max(turn)
        FROM conversations GROUP BY conv_id""",
    "mixed_folds": f"""
        SELECT session_id, list_reduce(
          list({{'t': t, 'g': g, 'd': d, 'q': seq, 'r': '', 'o': []::STRUCT(p VARCHAR, q BIGINT)[]}} ORDER BY seq),
          lambda a, x: {{'t': x.t, 'g': x.g, 'd': x.d, 'q': x.q,
            'r': CASE WHEN x.d THEN '' ELSE coalesce(({_PIECES})[-1], '') END,
            'o': list_concat(a.o, list_transform(CASE WHEN x.d THEN {_PIECES} ELSE ({_PIECES})[:-2] END,
              lambda p: {{'p': trim(p, {WS_SQL}), 'q': x.q}}))}},
          {{'t': '', 'g': false, 'd': false, 'q': 0::BIGINT, 'r': '', 'o': []::STRUCT(p VARCHAR, q BIGINT)[]}}).o AS o
        FROM mixed_said GROUP BY session_id""",
    "mixed_config": """
        SELECT s.session_id, s.seq, coalesce(last_value(voice IGNORE NULLS) OVER w, 'Metin') AS voice,
          coalesce(last_value(max_tokens IGNORE NULLS) OVER w, 2000)::INTEGER AS max_tokens,
          CASE WHEN s.turn % 2 = 0 THEN 'wav' ELSE 'pcm' END AS response_format
        FROM mixed_said s JOIN changing_messages c ON c.session_id = s.session_id AND c.seq = 2 * s.turn
        WINDOW w AS (PARTITION BY s.session_id ORDER BY s.seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
}


@query(
    "sentence_requests_mixed",
    with_inputs(
        """SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY k) - 1 AS sentence_index,
             p AS sentence_text, voice, max_tokens, response_format
           FROM (SELECT session_id, k, o[k].p AS p, o[k].q AS seq FROM
                  (SELECT session_id, o, unnest(range(1, len(o) + 1)) AS k FROM mixed_folds)
                 WHERE o[k].p <> '')
             JOIN mixed_config USING (session_id, seq)""",
        **MIXED_SQL,
    ),
)
def sentence_requests_mixed(spark, sf_dir):
    """Sessions whose granularity changes from turn to turn."""
    rows = ops.sentence_requests(I.mixed_messages(spark, sf_dir))
    return rows.select("session_id", "sentence_index", "sentence_text", "voice", "max_tokens", "response_format")


UNSUPPORTED_SQL = """
    SELECT conv_id AS session_id, turn AS seq, 'unsupported message type: ' || role AS error FROM conversations
    WHERE role <> 'user'"""


@query("unsupported_messages", UNSUPPORTED_SQL)
def unsupported_messages(spark, sf_dir):
    """Turns as messages whose type is their role, of which only the user's is known."""
    turns = I.table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "input.text").otherwise(F.col("role"))
    rows = turns.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), kind.alias("type"), "text")
    return ops.unsupported_messages(rows)


def chunks(spark, sf_dir) -> DataFrame:
    """Audio chunks per session: one per sentence, as long as its text; a sentence without a space has failed."""
    rows = ops.session_sentences(I.session_messages(spark, sf_dir))
    return rows.select(
        "session_id",
        "sentence_index",
        (F.length("sentence_text") * 2).cast("long").alias("bytes"),
        (~F.contains("sentence_text", F.lit(" "))).alias("error"),
    )


TOTALS_SQL = """
    SELECT session_id, count(*) AS total_sentences, sum(2 * length(sentence_text))::BIGINT AS total_bytes,
      count(*) FILTER (NOT contains(sentence_text, ' ')) AS failed_sentences
    FROM session_sentences GROUP BY 1"""


@query("session_totals", with_inputs(TOTALS_SQL, **SENTENCES_SQL))
def session_totals(spark, sf_dir):
    return telemetry.session_totals(chunks(spark, sf_dir))


@query(
    "assemble_audio",
    with_inputs(
        """SELECT session_id, 0::BIGINT AS part, count(*) AS chunks, 0::BIGINT AS byte_offset,
             md5('52494646FFFFFFFF57415645666D74201000000001000100C05D000080BB00000200100064617461FFFFFFFF' ||
               hex(string_agg(text, '' ORDER BY seq))) AS wav_md5
           FROM session_messages WHERE type = 'input.text' GROUP BY 1"""
    ),
)
def assemble_audio(spark, sf_dir):
    """The bytes of each text message stand for its audio."""
    rows = I.session_messages(spark, sf_dir).where(F.col("type") == "input.text")
    audio = ops.assemble_audio(rows.select("session_id", "seq", F.encode("text", "UTF-8").alias("chunk")))
    return audio.select("session_id", "part", "chunks", "byte_offset", F.md5(F.hex("wav")).alias("wav_md5"))


def message_files(spark, sf_dir) -> str:
    """Session messages as JSON files, spread so that the messages of a session come in different micro-batches."""
    rows = I.session_messages(spark, sf_dir)
    fields = [f.name for f in ops.MESSAGE_SCHEMA]
    payload = rows.select("session_id", "seq", F.to_json(F.struct(*fields)).alias("payload"))
    path = scratch_dir(spark)
    payload.repartition(2 * spark.sparkContext.defaultParallelism, "session_id", "seq").write.json(path)
    return path


def session_events(spark, sf_dir) -> DataFrame:
    files = message_files(spark, sf_dir)
    stream = streams.read_session_stream(spark, files, spark.sparkContext.defaultParallelism, "long")
    return run_to_table(segment_sessions(stream, None))


@query(
    "stream_session_sentences",
    with_inputs("SELECT session_id, sentence_index, sentence_text FROM session_sentences", **SENTENCES_SQL),
)
def stream_session_sentences(spark, sf_dir):
    events = session_events(spark, sf_dir)
    return events.where(F.col("kind") == "sentence").select("session_id", "sentence_index", "sentence_text")


@query(
    "stream_session_ends",
    with_inputs(
        """SELECT c.session_id, coalesce(n, 0) AS total_sentences, voice, max_tokens, response_format
           FROM final_config c LEFT JOIN (SELECT session_id, count(*) AS n FROM session_sentences GROUP BY 1)
             USING (session_id)""",
        **SENTENCES_SQL,
    ),
)
def stream_session_ends(spark, sf_dir):
    events = session_events(spark, sf_dir).where(F.col("kind") == "done")
    cols = ["voice", "max_tokens", "response_format"]
    return events.select("session_id", F.col("sentence_index").alias("total_sentences"), *cols)


@query("stream_session_totals", with_inputs(TOTALS_SQL, **SENTENCES_SQL))
def stream_totals(spark, sf_dir):
    path = scratch_dir(spark)
    rows = chunks(spark, sf_dir)
    rows.repartition(2 * spark.sparkContext.defaultParallelism, "session_id", "sentence_index").write.parquet(path)
    stream = (
        spark.readStream.schema(rows.schema)
        .option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism)
        .parquet(path)
    )
    return run_updates_to_table(stream_session_totals(stream), "session_id")


@query(
    "stream_windows",
    with_inputs(
        f"""SELECT request_id, token_index, array_to_string({_pick([0])}, ',') AS l0,
              array_to_string({_pick([1, 4])}, ',') AS l1, array_to_string({_pick([2, 3, 5, 6])}, ',') AS l2
            FROM windows""",
        **WINDOWS_SQL,
    ),
)
def windows_of_stream(spark, sf_dir):
    path = scratch_dir(spark)
    events = I.token_events(spark, sf_dir)
    events.repartition(2 * spark.sparkContext.defaultParallelism, "request_id", "seq").write.parquet(path)
    stream = streams.read_token_stream(spark, path, spark.sparkContext.defaultParallelism, "long")
    rows = run_to_table(stream_windows(stream, None))
    return rows.select("request_id", "token_index", *[C.join_ints(F.col(f"l{n}")).alias(f"l{n}") for n in range(3)])


@query(
    "clause_requests",
    f"""SELECT conv_id, turn, (generate_subscripts(s, 1) - 1)::INTEGER AS sentence_index, unnest(s) AS sentence_text
        FROM (SELECT conv_id, turn, {sentences_sql("text", "clause")} AS s FROM conversations)""",
)
def clause_requests(spark, sf_dir):
    turns = I.table(spark, sf_dir, "conversations", spread=True)
    pieces = X.sentences(F.col("text"), "clause")
    return turns.select("conv_id", "turn", F.posexplode(pieces).alias("sentence_index", "sentence_text"))
