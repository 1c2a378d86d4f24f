"""Text sessions as tables: messages (session_id, seq, type, …) to configuration and sentences.

``seq`` is 0-based and unique per session. Messages behind the first ``input.done`` of a session are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.functions.codes import idiv
from phonolake.functions.schema import struct
from phonolake.operators.joins import lookup_join
from phonolake.operators.ordered import carry_forward, join_on, number_rows, running_sum
from phonolake.session import materialise

MESSAGE_SCHEMA = struct(
    type="string",
    text="string",
    voice="string",
    speaker="string",
    split_granularity="string",
    response_format="string",
    stream_audio="boolean",
    repetition_penalty="double",
    max_tokens="int",
    temperature="double",
    top_p="double",
)
MESSAGE_TYPES = ["session.config", "input.text", "input.done"]
STICKY = {
    "voice": T.DEFAULT_VOICE,
    "repetition_penalty": T.DEFAULT_REPETITION_PENALTY,
    "max_tokens": T.DEFAULT_MAX_TOKENS,
    "temperature": T.DEFAULT_TEMPERATURE,
    "top_p": T.DEFAULT_TOP_P,
}
RESET = {
    "split_granularity": T.DEFAULT_GRANULARITY,
    "response_format": T.DEFAULT_RESPONSE_FORMAT,
    "stream_audio": True,
}


def open_messages(messages: DataFrame) -> DataFrame:
    """Messages up to and with the first ``input.done``; ``done_seq`` is null for a session without one, and
    ``last_text_seq`` is the last message with text."""
    has_text = (F.col("type") == "input.text") & (F.coalesce(F.col("text"), F.lit("")) != "")
    facts = messages.groupBy("session_id").agg(
        F.min(F.when(F.col("type") == "input.done", F.col("seq"))).alias("done_seq"),
        F.max(F.when(has_text, F.col("seq"))).alias("last_text_seq"),
    )
    marked = lookup_join(messages, facts, "session_id", "left")
    return marked.where(F.col("done_seq").isNull() | (F.col("seq") <= F.col("done_seq")))


def unsupported_messages(messages: DataFrame) -> DataFrame:
    """Error rows for messages of an unknown type."""
    known = F.coalesce(F.col("type").isin(MESSAGE_TYPES), F.lit(False))
    kind = F.coalesce(F.col("type"), F.lit("None"))
    return open_messages(messages).where(~known).select(
        "session_id", "seq", F.concat(F.lit("unsupported message type: "), kind).alias("error")
    )


def fold_session_config(messages: DataFrame) -> DataFrame:
    """Configuration in force at each message.

    Voice and numbers stay until a later message sets them; the other fields fall back to their default with every
    configuration message that leaves them out.
    """
    is_config = F.col("type") == "session.config"
    cols = {"voice": F.when(is_config, X.first_filled(F.col("voice"), F.col("speaker")))}
    cols |= {c: F.when(is_config, F.col(c)) for c in STICKY if c != "voice"}
    cols |= {c: F.when(is_config, F.coalesce(F.col(c), F.lit(d))) for c, d in RESET.items()}
    wanted = open_messages(messages).select("session_id", "seq", "type", *[e.alias(c) for c, e in cols.items()])
    folded = carry_forward(wanted, ["session_id"], "seq", list(cols))
    return folded.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in (STICKY | RESET).items()})


def session_sentences(messages: DataFrame, granularity: str = "sentence") -> DataFrame:
    """Sentences of each session's concatenated text (session_id, sentence_index, sentence_text), all cut alike."""
    return placed_sentences(messages, granularity).drop("seq")


def placed_sentences(messages: DataFrame, granularity: str) -> DataFrame:
    """Sentences with ``seq``, the message that made their end certain: where the next one begins, else the last.

    The text of a session is never put together whole. Each message is cut by itself; what it needs to know of the
    messages before it is one bit, whether they end in a mark and closing characters, so that the next other
    character starts a new sentence, and the number of cuts before it. Both come from a narrow table without text.
    Sentences whose end is not certain yet are given only for sessions that are done.
    """
    marks, closing = X.char_class(X.marks_of(granularity)), X.char_class(T.CLOSING_CHARS)
    texts = open_messages(messages).where((F.col("type") == "input.text") & (F.col("text") != ""))
    lead = F.regexp_extract("text", f"\\A[{closing}]*", 0)

    def pieces(col):
        return F.regexp_extract_all(col, F.lit(X.piece_pattern(granularity)), F.lit(0))

    # With a pending cut the leading closing characters belong to the sentence before, and the cut is behind them.
    whole, behind = pieces(F.col("text")), pieces(F.substr("text", F.length(lead) + 1))
    only_closing = F.col("text") == lead
    facts = materialise(
        texts.select(
            "session_id",
            "seq",
            F.when(~only_closing, F.col("text").rlike(f"[{marks}][{closing}]*\\z")).alias("pending"),
            F.greatest(F.size(whole) - 1, F.lit(0)).cast("long").alias("cuts"),
            F.size(behind).cast("long").alias("cuts_pending"),
        )
    )
    facts = materialise(carry_forward(facts, ["session_id"], "seq", ["pending"], include_self=False))
    cuts = F.when(F.coalesce("pending", F.lit(False)), F.col("cuts_pending")).otherwise(F.col("cuts"))
    facts = running_sum(facts, ["session_id"], "seq", cuts, "first_no")

    placed = join_on(texts, facts.select("session_id", "seq", "pending", "first_no"), ["session_id", "seq"])
    parts = F.when(F.coalesce("pending", F.lit(False)), F.concat(F.array(lead), behind)).otherwise(whole)
    unsure = F.col("done_seq").isNull() & (F.col("seq") == F.col("last_text_seq"))
    rows = placed.select("session_id", "seq", "done_seq", "first_no", unsure.alias("unsure"), parts.alias("parts"))
    rows = rows.select("*", F.size("parts").alias("n"), F.posexplode("parts").alias("k", "part")).drop("parts")
    ordered = F.sort_array(F.collect_list(F.struct("seq", "k", "part")))
    sentences = rows.groupBy("session_id", (F.col("first_no") + F.col("k")).alias("sentence_index")).agg(
        X.strip(F.array_join(F.transform(ordered, lambda p: p["part"]), "")).alias("sentence_text"),
        F.max(F.col("unsure") & (F.col("k") == F.col("n") - 1)).alias("unsure"),
        F.min("seq").alias("begins"),
        F.max("done_seq").alias("done_seq"),
    )
    nexts = sentences.select("session_id", (F.col("sentence_index") - 1).alias("sentence_index"), F.col("begins").alias("seq"))
    sentences = join_on(sentences.drop("begins"), nexts, ["session_id", "sentence_index"], "left")
    sentences = sentences.withColumn("seq", F.coalesce("seq", "done_seq")).drop("done_seq")
    sure = sentences.where(~F.col("unsure") & (F.col("sentence_text") != "")).drop("unsure")
    if not any(m.isspace() for m in X.marks_of(granularity)):
        # Every sentence but the last holds a mark, so none in between was empty and the numbers have no gaps.
        return sure
    # A line break is a mark that is trimmed away, so empty pieces leave gaps.
    sure = materialise(sure.withColumnRenamed("sentence_index", "raw_no"))
    return number_rows(sure, ["session_id"], "raw_no", "sentence_index").select(
        "session_id", "sentence_index", "sentence_text", "seq"
    )


#: Kinds of places where a sentence can end: behind a clause mark, behind a sentence mark.
CLAUSE, SENTENCE = 1, 2
LAST_SEQ = 1 << 62


def _next(facts: DataFrame, cols: list[str], include_self: bool) -> DataFrame:
    """Each column's next non-null value in the session."""
    turned = facts.withColumn("_turned", F.lit(LAST_SEQ) - F.col("seq"))
    return carry_forward(turned, ["session_id"], "_turned", cols, include_self).drop("_turned")


def changing_sentences(messages: DataFrame, granularity: DataFrame) -> DataFrame:
    """Sentences of sessions whose granularity (session_id, seq, split_granularity) may change, placed as above.

    A sentence may end behind a mark and its closing characters, where another character follows. That place belongs to
    the text alone. Behind a sentence mark it is a cut at the message that shows it. Behind a clause mark it is one at
    the next message with clause granularity, unless a message before that one showed the next cut behind a sentence
    mark, for the buffer was emptied up to there. So a message has to know the last mark before it, the next message
    with clause granularity and the next with a sentence mark's cut: values that are carried over blocks of a
    narrow table, forwards and backwards. Every message is then cut by itself, and no session is folded.
    """
    sentence, clause = X.char_class(T.SENTENCE_MARKS), X.char_class(T.CLAUSE_MARKS)
    closing = X.char_class(T.CLOSING_CHARS)

    def pieces(text, kind):
        return F.regexp_extract_all(text, F.lit(X.piece_pattern(kind)), F.lit(0))

    def within(text, kind):
        return F.greatest(F.size(pieces(text, kind)) - 1, F.lit(0))

    by_clause = F.col("split_granularity") != "sentence"
    own = granularity.select("session_id", "seq", by_clause.alias("by_clause"))
    said = open_messages(messages).where(F.col("type").isin("input.text", "input.done"))
    said = said.withColumn("text", F.when(F.col("type") == "input.text", F.coalesce("text", F.lit(""))).otherwise(""))
    said = join_on(said.select("session_id", "seq", "text", "done_seq", "last_text_seq"), own, ["session_id", "seq"])

    lead = F.regexp_extract("text", f"\\A[{closing}]*", 0)
    last = F.element_at(pieces(F.col("text"), "sentence"), -1)
    ends = F.when(F.col("text").rlike(f"[{sentence}][{closing}]*\\z"), SENTENCE)
    ends = ends.when(F.col("text").rlike(f"[{clause}][{closing}]*\\z"), CLAUSE).otherwise(0)
    facts = said.select(
        "session_id",
        "seq",
        "by_clause",
        F.when(F.col("text") != lead, ends).alias("before"),  # only closing characters change nothing
        (F.col("text") != lead).alias("filled"),
        within(F.col("text"), "sentence").alias("full"),
        within(F.col("text"), "clause").alias("all"),
        F.when(F.col("text") != "", within(last, "clause")).otherwise(0).alias("tail"),
    )
    facts = carry_forward(materialise(facts), ["session_id"], "seq", ["before"], include_self=False)
    facts = facts.withColumn("before", F.coalesce("before", F.lit(0)))
    opens = (F.col("filled") & (F.col("before") == SENTENCE)).cast("int")
    facts = facts.withColumn("full", F.col("full") + opens)
    facts = materialise(facts.withColumns({
        "clause_at": F.when(F.col("by_clause"), F.col("seq")), "full_at": F.when(F.col("full") > 0, F.col("seq"))
    }))
    facts = _next(materialise(_next(facts, ["clause_at"], True)), ["full_at"], False)
    late = F.when(F.col("full_at").isNull() | (F.col("clause_at") <= F.col("full_at")), F.col("clause_at"))
    facts = facts.withColumn("late", late)
    # What a clause mark before the message left open ends with its first character that closes nothing.
    open_clause = F.col("filled") & (F.col("before") == CLAUSE)
    now = open_clause & (F.col("by_clause") | ((F.col("full") == 0) & F.col("late").isNotNull()))
    facts = facts.withColumn("opens", now | (F.col("filled") & (F.col("before") == SENTENCE)))
    seldom = F.col("full") + F.when(F.col("late").isNotNull(), F.col("tail") + now.cast("int")).otherwise(0)
    cuts = F.when(F.col("by_clause"), F.col("all") + F.col("opens").cast("int")).otherwise(seldom)
    facts = running_sum(materialise(facts), ["session_id"], "seq", cuts.cast("long"), "first_no")

    placed = join_on(
        said.where(F.col("text") != "").drop("by_clause"),
        facts.select("session_id", "seq", "by_clause", "opens", "full", "late", "first_no"),
        ["session_id", "seq"],
    )
    rest = F.when(F.col("opens"), F.substr("text", F.length(lead) + 1)).otherwise(F.col("text"))
    whole = pieces(rest, "sentence")
    tail = F.concat(F.slice(whole, 1, F.greatest(F.size(whole) - 1, F.lit(0))), pieces(F.element_at(whole, -1), "clause"))
    body = F.when(F.col("by_clause"), pieces(rest, "clause")).when(F.col("late").isNotNull(), tail).otherwise(whole)
    parts = F.when(F.col("opens"), F.concat(F.array(lead), body)).otherwise(body)
    unsure = F.col("done_seq").isNull() & (F.col("seq") == F.col("last_text_seq"))
    rows = placed.select("*", parts.alias("parts"), unsure.alias("last")).drop("text")
    rows = rows.select("*", F.size("parts").alias("n"), F.posexplode("parts").alias("k", "part")).drop("parts")
    at_once = F.col("by_clause") | (F.col("k") <= F.col("full"))
    begins = F.when(F.col("k") == 0, None).when(at_once, F.col("seq")).otherwise(F.col("late"))
    ordered = F.sort_array(F.collect_list(F.struct("seq", "k", "part")))
    found = rows.groupBy("session_id", (F.col("first_no") + F.col("k")).alias("raw_no")).agg(
        X.strip(F.array_join(F.transform(ordered, lambda p: p["part"]), "")).alias("sentence_text"),
        F.max(F.col("last") & (F.col("k") == F.col("n") - 1)).alias("unsure"),
        F.min(begins).alias("begins"),
        F.max("done_seq").alias("done_seq"),
    )
    found = materialise(found)
    nexts = found.select("session_id", (F.col("raw_no") - 1).alias("raw_no"), F.col("begins").alias("seq"))
    found = join_on(found.drop("begins"), nexts, ["session_id", "raw_no"], "left")
    sure = found.where(~F.col("unsure") & (F.col("sentence_text") != ""))
    sure = sure.select("session_id", "raw_no", "sentence_text", F.coalesce("seq", "done_seq").alias("seq"))
    # Line breaks are clause marks that are trimmed away, so empty pieces leave gaps.
    return number_rows(materialise(sure), ["session_id"], "raw_no", "sentence_index").drop("raw_no")


def sentence_requests(messages: DataFrame) -> DataFrame:
    """Sentences with the voice and sampling configuration in force when their end became certain.

    The granularity is that of the configuration in force at each message.
    """
    folded = materialise(fold_session_config(messages))
    sentences = changing_sentences(messages, folded)
    return join_on(sentences, folded.drop("type"), ["session_id", "seq"]).drop("seq")


def assemble_audio(chunks: DataFrame, chunks_per_part: int = 4096) -> DataFrame:
    """WAV data per session from chunks (session_id, seq, chunk): streaming header, then the chunks in order.

    Sessions of up to ``chunks_per_part`` chunks give one blob. A longer one gives several parts with their byte
    offset, which put together in order are the file, so no session has to fit into one value or one task.
    """
    parted = chunks.withColumn("part", idiv(F.col("seq"), chunks_per_part))
    ordered = F.array_sort(F.collect_list(F.struct("seq", "chunk")))
    body = F.unhex(F.array_join(F.transform(ordered, lambda c: F.hex(c["chunk"])), ""))
    own = ["session_id", "part"]
    parts = parted.groupBy(*own).agg(body.alias("wav"), F.count(F.lit(1)).alias("chunks"))
    # Offsets come from lengths alone, so the audio is gathered once.
    sizes = materialise(parted.groupBy(*own).agg(F.sum(F.length("chunk")).alias("bytes")))
    before = running_sum(sizes, ["session_id"], "part", F.col("bytes"), "bytes_before")
    parts = join_on(parts, before.select(*own, "bytes_before"), own)
    starts = join_on(parts, sizes.groupBy("session_id").agg(F.min("part").alias("first_part")), ["session_id"])
    is_first, header = F.col("part") == F.col("first_part"), wav_header()
    return starts.withColumns(
        {
            "wav": F.when(is_first, F.concat(F.lit(header), "wav")).otherwise(F.col("wav")),
            "byte_offset": F.col("bytes_before") + F.when(is_first, 0).otherwise(len(header)),
        }
    ).drop("first_part", "bytes_before")


def wav_header(sample_rate: int = T.SAMPLE_RATE, bits: int = 16, channels: int = 1) -> bytes:
    """44-byte PCM header whose two size fields say "unknown"."""
    unknown = 0xFFFFFFFF
    align = channels * bits // 8

    def le(value: int, size: int) -> bytes:
        return value.to_bytes(size, "little")

    fmt = le(1, 2) + le(channels, 2) + le(sample_rate, 4) + le(sample_rate * align, 4) + le(align, 2) + le(bits, 2)
    return b"RIFF" + le(unknown, 4) + b"WAVE" + b"fmt " + le(len(fmt), 4) + fmt + b"data" + le(unknown, 4)
