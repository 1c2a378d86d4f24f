"""Analysis of generated token streams: events (request_id, seq, text) in the order of seq, which may have gaps.

Of events that repeat a request and seq the one with the largest token number counts.

Which slot a token falls into depends on how many tokens of its request were accepted before it, so extraction is a
fold in seq order. The fold has only seven slot states, so a block of events is summed up by seven numbers: the
tokens it accepts for each slot it may start in. Blocks are summed up in parallel, their sums are chained (blocked
again, so that a very long request is never gathered whole), and each block then runs once more from its true start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.operators.codes import in_range
from phonolake.operators.ordered import join_on
from phonolake.session import materialise

EVENTS_PER_BLOCK = 512
FRAMES_PER_BLOCK = 256

# Accepted values by mode: `parse` keeps 1..4096, `compat` any positive value, `strict` the codebook 0..4095.
ACCEPT = {
    "parse": lambda v: (v > 0) & (v <= T.CODEBOOK),
    "compat": lambda v: v > 0,
    "strict": lambda v: v.between(0, T.CODEBOOK - 1),
}


def parse_tokens(events: DataFrame) -> DataFrame:
    """Token number at the end of each event text, null for an invalid event."""
    return events.withColumn("token_number", X.last_token_number(F.col("text")))


def _value(number: Column, accepted: Column) -> Column:
    return number - T.CUSTOM_TOKEN_SHIFT - (accepted % T.SLOTS) * T.CODEBOOK


def _gain(numbers: Column, accept) -> Column:
    """Accepted tokens for each of the seven slots a block may start in."""

    def step(gains: Column, number: Column) -> Column:
        return F.transform(
            gains, lambda g, slot: g + F.coalesce(accept(_value(number, slot + g)).cast("long"), F.lit(0).cast("long"))
        )

    return F.aggregate(numbers, F.array(*[F.lit(0).cast("long")] * T.SLOTS), step)


def _chain(gains: Column) -> Column:
    """Gain of blocks run one after the other."""

    def step(acc: Column, nxt: Column) -> Column:
        return F.transform(acc, lambda g, slot: g + F.get(nxt, ((slot + g) % T.SLOTS).cast("int")))

    return F.aggregate(gains, F.array(*[F.lit(0).cast("long")] * T.SLOTS), step)


def _starts(blocks: DataFrame, width: int, levels: int = 1) -> DataFrame:
    """Tokens accepted before each block; (request_id, block, gain) to (request_id, block, start).

    Blocks are chained in their order, so missing ones make no difference.
    """
    group = C.idiv(F.col("block"), width) if levels else F.lit(0).cast("long")
    groups = blocks.groupBy("request_id", group.alias("group")).agg(
        F.sort_array(F.collect_list(F.struct("block", "gain"))).alias("members")
    )
    if levels:
        sums = groups.select("request_id", F.col("group").alias("block"), _chain(F.col("members.gain")).alias("gain"))
        groups = _with_start(groups, "group", _starts(sums, width, levels - 1))
    else:
        groups = groups.withColumn("start", F.lit(0).cast("long"))

    empty = F.expr("cast(array() as array<struct<block:bigint,start:bigint>>)")

    def step(acc: Column, m: Column) -> Column:
        end = acc["end"] + F.get(m["gain"], (acc["end"] % T.SLOTS).cast("int"))
        done = F.struct(m["block"].alias("block"), acc["end"].alias("start"))
        return F.struct(end.alias("end"), F.array_append(acc["done"], done).alias("done"))

    walked = F.aggregate("members", F.struct(F.col("start").alias("end"), empty.alias("done")), step, lambda a: a["done"])
    return groups.select("request_id", F.inline(walked))


def _with_start(blocks: DataFrame, block: str, starts: DataFrame) -> DataFrame:
    return join_on(blocks, starts.select("request_id", F.col("block").alias(block), "start"), ["request_id", block])


def extract_codes(events: DataFrame, mode: str = "compat", width: int = EVENTS_PER_BLOCK) -> DataFrame:
    """Accepted codes as rows (request_id, seq, idx, slot, code), idx counting accepted tokens from 0.

    ``compat`` and ``parse`` drop a legal code 0, which shifts all later slots; ``strict`` keeps it.
    """
    accept = ACCEPT[mode]
    numbered = parse_tokens(events).select(
        "request_id", F.col("seq").cast("long").alias("seq"), "token_number", C.idiv(F.col("seq"), width).alias("block")
    )
    # Both uses of this aggregate have the same columns, so Spark runs its shuffle once.
    blocks = numbered.groupBy("request_id", "block").agg(
        F.sort_array(F.collect_set(F.struct("seq", "token_number"))).alias("toks")
    )
    last_of_seq = F.filter("toks", lambda t, i: ~F.coalesce(F.get("toks", i + 1)["seq"] == t["seq"], F.lit(False)))
    blocks = blocks.withColumn("toks", last_of_seq)
    sums = blocks.select("request_id", "block", _gain(F.col("toks.token_number"), accept).alias("gain"))
    blocks = _with_start(blocks, "block", _starts(sums, width))
    empty = F.expr("cast(array() as array<struct<seq:bigint,idx:bigint,code:bigint>>)")

    def step(acc: Column, tok: Column) -> Column:
        v = _value(tok["token_number"], acc["n"])
        row = F.struct(tok["seq"].alias("seq"), acc["n"].alias("idx"), v.alias("code"))
        taken = F.struct((acc["n"] + 1).alias("n"), F.array_append(acc["codes"], row).alias("codes"))
        return F.when(accept(v), taken).otherwise(acc)

    first = F.struct(F.col("start").alias("n"), empty.alias("codes"))
    rows = blocks.select("request_id", F.inline(F.aggregate("toks", first, step, lambda a: a["codes"])))
    return rows.select("request_id", "seq", "idx", (F.col("idx") % T.SLOTS).cast("int").alias("slot"), "code")


def decode_windows(codes: DataFrame, width: int = FRAMES_PER_BLOCK) -> DataFrame:
    """Sliding decode windows: each whole frame from the fourth on with the three frames before it.

    Windows with a code above 4096 are left out. Frames are gathered in blocks of ``width``; the last three frames
    of a block also go to the next one, so no window crosses a block and no request is gathered whole.
    """
    overlap = T.WINDOW_FRAMES - 1
    frame = C.idiv(F.col("idx"), T.SLOTS)
    block = C.idiv(frame, width)
    blocks = F.when(frame % width >= width - overlap, F.array(block, block + 1)).otherwise(F.array(block))
    placed = codes.select("request_id", "idx", "code", F.explode(blocks).alias("block"))
    runs = placed.groupBy("request_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("idx", "code"))).alias("run")
    )
    runs = runs.withColumns({"first": F.col("run")[0]["idx"], "run": F.col("run.code")})
    n_windows = F.greatest(C.idiv(F.size("run"), T.SLOTS) - overlap, F.lit(0).cast("long"))
    windows = F.transform(
        C.index_range(n_windows),
        lambda w: F.struct(
            C.idiv(F.col("first") + (w + T.WINDOW_FRAMES) * T.SLOTS, F.lit(1)).alias("token_index"),
            F.slice("run", w * T.SLOTS + 1, T.SLOTS * T.WINDOW_FRAMES).alias("codes"),
        ),
    )
    rows = runs.select("request_id", F.inline(windows))
    rows = rows.where(F.forall("codes", lambda c: in_range(c, "lenient")))
    return window_layers(rows)


def window_layers(windows: DataFrame) -> DataFrame:
    """Layer codes and the output region of windows (request_id, token_index, codes)."""
    layers = {}
    for n in range(3):
        slots = [s for s, (layer, _, _) in enumerate(C.SLOT_SOURCE) if layer == n]
        at = [f * T.SLOTS + s for f in range(T.WINDOW_FRAMES) for s in slots]
        layers[f"l{n}"] = F.array(*[F.get("codes", F.lit(i)) for i in at]).cast("array<int>")
    return windows.withColumns(
        layers
        | {
            "sample_from": F.lit(T.FRAME_SAMPLES),
            "sample_to": F.lit(2 * T.FRAME_SAMPLES),
            "chunk_bytes": F.lit(2 * T.FRAME_SAMPLES),
        }
    ).drop("codes")


def decoder_report(events: DataFrame, first_chunks: int = 12) -> DataFrame:
    """Decoder counters per request. A token that parses to a value of 0 or less is neither parsed nor invalid."""
    seen = parse_tokens(events).groupBy("request_id").agg(
        F.count(F.lit(1)).alias("events_seen"), F.count_if(F.col("token_number").isNull()).alias("invalid_events")
    )
    codes = materialise(extract_codes(events, "compat"))
    parsed = codes.groupBy("request_id").agg(F.count(F.lit(1)).alias("parsed_tokens"))
    chunks = decode_windows(codes).groupBy("request_id").agg(
        F.count(F.lit(1)).alias("audio_chunks"),
        F.sum("chunk_bytes").alias("audio_bytes"),
        F.min("token_index").alias("first_audio_token_index"),
    )
    joined = seen.join(parsed, "request_id", "left").join(chunks, "request_id", "left")
    joined = joined.na.fill(0, ["parsed_tokens", "audio_chunks", "audio_bytes"])
    n_first = F.least("audio_chunks", F.lit(first_chunks)).cast("int")
    return joined.withColumn("audio_chunk_sizes", F.array_repeat(F.lit(2 * T.FRAME_SAMPLES), n_first))


def engine_report(events: DataFrame, samples: int = 8, sample_tail: int = 120, final_tail: int = 500) -> DataFrame:
    """Engine counters per request; the first ``samples`` texts are those with seq below it."""
    sample = F.struct("seq", F.length("text").alias("len"), F.right("text", F.lit(sample_tail)).alias("tail"))
    per = events.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("callback_count"),
        F.sort_array(F.collect_list(F.when(F.col("seq") < samples, sample))).alias("stream_text_samples"),
        F.max_by("text", "seq").alias("final_text"),
    )
    return per.select(
        "request_id",
        "callback_count",
        "stream_text_samples",
        F.length("final_text").alias("final_text_len"),
        X.count_tokens(F.col("final_text")).alias("custom_token_count"),
        F.right("final_text", F.lit(final_tail)).alias("final_text_tail"),
    )
