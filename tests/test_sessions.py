import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from phonolake.functions import text as X
from phonolake.operators import sessions as ops
from phonolake.session import scratch_dir
from phonolake.sources import streams
from phonolake.streaming.ordered import open_keys
from phonolake.streaming.run import run_to_table, run_updates_to_table
from phonolake.functions.text import rest_pieces
from phonolake.streaming.sessions import segment_sessions, stream_session_totals
from phonolake.streaming.windows import stream_windows
from tests.test_generated import slow_extract, slow_windows, stream

FIELDS = [f.name for f in ops.MESSAGE_SCHEMA]


def messages(spark, sessions):
    """sessions: {id: [message dict, …]} in seq order."""
    rows = [(s, i, *[m.get(f) for f in FIELDS]) for s, ms in sessions.items() for i, m in enumerate(ms)]
    random.Random(0).shuffle(rows)
    schema = "session_id long, seq long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ops.MESSAGE_SCHEMA)
    return spark.createDataFrame(rows, schema)


def text(value):
    return {"type": "input.text", "text": value}


DONE = {"type": "input.done"}


def random_sessions(n=60, seed=9):
    rng = random.Random(seed)
    alphabet = "ab  .!?…,:\n\"')"
    out = {}
    for s in range(n):
        parts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(12))]
        out[s] = [text(p) for p in parts] + ([DONE] if rng.random() < 0.6 else [])
        if rng.random() < 0.2:
            out[s] += [text("after the end. x")]
    return out


def expected(ms, granularity):
    """Sentences by feeding characters one at a time."""
    marks = X.marks_of(granularity)
    buffer, out = "", []
    for m in ms:
        if m["type"] == "input.done":
            return out + rest_pieces(buffer, granularity)
        for char in m["text"] or "":
            closed = buffer.rstrip("\"')]}”’ ")
            if char not in "\"')]}”’ " and closed and closed[-1] in marks:
                out.append(buffer.strip())
                buffer = ""
            buffer += char
    return out


def by_session(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["session_id"], r["sentence_index"])):
        assert r["sentence_index"] == len(out.setdefault(r["session_id"], []))
        out[r["session_id"]].append(r["sentence_text"])
    return out


@pytest.mark.parametrize("granularity", ["sentence", "clause"])
def test_session_sentences(spark, granularity):
    sessions = random_sessions()
    got = by_session(ops.session_sentences(messages(spark, sessions), granularity).collect())
    for s, ms in sessions.items():
        want = [p for p in expected(ms, granularity) if p]
        assert got.get(s, []) == want, ms


def test_config_fold(spark):
    config = lambda **kw: {"type": "session.config", **kw}
    sessions = {
        1: [
            text("a"),
            config(voice="x", max_tokens=5, response_format="wav", split_granularity="clause"),
            text("b"),
            config(speaker="y", temperature=0.9),
            text("c"),
            DONE,
            config(voice="late"),
        ]
    }
    got = ops.fold_session_config(messages(spark, sessions)).orderBy("seq").collect()
    assert [r["voice"] for r in got] == ["Metin", "x", "x", "y", "y", "y"]
    assert [r["max_tokens"] for r in got] == [2000, 5, 5, 5, 5, 5]
    assert [r["response_format"] for r in got] == ["pcm", "wav", "wav", "pcm", "pcm", "pcm"]
    assert [r["split_granularity"] for r in got] == ["sentence", "clause", "clause"] + ["sentence"] * 3
    assert got[-1]["temperature"] == 0.9 and got[0]["stream_audio"] is True


def test_unsupported_messages(spark):
    sessions = {1: [text("a"), {"type": "odd"}, {}, DONE, {"type": "odd"}]}
    got = ops.unsupported_messages(messages(spark, sessions)).orderBy("seq").collect()
    assert [(r["seq"], r["error"]) for r in got] == [
        (1, "unsupported message type: odd"), (2, "unsupported message type: None"),
    ]


def test_assemble_audio(spark):
    rows = [(1, i, bytes([i, 255 - i])) for i in range(10)] + [(2, 0, b"ab")]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "session_id long, seq long, chunk binary")
    whole = {r["session_id"]: r for r in ops.assemble_audio(df).collect()}
    header = ops.wav_header()
    assert len(header) == 44 and header[4:8] == header[40:44] == b"\xff" * 4
    assert bytes(whole[1]["wav"]) == header + b"".join(bytes([i, 255 - i]) for i in range(10))
    parts = ops.assemble_audio(df.where("session_id = 1"), 4).orderBy("part").collect()
    assert b"".join(bytes(p["wav"]) for p in parts) == bytes(whole[1]["wav"])
    assert [p["byte_offset"] for p in parts] == [0, 52, 60]


def write_messages(spark, sessions, files):
    """JSON lines with the messages of each session scattered over all files."""
    rows = [
        (str(s), i, json.dumps({k: v for k, v in m.items() if v is not None}))
        for s, ms in sessions.items()
        for i, m in enumerate(ms)
    ]
    random.Random(3).shuffle(rows)
    path = scratch_dir(spark)
    spark.createDataFrame(rows, streams.RAW_MESSAGES.format(id_type="string")).repartition(files).write.json(path)
    return path


def test_stream_equals_batch(spark):
    sessions = random_sessions(40, seed=21)
    stream = streams.read_session_stream(spark, write_messages(spark, sessions, 5), 1)
    events = run_to_table(segment_sessions(stream, None))
    got = by_session(events.where(F.col("kind") == "sentence").withColumn("session_id", F.col("session_id").cast("long")).collect())
    batch = by_session(ops.session_sentences(messages(spark, sessions)).collect())
    assert got == batch
    ended = {s for s, ms in sessions.items() if DONE in ms}
    assert {int(r["session_id"]) for r in events.where("kind = 'done'").collect()} == ended


def test_stream_config_errors_and_granularity_change(spark):
    sessions = {
        1: [
            text("a, b"),
            {"type": "session.config", "split_granularity": "clause", "voice": "v", "max_tokens": "7", "top_p": 0.25},
            text(" c"),
            {"type": "odd"},
            {"type": "session.config", "repetition_penalty": 2},
            text(", d. e"),
            DONE,
            text("ignored."),
        ]
    }
    stream = streams.read_session_stream(spark, write_messages(spark, sessions, 3), 1)
    rows = run_to_table(segment_sessions(stream, None)).orderBy("seq", "sentence_index").collect()
    said = [(r["seq"], r["sentence_text"]) for r in rows if r["kind"] == "sentence"]
    # The clause mark in the buffer counts from the next text on; then the default granularity is back.
    assert said == [(2, "a,"), (5, "b c, d."), (6, "e")]
    kinds = [r["kind"] for r in rows if r["kind"] != "sentence"]
    assert kinds == ["configured", "error", "configured", "done"]
    first, _, second, done = [r for r in rows if r["kind"] != "sentence"]
    assert (first["voice"], first["max_tokens"], first["top_p"]) == ("v", 7, 0.25)
    assert (second["voice"], second["repetition_penalty"], second["split_granularity"]) == ("v", 2.0, "sentence")
    assert done["sentence_index"] == 3


def test_stream_timeout_closes_without_flush(spark):
    sessions = {1: [text("One. two")], 2: [text("A. b"), DONE]}
    stream = streams.read_session_stream(spark, write_messages(spark, sessions, 1), 1)
    out = scratch_dir(spark)
    query = (
        segment_sessions(stream, timeout_ms=1)
        .writeStream.format("parquet")
        .options(path=f"{out}/rows", checkpointLocation=f"{out}/checkpoint")
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        for _ in range(60):
            query.awaitTermination(1)
            rows = spark.read.schema(stream_schema()).parquet(f"{out}/rows").collect() if has_rows(spark, out) else []
            if any(r["kind"] == "disconnected" for r in rows):
                break
    finally:
        query.stop()
    assert [(r["session_id"], r["sentence_index"]) for r in rows if r["kind"] == "disconnected"] == [("1", 1)]
    assert sorted(r["sentence_text"] for r in rows if r["kind"] == "sentence") == ["A.", "One.", "b"]


def test_open_sessions_go_from_one_query_to_the_next(spark):
    """Half of the messages to one query, in which some wait for a gap, the rest to another: all events as of one query."""
    sessions = random_sessions(25, seed=5)
    whole = run_to_table(segment_sessions(streams.read_session_stream(spark, write_messages(spark, sessions, 4), 1), None))
    rows = messages(spark, sessions)
    first, second, out = scratch_dir(spark), scratch_dir(spark), scratch_dir(spark)
    early = (F.col("seq") < 3) | (F.col("seq") == 5)
    for part, path in ((rows.where(early), first), (rows.where(~early), second)):
        part.select("session_id", "seq", F.to_json(F.struct(*FIELDS)).alias("payload")).write.json(path)

    def run(events, number):
        query = (
            events.writeStream.format("parquet")
            .options(path=f"{out}/{number}/rows", checkpointLocation=f"{out}/{number}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return spark.read.schema(events.schema).parquet(f"{out}/{number}/rows")

    one = run(segment_sessions(streams.read_session_stream(spark, first), None), 1)
    handed = open_keys(spark, f"{out}/1/checkpoint", "session_id")
    assert handed.where("held_seq = 5").count() > 0
    two = run(segment_sessions(streams.read_session_stream(spark, second), None, handed), 2)
    plain = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert plain(one.unionByName(two)) == plain(whole)


def stream_schema():
    from phonolake.streaming.sessions import SESSION_OUTPUT

    return StructType([StructField("session_id", StringType()), *SESSION_OUTPUT.fields[1:]])


def has_rows(spark, out):
    from pathlib import Path

    folder = Path(out.removeprefix("file:")) / "rows" / "_spark_metadata"
    return folder.exists()


def test_stream_windows(spark):
    rng = random.Random(13)
    requests = {f"req-{r}": stream(rng, n) for r, n in {1: 120, 2: 30, 3: 5}.items()}
    rows = [(r, i, t) for r, texts in requests.items() for i, t in enumerate(texts)]
    rng.shuffle(rows)
    path = scratch_dir(spark)
    spark.createDataFrame(rows, streams.TOKEN_EVENTS.format(id_type="string")).repartition(4).write.parquet(path)
    got = run_to_table(stream_windows(streams.read_token_stream(spark, path, 1), None)).collect()
    assert {(r["request_id"], r["token_index"]) for r in got} == {
        (r, end) for r, texts in requests.items() for end, _ in slow_windows(slow_extract(texts, "compat"))
    }
    assert got and all(len(r["l0"]) == 4 and len(r["l1"]) == 8 and len(r["l2"]) == 16 for r in got)


def test_stream_totals(spark):
    rows = [(1, 0, 4, False), (1, 0, 4, False), (1, 1, 0, True), (2, 0, 6, False)]
    path = scratch_dir(spark)
    schema = "session_id long, sentence_index long, bytes long, error boolean"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = {r["session_id"]: r for r in run_updates_to_table(stream_session_totals(stream), "session_id").collect()}
    assert (got[1]["total_sentences"], got[1]["total_bytes"], got[1]["failed_sentences"]) == (2, 8, 1)
    assert got[2]["total_sentences"] == 1


def changing_sessions():
    rng = random.Random(8)
    out = {}
    for s in range(30):
        out[s] = []
        for turn in range(rng.randrange(1, 9)):
            if rng.random() < 0.5:
                config = {"type": "session.config", "voice": f"v{turn}"}
                if s % 3:
                    config["split_granularity"] = rng.choice(["clause", "sentence"]) if s % 3 == 1 else "clause"
                out[s].append(config)
            out[s].append(text("".join(rng.choice("ab ,.!\n\"") for _ in range(rng.randrange(8)))))
        if rng.random() < 0.7:
            out[s].append(DONE)
    return out


def plain_requests(ms):
    """Buffer, granularity and voice of one session, message by message."""
    buffer, granularity, voice, out = "", "sentence", "Metin", []
    for m in ms:
        if m["type"] == "session.config":
            granularity, voice = m.get("split_granularity", "sentence"), m["voice"]
        elif m["type"] == "input.text":
            pieces, buffer = X.ready_pieces(buffer + m["text"], granularity)
            out += [(p, voice) for p in pieces]
        else:
            return out + [(p, voice) for p in rest_pieces(buffer, granularity)]
    return out


def test_sentence_requests_have_the_configuration_in_force(spark):
    sessions = changing_sessions()
    got = {}
    for r in ops.sentence_requests(messages(spark, sessions)).orderBy("session_id", "sentence_index").collect():
        found = got.setdefault(r["session_id"], [])
        assert r["sentence_index"] == len(found)
        found.append((r["sentence_text"], r["voice"]))
    assert got == {s: out for s, ms in sessions.items() if (out := plain_requests(ms))}


@pytest.mark.parametrize("seed", range(4))
def test_sentence_requests_of_changing_granularity(spark, seed):
    """Marks, closing characters, blanks and line breaks in messages of any cut, empty ones too."""
    rng = random.Random(seed)
    sessions = {}
    for s in range(150):
        out = sessions[s] = []
        for turn in range(rng.randrange(1, 14)):
            if rng.random() < 0.6:
                granularity = rng.choice(["clause", "sentence", "paragraph", None])
                out.append({"type": "session.config", "voice": f"v{turn}", "split_granularity": granularity})
            alphabet = rng.choice(["ab ,.!\n\"", ".,\"", "a,", "a) .:", "\n"])
            out.append(text("".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 5, 12])))))
        if rng.random() < 0.6:
            out.append(DONE)
    got = {}
    for r in ops.sentence_requests(messages(spark, sessions)).orderBy("session_id", "sentence_index").collect():
        found = got.setdefault(r["session_id"], [])
        assert r["sentence_index"] == len(found)
        found.append((r["sentence_text"], r["voice"]))
    want = {s: [{**m, "split_granularity": m["split_granularity"] or "sentence"} if "split_granularity" in m else m for m in ms] for s, ms in sessions.items()}
    assert got == {s: out for s, ms in want.items() if (out := plain_requests(ms))}


def test_a_long_changing_session_needs_no_python_and_no_task_of_its_own(spark):
    rows = spark.range(60_000).select(
        F.lit(1).alias("session_id"), F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "session.config").otherwise("input.text").alias("type"),
        F.when(F.col("id") % 3 == 1, "a, b").when(F.col("id") % 3 == 2, "c. d").alias("text"),
        F.when(F.col("id") % 6 == 0, "clause").alias("split_granularity"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in ops.MESSAGE_SCHEMA if f.name not in ("type", "text", "split_granularity")],
    )
    found = ops.sentence_requests(rows)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    ms = [r.asDict() for r in rows.orderBy("seq").collect()]
    for m in ms:
        m["split_granularity"] = m["split_granularity"] or "sentence"
        m["voice"] = "Metin"
    assert [(r["sentence_text"], r["voice"]) for r in found.orderBy("sentence_index").collect()] == plain_requests(ms)
