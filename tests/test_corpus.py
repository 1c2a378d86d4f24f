import pytest
from pyspark.sql import functions as F

from phonolake.functions import tokens as T
from phonolake.operators import corpus as ops
from phonolake.operators import telemetry
from phonolake.operators import vocab as V
from phonolake.session import materialise


def test_clean_rows(spark):
    rows = [(0, " a ", " s "), (1, "", "s"), (2, None, "s"), (3, "a", None), (4, "a", "  "), (5, "　", "s")]
    df = spark.createDataFrame(rows, "id long, text string, speaker string")
    tagged = {r["id"]: r for r in ops.tag_clean(df).collect()}
    assert (tagged[0]["text"], tagged[0]["speaker"]) == ("a", "s")
    assert [tagged[i]["drop_reason"] for i in range(6)] == [
        None, "empty_text", "empty_text", None, "empty_speaker", "empty_text",
    ]
    assert tagged[3]["speaker"] == "speaker"
    assert {r["speaker"] for r in ops.clean_rows(df.drop("speaker"), "me").collect()} == {"me"}


def test_duration_bounds_are_inclusive(spark):
    rows = [(0, 12000), (1, 11999), (2, 480000), (3, 480001)]
    df = spark.createDataFrame(rows, "id long, n_samples long").withColumn("sample_rate", F.lit(24000))
    assert sorted(r["id"] for r in ops.duration_filter(df).collect()) == [0, 2]


def test_length_limit(spark):
    df = spark.range(10)
    assert ops.length_filter(df, F.col("id"), 8).count() == 9
    assert ops.length_filter(df, F.col("id"), 0).count() == 10


def test_expected_lengths(spark):
    df = spark.createDataFrame([(0,), (1,), (2048,), (2049,)], "n_samples long")
    got = ops.expected_lengths(df).orderBy("n_samples").collect()
    assert [(r["padded_samples"], r["len_l0"], r["len_l1"], r["len_l2"]) for r in got] == [
        (0, 0, 0, 0), (2048, 1, 2, 4), (2048, 1, 2, 4), (4096, 2, 4, 8),
    ]


def test_attach_text(spark):
    audio = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a"), (3, None)], "id long, filepath string")
    meta = spark.createDataFrame(
        [("a", "late", 2), ("a", "first", 1), ("c", "x", 0), ("b", None, 0)], "filename string, text string, ord int"
    )
    got = {r["id"]: r["text"] for r in ops.attach_text(audio, meta).collect()}
    assert got == {0: "first", 2: "first"}
    assert sorted(r["id"] for r in ops.unmatched_audio(audio, meta).collect()) == [1, 3]


def layers(frames):
    return [1] * frames, [2] * (2 * frames), [3] * (4 * frames)


def test_assemble_a_drops_long_rows(spark):
    rows = [(0, [5, 6], 2048 * 2, *layers(2)), (1, [5, 6, 7], 2048 * 2, *layers(2))]
    df = spark.createDataFrame(
        rows, "id long, prompt_ids array<int>, n_samples long, l0 array<int>, l1 array<int>, l2 array<int>"
    )
    got = ops.assemble_a(df, 22).collect()
    assert [r["id"] for r in got] == [0] and got[0]["seq_len"] == len(got[0]["input_ids"]) == 22
    assert got[0]["attention_mask"] == [1] * 22
    assert ops.assemble_a(df, 0).count() == 2


def test_assemble_b(spark):
    rows = [(0, [5], *layers(3)), (1, [5], [], [], []), (2, [5] * 10, *layers(3))]
    df = spark.createDataFrame(rows, "id long, prompt_ids array<int>, l0 array<int>, l1 array<int>, l2 array<int>")
    tagged = ops.tag_length_b(ops.tag_audio_tokens(df), 15)
    assert {r["id"]: r["drop_reason"] for r in tagged.collect()} == {0: None, 1: "no_audio_tokens", 2: "over_length"}
    row = ops.assemble_b(ops.kept(tagged)).first()
    # Three equal frames are one after removing repeats.
    assert row["audio_token_count"] == 7 and row["sequence_length"] == len(row["input_ids"]) == 15
    assert row["labels"][:4] == [-100] * 4 and row["labels"][4:] == row["input_ids"][4:]
    assert row["attention_mask"] == [1] * 15


def test_stats(spark):
    rows = [("a", 10, 3600.0, None), ("a", 20, 1800.0, None), ("b", 99, 1.0, "over_length"), ("b", 1, 1.0, "duration")]
    df = spark.createDataFrame(rows, "speaker string, seq_len int, duration_s double, drop_reason string")
    row = ops.corpus_stats(df).first().asDict()
    assert row == {
        "rows_seen": 4, "rows_written": 2, "rows_skipped_over_length": 1,
        "min_seq_len": 10, "max_seq_len": 20, "mean_seq_len": 15.0,
    }
    empty = ops.corpus_stats(df.where(F.col("speaker") == "b")).first()
    assert (empty["min_seq_len"], empty["max_seq_len"], empty["mean_seq_len"]) == (0, 0, 0.0)
    got = {(r["speaker"], r["is_total"]): (r["examples"], r["dropped"], r["hours"]) for r in ops.speaker_stats(df).collect()}
    assert got == {("a", 0): (2, 0, 1.5), ("b", 0): (0, 2, 0.0), (None, 1): (2, 2, 1.5)}


def test_requests_and_voices(spark):
    rows = [("a", "b", "s", "v"), ("", "b", "", "v"), (None, " ", None, None), (None, None, None, "")]
    df = spark.createDataFrame(rows, "text string, prompt string, speaker string, voice string")
    got = [(r["chosen_text"], r["chosen_voice"], r["status"]) for r in ops.normalise_requests(df).collect()]
    assert got == [("a", "s", 200), ("b", "v", 200), (" ", "Metin", 400), ("", "Metin", 400)]
    voices = spark.createDataFrame([("zoe",), ("tara",), ("",), (None,)], "voice string")
    assert [r["error"] for r in ops.check_voice(voices).collect()] == [None, "unknown voice: tara", None, None]


def test_require_columns(spark):
    with pytest.raises(ValueError, match="missing columns \\['b'\\]"):
        ops.require_columns(spark.range(1).withColumnRenamed("id", "a"), ["a", "b"])


def test_waveform(spark):
    rows = [(0, [[0.5, -0.25]]), (1, [[2.0, -4.0]]), (2, [[1.0, 1.0], [0.0, -3.0]]), (3, [[]])]
    df = spark.createDataFrame(rows, "id long, channels array<array<double>>")
    got = {r["id"]: r["samples"] for r in ops.normalise_waveform(df).collect()}
    assert got == {0: [0.5, -0.25], 1: [0.5, -1.0], 2: [0.5, -1.0], 3: []}
    pcm = spark.createDataFrame([([1.0, -1.0, 0.5, -0.00004, 1.5, -1.5],)], "s array<double>")
    assert pcm.select(ops.to_pcm16(F.col("s"))).first()[0] == [32767, -32767, 16383, -1, 32767, -32768]


def test_sorts_and_grid(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("a", 0), (None, 2)], "speaker string, n int")
    assert [r["speaker"] for r in ops.distinct_sorted(df, "speaker").collect()] == ["a", "b"]
    assert [r["speaker"] for r in ops.distinct_sorted(df, "speaker", 1).collect()] == ["a"]
    assert [r["n"] for r in ops.length_sorted(df, "n", "speaker").collect()] == [0, 1, 1, 2]
    assert ops.first_rows(df, ["n"], 2).count() == 2 and ops.first_rows(df, ["n"], 0).count() == 4
    grid = ops.sample_grid(ops.distinct_sorted(df, "speaker"), ["x", "y"]).collect()
    assert {(r["speaker"], r["sample"], r["text"]) for r in grid} == {(s, i, t) for s in "ab" for i, t in [(1, "x"), (2, "y")]}


def vocab(spark, words="a b c"):
    return spark.createDataFrame([(w, i) for i, w in enumerate(words.split())], "token string, id int")


@pytest.mark.parametrize("small", [True, False])
def test_vocab_encode_and_decode(spark, small):
    most = 1_000_000 if small else 1
    rows = [(0, ["c", "a", "c", "zz"]), (1, []), (2, ["zz", None]), (3, None), (0, ["b"]), (None, ["a"]), (None, ["a"])]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    twice = vocab(spark).unionByName(spark.createDataFrame([("a", 7), (None, 8)], "token string, id int"))
    got = sorted(((r["id"], r["ids"]) for r in V.vocab_encode(df, twice, "id", "words", most=most).collect()), key=str)
    want = [(0, [2, 0, 2, -1]), (1, []), (2, [-1, -1]), (3, []), (0, [1]), (None, [0]), (None, [0])]
    assert got == sorted(want, key=str)
    ids = spark.createDataFrame([(0, [2, 0, 9])], "id long, ids array<int>")
    assert V.vocab_decode(ids, vocab(spark), "id", "ids", most=most).first()["tokens"] == ["c", "a", "\ufffd"]


def test_large_lookup_moves_distinct_entries(spark, monkeypatch):
    written = []
    monkeypatch.setattr(V, "materialise", lambda df: written.append(materialise(df)) or written[-1])
    df = spark.range(0, 3000, 1, 2).selectExpr("id", "if(id % 7 = 0, null, array('a', 'b', 'zz', 'a', null)) AS words")
    for chunk, parts in ((V.CHUNK, 2), (1, 4)):
        monkeypatch.setattr(V, "CHUNK", chunk)
        got = {r["id"]: r["ids"] for r in V.vocab_encode(df, vocab(spark), "id", "words", most=0).collect()}
        assert got == {i: [0, 1, -1, 0, -1] if i % 7 else [] for i in range(3000)}
        assert written[-1].agg(F.count_distinct("_chunk")).first()[0] == parts
        assert written[-1].agg(F.sum(F.size("_new"))).first()[0] == 3 * parts


def test_build_and_extend_vocab(spark):
    words = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("é",)], "token string")
    built = {r["token"]: r["id"] for r in V.build_vocab(words).collect()}
    assert built == {"a": 0, "b": 1, "é": 2}
    new = spark.createDataFrame([("z", 1), ("b", 2), ("y", 0), ("z", 5)], "token string, ord int")
    got = {r["token"]: (r["id"], r["status"]) for r in V.extend_vocab(V.build_vocab(words), new).collect()}
    assert got == {
        "a": (0, "base"), "b": (1, "skipped"), "é": (2, "base"), "y": (3, "added"), "z": (4, "added"),
    }


def test_custom_tokens(spark):
    base = spark.createDataFrame([("x", 128255)], "token string, id int")
    got = {r["token"]: r["id"] for r in V.extend_vocab(base, V.custom_tokens(spark)).collect()}
    assert got["<custom_token_0>"] == T.BASE_VOCAB_SIZE and got["<custom_token_10>"] == T.AUDIO_BASE
    assert got["<custom_token_1>"] == T.START_OF_SPEECH and len(got) == 1 + 28683


def test_mean_embedding(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 6.0]), (2, [5.0, 1.0])], "id long, embedding array<float>")
    members = spark.createDataFrame([("x", 0), ("x", 1), ("x", 1), ("y", None), ("z", 2)], "token string, id long")
    got = {r["token"]: r["embedding"] for r in V.mean_embedding(members, table).collect()}
    assert got["x"] == pytest.approx([7 / 3, 14 / 3]) and got["y"] == [3.0, 3.0] and got["z"] == [5.0, 1.0]


def test_telemetry(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "request_id string, n int")
    two = spark.createDataFrame([("b", 3)], "request_id string, n int")
    three = spark.createDataFrame([("c", 4)], "request_id string, n int")
    got = {r["request_id"]: r for r in telemetry.join_telemetry(one, two, three).collect()}
    assert got["b"]["engine_n"] == 2 and got["b"]["decoder_n"] == 3 and not got["b"]["has_transport"]
    assert got["c"]["has_transport"] and not got["c"]["has_engine"]

    rows = [(1, 0, 10, False), (1, 0, 5, False), (1, 1, None, True), (1, 2, 7, False)]
    chunks = spark.createDataFrame(rows, "session_id long, sentence_index long, bytes long, error boolean")
    total = telemetry.session_totals(chunks).first()
    assert (total["total_sentences"], total["total_bytes"], total["failed_sentences"]) == (3, 22, 1)

    rows = [("a", 0, 500_000, 2_000_000, 48000), ("b", 0, None, 1_000_000, 0)]
    requests = spark.createDataFrame(
        rows, "request_id string, start_us long, first_chunk_us long, end_us long, bytes long"
    )
    got = {r["request_id"]: r for r in telemetry.throughput(requests).collect()}
    assert (got["a"]["audio_s"], got["a"]["real_time_factor"], got["a"]["first_chunk_s"]) == (1.0, 2.0, 0.5)
    assert got["b"]["real_time_factor"] is None
    report = telemetry.throughput_report(requests).first()
    assert report["requests"] == 2 and report["first_chunk_p50_s"] == 0.5

    done = spark.createDataFrame([(0,), (1_000_000,), (2_000_000,)], "finished_us long")
    row = telemetry.progress_report(done, 9).first()
    assert (row["completed"], row["rate"], row["eta_s"]) == (3, 1.5, 4.0)


def test_constants():
    assert T.MAX_AUDIO_TOKEN == 156937 and T.CUSTOM_TOKEN_COUNT == 28683
