import random

import pytest
from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import tokens as T
from phonolake.operators import codes as ops
from phonolake.plans import inputs as I

BASE = T.AUDIO_BASE


def layered(spark, rows):
    return spark.createDataFrame(rows, "id long, l0 array<int>, l1 array<int>, l2 array<int>")


def random_layers(rng, frames):
    return tuple([rng.randrange(4096) for _ in range(frames * width)] for width in (1, 2, 4))


def expected_tokens(l0, l1, l2):
    frames = min(len(l0), len(l1) // 2, len(l2) // 4)
    out = []
    for f in range(frames):
        a, b = l1[2 * f : 2 * f + 2]
        c = l2[4 * f : 4 * f + 4]
        out += [BASE + s * 4096 + v for s, v in enumerate([l0[f], a, c[0], c[1], b, c[2], c[3]])]
    return out


def test_interleave_and_back(spark):
    rng = random.Random(1)
    rows = [(n, *random_layers(rng, n)) for n in (0, 1, 2, 5, 40)]
    rows.append((100, [1, 2, 3], [1, 2, 3, 4, 5], [9] * 11))
    got = {r["id"]: r for r in ops.interleave_codes(layered(spark, rows)).collect()}
    for key, l0, l1, l2 in rows:
        assert got[key]["audio_ids"] == expected_tokens(l0, l1, l2)
    checked = ops.roundtrip_check(layered(spark, rows[:-1])).select("same").distinct().collect()
    assert [r["same"] for r in checked] == [True]


def test_interleave_strict_errors(spark):
    rows = [
        (0, [0], [0, 4096], [1, 2, 3, 4]),
        (1, [0], [0, 4097], [1, 2, 3, 4]),
        (2, [0], [0], [1, 2, 3, 4]),
        (3, [-1], [0, 1], [1, 2, 3, 4]),
        (4, [], [], []),
    ]
    got = {r["id"]: r for r in ops.interleave_codes(layered(spark, rows), "strict").collect()}
    assert [got[i]["error"] for i in range(5)] == [None, "code_range", "layer_lengths", "code_range", None]
    assert got[1]["audio_ids"] is None and len(got[0]["audio_ids"]) == 7 and got[4]["audio_ids"] == []


def test_frames_of_whole_batches_against_entries_one_by_one(spark):
    """Null layers and entries, uneven lengths, empty rows: the same as by expressions; no lambda runs per entry."""
    rng = random.Random(3)
    some = lambda n: None if rng.random() < 0.2 else [None if rng.random() < 0.05 else rng.randrange(-9, 5000) for _ in range(n)]
    sizes = [(0, 0, 0), (1, 2, 4), (3, 6, 12), (5, 4, 30), (2, 9, 8)]
    rows = [(i, *map(some, rng.choice(sizes))) for i in range(300)] + [(300, None, None, None)]
    df = layered(spark, rows)
    joined = ops.interleave_codes(df)
    slow = C.interleave(F.col("l0"), F.col("l1"), F.col("l2"))
    for got in (joined, ops.deinterleave_codes(joined.drop("l0", "l1", "l2"))):
        assert "lambda" not in got._jdf.queryExecution().executedPlan().toString()
    assert [r["id"] for r in joined.withColumn("slow", slow).where(~F.col("audio_ids").eqNullSafe(F.col("slow"))).collect()] == []
    ids = ids_frame(spark, [(i, some(rng.randrange(40))) for i in range(300)])
    back = ops.deinterleave_codes(ids, "ids")
    for layer in range(3):
        assert back.where(~F.col(f"l{layer}").eqNullSafe(C.layer_of(F.col("ids"), layer))).count() == 0


def test_a_code_beyond_an_int_is_an_error_row(spark):
    rows = [(0, [2**31 - 1], [0, 1], [1, 2, 3, 4]), (1, [1], [0, 1], [1, 2, 3, 4])]
    got = {r["id"]: r for r in ops.interleave_codes(layered(spark, rows), "strict").collect()}
    assert (got[0]["error"], got[0]["audio_ids"]) == ("code_range", None) and len(got[1]["audio_ids"]) == 7


def test_codes_of_odd_recordings(spark):
    """No number, no length, a negative number, and more frames than are made at once."""
    rows = [(None, 5000), (7, None), (-7, 5000), (8, 0), (9, -5), (10, 2048 * 70_000), (11, 2048)]
    got = {r["utt_id"]: r for r in I.add_codes(spark.createDataFrame(rows, "utt_id long, n_samples long").coalesce(1)).collect()}
    assert (got[None]["l0"], got[None]["l2"]) == ([None] * 3, [None] * 12)
    assert got[7]["l1"] == got[8]["l0"] == got[9]["l2"] == []
    assert got[-7]["l0"] == [(7 * 31 + i // 2 * 17) % 4096 for i in range(3)]
    assert got[10]["l2"] == [(410 + i * 23) % 4096 for i in range(280_000)] and got[11]["l1"] == [407, 426]


def test_validate_modes(spark):
    rows = [(i, [v], [1, 1], [1, 1, 1, 1]) for i, v in enumerate([-1, 0, 1, 4095, 4096, 4097])]
    for mode, valid in {
        "strict": [False, True, True, True, False, False],
        "lenient": [False, True, True, True, True, False],
        "parse": [False, False, True, True, True, False],
    }.items():
        got = ops.validate_codes(layered(spark, rows), mode).orderBy("id").collect()
        assert [r["valid"] for r in got] == valid


def ids_frame(spark, rows):
    return spark.createDataFrame(rows, "id long, ids array<int>")


def test_dedup_frames(spark):
    frame = lambda first, rest: [first] + [rest] * 6
    same = frame(5, 1) + frame(5, 2) + frame(5, 3)
    mixed = frame(5, 1) + frame(5, 2) + frame(6, 3) + frame(5, 4)
    rows = [(0, []), (1, same), (2, mixed), (3, [1] * 8)]
    got = {r["id"]: r for r in ops.dedup_frames(ids_frame(spark, rows), "ids").collect()}
    assert got[0]["deduped_ids"] == []
    assert got[1]["deduped_ids"] == frame(5, 1)
    assert got[2]["deduped_ids"] == frame(5, 1) + frame(6, 3) + frame(5, 4)
    assert got[3]["error"] == "length_not_divisible" and got[3]["deduped_ids"] is None
    again = ops.dedup_frames(ids_frame(spark, [(2, got[2]["deduped_ids"])]), "ids").first()
    assert again["deduped_ids"] == got[2]["deduped_ids"]


def test_changed_frames_equal_dedup_of_tokens(spark):
    rng = random.Random(2)
    rows = []
    for n in range(12):
        l0, l1, l2 = random_layers(rng, n)
        rows.append((n, [v % 2 for v in l0], l1, l2))
    df = layered(spark, rows)
    frames = C.changed_frames(F.col("l0"), F.col("l1"), F.col("l2"))
    direct = C.interleave_frames(F.col("l0"), F.col("l1"), F.col("l2"), frames)
    after = C.drop_repeated_frames(C.interleave(F.col("l0"), F.col("l1"), F.col("l2")))
    assert df.where(~direct.eqNullSafe(after)).count() == 0


def test_trim_and_split(spark):
    eos = T.END_OF_SPEECH
    rows = [(0, [eos, 1, 2]), (1, [1, 2]), (2, [1, eos, 2, eos]), (3, []), (4, [BASE, T.MAX_AUDIO_TOKEN, BASE - 1])]
    got = {r["id"]: r for r in ops.trim_at_eos(ids_frame(spark, rows)).collect()}
    assert [got[i]["trimmed_ids"] for i in range(4)] == [[], [1, 2], [1], []]
    assert [got[i]["has_eos"] for i in range(4)] == [True, False, True, False]
    split = ops.audio_token_split(ids_frame(spark, rows)).where("id = 4").first()
    assert split["audio_ids"] == [BASE, T.MAX_AUDIO_TOKEN] and split["stray_ids"] == [BASE - 1]
    many = ops.audio_token_split(ids_frame(spark, [(0, list(range(30)))])).first()
    assert many["stray_count"] == 30 and many["stray_ids"] == list(range(20))


def test_partial_frame_is_left_out(spark):
    ids = expected_tokens([7], [8, 9], [1, 2, 3, 4]) + [BASE]
    got = ops.deinterleave_codes(ids_frame(spark, [(0, ids)]), "ids").first()
    assert (got["l0"], got["l1"], got["l2"]) == ([7], [8, 9], [1, 2, 3, 4])


def test_token_report(spark):
    ids = [T.START_OF_SPEECH, 5, T.END_OF_SPEECH, 9, T.END_OF_SPEECH]
    got = ops.token_report(ids_frame(spark, [(0, ids)])).first()
    assert (got["eos_count"], got["eos_first"], got["sos_first"]) == (2, 2, 0)
    assert (got["pad_count"], got["pad_first"]) == (0, None)
    assert got["first_14"] == got["last_14"] == ",".join(map(str, ids))


def test_inference_report(spark):
    good = expected_tokens([1, 2], [1] * 4, [1] * 8) + [T.END_OF_SPEECH]
    rows = [(0, good), (1, good[:6]), (2, [1] + good)]
    got = {r["id"]: r for r in ops.inference_report(ids_frame(spark, rows)).collect()}
    assert got[0]["duration_s"] == pytest.approx(2 * 2048 / 24000)
    assert got[1]["error"] == "too_short" and got[1]["duration_s"] is None
    assert not got[2]["valid"] and got[2]["duration_s"] is None


def test_sequences(spark):
    df = spark.createDataFrame([([1, 2], [7] * 7)], "p array<int>, a array<int>")
    got = df.select(
        C.sequence_a(F.col("p"), F.col("a")).alias("a"), C.sequence_b(F.col("p"), F.col("a")).alias("b")
    ).first()
    head = [128259, 1, 2, 128009, 128260, 128261, 128257]
    assert got["a"] == head + [7] * 7 + [128258]
    assert got["b"] == head + [7] * 7 + [128258, 128262]
    labels = df.select(C.labels_b(C.sequence_b(F.col("p"), F.col("a")), F.size("p")).alias("l")).first()["l"]
    assert labels == [-100] * 5 + got["b"][5:]


def test_layers_are_not_recomputed_per_element(spark):
    """A filter on an interleaved column must not put its expression into a lambda."""
    df = spark.range(1).select(
        F.transform(F.sequence(F.lit(0), F.lit(3999)), lambda i: i.cast("int")).alias("l0"),
        F.transform(F.sequence(F.lit(0), F.lit(7999)), lambda i: i.cast("int") % 4096).alias("l1"),
        F.transform(F.sequence(F.lit(0), F.lit(15999)), lambda i: i.cast("int") % 4096).alias("l2"),
    )
    out = ops.interleave_codes(df).where(F.size("audio_ids") > 0)
    out = ops.dedup_frames(out).where(F.size("deduped_ids") > 0)
    assert out.select(F.size("deduped_ids")).first()[0] == 28000
