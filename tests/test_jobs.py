import json
import random

import pytest
from pyspark.sql import functions as F

from phonolake.functions import tokens as T
from phonolake.operators.text import phoneme_vocab
from phonolake.plans import jobs
from phonolake.sources import readers

LAYERS = "utt_id long, l0 array<int>, l1 array<int>, l2 array<int>"


def layers(spark, sizes):
    rng = random.Random(6)
    rows = [(u, *[[rng.randrange(4096) for _ in range(n * w)] for w in (1, 2, 4)]) for u, n in sizes.items()]
    return spark.createDataFrame(rows, LAYERS)


def vocab(spark):
    return spark.createDataFrame([("hi", 0), ("you", 1), ("ann", 2), ("Hi", 3), (":", 4), ("!", 5)], "token string, id int")


def test_format_a(spark, tmp_path):
    audio = spark.createDataFrame(
        [(u, f"f{u}", "ann" if u % 2 else "", 2048 * 2) for u in range(7)] + [(9, "f9", "ann", 2048 * 500)],
        "utt_id long, filepath string, speaker string, n_samples long",
    )
    meta = spark.createDataFrame(
        [(f"f{u}", "Hi you!", 0) for u in range(10) if u != 3], "filename string, text string, ord int"
    )
    out = str(tmp_path)
    codes = layers(spark, {**{u: 2 for u in range(7)}, 9: 500})
    stats = jobs.prepare_format_a(audio, meta, codes, vocab(spark), out, max_len=100, rows_per_shard=4).first()
    assert (stats["rows_seen"], stats["rows_written"], stats["rows_skipped_over_length"]) == (7, 6, 1)
    rows = {r["filename"]: r for r in readers.read_training_set(spark, out).collect()}
    assert set(rows) == {"f0", "f1", "f2", "f4", "f5", "f6"}
    assert rows["f1"]["input_ids"][:8] == [T.START_OF_HUMAN, 2, 4, 3, 1, 5, *[128009, 128260]]
    assert rows["f0"]["input_ids"][:8] == [T.START_OF_HUMAN, 3, 1, 5, *[128009, 128260, 128261, 128257]]
    assert len(rows["f0"]["input_ids"]) == rows["f0"]["seq_len"] == 1 + 3 + 4 + 14 + 1
    shards = readers.read_shards(spark, out).groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in shards} == {0: 4, 1: 2}
    (pointer,) = [x for f in (tmp_path / "pointer").glob("*.json") for x in f.read_text().splitlines()]
    assert json.loads(pointer)["num_shards"] == 2
    again = jobs.prepare_format_a(audio, meta, codes, vocab(spark), out, max_len=100, rows_per_shard=1, mode="ignore")
    assert again is None
    (same,) = [x for f in (tmp_path / "pointer").glob("*.json") for x in f.read_text().splitlines()]
    assert same == pointer


def source(spark):
    rows = [(0, " Hi you ", "ann", 24000), (1, "hi", None, 24000), (2, "  ", "ann", 24000), (3, "hi", "ann", 100),
            (4, "hi", "ann", 24000), (5, "hi " * 50, "ann", 24000)]
    return spark.createDataFrame(rows, "utt_id long, text string, speaker string, n_samples long").withColumn(
        "sample_rate", F.lit(24000)
    )


def test_format_b(spark, tmp_path):
    codes = layers(spark, {0: 2, 1: 3, 2: 1, 3: 1, 5: 2})
    out = str(tmp_path / "b")
    stats = jobs.prepare_format_b(
        source(spark), codes, vocab(spark), out, "{speaker_id}: {text}", default_speaker="you", max_len=40
    )
    got = {(r["speaker"], r["is_total"]): r for r in stats.collect()}
    assert (got["ann", 0]["examples"], got["ann", 0]["dropped"]) == (1, 4)
    assert got["you", 0]["examples"] == 1 and got[None, 1]["examples"] == 2
    assert got[None, 1]["hours"] == pytest.approx(2 / 3600) and got[None, 1]["max_sequence_length"] == 3 + 21 + 7
    rows = {r["speaker_id"]: r for r in readers.read_training_set(spark, out).collect()}
    assert rows["ann"]["input_ids"][:5] == [T.START_OF_HUMAN, 2, 4, 3, 1] and rows["ann"]["text"] == "Hi you"
    for r in rows.values():
        n = r["sequence_length"]
        assert len(r["input_ids"]) == len(r["labels"]) == len(r["attention_mask"]) == n
    again = jobs.prepare_format_b(source(spark), codes, vocab(spark), out, mode="ignore")
    assert again is None
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        jobs.prepare_format_b(source(spark), codes, vocab(spark), out)


def test_format_b_with_phonemes(spark, tmp_path):
    ids = phoneme_vocab(200)
    words = spark.createDataFrame(list(ids.items()), "token string, id int")
    df = source(spark).where("utt_id < 2").withColumn("ipa", F.lit("tʃa"))
    out = str(tmp_path / "p")
    jobs.prepare_format_b(df, layers(spark, {0: 1, 1: 1}), words, out, phonemize="ipa")
    rows = readers.read_training_set(spark, out).collect()
    assert len(rows) == 2
    for r in rows:
        assert r["input_ids"][1:3] == [ids["<|ph_ch|>"], ids["<|ph_a|>"]]


def test_layers_move_once_to_their_shard(spark, tmp_path, monkeypatch):
    """Layers of rejected rows do not count, neither do rows without layers: places have no gap."""
    audio = spark.range(8).selectExpr("id AS utt_id", "concat('f', id) AS filepath", "'s' AS speaker", "if(id = 3, 20480000, 2048) AS n_samples")
    meta = spark.range(8).selectExpr("concat('f', id) AS filename", "'a' AS text", "0 AS ord")
    layers = spark.range(12).where("id <> 5").selectExpr(
        "id AS utt_id", "array(1) AS l0", "array(1, 2) AS l1", "array(1, 2, 3, cast(id AS int)) AS l2")
    words = spark.createDataFrame([("s", 0), (":", 1), ("a", 2)], "token string, id int")
    moved = []
    build = jobs.corpus.assemble_a
    monkeypatch.setattr(jobs.corpus, "assemble_a", lambda df, n: moved.append(df._jdf.queryExecution().optimizedPlan().toString()) or build(df, n))
    for most in (jobs.MOST_IDS, 0):
        monkeypatch.setattr(jobs, "MOST_IDS", most)
        path = f"{tmp_path}/{most}"
        jobs.prepare_format_a(audio, meta, layers, words, path, rows_per_shard=2)
        rows = readers.read_shards(spark, path, 2).orderBy("shard", "filename").collect()
        assert [(r["filename"], r["shard"]) for r in rows] == [("f0", 0), ("f1", 0), ("f2", 1), ("f4", 1), ("f6", 2), ("f7", 2)]
        assert all(r["seq_len"] == len(r["input_ids"]) == len(r["attention_mask"]) == 16 for r in rows)
        assert [r["input_ids"][-2] for r in rows] == [152842 + i for i in (0, 1, 2, 4, 6, 7)]
    assert all("RepartitionByExpression" in plan for plan in moved)
