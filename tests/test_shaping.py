import random

import pytest
from pyspark.sql import functions as F

from phonolake.functions import tokens as T
from phonolake.operators import shaping as ops


def numbered(spark, n, name):
    return spark.range(n).select("id", F.lit(name).alias("name")).repartition(3)


def slow_mix(n1, n2, ratio, block):
    out, a, b = [], 0, 0
    while a + ratio * block <= n1 and b + block <= n2:
        out += [("a", i) for i in range(a, a + ratio * block)] + [("b", i) for i in range(b, b + block)]
        a, b = a + ratio * block, b + block
    return out


@pytest.mark.parametrize(("n1", "n2", "ratio", "block"), [(50, 20, 2, 4), (3, 20, 2, 4), (40, 5, 1, 5), (0, 0, 1, 1)])
@pytest.mark.parametrize("key", [None, ["id"]])
def test_mix_by_ratio(spark, n1, n2, ratio, block, key):
    d1, d2 = numbered(spark, n1, "a"), numbered(spark, n2, "b")
    got = ops.mix_by_ratio(d1, d2, ["id"], ["id"], ratio, block, key).orderBy("mix_pos").collect()
    assert [r["mix_pos"] for r in got] == list(range(len(got)))
    assert [(r["name"], r["id"]) for r in got] == slow_mix(n1, n2, ratio, block)


def test_mix_schedule_and_errors(spark):
    d1, d2 = numbered(spark, 30, "a"), numbered(spark, 30, "b")
    got = ops.mix_by_schedule(d1, d2, ["id"], ["id"], [(2, 1, 2), (1, 1, 1), (0, 1, None)], 3).orderBy("mix_pos")
    names = "".join(r["name"] for r in got.collect())
    assert names == "aaaaaabbb" * 2 + "aaabbb" + "bbb" * 7
    with pytest.raises(ValueError):
        ops.mix_by_ratio(d1, d2, ["id"], ["id"], 0, 4)


def sequence_rows(rng, n):
    rows = []
    for i in range(n):
        size = rng.randrange(0, 12)
        ids = [rng.randrange(1000) for _ in range(size)]
        given = i < n // 2
        rows.append((i, ids, [1] * size if given else None, [-100] * size if given else None))
    return rows


@pytest.mark.parametrize("mode", ["pretrain", "finetune", "labelled"])
@pytest.mark.parametrize("narrow", [True, False])
def test_pad_batches(spark, mode, narrow):
    rows = sequence_rows(random.Random(4), 22)
    if mode == "labelled":
        rows = rows[:11]
    df = spark.createDataFrame(rows, "id long, input_ids array<int>, attention_mask array<int>, labels array<int>")
    if narrow:
        out = ops.padded_batches(df, ["id"], ["id"], 4, mode)
    else:
        out = ops.pad_batches(ops.batches(df, ["id"], 4), mode)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for start in range(0, len(rows), 4):
        batch = rows[start : start + 4]
        longest = max(len(r[1]) for r in batch)
        complete = all(r[3] is not None for r in batch)
        for i, ids, mask, labels in batch:
            fill = longest - len(ids)
            assert got[i]["batch_id"] == start // 4 and got[i]["padded_len"] == longest
            assert got[i]["input_ids"] == ids + [T.PAD] * fill
            use = mask if mode == "labelled" or complete else [1] * len(ids)
            assert got[i]["attention_mask"] == use + [0] * fill
            use = ids if mode == "finetune" else labels if mode == "labelled" or complete else ids
            assert got[i]["labels"] == use + [-100] * fill


def test_pad_batches_without_given_columns(spark):
    df = spark.createDataFrame([(0, 0, [1]), (1, 0, [1, 2])], "id long, batch_id long, input_ids array<int>")
    got = {r["id"]: r for r in ops.pad_batches(df).collect()}
    assert got[0]["attention_mask"] == [1, 0] and got[0]["labels"] == [1, -100]
    with pytest.raises(ValueError):
        ops.pad_batches(df, "other")


@pytest.mark.parametrize("block", [1, 5, 16, 1000])
def test_pack_sequences(spark, block):
    rng = random.Random(8)
    rows = [(i, [rng.randrange(9) for _ in range(rng.choice([0, 1, 3, 40]))]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, input_ids array<int>").repartition(4)
    chain = [t for _, ids in rows for t in ids]
    got = ops.pack_sequences(df, ["id"], block).orderBy("block_id").collect()
    assert [r["input_ids"] for r in got] == [chain[i : i + block] for i in range(0, len(chain), block)]


def test_places_of_sequences_are_sent_out(spark, monkeypatch):
    df = spark.range(50).selectExpr("id", "array(cast(id AS int), 1, 2) AS input_ids").repartition(4)
    sent = []
    for most in (ops.MOST_PLACES, 0):
        monkeypatch.setattr(ops, "MOST_PLACES", most)
        packed = ops.pack_sequences(df, ["id"], 7)
        sent.append(packed._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast"))
        assert [t for r in packed.orderBy("block_id").collect() for t in r["input_ids"]] == [t for i in range(50) for t in (i, 1, 2)]
    assert sent[0] == sent[1] + 1


def test_padding_report(spark):
    sizes = [1, 10, 1, 10, 1, 10]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, n long")
    got = {r["batching"]: r for r in ops.padding_report(df, "n", "id", 2).collect()}
    assert got["unsorted"]["total_tokens"] == 60 and got["sorted"]["total_tokens"] == 2 + 20 + 20
    assert got["sorted"]["used_tokens"] == 33 and got["unsorted"]["waste"] == pytest.approx(27 / 60)


@pytest.mark.parametrize("ratio", [0, 1, 2])
def test_classify_steps(spark, ratio):
    steps = [0, 1, 2, 3, 6, 8, 9, 30]
    df = spark.createDataFrame([(s,) for s in steps], "global_step long")
    got = {r["global_step"]: (r["modality"], r["modality_step"]) for r in ops.classify_steps(df, ratio).collect()}
    seen = {"audio": 0, "text": 0}
    for s in steps:
        kind = "audio" if ratio <= 0 or s % (ratio + 1) == 0 else "text"
        assert got[s] == (kind, seen[kind])
        seen[kind] += 1
