"""Subwords by rank tables against plain merging and against the library the rank files are made for."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from phonolake.operators import subwords as ops
from phonolake.operators.vocab import custom_tokens, extend_vocab
from phonolake.plans.vocab import RANKS
from phonolake.sources import readers


def plain(piece, ranks):
    """Merge the leftmost pair of the lowest rank until there is none."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return [ranks.get(p, -1) for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(20))
def test_merging_against_all_pairs(seed):
    rng = random.Random(seed)
    ranks = {bytes([c]): i for i, c in enumerate(b"abcd")}
    for _ in range(rng.randrange(40)):
        ranks.setdefault(bytes(rng.choice(b"abcd") for _ in range(rng.randrange(2, 6))), len(ranks))
    for _ in range(100):
        piece = bytes(rng.choice(b"abcde") for _ in range(rng.randrange(1, 30)))
        assert ops.merge_ids(piece, ranks) == plain(piece, ranks)


@pytest.mark.parametrize("seed", range(20))
def test_merging_in_step_against_all_pairs(seed, monkeypatch):
    """Bytes that are no token, tokens of equal ids, pieces of all lengths, and more pieces than are merged in step."""
    monkeypatch.setattr(ops, "STEP", 7)
    rng = random.Random(seed)
    ranks = {bytes([c]): i for i, c in enumerate(b"abcd")}
    for _ in range(rng.randrange(40)):
        ranks.setdefault(bytes(rng.choice(b"abcde") for _ in range(rng.randrange(2, 6))), rng.randrange(4, 30))
    pairs = ops.Pairs(pa.array(list(ranks), pa.binary()), pa.array(list(ranks.values()), pa.int32()), -1)
    pieces = list({bytes(rng.choice(b"abcde") for _ in range(rng.randrange(90))) for _ in range(100)})
    lists, place = pairs.encode(pa.array([b"x", *pieces], pa.binary()).slice(1))
    assert lists.take(pa.array(place)).to_pylist() == [plain(p, ranks) for p in pieces]
    assert pairs.encode(pa.array([], pa.binary()))[0].to_pylist() == []


def test_a_worker_keeps_nothing_of_the_pieces_it_has_met():
    """600,000 different pieces in thirty batches: what is held after the last is what was held after the first."""
    ranks = {bytes([c]): i for i, c in enumerate(b"abcdefghij")} | {b"ab": 10, b"cd": 11, b"abcd": 12}
    pairs = ops.Pairs(pa.array(list(ranks), pa.binary()), pa.array(list(ranks.values()), pa.int32()), -1)
    digits = bytes.maketrans(b"0123456789", b"abcdefghij")
    held = []
    tracemalloc.start()
    for batch in range(30):
        pieces = [b"%d" % n for n in range(1_000_000 + batch * 20_000, 1_020_000 + batch * 20_000)]
        lists, _ = pairs.encode(pa.array([p.translate(digits) for p in pieces], pa.binary()))
        assert len(lists) == 20_000
        del pieces, lists
        held.append(tracemalloc.get_traced_memory()[0])
    tracemalloc.stop()
    assert held[-1] - held[0] < 1_000_000


def test_a_long_piece_is_merged_in_time():
    ranks = {b"a" * n: n for n in (1, 2, 4, 8)}
    assert ops.merge_ids(b"a" * 200_001, ranks) == [8] * 25_000 + [1]


TEXTS = [
    None, "", " ", "Hello  world\n\n x\t\ty", "it's we'll I'D don't", "naïve Ünïcode — “quotes” 北京 😀", "a b  c",
    "12345 6 7.8", "   trailing   ", "\x00\x07", "x" * 5000, "<custom_token_3>", "?!<custom_token_12>ok<|ph_a|>", "<custom_token_>",
]


def library():
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    from phonolake.functions.text import SUBWORD_PATTERN

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    added = {f"<custom_token_{i}>": 60_000 + i for i in range(20)} | {"<|ph_a|>": 70_000}
    return tiktoken.Encoding("own", pat_str=SUBWORD_PATTERN, mergeable_ranks=ranks, special_tokens=added), added


def test_ids_and_texts_against_the_library(spark):
    encoding, added = library()
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = list(enumerate(TEXTS + docs))
    df = spark.createDataFrame(rows, "n int, text string")
    extra = ops.as_ranks(spark.createDataFrame(list(added.items()), "token string, id int"))
    ranks = readers.read_ranks(spark, f"file://{RANKS}").unionByName(extra)
    coded = ops.subword_encode(df, ranks, F.col("text"))
    got = {r["n"]: list(r["ids"]) for r in coded.select("n", "ids").collect()}
    want = {n: encoding.encode(t, allowed_special="all") if t else [] for n, t in rows}
    assert got == want
    back = ops.subword_decode(coded, ranks, "n")
    assert {r["n"]: r["text"] for r in back.collect()} == {n: t or "" for n, t in rows}
    assert ops.subword_encode(df.limit(0), ranks, F.col("text")).count() == 0


def test_extended_ranks_keep_custom_tokens_whole(spark):
    ranks = readers.read_ranks(spark, f"file://{RANKS}")
    new = custom_tokens(spark, 30).withColumn("token", F.encode("token", "UTF-8"))
    extended = extend_vocab(ranks, new).select("token", "id")
    df = spark.createDataFrame([(0, "<custom_token_3>Hi[ann]<custom_token_29>")], "n int, text string")
    ids = ops.subword_encode(df, extended, F.col("text")).first()["ids"]
    assert (ids[0], ids[-1]) == (50_256 + 3, 50_256 + 29)
    assert ops.subword_decode(ops.subword_encode(df, extended, F.col("text")), extended, "n").first()["text"] == df.first()["text"]


def test_too_many_ranks_are_refused(spark, monkeypatch):
    monkeypatch.setattr(ops, "MOST_RANKS", 100)
    with pytest.raises(ValueError, match="a rank table of 50256 tokens"):
        ops.subword_encode(spark.range(1).select(F.lit("a").alias("t")), readers.read_ranks(spark, f"file://{RANKS}"), F.col("t"))


def test_prompts_by_words_and_by_subwords(spark):
    df = spark.createDataFrame([(1, "Hi you", "k")], "utt_id long, text string, kept string")
    words = spark.createDataFrame([("Hi", 7), ("you", 8)], "token string, id int")
    row = ops.encode_prompts(df, F.col("text"), words, "utt_id", "ids", ["kept"]).first()
    assert (row["utt_id"], row["kept"], row["ids"]) == (1, "k", [7, 8])
    row = ops.encode_prompts(df, F.col("text"), readers.read_ranks(spark, f"file://{RANKS}"), "utt_id", "ids", ["kept"]).first()
    assert row["ids"] == library()[0].encode("Hi you")
