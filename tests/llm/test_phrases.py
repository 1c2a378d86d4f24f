import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from phonolake.llm import phrases
from tests.llm.helpers import SF, run_on

DOCS = "doc_id long, text string, n_words string, _spans int"


def brute(docs):
    key = lambda d: -1 if d is None else d
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    earliest = {}
    for d, w in texts:
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            earliest[k] = min(earliest.get(k, (key(d), i)), (key(d), i))
    out = Counter()
    for d, w in texts:
        gone = set()
        for i in range(len(w) - 19):
            if earliest[tuple(w[i : i + 20])] < (key(d), i):
                gone |= set(range(i, i + 20))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def check(spark, tmp_path, docs):
    got = run_on(spark, tmp_path, "op7_phrase_automata", documents=([(*d, "", 0) for d in docs], DOCS))
    assert Counter(map(tuple, got)) == brute(docs)


@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = phrases.op7_phrase_automata(spark, sf_dir).collect()
    want = brute(docs)
    assert Counter(map(tuple, got)) == want
    assert sum(n for (_, _, gone, _), n in want.items() if gone) > 5


def passages(rng, n):
    return [" ".join(rng.integers(0, 10**6, size).astype(str)) for size in rng.integers(15, 60, n)]


def test_edge_rows(spark, tmp_path):
    rng = np.random.default_rng(0)
    shared = passages(rng, 6)
    docs = [(1, None), (2, ""), (3, "a " * 19), (4, "a " * 20), (5, "a " * 500), (6, "\n\ta  " * 21), (7, "b c " * 40),
            (8, "É漢 \x1c" * 60), (9, "É漢 \x1c" * 60), (None, shared[0]), (10, "x" * 100_000 + " " + shared[1])]
    for i in range(30):
        parts = [shared[k] for k in rng.integers(0, 6, 3)] + passages(rng, 1)
        docs.append((100 - i, ("\n" if i % 2 else "  ").join(parts)))
    docs += [docs[12], (100, "again " + shared[2]), (100, shared[2])]
    check(spark, tmp_path, docs)


@pytest.mark.parametrize("hot", [50_000, 6, 1])
def test_small_shards_and_hot_phrases(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "PIECES", 7)
    rng = np.random.default_rng(1)
    shared = passages(rng, 3)
    check(spark, tmp_path, [(i, " ".join([shared[i % 3], *passages(rng, 1), shared[(i + 1) % 3][5:]])) for i in range(25)])


def test_places_come_from_the_automaton(spark, tmp_path):
    """A piece does not say where its phrase is; without a compiled phrase nothing is found."""
    docs = [(i, " ".join(f"w{k}" for k in range(40))) for i in range(4)]
    shard = phrases._Shard()
    shard.phrase("w3 w4 w5 w6 w7", 2, False)
    shard.pieces = [(i, 0, i, i, False, docs[i][1]) for i in (1, 0)]
    assert shard.resolved() == ([(1, 1, 0, 23)], [])  # the windows around the phrase, in the later document
    shard.times.clear()
    assert shard.resolved() == ([], [])
    check(spark, tmp_path, docs)


def test_small_alphabet(spark, tmp_path):
    rng = np.random.default_rng(2)
    check(spark, tmp_path, [(i, " ".join(rng.choice(["a", "b"], p=[0.9, 0.1], size=120))) for i in range(25)])


def test_empty_table_and_other_columns(spark, tmp_path):
    assert run_on(spark, tmp_path, "op7_phrase_automata", documents=([], DOCS)) == []
    text = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(1, text, "kept", 5), (2, "z " + text, "kept", 6)], "doc_id long, text string, _row string, _all int")
    out = phrases.remove_repeats(df).orderBy("doc_id").select("text", "_row", "_all", F.col("n_removed")).collect()
    assert [tuple(r) for r in out] == [(text, "kept", 5, 0), ("z", "kept", 6, 30)]
