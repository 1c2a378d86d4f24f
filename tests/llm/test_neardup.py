import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from phonolake.llm import neardup
from tests.llm.helpers import SF, run_on

DOCS = "doc_id long, text string, component_id string, cls int"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs, percent=85):
    """Component by id; rows that share an id are one node, a null id is the smallest."""
    key = lambda d: -1 if d is None else d
    sets = [(key(d), shingles(t)) for d, t in docs]
    holders = defaultdict(set)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].add(i)
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, s) in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = root(d), root(sets[j][0])
                up[max(a, b)] = min(a, b)
    return Counter((d, len(shingles(t)), None if root(key(d)) < 0 else root(key(d))) for d, t in docs)


def check(spark, tmp_path, docs):
    got = run_on(spark, tmp_path, "op6_bayes_minhash", documents=([(*d, "", 0) for d in docs], DOCS))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("sf_dir", [SF, "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = neardup.op6_bayes_minhash(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(docs)


def test_edge_rows(spark, tmp_path):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 10**6, 400).astype(str)
    docs = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "b a"), (7, "a b c d e"), (8, "A B C D E"),
            (9, "w " * 50_000), (10, "w w w w w"), (11, "w w w w"), (None, "x y z"), (12, "x y z"), (13, None)]
    for i in range(40):  # near copies of one text, some on either side of the limit
        words = base.copy()
        words[rng.integers(0, 400, rng.integers(0, 20))] = "edit"
        docs.append((100 + i, " ".join(words)))
    docs += [(100, docs[-1][1]), (101, docs[14][1]), (200, "a b c d e"), (200, "a b c d e"), (200, "x y z")]
    check(spark, tmp_path, docs)


def test_empty_table(spark, tmp_path):
    assert run_on(spark, tmp_path, "op6_bayes_minhash", documents=([], DOCS)) == []


def test_blocks_of_a_large_bucket_lose_no_pair(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "SET_BLOCK", 5)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 10**6, 300).astype(str)
    docs = []
    for i in range(60):
        words = base.copy()
        words[rng.integers(0, 300, rng.integers(1, 12))] = f"e{i}"
        docs.append((i, " ".join(words)))
    check(spark, tmp_path, docs)


def test_prune_keeps_similar_and_drops_different():
    rng = np.random.default_rng(2)

    def pair(similarity, size=600):
        common = round(size * 2 * similarity / (1 + similarity))
        words = rng.integers(0, 10**9, 2 * size - common).astype(str)
        return [" ".join(words[:size]), " ".join([*words[:common], *words[size:]])]

    texts = [t for s in (0.86, 0.9, 0.99, 0.3, 0.6, 0.7) for _ in range(30) for t in pair(s)]
    found = neardup.Sets(pa.array(texts))
    sketches = found.sketches()
    n = len(texts) // 2
    left = np.arange(n) * 2
    stay = np.zeros(n, bool)
    stay[neardup.survivors(left, left + 1, sketches, found.sizes)[0]] = True
    sets = [shingles(t) for t in texts]
    true = np.array([len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in left])
    assert stay[true >= 0.85].all() and not stay[true < 0.7].any()


def test_bounds_follow_the_posterior():
    need = neardup.least_equal()
    assert need[0] == 0 and (np.diff(need) >= 0).all() and 0.78 < need[1024] / 1024 < 0.85


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)] + [(200, k) for k in range(201, 230)]
    got = dict(map(tuple, neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 90 for i in (90, 95, 100)} | {k: 200 for k in range(200, 230)}
