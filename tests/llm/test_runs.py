"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib

import pytest

from phonolake.llm import runs
from tests.llm.helpers import SF, run_on

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(items, shortest=24, times=3):
    """For each period the maximal stretches that keep it; the smallest period of a stretch is the run's."""
    found = {}
    for q in range(1, len(items) // times + 1):
        start = None
        for i in range(len(items) - q + 1):
            same = i + q < len(items) and items[i] == items[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i - start + q
                if length >= max(shortest, times * q):
                    found.setdefault((start, length), q)
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    ws = WORD.findall(text or "")
    ws = ws if doc_id is None else planted(ws, doc_id)
    found = brute(ws)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = (None,) * 4
    if found:
        s, n, q = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
    return (doc_id, len(found), *best, sha(lines), sha(kept))


@pytest.mark.parametrize("seed", range(60))
def test_automaton_against_all_periods(seed):
    rng = random.Random(seed)
    items = []
    while len(items) < rng.choice([30, 150, 400]):
        unit = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(1, 14))]
        items += unit * rng.randrange(1, 9)
    assert runs.runs_of(items) == brute(items)
    assert runs.runs_of(items, 6, 2) == brute(items, 6, 2)


def test_period_one_stays_fast():
    assert runs.runs_of([0] * 20_000) == [(0, 20_000, 1)]


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert runs.runs_of(b) == brute(b)


def test_query_on_edge_rows(spark, tmp_path):
    rng = random.Random(3)
    unit = "alpha beta\tgamma\n delta"
    rows = [
        (None, "x " * 30), (1, None), (2, ""), (3, " \n\t"), (4, unit * 9), (4, unit * 9), (5, "é ü " * 40),
        (6, "a b " * 11 + "a b c"), (7, "one two three " * 8), (8, ("w " * 23) + "z"), (9, "w " * 24),
        (10, " ".join(rng.choice("abcdefg") for _ in range(3000))), (11, " ".join(f"v{i}" for i in range(3000))),
        *((i, " ".join(rng.choice(["la", "le", "lu"]) for _ in range(rng.randrange(1, 300)))) for i in range(12, 90)),
    ]
    schema = "doc_id long, text string"
    got = sorted(map(tuple, run_on(spark, tmp_path, "op12_periodic_runs", documents=(rows, schema))), key=repr)
    assert got == sorted((expected(*r) for r in rows), key=repr)


def test_query_on_whole_table(spark):
    from phonolake.llm import registry

    got = sorted(map(tuple, registry.QUERIES["op12_periodic_runs"](spark, SF).collect()))
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 6000").select("doc_id", "text").collect()
    small = {r["doc_id"] for r in docs}
    assert len(small) > 100
    assert [r for r in got if r[0] in small] == sorted(expected(*r) for r in docs)


def test_clashing_columns_and_no_rows(spark):
    schema = "`_done` int, `a.b` string, runs int, text string, n_words string"
    df = spark.createDataFrame([(1, "k", 2, "go " * 30, "n")], schema)
    out = runs.collapse_runs(df)
    assert out.columns == ["_done", "a.b", "runs", "text", "n_words"]
    row = out.first()
    assert (row["_done"], row["a.b"], row["text"], row["n_words"]) == (1, "k", "go", 30)
    assert [tuple(r) for r in row["runs"]] == [(0, 30, 1)]
    assert runs.collapse_runs(df.limit(0)).count() == 0
