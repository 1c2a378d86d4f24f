import hashlib
import re

import numpy as np

from phonolake.llm import filters
from tests.llm.helpers import run_on, same_as_sql

DOCS = "doc_id long, text string, n_words string, window string"
ITEMS = "item_id long, text string, size string"


def of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = of(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = of(text)
        hit, owners = set(), set()
        for i in range(len(w)):
            for n in range(1, 11):
                if i + n <= len(w) and tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    owners |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(owners), digest, bool(hit)))
    return sorted(out, key=str)


def check(spark, tmp_path, docs, items):
    tables = {
        "documents": ([(*d, "", "") for d in docs], DOCS),
        "benchmark": ([(*i, "") for i in items], ITEMS),
    }
    got = run_on(spark, tmp_path, "op4_prefix_join", **tables)
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_query_matches_sql(spark):
    same_as_sql(spark, "op4_prefix_join", "/root/testdata/sf0.01")


def test_edge_rows(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(30))
    docs = [
        (1, None), (2, ""), (3, long.upper()), (4, "w5 " + " ".join(f"w{i}" for i in range(4, 14))), (5, "one"),
        (6, "a b c. d-e? a b"), (7, "same " * 3000), (8, "Éa É\x01a İ straße x"), (9, "w0 w1 w2 w3 w4 w5 w6 w7 w8"),
        (3, long.upper()), (None, long), (10, " ".join(f"w{i}" for i in range(25, 30)) + " " + long),
    ]
    items = [
        (1, long), (2, "One"), (3, None), (4, "--"), (5, "a b"), (6, "c, d, e"), (7, "same " * 12), (8, "É a i̇"),
        (None, "straße X"), (9, long), (1, long), (10, "never seen words here at all in any of the texts"), (11, "same same"),
    ]
    check(spark, tmp_path, docs, items)


def test_random_texts(spark, tmp_path):
    rng = np.random.default_rng(2)
    text = lambda n: " ".join(rng.choice(list("abc"), n))
    docs = [(i, text(rng.integers(0, 80))) for i in range(40)]
    items = [(i, text(rng.integers(0, 25))) for i in range(12)]
    check(spark, tmp_path, docs, items)


def test_empty_tables(spark, tmp_path):
    check(spark, tmp_path, [], [(1, "a b")])
    check(spark, tmp_path, [(1, "a b")], [])
    check(spark, tmp_path, [(1, "a b")], [(1, " ")])


def test_filter_never_misses(spark):
    values = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 3000)
    table = filters.build(spark.createDataFrame([(int(v),) for v in values], "h long"), "h", 16)
    assert filters.contains(table, values.view(np.uint64)).all()
    others = np.random.default_rng(1).integers(0, 2**63, 3000, dtype=np.uint64)
    assert filters.contains(table, others).mean() < 0.1
