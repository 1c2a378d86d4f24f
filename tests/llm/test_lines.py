import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from phonolake.llm import lines
from tests.llm.helpers import run_on, same_as_sql

DOCS = "doc_id long, text string, n_lines string, _lines string, line string"


BLANKS = " \t\r\v\f"


def brute(docs, least, keep_first):
    """Kept text per (doc_id, text) by plain dictionaries."""
    found = []
    for doc, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0], d[1] or "")):
        for i, line in enumerate((text or "").split("\n")):
            ws = [None if re.search("[0-9]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", line)]
            if ws:
                leaf = (len(ws), *ws[:3]) if len(ws) >= 4 else line.strip(BLANKS)
                found.append((doc, text or "", i, ws if len(ws) >= 4 else [], leaf, line.strip(BLANKS)))
    tokens, leaves = defaultdict(set), defaultdict(set)
    for _, text, _, ws, leaf, _ in found:
        leaves[leaf].add(text)
        for p, w in enumerate(ws):
            if w is not None:
                tokens[leaf, p, w].add(text)
    templates, members = defaultdict(set), defaultdict(list)
    for doc, text, i, ws, leaf, line in found:
        keys = {line}
        for share in lines.SHARES:
            most = max(least, share * len(leaves[leaf]))
            constant = tuple((p, w) for p, w in enumerate(ws) if w is not None and len(tokens[leaf, p, w]) >= most)
            if constant and len(constant) >= 0.7 * sum(w is not None for w in ws):
                keys.add(constant)
        for key in keys:
            templates[leaf, key].add(text)
            members[leaf, key].append((doc, text, i))
    gone = set()
    for key, texts in templates.items():
        if len(texts) >= (5 * least if isinstance(key[0], str) else least):
            first = members[key][0]
            gone |= {m for m in members[key] if not (keep_first and (m[0], m[2]) == (first[0], first[2]))}
    return {
        (doc, text): "\n".join(x for i, x in enumerate((text or "").split("\n")) if (doc, text or "", i) not in gone)
        for doc, text in docs
    }


def documents():
    body = [f"own words number {'abcdefghij'[i]} of this text {'klmnopqrst'[i]} stay here" for i in range(10)]
    docs = []
    for i in range(8):
        docs.append((i, f"{body[i]}\nAll rights reserved by {'xyz'[i % 3]}{i} since then\n\nshort line\nAll rights kept by them {i}"))
    docs += [(20 + i, "a copied text that is\nthe same in many rows") for i in range(9)]
    docs += [(30 + i, f"12 34 56 78 {i}\nthe first and the {'uvwxyzabc'[i]} one\n{'k' * i} the of and") for i in range(7)]
    docs += [(50, None), (51, ""), (52, "\n\n"), (53, "w " * 50_000 + "\n" + "All rights kept by them 9"), (None, "All rights kept by them 77"), (0, docs[0][1])]
    docs += [(100 + i, f"Seen in the {'abc'[i % 3]} by {'xyzuvw'[i // 3 % 6]} for our dear readers\nown {'k' * i}\n Read more ") for i in range(60)]
    return docs


@pytest.mark.parametrize(("least", "keep_first"), [(5, False), (5, True), (2, False), (3, True)])
def test_against_brute_force(spark, least, keep_first):
    docs = documents()
    df = spark.createDataFrame([(*d, "", "", "") for d in docs], DOCS)
    got = lines.drop_lines(df, least=least, keep_first=keep_first)
    assert set(df.columns) < {*got.columns}
    want = brute(docs, least, keep_first)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((d[0], want[d]) for d in docs)
    assert any(want[d] != (d[1] or "") for d in docs)
    for r in got.collect():
        assert r["n_dropped"] <= r["n_lines"]


def kept(spark, tmp_path, docs):
    """Rows of the registered query."""
    return {r["doc_id"]: r for r in run_on(spark, tmp_path, "op10_template_lines", documents=(docs, "doc_id long, text string"))}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n", [300, 20_000])
def test_the_same_mix_drops_the_same_share_in_any_corpus(spark, tmp_path, n):
    """100 sections and 100 names, evenly spread: values of a field do not split a template as the corpus grows."""
    word = [f"{'abcdefghij'[i // 10]}{'klmnopqrst'[i % 10]}" for i in range(100)]
    docs = [(i, f"Posted in the {word[i % 100]} by {word[i // 100 % 100]} for our readers today\nown {i}") for i in range(n)]
    assert all(r["n_dropped"] == 1 and r["kept_sha256"] == sha(f"own {i}") for i, r in kept(spark, tmp_path, docs).items())


def test_lines_of_digits_recur(spark, tmp_path):
    """The first is one text everywhere, the others are a template whose fields are digits."""
    docs = [(i, f"own {i}\nTel: 0800 123 456 789\n12 34 56 78\nPage {i} of {i + 9}") for i in range(8)]
    assert {i: r["kept_sha256"] for i, r in kept(spark, tmp_path, docs).items()} == {i: sha(f"own {i}") for i in range(8)}


def test_short_lines_recur_by_their_text(spark, tmp_path):
    docs = [(i, f"own {i}\n Read more \n\nAll rights reserved" + "\nAt last" * (i < 24)) for i in range(25)]
    want = {i: sha(f"own {i}\n" + "\nAt last" * (i < 24)) for i in range(25)}
    assert {i: r["kept_sha256"] for i, r in kept(spark, tmp_path, docs).items()} == want


def test_a_template_of_most_lines_can_be_split(spark):
    """A join's sides are dealt by the join alone: no count is still dealt by the same key."""
    docs = [(i, f"All rights reserved by them {i}\nown words {'k' * (i % 50)}") for i in range(3000)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        texts = spark.createDataFrame(docs, "_id long, _text string")
        texts = texts.select("_id", F.xxhash64("_id", "_text").alias("_row"), F.xxhash64("_text").alias("_copy"), "_text")
        lost = lines.recurring_lines(texts, keep_first=True)
        plan = lost._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning(leaf") == 2
    assert lost.count() == 2999


def test_query_matches_sql(spark):
    same_as_sql(spark, "op10_template_lines", "/root/testdata/sf0.01")


def test_query_drops_lines(spark):
    out = lines.op10_template_lines(spark, "/root/testdata/sf0.01")
    assert out.where(F.col("n_dropped") > 0).count() > 10


def test_empty_table(spark, tmp_path):
    assert run_on(spark, tmp_path, "op10_template_lines", documents=([], DOCS)) == []
