import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from phonolake.llm import quality
from tests.llm.helpers import SF, run_on

DOCS = "doc_id long, text string, n_words string, kept string"
LABELS = "doc_id long, quality int, toxic int, text string"


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    times = Counter(windows)
    hit = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def check(rows, texts):
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = quality.op3_decision_list(spark, SF).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_edge_rows(spark, tmp_path):
    texts = {
        1: None, 2: "", 3: " \n\t\x0b", 4: "a\na\n a\n\n\na", 5: "é—漢 \x1c x\x85y #|", 6: "w " * 100_000,
        7: "a b c d e a b c d e", 8: "a b c d e f g h i j k\n" * 2, 9: "x" * 300_000 + "\n" + "x" * 300_000,
    }
    rows = [(k, v, "", "") for k, v in texts.items()]
    labels = [(1, 0, 0, ""), (1, 1, 0, ""), (2, None, 0, ""), (99, 0, 0, ""), (None, 0, 0, "")]
    out = run_on(spark, tmp_path, "op3_decision_list", documents=(rows, DOCS), labels=(labels, LABELS))
    assert len(out) == len(texts)
    check(out, texts)


def test_empty_tables(spark, tmp_path):
    assert run_on(spark, tmp_path, "op3_decision_list", documents=([], DOCS), labels=([], LABELS)) == []
    same = [(1, "one two three four five six seven eight nine ten", "", "")] * 2
    out = run_on(spark, tmp_path, "op3_decision_list", documents=(same, DOCS), labels=([], LABELS))
    assert [r["kept"] for r in out] == [True, True]


def labelled(n=600):
    rng = np.random.default_rng(3)
    rows = rng.random((n, len(quality.FEATURES)))
    bad = (rows[:, 2] > 0.7) | ((rows[:, 1] <= 0.3) & (rows[:, 4] > 0.5))
    return rows, bad


def test_rules_find_the_planted_conjunctions():
    rows, bad = labelled()
    found = quality.learn_rules(rows, bad)
    hit = np.zeros(len(rows), bool)
    for rule in found.rules:
        hit |= quality.covered(rule, rows)
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() < 0.02 * (~bad).sum()


def test_noise_gives_no_rule():
    rows, _ = labelled()
    found = quality.learn_rules(rows, np.random.default_rng(4).random(len(rows)) < 0.1)
    assert found.rules == []


def test_expression_agrees_with_the_list(spark):
    rules = quality.DecisionList(
        [[quality.Condition("symbols_per_word", True, 0.5), quality.Condition("n_words", False, 20.0)],
         [quality.Condition("mean_word", False, 2.0)]]
    )
    texts = ["a b c d e f g h i j k", "word## word## " * 6, "word## word## " * 60, "plain words in a longer line of text here now ok"]
    stats = quality.add_statistics(spark.createDataFrame([(t,) for t in texts], "text string"))
    got = stats.withColumns(quality.features() | {"rule": rules.column()}).select(*quality.FEATURES, "rule", F.col("text"))
    for r in got.collect():
        row = np.array([[r[f] for f in quality.FEATURES]])
        want = next((i for i, rule in enumerate(rules.rules, 1) if quality.covered(rule, row)[0]), 0)
        assert r["rule"] == want
    assert {r["rule"] for r in got.collect()} == {0, 1, 2}
