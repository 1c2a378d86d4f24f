"""Hidden Markov model against plain recursions, and its scores against plain counts."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from phonolake.llm import hmm, registry, words
from phonolake.session import materialise
from tests.llm.helpers import SF, run_on

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string"


def texts(n, seed=1):
    """Two kinds of texts with words of their own, and some words of both."""
    rng = random.Random(seed)
    pools = [[f"{kind}{i}" for i in range(12)] + ["of", "In"] for kind in ("ka", "mo")]
    out = [" ".join(rng.choices(pools[i % 2], k=rng.choice([0, 1, 5, 7, 8, 9, 40, 510, 511, 512, 300]))) for i in range(n)]
    return out + [None, "", " \n", "Ka1 kA1\tKA1"]


def class_of(token):
    """Class of a word, of the end if it is None; the word's hash comes from the library."""
    if token is None:
        return hmm.CLASSES
    return int(words.Words(*words.raw(pa.array([token])), words.LOWER).hashes[0] >> np.uint64(64 - hmm.BITS))


def tokens_of(text):
    return [w.translate(FOLD) for w in WORD.findall(text or "")] + [None]


def plain(model, classes):
    """Forward and backward of one text, step by step."""
    alphas, scales = [], []
    for t, c in enumerate(classes):
        alpha = (model.start if t == 0 else alphas[-1] @ model.move) * model.emit[c]
        scales.append(alpha.sum())
        alphas.append(alpha / alpha.sum())
    betas = [np.ones(len(model.start))]
    for c in reversed(classes[1:]):
        beta = model.move @ (model.emit[c] * betas[-1])
        betas.append(beta / beta.sum())
    betas.reverse()
    share = [a * b / (a * b).sum() for a, b in zip(alphas, betas, strict=True)]
    moves = np.zeros_like(model.move)
    for t in range(1, len(classes)):
        step = alphas[t - 1][:, None] * model.move * (model.emit[classes[t]] * betas[t])[None, :]
        moves += step / step.sum()
    return sum(map(math.log10, scales)), share, moves


def some_model(states, seed=0):
    rng = np.random.default_rng(seed)
    model = hmm.untrained(rng.uniform(1, 9, hmm.CLASSES + 1), states)
    model.move = rng.dirichlet(np.ones(states), states)
    model.start = rng.dirichlet(np.ones(states))
    return model


@pytest.mark.parametrize("states", [1, 3, 8])
def test_spans_give_the_plain_recursion(states):
    model = some_model(states)
    column = pa.array([*texts(25), " ".join(f"w{i % 37}" for i in range(2500))])
    tokens = hmm.Tokens(column)
    lattice = hmm.Lattice(model, tokens)
    likelihoods = hmm.Lattice(model, tokens).likelihoods()
    by_step, moves, starts = lattice.expected()
    share = np.empty_like(by_step)
    share[lattice.order] = by_step
    all_moves, all_starts = np.zeros_like(model.move), np.zeros(states)
    for i, text in enumerate(column.to_pylist()):
        classes = [class_of(t) for t in tokens_of(text)]
        low, high = tokens.first[i], tokens.first[i + 1]
        assert tokens.classes[low:high].tolist() == classes
        likelihood, own, step = plain(model, classes)
        assert likelihoods[i] == pytest.approx(likelihood)
        np.testing.assert_allclose(share[low:high], own, rtol=1e-8)
        all_moves, all_starts = all_moves + step, all_starts + own[0]
    np.testing.assert_allclose(moves, all_moves, rtol=1e-8)
    np.testing.assert_allclose(starts, all_starts, rtol=1e-8)


def brute_training(column, states, rounds):
    counts = {}
    for text in column:
        for token in tokens_of(text):
            counts[token] = counts.get(token, 0) + 1
    mass = np.ones(hmm.CLASSES + 1)
    for token, n in counts.items():
        mass[class_of(token)] += n + 1
    model = hmm.untrained(mass, states)
    for _ in range(rounds):
        emit, moves, starts = np.zeros_like(model.emit), np.zeros_like(model.move), np.zeros(states)
        for text in column:
            classes = [class_of(t) for t in tokens_of(text)]
            _, share, step = plain(model, classes)
            for c, s in zip(classes, share, strict=True):
                emit[c] += s
            moves, starts = moves + step, starts + share[0]
        model = hmm.learned(model, emit, moves, starts)
    return model, counts


@pytest.mark.parametrize("table", [hmm.TABLE, 4, 0])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, table):
    monkeypatch.setattr(hmm, "TABLE", table)
    rows = list(enumerate(texts(60))) + [(None, "ka1 other words"), (3, "ka1 ka2"), (3, "ka1 ka2"), (900, "new new ka1")]
    rows += [(i, " ".join(["unseen"] * 50 + ["of"])) for i in range(1000, 1060) if zlib.crc32(str(i).encode()) % 7 == 2]
    is_held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    got = run_on(spark, tmp_path, "op11_hidden_markov", documents=(rows, SCHEMA))
    model, counts = brute_training([t for i, t in rows if not is_held(i)], hmm.STATES, hmm.ROUNDS)
    total, different = sum(counts.values()), len(counts)
    expected = []
    for i, text in rows:
        found = tokens_of(text)
        base = sum(math.log10((counts.get(t, 0) + 1) / (total + different + 1)) for t in found)
        classes = [class_of(t) for t in found]
        inner = sum(math.log10((counts.get(t, 0) + 1) / model.mass[c]) for t, c in zip(found, classes, strict=True))
        known = sum(t in counts for t in found)
        expected.append((i, is_held(i), len(found), known, total, base, plain(model, classes)[0] + inner))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted((tuple(r[n] for n in names) for r in got), key=key)
    for mine, want in zip(got, sorted(expected, key=key), strict=True):
        assert mine[:5] == want[:5]
        assert mine[5:] == pytest.approx(want[5:])


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_counts_of_a_table(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    counts = hmm.Counts(keys, np.arange(1, len(keys) + 1))
    asked = np.concatenate([keys, keys + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    known = dict(zip(keys.tolist(), range(1, len(keys) + 1), strict=True))
    assert counts.of(asked).tolist() == [known.get(h, 0) for h in asked.tolist()]


def test_sums_pass_in_packed_form():
    values = np.zeros((9, 3))
    values[[2, 7]] = np.arange(6).reshape(2, 3) + 0.5
    rows, found = hmm._unpacked(hmm._packed(values, "f4"), 3, "f4")
    assert rows.tolist() == [2, 7] and found.tolist() == values[[2, 7]].tolist()
    assert hmm._unpacked(hmm._packed(values * 0, "f8"), 3, "f8")[1].shape == (0, 3)


def test_probabilities_sum_to_one():
    model, counts = brute_training(texts(10), 3, 2)
    by_class = {}
    for token, n in counts.items():
        by_class.setdefault(class_of(token), []).append(n + 1)
    np.testing.assert_allclose(model.emit.sum(0), 1)
    np.testing.assert_allclose(model.move.sum(1), 1)
    for c, masses in by_class.items():
        assert sum(masses) + 1 == model.mass[c]  # one for an unknown word


def test_rounds_raise_the_likelihood_and_partitions_do_not_matter(spark):
    df = spark.createDataFrame([(t,) for t in texts(60)], "text string")
    counts = materialise(hmm.count_words(df))
    shared = df.select(F.col("text").alias("_text"))
    model = hmm.untrained(np.ones(hmm.CLASSES + 1), 4)
    last = -math.inf
    for _ in range(4):
        one, many = hmm._round(shared.coalesce(1), model), hmm._round(shared.repartition(5), model)
        for a, b in zip(one, many, strict=True):
            np.testing.assert_allclose(a, b, rtol=1e-6, atol=1e-9)
        assert one[3] > last
        last = one[3]
        model = hmm.learned(model, *one[:3])
    assert counts.count() == len({t for x in texts(60) for t in tokens_of(x)})


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    rows = registry.QUERIES["op11_hidden_markov"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    n = sum(r["n_tokens"] for r in rows)
    gain = sum(r["score"] - r["base_score"] for r in rows) / n
    assert len(rows) > 100
    assert gain > 0.15  # log10 a token


def test_end_is_no_word_of_the_smallest_table(spark):
    counts = hmm.count_words(spark.read.parquet(f"{SF}/documents.parquet"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert counts.where(F.col("word") == hmm.END).first()["n"] == docs


def test_no_training_texts_and_clashing_columns(spark):
    schema = "`a.b` int, place int, text string, rest string, score string, single int"
    df = spark.createDataFrame([(1, 2, "x y", "r", "s", 5), (1, 2, "x y", "r", "s", 5), (2, 2, None, None, None, None)], schema)
    counts = materialise(hmm.count_words(df.limit(0)))
    out = hmm.score(df, hmm.train(df.limit(0), counts), counts)
    assert out.columns == ["a.b", "place", "rest", "score", "single", "n_tokens", "n_known", "train_tokens", "base_score"]
    rows = sorted(out.collect())
    assert [r["n_tokens"] for r in rows] == [3, 3, 1]
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows)
    assert rows[0]["score"] == rows[1]["score"] < 0
    assert hmm.score(df.limit(0), hmm.train(df, counts), counts).count() == 0
