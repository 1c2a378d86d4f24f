import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from phonolake.llm import language
from tests.llm.helpers import run_on

DOCS = "doc_id long, text string, lang string, score string"
SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = language.op5_subword_language(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.98


def rows(n=60):
    rng = np.random.default_rng(1)
    made = {"aa": ["ban", "lor", "tig", "mur"], "bb": ["xok", "zév", "qual", "jyr"]}
    out = []
    for i in range(n):
        lang = ["aa", "bb"][i % 2]
        out.append((i, " ".join(rng.choice(made[lang], 40)), lang, "s"))
    return out


def test_edge_rows_and_held_out_languages_stay_unseen(spark, tmp_path):
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 4 == 2)
    odd = [
        (1000, None, "aa", ""), (1001, "", "aa", ""), (1002, "12 34 --- \n", "aa", ""), (1003, "ban lor", None, ""),
        (None, "ZÉV QUAL xok", None, ""), (held, "ban lor tig", "only-held-out", ""), (1004, "a", None, ""),
        (1005, "xok " * 200_000, "bb", ""), (1006, "中文字", None, ""), (1006, "中文字", None, ""),
    ]
    out = run_on(spark, tmp_path, "op5_subword_language", documents=(rows() + odd, DOCS))
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows()) + len(odd)
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[1003]["lang_pred"] == "aa" and got[None]["lang_pred"] == "bb" and got[1005]["lang_pred"] == "bb"
    assert got[held]["lang_pred"] == "aa" and got[1006]["lang_pred"] in ("aa", "bb")
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _ in rows())


def test_nothing_to_learn_from(spark, tmp_path):
    out = run_on(spark, tmp_path, "op5_subword_language", documents=([(1, "abc", None, "")], DOCS))
    assert [(r["lang_pred"], r["score"]) for r in out] == [("und", 0.0)]
    assert run_on(spark, tmp_path, "op5_subword_language", documents=([], DOCS)) == []


def test_prediction_ignores_everything_but_text(spark):
    df = spark.createDataFrame(rows(), DOCS)
    model = language.train(df)
    texts = df.select("text", F.lit("bb").alias("lang"), F.lit(7).alias("doc_id"))
    a = {r["text"]: r["lang_pred"] for r in language.predict(df, model).collect()}
    b = {r["text"]: r["lang_pred"] for r in language.predict(texts, model).collect()}
    assert a == b


def test_scores_are_rejected_where_the_model_cannot_tell():
    model = language.Model(["a", "b"], np.zeros((language.BUCKETS, 2), np.float32), np.zeros(2), 1.0, 0.5)
    found = language._predict(model, pa.array(["abc", None])).to_pylist()
    assert found[0]["score"] == 0.5 and not found[0]["rejected"] and found[1]["rejected"]


def test_subwords_do_not_cross_words_or_texts():
    def of(*texts):
        grams, first = language.subwords(pa.array(texts))
        return [sorted(grams[a:b]) for a, b in zip(first, first[1:])]

    assert of("ab cd", "x") == of("AB-1-cd", " x.")
    assert of("ab", "cd") == [of("ab")[0], of("cd")[0]]
    assert of("ÉÀ")[0] == of("éà")[0]
    assert of("", None) == [[], []]


def plain_buckets(text):
    """Buckets of one text, byte by byte: words in lower case with one blank around them, runs of three and four."""
    data = bytearray(text.encode())
    for i, b in enumerate(data):
        if 65 <= b <= 90 or (i and text and data[i - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97):
            data[i] = b + 32
    data = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in data)
    data = b" " + data + b" "
    grams = []
    for i in range(1, len(data) - 1):
        for size, factor in ((3, 0x9E3779B1), (4, 0x85EBCA6B)):
            inner = data[i : i + size - 2]
            if len(data) >= i + size - 1 and len(inner) == size - 2 and 32 not in inner:
                gram = int.from_bytes(data[i - 1 : i + size - 1], "little")
                mixed = gram * factor & 0xFFFFFFFF
                mixed ^= mixed >> 15
                grams.append((mixed * 0xC2B2AE35 & 0xFFFFFFFF) >> 17)
    return grams


def test_scores_against_a_plain_loop(spark):
    """Mean of table rows, softmax, and the best class, text by text."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").limit(120)
    model = language.train(docs)
    for row in language.predict(docs, model).collect():
        grams = plain_buckets(row["text"])
        if not any(c.isalpha() for c in row["text"]):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        scores = model.bias.copy()
        if grams:
            scores += sum(model.table[g].astype(float) for g in grams) / len(grams)
        scores = np.exp((scores - scores.max()) / model.temperature)
        scores /= scores.sum()
        assert row["lang_pred"] == model.languages[scores.argmax()]
        assert abs(row["score"] - scores.max()) < 1e-5
        assert row["rejected"] == (row["score"] < model.threshold)


def test_every_labelled_language_is_a_class_and_the_sample_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 300)
    monkeypatch.setattr(language, "TEXT_BUCKETS", 20)
    rng = np.random.default_rng(0)
    rows = [(f"l{i}", " ".join(f"{'abcdefghijklmnop'[i % 16]}{'qrstuvwxyz'[i // 16 % 10]}{w}" for w in rng.choice(["xo", "ja", "ku"], 30))) for i in range(250) for _ in range(3)]
    seen = []
    monkeypatch.setattr(language, "fit", lambda texts: seen.extend(texts))
    language.train(spark.createDataFrame(rows, "lang string, text string"))
    assert {t[0] for t in seen} == {f"l{i}" for i in range(250)}
    assert len(seen) < 600 and all(len(t[1]) <= 20 for t in seen)
