"""Rejection of languages that were not learned, and what a language is learned from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from phonolake.llm import language

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("left_out", ["en", "es", "fr"])
def test_texts_of_a_language_left_out_are_turned_away_and_clean_ones_stay(spark, left_out):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language.train(docs.where((F.col("lang") != left_out) & ~language.held_out(F.col("doc_id"))))
    found = language.predict(docs, model).select("lang", "rejected").collect()
    assert np.mean([r["rejected"] for r in found if r["lang"] == left_out]) > 0.9
    assert np.mean([r["rejected"] for r in found if r["lang"] != left_out]) <= 0.01


def test_copies_do_not_take_the_place_of_other_texts(spark, monkeypatch):
    """One text in 200,000 copies beside 500 others of its language."""
    copies = spark.range(200_000).select(F.lit("ban lor tig mur").alias("text"), F.lit("aa").alias("lang"))
    others = [(f"ban lor {'tig ' * (i % 25)}mur {'lor ' * (i // 25)}", "aa") for i in range(500)]
    others += [(f"xok {'jyr ' * i}qual", "bb") for i in range(60)]
    learned = []
    monkeypatch.setattr(language, "fit", learned.extend)
    language.train(copies.unionByName(spark.createDataFrame(others, "text string, lang string")))
    assert [sum(t[0] == lang for t in learned) for lang in ("aa", "bb")] == [501, 60]
