"""Each stage against brute force on its own input."""

import pytest

import corpus_pipeline
from phonolake.session import materialise
from tests.llm import test_decontamination as contaminated
from tests.llm import test_lines as line_test
from tests.llm import test_neardup as groups
from tests.llm import test_packing as pieces

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF)))
    return [df.collect() for df in out]


def texts(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_columns(stages):
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == COLUMNS


def test_language_keeps_clean_documents(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(after) <= set(before) and len(after) >= 0.995 * len(before)


def test_lines(stages):
    before, after = texts(stages[1]), texts(stages[2])
    want = line_test.brute(before, 5, True)
    assert sorted(after) == sorted((d, want[d, t]) for d, t in before)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_one_document_of_each_group_stays(stages):
    before, after = texts(stages[2]), texts(stages[3])
    found = groups.brute(before, corpus_pipeline.SIMILAR)
    assert sorted(d for d, _ in after) == sorted(d for d, _, component in found if d == component)
    assert set(after) <= set(before)


def test_a_pair_of_four_fifths_is_one_group(spark):
    """90 shingles of 110 are shared, a similarity of 0.818; the third text shares 88 of 112, 0.786."""
    words = [f"w{i}" for i in range(104)]
    docs = [(1, words), (2, words[:94] + [f"x{i}" for i in range(10)]), (3, words[:92] + [f"y{i}" for i in range(12)])]
    rows = [(d, " ".join(w), "en", "s", 1) for d, w in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    kept = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]


def test_decontamination(spark, stages):
    before, after = texts(stages[3]), texts(stages[4])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {r[0] for r in contaminated.brute(before, items) if r[-1]}
    assert hit and sorted(d for d, _ in after) == sorted(d for d, _ in before if d not in hit)


def test_packing(stages):
    pieces.check_pieces(stages[5], dict(texts(stages[4])))


ODD = [(1, None, None, None, None), (2, "", "en", "", 0), (3, "12 34", "en", "s", 5), (4, "some words of text here", None, "s", 23),
       (4, "some words of text here", None, "s", 23), (4, "other words of text there", "en", "s", 25), (None, "a b", "en", "s", 3)]


@pytest.mark.parametrize("rows", [[], ODD])
def test_every_stage_takes_odd_rows(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, spark.createDataFrame(rows, schema), SF).collect()
        assert rows or not found


def test_one_row_of_repeated_ids_stays(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    found = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(ODD, schema), SF).collect()
    assert sorted((r["doc_id"] for r in found), key=str) == [1, 2, 3, 4, None]
