import hashlib
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from phonolake.llm import warc
from tests.llm.helpers import run_on, same_as_sql

PAGES = "page_id long, url string, html string, digest string"


def test_query_matches_sql(spark):
    same_as_sql(spark, "op8_seekable_warc")


def test_edge_rows(spark, tmp_path):
    big, odd = "é" * 50, "a\r\n\r\nb\0ß퟿" * 30
    rows = [
        (5, "u", big, "x"), (3, None, big, "x"), (9, "u", big, "x"), (3, "again", big, "x"),
        (1, "u", "short", "x"), (2, "u", "short", "x"), (4, "u\r\nX: y", odd, None), (6, "", None, None),
        (7, "u", "", None), (8, "u", "z" * 3_000_000, None), (None, "u", big, None), (10, "u", "q" * 99, ""),
        (11, "u", "q" * 99, ""), (None, "u", "alone" * 40, ""),
    ]
    out = run_on(spark, tmp_path, "op8_seekable_warc", pages=(rows, PAGES))
    want = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        revisit = html == big and page_id != 3
        kind = ("revisit", 3) if revisit else ("response", None)
        want.append((page_id, len(data), hashlib.sha256(data).hexdigest(), *kind))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_other_columns_may_have_any_name(spark):
    rows = [(i, "u", "same" * 50, 1, "x") for i in range(4)] + [(9, "u", "other" * 50, 2, "y")]
    pages = spark.createDataFrame(rows, "id long, url string, payload string, _first int, `first.key` string")
    found = {r["id"]: r["refers_to"] for r in warc.mark_revisits(pages).collect()}
    assert found == {0: None, 1: 0, 2: 0, 3: 0, 9: None}


def test_a_payload_of_most_pages_does_not_move(spark):
    """Rows that meet their first page are narrow, in a join whose sides are dealt by it alone."""
    pages = spark.range(2000).select("id", F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, F.repeat(F.lit("p"), 5000)).otherwise(F.concat(F.repeat(F.lit("q"), 200), "id")).alias("payload"))
    marked = warc.mark_revisits(pages)
    assert marked.where("refers_to = 1").count() == marked.where("refers_to is not null").count() > 1300
    assert marked.where("refers_to is not null and payload <> ''").count() == 0
    assert marked.count() == 2000


def test_empty_table(spark, tmp_path):
    assert run_on(spark, tmp_path, "op8_seekable_warc", pages=([], PAGES)) == []


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "bundles")
    pages = spark.range(400).select(
        "id", F.lit("http://x/").alias("url"), F.concat(F.lit("page "), F.col("id").cast("string"), F.repeat(F.lit(" w"), 400)).alias("payload")
    )
    warc.write_bundles(pages.repartition(2, "id"), path, frame_bytes=2000)
    return path


def test_any_reader_of_the_format_sees_the_records(archive):
    total = 0
    files = sorted(Path(archive).glob("part-*"))
    assert len(files) > 2
    for file in files:
        data = file.read_bytes()
        if data:
            plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
            assert plain.startswith(b"WARC/1.1\r\n")
            total += plain.count(b"WARC-Record-ID")
            bundle = warc.Bundle(data)
            assert len(bundle.frames) <= warc.BUNDLE_FRAMES
            assert b"".join(bundle.frame(i) for i in range(len(bundle.frames))) == plain
    assert total == 400


def test_index_and_random_access(spark, archive):
    assert warc.read_index(spark, archive).select("id").distinct().count() == 400
    wanted = spark.createDataFrame([(7,), (390,), (7,), (12345,)], "id long")
    got = {r["id"]: warc.parse_record(r["record"]) for r in warc.fetch(spark, archive, wanted).collect()}
    assert sorted(got) == [7, 390]
    assert got[7]["payload"].startswith(b"page 7 w") and got[7]["headers"]["x-page-id"] == "7"


def test_damage_is_noticed():
    record = warc.build_record(1, "u", b"abc", 3, hashlib.sha256(b"abd").hexdigest(), None)
    with pytest.raises(ValueError, match="damaged"):
        warc._row(warc.parse_record(record))
