import zlib

import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from phonolake.llm import packing, words
from tests.llm.helpers import SF, run_on

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, sequence_id string, doc_tokens int"


def plain_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(rows, texts):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids, at = plain_ids(text), 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            body = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(body) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
    assert max(sizes) <= 2048 and all(n == 2048 or n & (n - 1) == 0 for n in sizes)


def test_query_holds_every_id_once(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_pieces(packing.op9_hilbert_packing(spark, SF).collect(), texts)


def test_edge_rows(spark, tmp_path):
    odd = "İıſK <|endoftext|> a\x1cb c　d é é ́x 12 3's don't\r\n\t\v\f zz"
    texts = {1: None, 2: "", 3: "  \n ", 4: odd, 5: "word " * 9000, 6: "word " * 9000, 7: "x" * 5000}
    rows = [(k, v, "s", 3) for k, v in texts.items()]
    check_pieces(run_on(spark, tmp_path, "op9_hilbert_packing", documents=(rows, DOCS)), texts)


def test_empty_table_and_repeated_rows(spark, tmp_path):
    assert run_on(spark, tmp_path, "op9_hilbert_packing", documents=([], DOCS)) == []
    out = run_on(spark, tmp_path, "op9_hilbert_packing", documents=([(1, "a b", "", 0)] * 3, DOCS))
    assert sum(r["length"] for r in out) == 9


def test_equal_texts_lie_together():
    ids = np.array([5, 6, 7, 1, 5, 6, 7, 1, 900, 1], np.uint16)
    keys = packing.hilbert_key(packing.coordinates(ids, np.array([4, 4, 2])))
    assert keys[0] == keys[1] != keys[2]


def test_hilbert_visits_every_cell_once_by_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_key(grid, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


@given(st.integers(0, 10**7))
def test_tail_is_cut_at_powers_of_two(total):
    at = [*packing.boundaries(total, 2048), total]
    assert at[0] == total - total % 2048
    assert all((b - a) & (b - a - 1) == 0 for a, b in zip(at, at[1:]))


@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_words_agree_with_pattern(texts):
    import re

    import pyarrow as pa

    found = words.Words(*words.raw(pa.array(texts)), words.PLAIN)
    want = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert found.counts().tolist() == list(map(len, want))
    flat = [w for ws in want for w in ws]
    first = {}
    for word, h in zip(flat, found.hashes.tolist()):
        assert first.setdefault(word, h) == h
    assert len(set(first.values())) == len(first)
