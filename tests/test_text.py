import random
import re

import pytest
from pyspark.sql import functions as F

from phonolake.functions import sql
from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.operators import text as ops


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


def slow_sentences(text, marks):
    """Character by character: end a piece behind a mark and its closing characters."""
    out, piece, i = [], "", 0
    while i < len(text):
        piece += text[i]
        i += 1
        if piece[-1] in marks:
            while i < len(text) and text[i] in T.CLOSING_CHARS:
                piece += text[i]
                i += 1
            out.append(piece)
            piece = ""
    return [p.strip() for p in [*out, piece] if p.strip()]


CASES = ["", "   ", "Wait...", 'Hi! "ok" bye', "no mark", "a. b", 'x.")  y', "A…B?!", "line\nbreak, clause; x: y"]


@pytest.mark.parametrize("text", CASES)
@pytest.mark.parametrize("mode", ["sentence", "clause"])
def test_sentences(spark, text, mode):
    want = slow_sentences(text, X.marks_of(mode))
    assert one(spark, text, lambda c: X.sentences(c, mode)) == want
    assert X.rest_pieces(text, mode) == want


@pytest.mark.parametrize("mode", ["sentence", "clause"])
def test_incremental_cut_does_not_depend_on_pushes(mode):
    rng = random.Random(5)
    alphabet = "ab .!?…,:;\n\"')"
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        buffer, got, at = "", [], 0
        while at < len(text):
            step = rng.randrange(1, 6)
            ready, buffer = X.ready_pieces(buffer + text[at : at + step], mode)
            got += ready
            at += step
        assert got + X.rest_pieces(buffer, mode) == slow_sentences(text, X.marks_of(mode))


def slow_phonemes(ipa):
    text = " ".join(p for p in ipa.strip(T.WHITESPACE).split(" ") if p)
    out, i = [], 0
    while i < len(text):
        for width in (2, 1):
            if text[i : i + width] in T.PHONEMES and len(text[i : i + width]) == width:
                out.append(T.PHONEMES[text[i : i + width]])
                i += width
                break
        else:
            i += 1
    return out


@pytest.mark.parametrize(
    "ipa", ["", "  dʒa  tʃe ", "d?ʒ", "dʒ", "gɡ", "lˈœtfen ɯʊ", "ATŞ ö", "t ʃ", "\tdʒ\n", "a  \n  b"]
)
def test_phonemes(spark, ipa):
    want = slow_phonemes(ipa)
    assert one(spark, ipa, X.ipa_to_tokens) == "".join(want)
    df = spark.createDataFrame([(ipa,)], "ipa string")
    vocab = ops.phoneme_vocab(5)
    assert ops.phoneme_ids(df, first_id=5).first()["phoneme_ids"] == [vocab[w] for w in want]
    assert one(spark, "".join(want), X.phoneme_array) == want


def test_phoneme_vocab():
    assert len(T.PHONEMES) == len(ops.phoneme_vocab()) == 41


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("<custom_token_12>", 12),
        ("  x<custom_token_1><custom_token_2> \n", 2),
        ("<custom_token_>", None),
        ("<custom_token_3> tail", None),
        ("<custom_token_x>", None),
        ("<custom_token_-4>", -4),
        ("noise", None),
        ("", None),
    ],
)
def test_last_token_number(spark, text, number):
    assert one(spark, text, X.last_token_number) == number


def test_prompts(spark):
    df = spark.createDataFrame([("zoe", "hi {text}"), ("", "hi"), (None, "hi")], "s string, t string")
    voice = [r[0] for r in df.select(X.voice_prompt(F.col("s"), F.col("t"))).collect()]
    assert voice == ["zoe: hi {text}", "hi", "hi"]
    bracket = [r[0] for r in df.select(X.bracket_prompt(F.col("s"), F.col("t"))).collect()]
    assert bracket[0] == "<custom_token_3>hi {text}[zoe]<custom_token_4><custom_token_5>"
    assert bracket[1] == bracket[2] == "<custom_token_3>hi<custom_token_4><custom_token_5>"
    fill = lambda t: df.select(X.template_prompt(t, F.col("s"), F.col("t"))).first()[0]
    assert fill("{speaker_id}: {text}") == "zoe: hi {text}"
    assert fill("") == fill(None) == "hi {text}"
    assert fill("fixed") == "fixed"
    # The speaker goes in first, so a text place inside it is filled too.
    odd = spark.createDataFrame([("a{text}", "b")], "s string, t string")
    assert odd.select(X.template_prompt("{speaker_id}", F.col("s"), F.col("t"))).first()[0] == "ab"


def test_strip_takes_all_white_space(spark):
    assert one(spark, T.WHITESPACE + "a b" + T.WHITESPACE, X.strip) == "a b"
    assert (T.WHITESPACE + "a").strip() == "a" and len(set(T.WHITESPACE)) == 29


def test_emotive_tags(spark):
    df = spark.createDataFrame([(1, "<laugh> so <Laugh> happy <nope> happy sad")], "id long, text string")
    got = {(r["kind"], r["word"]): r["n"] for r in ops.emotive_tags(df, "id").collect()}
    assert got == {("tag", "laugh"): 2, ("style", "happy"): 2, ("style", "sad"): 1}


def test_request_plan(spark):
    runs = ops.request_runs(spark, 2, 4)
    got = ops.request_plan(runs, ["Hello"]).collect()
    assert len(got) == 2 * 4 + 2
    three = ops.request_plan(runs, ["Hello", "Well", F.lit("So")]).collect()
    assert {r["label"].split("_")[0] for r in three} == {"short", "medium", "long", "warmup"} and len(three) == 26
    with pytest.raises(ValueError, match="at most 3"):
        ops.request_plan(runs, ["a", "b", "c", "d"])
    by_label = {r["label"]: r for r in got}
    assert by_label["short_run5"]["prompt"] == "Chapter 5: Hello" and by_label["short_run5"]["offset"] == 4
    assert by_label["warmup_run94"]["prompt"] == "Chapter 94: warmup"
    assert sorted(r["label"] for r in got if r["saved"]) == ["short_run0", "short_run1", "short_run2"]


def test_sql_functions(spark):
    sql.register(spark)
    row = spark.sql(
        "SELECT text_sentences('Hi! It\\'s \"ok\". x') s, text_clauses('a,b') c, token_frames(sequence(1, 15)) f, "
        "token_frames(array(1)) e, token_number('<custom_token_7> ') n, voice_prompt('', 'x') p"
    ).first()
    assert row["s"] == ["Hi!", 'It\'s "ok".', "x"] and row["c"] == ["a,", "b"]
    assert row["f"] == [list(range(1, 8)), list(range(8, 15))] and row["e"] == []
    assert row["n"] == 7 and row["p"] == "x"


def test_text_tokens_keep_everything_but_blanks(spark):
    value = "Şu ğ 12a, é́  x²\t—漢字\u00a0\U0001d4b3!"
    tokens = one(spark, value, X.text_tokens)
    assert "".join(tokens) == re.sub("[\x09-\x0d ]", "", value) and tokens[:5] == ["Şu", "ğ", "12", "a", ","]
