import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from phonolake.llm import secrets
from tests.llm.helpers import run_on, same_as_sql

DOCS = "doc_id long, text string, source string, lang string, spans string, owner string"
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def check(rows, texts):
    for r in rows:
        found = base(texts[r["doc_id"]])
        text = ",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in found)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in found) for k in range(3)]
        left = [s for s in r["spans"].split(",") if s and not s.startswith("generic")]
        assert ",".join(left) == text


def test_query_matches_sql(spark):
    same_as_sql(spark, "op2_secret_ownership", "/root/testdata/sf0.01")


TEXTS = {
    1: None, 2: "", 3: "password=abc", 4: "token: secret: abcdefgh", 5: "API_KEY = 'a1b2c3d4'", 6: "ſecret=abcdefg",
    7: "é𝒳 toKen=\"é\" token=abcdef " + "0123456789abcdef" * 3, 8: "AKIA" + "X" * 15 + " AKIA" + "Y" * 16,
    9: "AKIAXAKIA" + "Q" * 14, 10: "secret=" + "deadbeef" * 4 + "AKIA" + "A" * 20, 11: "apikey=abcdef" * 400,
    12: "x" * 200_000 + " passwd:abcdefg", 13: "apiKey\n= abcdefg api__key=abcdefg PASSWD  =  abc.def",
    14: "f" * 24 + "F" + "0" * 23, 15: "password=token=secret=x1", 16: "\n\npassword='",
}


def test_edge_rows(spark, tmp_path):
    rows = [(k, v, "s", "en", "x", "y") for k, v in TEXTS.items()] + [(17, "token=abcdef", None, None, None, None)]
    out = run_on(spark, tmp_path, "op2_secret_ownership", documents=(rows, DOCS))
    assert len(out) == len(rows)
    check(out, TEXTS | {17: "token=abcdef"})


def test_empty_and_repeated(spark, tmp_path):
    assert run_on(spark, tmp_path, "op2_secret_ownership", documents=([], DOCS)) == []
    rows = [(1, "token=abcdef", "s", "en", "", "")] * 3
    out = run_on(spark, tmp_path, "op2_secret_ownership", documents=(rows, DOCS))
    assert [(r["n_assign"], r["n_live"]) for r in out] == [(1, 1)] * 3


def test_ownership_separates_examples_from_live(spark, tmp_path):
    shared, own = "AbCdEfGhIjKlMnOpQr12", "ZzYyXxWwVvUuTtSsRr99"
    rows = [(i, f"x {shared} y", f"s{i % 3}", "en", "", "") for i in range(6)]
    rows += [(10 + i, f"x {own} y", "s1", "en" if i else "fr", "", "") for i in range(4)]
    out = {r["doc_id"]: r for r in run_on(spark, tmp_path, "op2_secret_ownership", documents=(rows, DOCS))}
    assert all(out[i]["n_generic"] == 0 and out[i]["spans"] == "" for i in range(6))
    assert all(out[10 + i]["spans"] == "generic:2:22" and out[10 + i]["n_live"] == 1 for i in range(4))
    docs = spark.createDataFrame([(r[0], r[1], r[2], r[2] + r[3]) for r in rows], "doc_id long, text string, owner string, repository string")
    found = secrets.ownership(secrets.candidates(docs)).collect()
    assert sorted((r["owners"], r["repositories"]) for r in found) == [(1, 2), (3, 3)]


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_random_texts(spark, data):
    alphabet = st.sampled_from(["token", "Secret", "=", ":", " ", '"', "abcdef12", "é", "AKIA", "ABCDEFGHIJKLMNOPQ", "0f", "\n", "api_key"])
    texts = {i: "".join(data.draw(st.lists(alphabet, max_size=40))) for i in range(60)}
    docs = spark.createDataFrame([(k, v, "o", "r") for k, v in texts.items()], "doc_id long, text string, owner string, repository string")
    check(secrets.digest(secrets.scan(docs)).collect(), texts)
