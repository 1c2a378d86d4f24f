"""Secret scan with corpus-wide ownership frequency.

Candidates are assignments, access keys, long hexadecimal runs and, added by this method, generic tokens: runs of 20 or
more token characters that mix both cases and digits. Every candidate value is hashed, and hashes are counted over
distinct owners and repositories of the whole corpus. A value that ``EXAMPLE_OWNERS`` owners or more share is a copied
example; one that fewer have is specific to its owners and looks live. Generic tokens are reported where they look live;
the other kinds always are.

All of it are DataFrame expressions. Places come from the lengths of what lies between and inside the matches. Distinct
(hash, owner, repository) rows are combined before they move, then counted in two steps, so a value in a third of all
texts costs a row per task. Texts are read once and never shuffled.

Defined results: null text is empty; a null owner or repository is one of its own; repeated rows are separate documents
of one owner; an empty table gives an empty table. Places are code points, the end excluded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.llm.registry import query, table
from phonolake.session import materialise


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed patterns; the order of the kinds is the order of spans that start together.
NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
KINDS = {
    "assign": rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{16,}",  # a run is as long as it can be, so no shorter match hides a longer one
    "hex": "[0-9a-f]{24,}",
    "generic": "[A-Za-z0-9+/_-]{20,}",
}
BASE = ["assign", "access", "hex"]
LEAST_VALUE = 6
EXAMPLE_OWNERS = 3


def _spans(kind: str) -> Column:
    """Matches of one kind as structs (start, kind, stop, value), by start."""
    pattern = KINDS[kind]
    text, found = F.col("_text"), F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("_text", F.lit(pattern), F.lit(2)) if kind == "assign" else found
    number = list(KINDS).index(kind)
    zipped = F.arrays_zip(
        found.alias("hit"), value.alias("value"), F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap")
    )

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        stop = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), stop.alias("stop"), x["value"].alias("value"))
        return F.struct(F.concat(state["out"], F.array(span)).alias("out"), stop.alias("at"))

    empty = F.array().cast("array<struct<start:int,kind:int,stop:int,value:string>>")
    spans = F.aggregate(zipped, F.struct(empty.alias("out"), F.lit(0).alias("at")), step, lambda s: s["out"])
    if kind == "assign":
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= LEAST_VALUE)
    if kind == "generic":
        spans = F.filter(
            spans, lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]")
        )
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def candidates(docs: DataFrame) -> DataFrame:
    """Per document its candidate spans with the hash of their values: doc_id, _row, owner, repository, found."""
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce("owner", F.lit("")).alias("owner"),
        F.coalesce("repository", F.lit("")).alias("repository"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    spans = F.array_sort(F.concat(*[_spans(kind) for kind in KINDS]))
    hashed = F.transform(
        spans, lambda s: F.struct(s["start"], s["kind"], s["stop"], F.sha2(s["value"].cast("binary"), 256).alias("hash"))
    )
    return materialise(rows.withColumn("found", hashed).drop("_text"))


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash the number of distinct owners and repositories that hold it."""
    held = found.select(F.explode("found.hash").alias("hash"), "owner", "repository").distinct()
    held = held.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return held.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def scan(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``docs`` (doc_id, text, owner, repository) as doc_id and ``spans``: structs of
    (start, kind, stop, hash, owners, repositories, live), all that are reported, by start and kind.
    """
    found = candidates(docs)
    # Written, so that the join deals both sides itself and Spark can split a value that is very common.
    owners = materialise(ownership(found))
    each = found.where(F.size("found") > 0).select("_row", F.inline("found")).join(owners, "hash")
    live = F.col("owners") < example_owners
    generic = F.col("kind") == list(KINDS).index("generic")
    each = each.withColumn("live", live).where(~generic | live)
    span = F.struct("start", "kind", "stop", "hash", "owners", "repositories", "live")
    spans = each.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    joined = found.select("doc_id", "_row").join(spans, "_row", "left")
    return joined.select("doc_id", F.coalesce("spans", none).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
    return F.array_join(F.transform(spans, text), ",")


def _count(condition) -> Column:
    return F.size(F.filter("spans", condition)).cast("long")


def _is_kind(number: int):
    return lambda s: s["kind"] == number


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    of_kind = {f"n_{k}": _count(_is_kind(i)) for i, k in enumerate(KINDS)}
    return found.select(
        "doc_id",
        *[column.alias(name) for name, column in of_kind.items()],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        _count(lambda s: s["live"]).alias("n_live"),
        _count(lambda s: ~s["live"]).alias("n_example"),
    )


def _sql() -> str:
    quoted = {k: p.replace("'", "''") for k, p in KINDS.items()}
    of_kind = " union all ".join(
        f"""select doc_id, owner, repository, {i} kind, regexp_extract_all(t, '{quoted[k]}', 0) h,
            regexp_extract_all(t, '{quoted[k]}', {2 if k == "assign" else 0}) v, string_split_regex(t, '{quoted[k]}') p
            from d where regexp_matches(t, '{quoted[k]}')"""
        for i, k in enumerate(KINDS)
    )
    names = ", ".join(f"'{k}'" for k in KINDS)
    counts = ", ".join(f"count(*) filter (kind = {i}) n_{k}" for i, k in enumerate(KINDS))
    zeros = ", ".join(f"coalesce(n_{k}, 0)::bigint n_{k}" for k in KINDS)
    return f"""
with d as (select doc_id, coalesce(source, '') owner, coalesce(source, '') || '/' || coalesce(lang, '') repository,
                  coalesce(text, '') t from documents),
m as ({of_kind}),
e as (select doc_id, owner, repository, kind, h, p, v, unnest(range(1, len(h) + 1)) i from m),
s as (
  select doc_id, owner, repository, kind, v[i] val,
         (list_sum(list_transform(p[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0))::bigint a, length(h[i]) n from e),
c as (
  select * from s where (kind <> 0 or length(val) >= {LEAST_VALUE}) and (kind <> 3 or
    (regexp_matches(val, '[a-z]') and regexp_matches(val, '[A-Z]') and regexp_matches(val, '[0-9]')))),
o as (select val, count(distinct owner) < {EXAMPLE_OWNERS} live from c group by 1),
r as (select doc_id, kind, a, [{names}][kind + 1] || ':' || a || ':' || (a + n) x, live
      from c join o using (val) where kind <> 3 or live),
g as (
  select doc_id, {counts}, count(*) filter (live) n_live, count(*) filter (not live) n_example,
         string_agg(x, ',' order by a, kind) spans, string_agg(x, ',' order by a, kind) filter (kind < 3) base
  from r group by 1)
select d.doc_id, {zeros}, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans,
       coalesce(n_live, 0)::bigint n_live, coalesce(n_example, 0)::bigint n_example
from d left join g using (doc_id)
"""


OP2_SQL = _sql()


@query("op2_secret_ownership", OP2_SQL)
def op2_secret_ownership(spark, sf_dir):
    """Secrets of every document; a source is an owner, its texts of one language a repository."""
    docs = table(spark, sf_dir, "documents")
    source = F.coalesce("source", F.lit(""))
    repository = F.concat_ws("/", source, F.coalesce("lang", F.lit("")))
    return digest(scan(docs.select("doc_id", "text", source.alias("owner"), repository.alias("repository"))))
