"""Line dedup by a log-template tree.

A line's place in the tree has a fixed depth: its number of tokens, then its leading tokens, where a token with a digit is a
variable field. Inside a leaf a token is constant at its position if at least ``MIN_DOCUMENTS`` different documents have
it there, and a share of all documents of the leaf: a line has a template for each of ``SHARES``, so values of a field
that reach ``MIN_DOCUMENTS`` in a large corpus are variable in one of them, as they are in a small one. A template is a
line's constant tokens. Tokens with a digit are fields that always match; of the other positions, at least one,
``LEAST_CONSTANT`` must be constant. A line's whole text, but for blanks at its ends, is one more template, which needs no constant
tokens. It is the only one of lines of fewer than ``MIN_TOKENS`` tokens, which needs ``SHORT`` times the documents, because few
words meet by chance.

A template that occurs in ``MIN_DOCUMENTS`` different documents recurs, and its lines are dropped: all of them, or all but the
first one (smallest document, then line) if ``keep_first`` is set; then every dropped line has an earlier one with which
it shares a template.

Documents with equal texts count once, so the lines of mere copies do not recur. Counts go over the whole corpus. The
first scan counts leaves, the second hands on the tokens of lines in recurring leaves only, told by a filter of fixed
size; what it lets through in vain falls out in the counts. Every count combines distinct (key, document) pairs before
they move. Counts are written before lines meet them, so both sides of such a join are dealt by it alone, and Spark can
split the rows of a token or template that a third of all documents share, or send a small table of counts to all tasks.

Defined results: null text has one empty line and becomes empty; blank lines always stay; a document may lose all lines and
stays as an empty text; very long texts and lines are read whole, in batches of half a megabyte or one text; equal rows
get equal results; a null id sorts first, equal ids by their lines' numbers; an empty table gives an empty one. All other
columns are kept, whatever their names; columns with the names that are added are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.llm import filters, words
from phonolake.llm.columns import pack, unpack
from phonolake.llm.registry import bound_batches, query, table
from phonolake.session import materialise

MIN_TOKENS = 4
LEADING = 3
MIN_DOCUMENTS = 5
LEAST_CONSTANT = 0.7
SHARES = (0.0, 0.01, 0.1, 0.5)
SHORT = 5
FIELD = np.uint64(0x2A)


class Lines:
    """Lines with words: leaf, text, line number, and their words."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = words.raw(column)
        found = words.Words(data, offsets, words.PLAIN)
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        self.field = digits[found.ends] > digits[found.starts]
        self.hashes = np.where(self.field, FIELD, found.hashes)
        breaks = np.flatnonzero(data == 10)
        owners = found.owners()
        line = np.searchsorted(breaks, found.starts)
        self.first = first = np.flatnonzero(np.diff(line + owners, prepend=-1))
        self.sizes = np.diff(np.append(first, len(found)))
        self.owner = owners[first]
        self.number = line[first] - np.searchsorted(breaks, offsets[:-1])[self.owner]
        self.long = self.sizes >= MIN_TOKENS
        self.text = words.blocks_of_spans(words.PLAIN.values, data, found.starts[first], found.ends[first + self.sizes - 1])
        self.leaf = words.mix(self.text + words.BASE)
        lead = words.sequence_hashes(self.hashes, first[self.long], LEADING)
        self.leaf[self.long] = words.mix(lead + self.sizes[self.long].astype(np.uint64) * words.BASE)

    def keys(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of (leaf, position, token) of the chosen lines' constant-looking words, and how many each has."""
        sizes = self.sizes[chosen]
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(self.first[chosen], sizes) + place
        leaf = np.repeat(self.leaf[chosen], sizes)
        keys = words.mix(leaf + words.mix(self.hashes[at] + place.astype(np.uint64) * words.BASE))
        plain = ~self.field[at] & np.repeat(self.long[chosen], sizes)
        line = np.repeat(np.arange(len(sizes)), sizes)
        return keys[plain], np.bincount(line[plain], minlength=len(sizes))


def _leaves(batches):
    for batch in words.slices(batches, "_text"):
        lines = Lines(batch.column("_text"))
        pairs = np.unique(np.stack([lines.owner.astype(np.uint64), lines.leaf], 1), axis=0)
        copies = batch["_copy"].to_numpy(zero_copy_only=False)[pairs[:, 0].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(words.signed(pairs[:, 1].copy())), pa.array(copies)], ["leaf", "_copy"])


def _tokens(shared):
    def run(batches):
        for batch in words.slices(batches, "_text"):
            lines = Lines(batch.column("_text"))
            chosen = np.flatnonzero(filters.contains(shared.value, lines.leaf))
            keys, counts = lines.keys(chosen)
            at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            owner = pa.array(lines.owner[chosen])
            held = [batch.column(c).take(owner) for c in ("_id", "_row", "_copy")]
            own = [pa.array(lines.number[chosen].astype(np.int32)), pa.array(lines.sizes[chosen].astype(np.int32))]
            tokens = pa.ListArray.from_arrays(pa.array(at), pa.array(words.signed(keys)))
            hashes = [pa.array(words.signed(h[chosen])) for h in (lines.leaf, lines.text)]
            yield pa.RecordBatch.from_arrays(
                [*held, *own, *hashes, tokens], ["_id", "_row", "_copy", "line", "n", "leaf", "whole", "tokens"]
            )

    return run


LINE = "_id long, _row long, _copy long, line int, n int, leaf long, whole long, tokens array<long>"


def _common(pairs: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Keys that at least ``least`` different documents have."""
    counts = pairs.select(*keys, "_copy").distinct().groupBy(*keys).agg(F.count("*").alias("documents"))
    return counts.where(F.col("documents") >= least)


def _levels(lines: DataFrame, least: int) -> DataFrame:
    """Constant tokens, and how many of ``SHARES`` of their leaf's documents they reach."""
    tokens = _common(lines.select("leaf", "_copy", F.explode("tokens").alias("token")), ["leaf", "token"], least)
    leaves = _common(lines, ["leaf"], least).withColumnRenamed("documents", "all")
    reached = sum((F.col("documents") >= share * F.col("all")).cast("int") for share in SHARES)
    return tokens.join(leaves, "leaf").select("token", reached.alias("level"))


def recurring_lines(texts: DataFrame, least: int = MIN_DOCUMENTS, keep_first: bool = False) -> DataFrame:
    """Lines to drop, (_row, _copy, lines), from ``texts`` (_id, _row, _copy, _text)."""
    spark = texts.sparkSession
    leaves = texts.select("_copy", "_text").mapInArrow(_leaves, "leaf long, _copy long")
    known = spark.sparkContext.broadcast(filters.build(_common(leaves, ["leaf"], least), "leaf"))
    lines = texts.mapInArrow(_tokens(known), LINE).withColumn("_place", F.monotonically_increasing_id())
    lines = materialise(lines)  # repeated rows differ by their place
    levels = materialise(_levels(lines, least))
    each = lines.select("_place", F.explode("tokens").alias("token")).join(levels, "token")
    # The set of constant tokens at each share by two sums that need no order.
    sums, sets = [], []
    for i in range(len(SHARES)):
        token = F.when(F.col("level") > i, F.col("token"))
        again = F.when(F.col("level") > i, F.xxhash64("token"))
        sums += [F.count(token).alias(f"c{i}"), F.bit_xor(token).alias(f"a{i}"), F.bit_xor(again).alias(f"b{i}")]
        enough = F.col(f"c{i}") >= LEAST_CONSTANT * F.col("n")
        sets.append(F.when(enough, F.struct(F.col(f"a{i}").alias("t1"), F.col(f"b{i}").alias("t2"))))
    # Tokens move to their line as they are: sums of single tokens would be larger.
    found = each.repartition("_place").groupBy("_place").agg(*sums)
    sized = lines.select("_place", "_id", "_row", "_copy", "line", F.size("tokens").alias("n"), "leaf")
    templates = found.join(sized, "_place").withColumn("_sets", F.array_compact(F.array_distinct(F.array(*sets))))
    templates = materialise(templates.select("_id", "_row", "_copy", "line", "leaf", F.inline("_sets")))
    template = ["leaf", "t1", "t2"]
    own = [F.col("whole").alias("t1"), F.lit(0).cast("long").alias("t2")]
    whole = lines.select("_id", "_row", "_copy", "line", "leaf", *own)
    many = _common(lines.select("_copy", "leaf", "n", *own), [*template, "n"], least)
    many = many.where((F.col("n") >= MIN_TOKENS) | (F.col("documents") >= SHORT * least))
    recurring = materialise(_common(templates, template, least).unionByName(many.drop("n")).select(*template))
    dropped = templates.unionByName(whole).join(recurring, template)
    if keep_first:
        dropped = materialise(dropped)
        place = F.struct("_id", "line")
        firsts = materialise(dropped.groupBy(*template).agg(F.min(place).alias("_first")))
        dropped = dropped.join(firsts, template).where(~place.eqNullSafe(F.col("_first")))
    return dropped.groupBy("_row", "_copy").agg(F.collect_set("line").alias("_lines"))


def drop_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_DOCUMENTS, keep_first: bool = False
) -> DataFrame:
    """``docs`` without the lines of recurring templates; adds n_lines and n_dropped."""
    bound_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    own = {"_row": F.xxhash64(doc_id, whole), "_copy": F.xxhash64(whole), "_id": F.col(doc_id).cast("long")}
    keyed = pack(docs, **own, _text=whole)
    lost = recurring_lines(keyed.select("_id", "_row", "_copy", "_text"), least, keep_first)
    joined = keyed.join(lost, ["_row", "_copy"], "left")
    split = F.split("_text", "\n", -1)
    stays = F.filter(split, lambda line, i: ~F.array_contains("_lines", i))
    rest = F.when(F.col("_lines").isNull(), F.col("_text")).otherwise(F.array_join(stays, "\n"))
    dropped = F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines"))
    return unpack(joined, docs.columns, **{text: rest, "n_lines": F.size(split), "n_dropped": dropped})


OP10_SQL = rf"""
with d as (select doc_id, coalesce(text, '') t from documents),
l as (select doc_id, t, ls, unnest(range(1, len(ls) + 1)) i from (select doc_id, t, string_split(t, chr(10)) ls from d)),
w as (select doc_id, t, i, trim(ls[i], e' 	
') line, list_transform(regexp_extract_all(ls[i], '[^ 	-
]+'),
        lambda x: case when regexp_matches(x, '[0-9]') then '' else x end) ws from l),
c as (select doc_id, t, i, ws, line, len(ws) n, len(list_filter(ws, lambda x: x <> '')) asked,
        case when len(ws) >= {MIN_TOKENS} then [len(ws)::varchar, ws[1], ws[2], ws[3]] else [line] end leaf
      from w where len(ws) > 0),
k as (select *, unnest(range(1, n + 1)) p from c where n >= {MIN_TOKENS}),
held as (select leaf, count(distinct t) docs from c group by leaf),
tok as (select leaf, p, ws[p] x, count(distinct t) docs from k where ws[p] <> '' group by all having count(distinct t) >= {MIN_DOCUMENTS}),
lvl as (select tok.leaf, p, x, s from tok join held using (leaf), (values {", ".join(f"({x}::double)" for x in SHARES)}) v(s)
        where tok.docs >= s * held.docs),
tpl as (
  select doc_id, i, t, leaf, list((p, x) order by p) tp
  from (select k.doc_id, k.i, k.t, k.leaf, k.asked, k.p, k.ws[k.p] x from k) k1
  join lvl using (leaf, p, x) group by doc_id, i, t, leaf, asked, s having count(*) >= {LEAST_CONSTANT}::double * asked),
rec as (select leaf, tp from tpl group by all having count(distinct t) >= {MIN_DOCUMENTS}),
whole as (select leaf, line from c group by leaf, line, n
          having count(distinct t) >= case when n >= {MIN_TOKENS} then {MIN_DOCUMENTS} else {SHORT * MIN_DOCUMENTS} end),
gone as (select doc_id, t, list(distinct i) lost from (
    select doc_id, t, i from tpl join rec using (leaf, tp)
    union all select doc_id, t, i from c join whole using (leaf, line)) group by 1, 2)
select d.doc_id, len(string_split(d.t, chr(10)))::int n_lines, coalesce(len(lost), 0)::int n_dropped,
       sha256(case when lost is null then d.t else array_to_string(
         [z[1] for z in list_zip(string_split(d.t, chr(10)), range(1, len(string_split(d.t, chr(10))) + 1))
          if not list_contains(lost, z[2])], chr(10)) end) kept_sha256
from d left join gone g on d.doc_id = g.doc_id and d.t = g.t
"""


@query("op10_template_lines", OP10_SQL)
def op10_template_lines(spark, sf_dir):
    """Every document without lines whose template recurs in five documents or more."""
    kept = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)
