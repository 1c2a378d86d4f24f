"""Benchmark decontamination as a prefix-filtered set join.

An item window (ten consecutive words of an item, or a whole shorter item) is a set of placed shingles of five words;
items of fewer words have one shingle, themselves. A document contains the window only if it contains all its shingles,
so it is enough to join one: shingles are ordered by how often they occur in the corpus, and the rarest of each window is
its prefix. A window with a shingle that never occurs cannot occur and is dropped. A document place that has a prefix
shingle must leave room for the window before and behind it (positional and length bound); what remains is compared word
by word.

The corpus is read twice, once to count the benchmark's shingles and once for candidates; both scans skip other
shingles by a filter of fixed size. The benchmark is never broadcast by hand: its tables are joined by key.

Defined results: words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased; null and empty
texts have no words, items without words have no window; a null item id counts as the empty string; repeated items and
documents are judged each for itself. Columns other than id and text are ignored.
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

WINDOW = 10
SHINGLE = 5


def _texts(found: words.Words) -> np.ndarray:
    body = found.pattern.fold[found.data].tobytes()
    spans = zip(found.starts.tolist(), found.ends.tolist(), strict=True)
    return np.array([body[a:b].decode() for a, b in spans], object)


def _item_windows(batches):
    """Distinct windows of each item with the hashes of their shingles in order."""
    for batch in words.slices(batches, "text"):
        found = words.Words(*words.raw(batch.column("text")), words.ALNUM)
        texts = _texts(found)
        rows = []
        for i, item in enumerate(batch["item_id"].to_pylist()):
            low, high = int(found.first[i]), int(found.first[i + 1])
            width = min(WINDOW, high - low)
            size = min(SHINGLE, width)
            for start in range(low, high - width + 1) if width else ():
                at = np.arange(start, start + width - size + 1)
                hashes = words.sequence_hashes(found.hashes, at, size)
                rows.append((item, texts[start : start + width].tolist(), size, words.signed(hashes).tolist()))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.string(), pa.list_(pa.string()), pa.int32(), pa.list_(pa.int64())]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["item_id", "window", "size", "shingles"])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """One row per item and window: item_id, window (words), size of its shingles, their hashes."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    schema = "item_id string, window array<string>, size int, shingles array<long>"
    return items.mapInArrow(_item_windows, schema)


def _found_in(found: words.Words, wanted, sizes: list[int]):
    for size in sizes:
        hashes, at = found.windows(size)
        chosen = filters.contains(wanted, hashes)
        yield size, hashes[chosen], at[chosen]


def _counts(shared, sizes: list[int]):
    def run(batches):
        for batch in words.slices(batches, "text"):
            found = words.Words(*words.raw(batch.column("text")), words.ALNUM)
            hits = [hashes for _, hashes, _ in _found_in(found, shared.value, sizes)]
            keys, times = np.unique(np.concatenate(hits), return_counts=True)
            columns = [pa.array(words.signed(keys)), pa.array(times.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["shingle", "times"])

    return run


def _candidates(shared, sizes: list[int]):
    """One row per document (place null) and one per place that may have a prefix shingle, with the words around it."""

    def run(batches):
        for batch in words.slices(batches, "text"):
            found = words.Words(*words.raw(batch.column("text")), words.ALNUM)
            counts, owners = found.counts(), found.owners()
            n = len(counts)
            rows = batch["_row"].to_numpy(zero_copy_only=False)
            body = found.pattern.fold[found.data].tobytes()
            keys, places, hashes, around, before = [], [], [], [], []
            for _, hits, at in _found_in(found, shared.value, sizes):
                owner = owners[at]
                low = np.maximum(at - (WINDOW - 1), found.first[owner])
                high = np.minimum(at + WINDOW, found.first[owner + 1])
                for a, b in zip(low.tolist(), high.tolist(), strict=True):
                    spans = zip(found.starts[a:b].tolist(), found.ends[a:b].tolist(), strict=True)
                    around.append([body[s:e].decode() for s, e in spans])
                keys.append(rows[owner])
                places.append(at - found.first[owner])
                hashes.append(words.signed(hits))
                before.append(at - low)
            total = len(around)
            ids = batch["doc_id"].to_pylist() + [None] * total
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, places, hashes, before)]
            blank = [None] * n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(np.concatenate([rows, flat[0]]), pa.int64()),
                    pa.array(counts.tolist() + [None] * total, pa.int64()),
                    pa.array(blank + flat[1].tolist(), pa.int64()),
                    pa.array(blank + flat[2].tolist(), pa.int64()),
                    pa.array(blank + flat[3].tolist(), pa.int32()),
                    pa.array(blank + around, pa.list_(pa.string())),
                ],
                ["doc_id", "_row", "n_words", "place", "shingle", "before", "around"],
            )

    return run


CANDIDATE = "doc_id long, _row long, n_words long, place long, shingle long, before int, around array<string>"


def occurrences(documents: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, _row, n_words), occurring windows (_row, start, length, window), window owners.

    ``documents`` has doc_id and text. Window owners are (window, item_id), each pair once.
    """
    spark = documents.sparkSession
    items = materialise(item_windows(benchmark))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # 1 to 5
    shingles = items.select(F.explode("shingles").alias("shingle"))
    known = spark.sparkContext.broadcast(filters.build(shingles, "shingle"))
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if sizes:
        counts = texts.select("text").mapInArrow(_counts(known, sizes), "shingle long, times long")
        counts = counts.groupBy("shingle").agg(F.sum("times").alias("times"))
    else:
        counts = spark.createDataFrame([], "shingle long, times long")
    windows = items.select("window", "size", "shingles").dropDuplicates(["window"])
    placed = windows.select("window", "size", F.posexplode("shingles").alias("offset", "shingle"))
    placed = placed.join(counts, "shingle", "left")
    rarest = placed.groupBy("window").agg(
        F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "offset", "shingle")).alias("prefix")
    )
    prefixes = materialise(rarest.where("prefix.times > 0").select("window", "prefix.offset", "prefix.shingle"))
    wanted = spark.sparkContext.broadcast(filters.build(prefixes, "shingle"))
    rows = texts.withColumn("_row", F.monotonically_increasing_id())
    found = materialise(rows.mapInArrow(_candidates(wanted, sizes), CANDIDATE))
    docs = found.where(F.col("place").isNull()).select("doc_id", "_row", "n_words")
    candidates = found.where(F.col("place").isNotNull()).select("_row", "place", "shingle", "before", "around")
    room = (F.col("offset") <= F.col("before")) & (
        F.col("before") - F.col("offset") + F.size("window") <= F.size("around")
    )
    same = F.expr("slice(around, before - offset + 1, size(window)) = window")
    hits = candidates.join(prefixes, "shingle").where(room).where(same)
    hits = hits.select("_row", (F.col("place") - F.col("offset")).alias("start"), F.size("window").alias("length"), "window")
    return docs, hits, items.select("window", "item_id").distinct()


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, _row, n_words, n_hit (words inside an occurrence), items (sorted ids)."""
    docs, hits, owners = occurrences(documents, benchmark)
    hits = materialise(hits)
    merge = """aggregate(array_sort(collect_set(struct(start, start + length as stop))),
        struct(0L as n, 0L as upto),
        (s, x) -> struct(s.n + greatest(0L, x.stop - greatest(x.start, s.upto)) as n, greatest(s.upto, x.stop) as upto),
        s -> s.n)"""
    covered = hits.groupBy("_row").agg(F.expr(merge).alias("n_hit"))
    items = hits.select("_row", "window").distinct().join(owners, "window")
    items = items.groupBy("_row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = docs.join(covered, "_row", "left").join(items, "_row", "left")
    return found.withColumns(
        {
            "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
            "items": F.coalesce("items", F.array().cast("array<string>")),
        }
    )


def clean(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without those that hold an item's window; all their columns stay."""
    bound_batches(documents.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    # Whether a text is hit depends on the text alone, so its hash stands for it.
    docs, hits, _ = occurrences(documents.select(F.xxhash64(whole).alias("doc_id"), whole.alias("text")), benchmark)
    hit = docs.join(hits.select("_row").distinct(), "_row", "left_semi")
    hit = materialise(hit.select(F.col("doc_id").alias("_key")).distinct())
    return unpack(filters.without(pack(documents, _key=F.xxhash64(whole)), hit, "_key"), documents.columns)


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP4_SQL = rf"""
with d as (select doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
i as (select coalesce(item_id::varchar, '') item_id,
             regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
iw as (
  select distinct item_id, least(len(w), 10) n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') win
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) k from i where len(w) > 0)),
dw as (
  select doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) k from d, (select distinct n from iw) where len(w) >= n)),
hit as (select doc_id, k, dw.n, item_id from dw join iw using (win)),
words_hit as (
  select doc_id, count(distinct p) n_hit from (select distinct doc_id, unnest(range(k, k + n)) p from hit) group by 1),
items as (
  select doc_id, count(distinct item_id) n_items, array_to_string(list_sort(list(distinct item_id)), ',') ids
  from hit group by 1)
select d.doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join words_hit using (doc_id) left join items using (doc_id)
"""


@query("op4_prefix_join", OP4_SQL)
def op4_prefix_join(spark, sf_dir):
    """Every document against every benchmark item."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
