"""Substring dedup by repeated-phrase automata.

A window is twenty consecutive words. Of the sixteen five-word phrases in a window, the one of the smallest hash is its
anchor, so equal windows have equal anchors and about one phrase in eight is an anchor at all. The first scan counts
anchors over the whole corpus. The second takes the texts apart around anchors that occur more than once: it hands on each
such phrase, and the pieces that hold it, the words of all windows that share one place of an anchor.

Phrases and pieces go to shards by the anchor's hash. A shard confirms the phrases that recur, word by word, compiles them into an
Aho-Corasick automaton and streams its pieces through it. A piece does not say where its phrase is: the automaton locates
all occurrences of all the shard's phrases, and the windows around them are compared word by word. Each window that was seen in an
earlier document is removed. A shard's size is bounded, whatever the corpus: the number of shards follows the number of
pieces, and the pieces of an anchor of more than ``HOT`` occurrences are dealt over many shards by their documents, twice as
many for each doubling. Such a shard locates windows in the same way, but cannot know the earliest one; it gives the windows with their
128-bit digests, whose minima are combined before they move, and joined back.

No text is shuffled but pieces, phrases, and texts that lose words.

Earlier means a smaller document id or, in the same one, an earlier start; a null id is the smallest; rows that repeat
an id and a start are not earlier than each other. Windows are judged on the input. Null text has no words; a very long text
is read whole, as a batch of its own; an empty table gives an empty one. All other columns are kept, whatever their names;
columns with names that are added are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.llm import filters, words
from phonolake.llm.columns import ALL, pack, unpack
from phonolake.llm.registry import bound_batches, query, table
from phonolake.session import materialise

WINDOW = 20
ANCHOR = 5
PIECES = 8_000
HOT = 20_000
SPACES = r"\x20\x09-\x0D"
NO_ID = -(2**63)


def anchors(found: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, the first word of each window's anchor, and the hashes of phrases by first word."""
    hashes = np.zeros(len(found) + 1, np.uint64)
    starts = found.window_starts(ANCHOR)
    hashes[starts] = words.sequence_hashes(found.hashes, starts, ANCHOR)
    windows = found.window_starts(WINDOW)
    spread = WINDOW - ANCHOR + 1
    # Place of the smallest of the next 1, 2, 4, ... phrases; the first of equal ones.
    best, width = np.arange(len(found)), 1
    while width * 2 <= spread:
        later = np.minimum(np.arange(len(found)) + width, len(found) - 1)
        best = np.where(hashes[best[later]] < hashes[best], best[later], best)
        width *= 2
    rest = best[windows + spread - width]
    best = best[windows]
    return windows, np.where(hashes[rest] < hashes[best], rest, best), hashes


def _runs(windows: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs of windows that share a place of an anchor."""
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(windows)) - 1


def _counts(batches):
    for batch in words.slices(batches, "_text"):
        found = words.Words(*words.raw(batch.column("_text")), words.PLAIN)
        windows, anchor, hashes = anchors(found)
        keys, times = np.unique(hashes[anchor[_runs(windows, anchor)[0]]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.signed(keys)), pa.array(times.astype(np.int64))], ["anchor", "n"])


def _normal(found: words.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space between them, and where each starts and ends."""
    inside = found.pattern.inside[found.data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    shift = np.cumsum(keep) - keep
    body = np.where(inside, found.data, np.uint8(32))[keep].tobytes()
    return body, shift[found.starts], shift[found.ends - 1] + 1 if len(found) else found.ends


PHRASE_ROW, PIECE_ROW = 0, 1
PIECE = "unit long, kind int, hot boolean, times int, _id long, _row long, _copy long, low int, body binary"


class _Runs:
    """Runs of windows of one place of an anchor in the texts of a batch, those whose anchor is wanted."""

    def __init__(self, batch: pa.RecordBatch, wanted: np.ndarray) -> None:
        self.found = words.Words(*words.raw(batch.column("_text")), words.PLAIN)
        windows, anchor, hashes = anchors(self.found)
        first, last = _runs(windows, anchor)
        key = hashes[anchor[first]]
        chosen = filters.contains(wanted, key)
        first, last = first[chosen], last[chosen]
        self.key, self.place = key[chosen], anchor[first]
        self.low, self.stop = windows[first], windows[last] + WINDOW
        self.owner = self.found.owners()[self.low]
        self.number = self.low - self.found.first[self.owner]


def _pieces(recurring, hot: list, units: int, hot_units: int):
    """Phrases and pieces of all texts with the numbers of their shards; ``hot`` has a filter for each doubling."""

    def run(batches):
        for batch in words.slices(batches, "_text"):
            runs = _Runs(batch, recurring.value)
            if not len(runs.low):
                continue
            body, starts, ends = _normal(runs.found)
            level = sum((filters.contains(f.value, runs.key).astype(np.int64) for f in hot), np.zeros(len(runs.key), np.int64))
            held = [batch.column(c).take(pa.array(runs.owner)) for c in ("_id", "_row", "_copy")]
            copy = held[2].to_numpy(zero_copy_only=False).view(np.uint64)
            salt = words.mix(copy) & ((np.uint64(1) << level.astype(np.uint64)) - np.uint64(1))
            unit = (runs.key % np.uint64(units)).astype(np.int64)
            dealt = units + (words.mix(runs.key ^ words.mix(salt)) % np.uint64(hot_units)).astype(np.int64)
            unit = np.where(level > 0, dealt, unit)
            # Each phrase once for its shard, and how often.
            order = np.lexsort((runs.key, unit))
            new = np.ones(len(order), bool)
            new[1:] = (unit[order][1:] != unit[order][:-1]) | (runs.key[order][1:] != runs.key[order][:-1])
            some, times = order[new], np.diff(np.append(np.flatnonzero(new), len(order)))
            begin, end = starts[runs.place[some]], ends[runs.place[some] + ANCHOR - 1]
            texts = [body[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            begin, end = starts[runs.low], ends[runs.stop - 1]
            texts += [body[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            n, m = len(some), len(unit)
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([unit[some], unit])),
                    pa.array(np.repeat(np.array([PHRASE_ROW, PIECE_ROW], np.int32), [n, m])),
                    pa.array(np.concatenate([level[some], level]) > 0),
                    pa.array(np.concatenate([times, np.zeros(m, np.int64)]).astype(np.int32)),
                    *[pa.concat_arrays([none, column]) for column in held],
                    pa.concat_arrays([none.cast(pa.int32()), pa.array(runs.number.astype(np.int32))]),
                    pa.array(texts, pa.binary()),
                ],
                ["unit", "kind", "hot", "times", "_id", "_row", "_copy", "low", "body"],
            )

    return run


class _Shard:
    """Recurring phrases of a shard as an automaton, and the pieces to stream through it."""

    def __init__(self) -> None:
        self.times: Counter[str] = Counter()
        self.sure: set[str] = set()
        self.pieces: list[tuple] = []

    def phrase(self, text: str, times: int, hot: bool) -> None:
        self.times[text] += times
        if hot:  # counted over the whole corpus
            self.sure.add(text)

    def _compiled(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for phrase, times in self.times.items():
            if times > 1 or phrase in self.sure:
                machine.add_word(f" {phrase} ", len(phrase))
        if len(machine):
            machine.make_automaton()
        return machine

    def located(self):
        """Pieces with their windows around located phrases: id, low, row, copy, hot, and (first word, text) of each."""
        machine = self._compiled()
        if not len(machine):
            return
        for doc, low, row, copy, hot, text in sorted(self.pieces, key=lambda p: p[:2]):
            cuts = [0, *itertools.accumulate(len(w) + 1 for w in text.split(" "))]
            last = len(cuts) - 1 - WINDOW
            found = set()
            for end, size in machine.iter(f" {text} "):
                at = bisect_left(cuts, end - size - 1)
                found.update(range(max(0, at + ANCHOR - WINDOW), min(at, last) + 1))
            if found:
                yield doc, low, row, copy, hot, [(k, text[cuts[k] : cuts[k + WINDOW] - 1]) for k in sorted(found)]

    def resolved(self) -> tuple[list[tuple], list[tuple]]:
        """Spans of words to remove (row, copy, start, stop), and hot windows (row, copy, start, id, digest).

        Pieces come in the order of their documents, so the first to show a window has its earliest place.
        """
        seen: dict[str, tuple] = {}
        spans, windows = [], []
        for doc, low, row, copy, hot, around in self.located():
            if hot:
                windows += [(row, copy, low + k, doc, hashlib.md5(w.encode()).digest()) for k, w in around]
                continue
            last = None
            for k, window in around:
                first = seen.setdefault(window, (doc, low + k))
                if first < (doc, low + k):
                    if last == k - 1:
                        spans[-1] = (*spans[-1][:3], low + k + WINDOW)
                    else:
                        spans.append((row, copy, low + k, low + k + WINDOW))
                    last = k
        return spans, windows


FOUND = "_row long, _copy long, start int, stop int, _id long, digest binary"


def _shards(batches):
    """Shards come sorted, phrases first; one is held at a time, and it is bounded."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def found(shard: _Shard) -> pa.RecordBatch:
        spans, windows = shard.resolved()
        rows = [(*s, None, None) for s in spans] + [(row, copy, at, None, doc, w) for row, copy, at, doc, w in windows]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["_row", "_copy", "start", "stop", "_id", "digest"])

    now, shard = None, _Shard()
    names = ["unit", "kind", "hot", "times", "_id", "_row", "_copy", "low", "body"]
    for batch in batches:
        for unit, kind, hot, times, doc, row, copy, low, body in zip(*(batch[c].to_pylist() for c in names), strict=True):
            if unit != now:
                if now is not None:
                    yield found(shard)
                now, shard = unit, _Shard()
            if kind == PHRASE_ROW:
                shard.phrase(body.decode(), times, hot)
            else:
                shard.pieces.append((doc, low, row, copy, hot, body.decode()))
    if now is not None:
        yield found(shard)
    words.release()


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Spans of words, (_row, _copy, start, stop), that windows seen earlier cover, of (_id, _row, _copy, _text)."""
    spark = texts.sparkSession
    counts = texts.select("_text").mapInArrow(_counts, "anchor long, n long")
    counts = materialise(counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"))
    plain, hot_total, most = counts.agg(
        F.coalesce(F.sum(F.when(F.col("n") <= HOT, F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("n") > HOT, F.col("n"))), F.lit(0)),
        F.coalesce(F.max("n"), F.lit(0)),
    ).first()
    share = spark.sparkContext.broadcast
    recurring = share(filters.build(counts, "anchor"))
    doublings = (most // HOT).bit_length() if most > HOT else 0
    hot = [share(filters.build(counts.where(F.col("n") > (HOT << i)), "anchor")) for i in range(doublings)]
    units, hot_units = (max(1, -(-n // PIECES)) for n in (plain, hot_total))
    pieces = texts.mapInArrow(_pieces(recurring, hot, units, hot_units), PIECE)
    found = pieces.repartition("unit").sortWithinPartitions("unit", "kind").mapInArrow(_shards, FOUND)
    own = ["_row", "_copy", "start"]
    if not hot:
        return found.select(*own, "stop")
    found = materialise(found)
    each = found.where(F.col("digest").isNotNull())
    place = F.struct("_id", "start")
    firsts = each.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("earliest"))
    # Written, so that the join deals both sides itself and Spark can split a window that is very frequent.
    firsts = materialise(firsts.where("n > 1").drop("n"))
    later = each.join(firsts, "digest").where(place > F.col("earliest"))
    spans = found.where(F.col("digest").isNull()).select(*own, "stop")
    return spans.unionByName(later.select(*own, (F.col("start") + WINDOW).alias("stop")))


def _cut(column: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without the words of their spans, the rest joined by one space, and the numbers of words."""
    found = words.Words(*words.raw(column), words.PLAIN, hashed=False)
    body, starts, ends = _normal(found)
    out, removed = [], []
    for i in range(len(column)):
        low, high = int(found.first[i]), int(found.first[i + 1])
        listed = spans[i]
        if not listed.is_valid or low == high:
            out.append(body[starts[low] : ends[high - 1]] if low < high else b"")
            removed.append(0)
            continue
        edges = np.zeros(high - low + 1, np.int64)
        inner = listed.values
        np.add.at(edges, inner.field("start").to_numpy(), 1)
        np.add.at(edges, inner.field("stop").to_numpy(), -1)
        gone = np.cumsum(edges[:-1]) > 0
        stay = np.flatnonzero(~gone) + low
        out.append(b" ".join(body[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)))
        removed.append(int(gone.sum()))
    columns = [pa.array(out, pa.binary()).cast(pa.string()), pa.array(found.counts(), pa.int64()), pa.array(removed, pa.int64())]
    return pa.StructArray.from_arrays(columns, ["text", "n_words", "n_removed"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the words that stay, joined by one space, as text; adds n_words and n_removed."""
    bound_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    keyed = pack(docs, _id=number, _row=F.xxhash64(doc_id, whole), _copy=F.xxhash64(whole), _text=whole)
    own = ["_row", "_copy"]
    spans = repeated_spans(keyed.select("_id", *own, "_text"))
    spans = materialise(spans.groupBy(*own).agg(F.collect_list(F.struct("start", "stop")).alias("_spans")))
    touched = filters.may_hold(spans, "_row", F.col("_row"))

    def cut(column: pa.Array, listed: pa.Array) -> pa.Array:
        return _cut(column, listed)

    cut = F.arrow_udf(cut, "text string, n_words long, n_removed long").asNondeterministic()
    # Only texts that lose words meet their spans; the filter may send some others along.
    split = F.filter(F.split("_text", f"[{SPACES}]+"), lambda w: w != "")
    whole = F.struct(
        F.array_join(split, " ").alias("text"),
        F.size(split).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
    )
    plain = keyed.where(~touched).select(ALL, whole.alias("_cut"))
    joined = keyed.where(touched).join(spans, own, "left").select(ALL, cut("_text", "_spans").alias("_cut"))
    result = plain.unionByName(joined)
    parts = {name: F.col("_cut").getField(name) for name in ("n_words", "n_removed")}
    return unpack(result, docs.columns, **{text: F.col("_cut").getField("text")}, **parts)


@query("op7_phrase_automata")
def op7_phrase_automata(spark, sf_dir):
    """Every document without the words of twenty-word windows that start earlier in the corpus."""
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", digest)
