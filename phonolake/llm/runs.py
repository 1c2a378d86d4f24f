"""Periodic runs of words, found by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q, at least ``SHORTEST`` words and ``TIMES`` periods long, that
no neighbouring word extends. For every text, the suffix automaton of its words is built, and its words are then
appended one by one: the node of the prefix that ends at word i is accessed in a link-cut tree over the suffix links, which
recolours the path to the root with i. The path falls into segments of nodes last reached at one earlier end c, and the
deepest node of a segment gives the longest suffix that ended at c before. Where that suffix, of length l, is no
shorter than the distance d = i - c, the two occurrences touch: the l + d words up to i have period d, a square at least.
Squares of one start and period grow with i into a run. All segments of all accesses are O(n log n) for n words, however
periodic the text is.

Every stretch of eight words in a run recurs in it, because a run holds three periods and 24 words. So only words that
repeated eight-word phrases of their own text cover go into an automaton; a run lies within one such stretch.

One text is read by one task; what is held beside a batch of half a megabyte of texts, or one longer text, is about a
kilobyte for each word of the longest stretch. Nothing is shuffled. Defined results: null and blank texts have no runs and
become empty; very long texts are read whole; equal rows get equal results; an empty table gives an empty one. All other
columns are kept, whatever their names; columns of the names that are added are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.llm import words
from phonolake.llm.columns import pack, unpack
from phonolake.llm.registry import bound_batches, query, table

SHORTEST = 24
TIMES = 3
PHRASE = SHORTEST // TIMES
SPACES = r"\x20\x09-\x0D"


class Automaton:
    """Suffix automaton of a sequence: for every state its suffix link and longest length; state 0 is the empty word."""

    def __init__(self, items: list[int]) -> None:
        self.link, self.length = [0], [0]
        self.prefix = []  # the state of each prefix
        steps: list[dict[int, int]] = [{}]
        link, length, last = self.link, self.length, 0
        for item in items:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            steps.append({})
            at = last
            while item not in steps[at]:
                steps[at][item] = new
                if not at:
                    break
                at = link[at]
            else:
                to = steps[at][item]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    twin = len(length)
                    length.append(length[at] + 1)
                    link.append(link[to])
                    steps.append(steps[to].copy())
                    while steps[at].get(item) == to:
                        steps[at][item] = twin
                        if not at:
                            break
                        at = link[at]
                    link[to] = link[new] = twin
            self.prefix.append(new)
            last = new


class LinkCut:
    """Paths of the suffix-link tree, each held as a splay tree by depth, whose root keeps the path's colour.

    A path holds the nodes whose strings all ended last at one place, its colour; nodes not reached yet stand alone.
    """

    def __init__(self, link: list[int]) -> None:
        self.up = list(link)
        self.above = [0] * len(link)
        self.below = [0] * len(link)
        self.colour = [-1] * len(link)

    def _turn(self, x: int) -> None:
        """Rotate ``x`` over its parent within a splay tree."""
        up, above, below = self.up, self.above, self.below
        p = up[x]
        g = up[p]
        if above[p] == x:
            child = above[p] = below[x]
            below[x] = p
        else:
            child = below[p] = above[x]
            above[x] = p
        if child:
            up[child] = p
        if g:
            if above[g] == p:
                above[g] = x
            elif below[g] == p:
                below[g] = x
        up[x], up[p] = g, x
        self.colour[x] = self.colour[p]

    def _splay(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        while True:
            p = up[x]
            if not p or (above[p] != x and below[p] != x):
                return
            g = up[p]
            if g and (above[g] == p or below[g] == p):
                self._turn(p if (above[g] == p) == (above[p] == x) else x)
            self._turn(x)

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Recolour the path from ``node`` to the root; its segments until now, as (colour, deepest node)."""
        up, below, colours = self.up, self.below, self.colour
        found = []
        x, lower = node, 0
        while x:
            self._splay(x)
            old = colours[x]
            if below[x]:
                colours[below[x]] = old
            if old >= 0:
                found.append((old, x))
            below[x] = lower
            x, lower = up[x], x
        self._splay(node)
        colours[node] = colour
        return found


def runs_of(items: list[int], shortest: int = SHORTEST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Runs of a sequence as (start, length, period), by start, then period."""
    automaton = Automaton(items)
    tree, length = LinkCut(automaton.link), automaton.length
    stops: dict[tuple[int, int], int] = {}
    for i, node in enumerate(automaton.prefix):
        for end, deepest in tree.access(node, i):
            period, size = i - end, length[deepest]
            whole = size + period
            if whole >= times * period and whole >= shortest:
                stops[i - whole + 1, period] = i
    return sorted((start, stop - start + 1, period) for (start, period), stop in stops.items())


def _stretches(found: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 word of the stretches that phrases recurring in their own text cover."""
    hashes, starts = found.windows(PHRASE)
    own = words.mix(hashes + words.BASE * found.owners()[starts].astype(np.uint64))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    again = np.zeros(len(own), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edges = np.zeros(len(found) + 1, np.int64)
    edges[starts[again]] += 1
    np.add.at(edges, starts[again] + PHRASE, -1)
    inside = np.cumsum(edges[:-1]) > 0
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    borders = found.first[1:-1][(found.first[1:-1] > 0) & (found.first[1:-1] < len(found))]
    begin[borders] = inside[borders]
    finish[borders - 1] = inside[borders - 1]
    first, stop = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    enough = stop - first >= SHORTEST
    return first[enough], stop[enough]


RESULT = "text string, n_words long, runs array<struct<start:long,length:long,period:long>>"


def _collapse(column: pa.Array) -> pa.Array:
    data, offsets = words.raw(column)
    found = words.Words(data, offsets, words.PLAIN)
    body = data.tobytes()
    starts, ends = found.starts, found.ends
    runs: list[list[dict]] = [[] for _ in range(len(column))]
    gone = np.zeros(len(found), bool)
    first, stop = _stretches(found)
    owners = np.searchsorted(found.first, first, "right") - 1
    for low, high, owner in zip(first.tolist(), stop.tolist(), owners.tolist(), strict=True):
        numbers: dict[bytes, int] = {}
        spans = zip(starts[low:high].tolist(), ends[low:high].tolist(), strict=True)
        items = [numbers.setdefault(body[a:b], len(numbers)) for a, b in spans]
        for start, length, period in runs_of(items):
            gone[low + start + period : low + start + length] = True
            place = low - int(found.first[owner]) + start
            runs[owner].append({"start": place, "length": length, "period": period})
    texts = []
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        stay = np.flatnonzero(~gone[low:high]) + low
        texts.append(b" ".join(body[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    columns = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(found.counts(), pa.int64()), pa.array(runs, kind)]
    return pa.StructArray.from_arrays(columns, ["text", "n_words", "runs"])


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each run cut to its first period, words joined by one space; adds n_words and runs."""
    bound_batches(docs.sparkSession)

    def collapsed(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [_collapse(part.column("text")) for part in words.slices([batch], "text")]
        return pa.concat_arrays(parts) if parts else _collapse(column)

    done = F.arrow_udf(collapsed, RESULT).asNondeterministic()(F.col(text))  # else every field runs it again
    result = pack(docs, _done=done)
    field = F.col("_done").getField
    return unpack(result, docs.columns, **{text: field("text"), "n_words": field("n_words"), "runs": field("runs")})


def strongest(runs: Column) -> Column:
    """The run of the greatest length for its period, the first of equal ones; null without runs."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, better)


def planted(text: Column, doc_id: Column) -> Column:
    """Texts with a period of their own from some word on, for a tenth of the documents, told by their ids."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    found = F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")

    def repeated(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        at = g % n
        period = 1 + F.floor((n - at) / (3 + g % 8))
        place = lambda i: F.when(i < at, i).otherwise(at + (i - at) % period)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(ws, place(i))), " "))

    damaged = F.get(F.transform(F.array(found), repeated), F.lit(0))
    return F.when(h % 10 == 0, F.coalesce(damaged, text)).otherwise(text)


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    """Runs of every document after a tenth got one planted, the strongest, and the text without their repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = collapse_runs(docs)
    best = strongest(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.select("doc_id", "runs", best.alias("best"), "text", lines.alias("lines"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best").getField(name).alias(name) for name in ("start", "length", "period")],
        F.floor(F.expr("(1000 * best.length) div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
