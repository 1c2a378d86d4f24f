"""Hidden Markov language model, trained by Baum-Welch counts that are aggregated across partitions.

Tokens are a text's words, A-Z in lower case, and one end. A hidden state emits a class of words, the class the word: a
class holds the words whose hashes begin alike, and gives each the share of its count. Words' counts are gathered over
the whole training corpus, whatever its vocabulary; the states' tables are ``STATES`` rows of ``CLASSES`` + 1 numbers,
so every task can hold them. An unknown word is one more word of its class. The probabilities of all tokens, and of all
texts, sum to one.

A round of Baum-Welch reads every training text. A task runs the scaled forward and backward recursions and adds up expected
emissions and transitions in numpy; the sums of all tasks are added in two shuffles. Texts are whole and exact: a text
is cut into spans of ``SPAN`` tokens that run side by side, each span's transition product carries the state
distributions from span to span. So the sequential part of a text is one product per span.

A text's likelihood is the product of the forward recursion's scales. Counts of single words come from a sorted table of the most
frequent ones, ``TABLE`` at most, which every task holds; the other tokens meet their counts in a join by word, one row per
text and word, so both ways give the same numbers for every word.

What is held of a batch follows two megabytes of text, or one longer text. Defined results: null and blank texts are their
end alone; without training texts every text scores by the untrained model over unknown words; equal texts score the same,
repeated rows stay apart; an empty table gives an empty one. All columns but the text are kept, whatever their names;
columns of the names that are added are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phonolake.llm import words
from phonolake.llm.columns import ALL, pack, unpack
from phonolake.llm.registry import bound_batches, query, table
from phonolake.session import materialise

STATES = 8
BITS = 16
CLASSES = 1 << BITS
ROUNDS = 5
SPAN = 512
NORMED = 8
SLICE = 1 << 21
TABLE = 1 << 20
HELD = 1 << 22
STAY = 0.99
SPREAD = 0.5
PART = 1024
FAN_IN = 64
TASK_TOKENS = 1 << 23
END = 0x1E2D3C4B5A69788


class Tokens:
    """Classes and hashes of all tokens of a column, and each text's range ``first[i]:first[i + 1]``."""

    def __init__(self, column: pa.Array) -> None:
        found = words.Words(*words.raw(column), words.LOWER)
        ends = found.first[1:]
        self.first = found.first + np.arange(len(found.first))
        self.hashes = np.insert(found.hashes, ends, np.uint64(END))
        self.classes = (self.hashes >> np.uint64(64 - BITS)).astype(np.int64)
        self.classes[self.first[1:] - 1] = CLASSES

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # by class, then state; not changed in place
    mass: np.ndarray  # of each class: its words' counts, one more for each, and one for an unknown word
    tokens: int = 0
    different: int = 0

    def __post_init__(self) -> None:
        self.tops = self.emit.max(1)
        self.relative = self.emit / self.tops[:, None]

    @property
    def unigram_total(self) -> int:
        return self.tokens + self.different + 1


class Spans:
    """Spans of texts of ``sizes`` tokens, the longest first, and how they follow each other."""

    def __init__(self, first: np.ndarray) -> None:
        sizes = np.diff(first)
        self.counts = -(-sizes // SPAN)
        self.text = np.repeat(np.arange(len(sizes)), self.counts)
        begin = np.cumsum(self.counts) - self.counts
        self.number = np.arange(len(self.text)) - begin[self.text]
        self.start = first[:-1][self.text] + self.number * SPAN
        self.size = np.minimum(first[1:][self.text] - self.start, SPAN)
        order = np.argsort(-self.size, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.start, self.size, self.number, self.text = (x[order] for x in (self.start, self.size, self.number, self.text))
        self.head = self.number == 0
        # Spans longer than t are the first so many.
        self.active = np.searchsorted(-self.size, -np.arange(SPAN + 1), "left").tolist()
        self.steps = int(self.size[0]) if len(self.size) else 0
        # Level j: places of the spans number j and j + 1 of all texts that have both.
        self.follows = []
        left = np.flatnonzero(self.counts > 1)
        j = 0
        while len(left):
            self.follows.append((place[begin[left] + j], place[begin[left] + j + 1]))
            j += 1
            left = left[self.counts[left] > j + 1]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


class Lattice:
    """Forward and backward recursions over all spans side by side, from the distributions that enter them.

    Arrays over tokens go step by step, with the spans' tokens of a step together. A token's emissions are taken relative
    to the likeliest state's. Distributions are normed every ``NORMED`` steps and at a span's last token, by ``scales``,
    which are one elsewhere; the backward recursion is divided by the same scales, so that the product of both sums to one
    at every token.
    """

    def __init__(self, model: Model, tokens: Tokens) -> None:
        self.model, self.tokens = model, tokens
        self.spans = spans = Spans(tokens.first)
        self.steps = [slice(b - n, b) for n, b in zip(spans.active, np.cumsum(spans.active).tolist(), strict=True)]
        self.order = np.empty(len(tokens.classes), np.int64)  # the token at each place
        for t in range(spans.steps):
            np.add(spans.start[: spans.active[t]], t, out=self.order[self.steps[t]])
        self.classes = tokens.classes[self.order]
        self.emitted = model.relative[self.classes]
        self.entry = np.zeros((len(spans.start), len(model.start)))
        if spans.follows:
            self._carry()
        self._forward()

    def _carry(self) -> None:
        """Product of each later span's steps, and from them the distribution behind every span."""
        spans, move = self.spans, self.model.move
        later = np.flatnonzero(~spans.head)
        states = len(move)
        active = np.searchsorted(-spans.size[later], -np.arange(SPAN), "left").tolist()
        products = np.broadcast_to(np.eye(states), (len(later), states, states)).copy()
        for t, n in enumerate(active):
            if not n:
                break
            step = (products[:n].reshape(-1, states) @ move).reshape(n, states, states)
            np.multiply(step, self.emitted[self.steps[t]][later[:n], None, :], out=products[:n])
            if t % NORMED == NORMED - 1:
                products[:n] /= products[:n].sum((1, 2), keepdims=True)
        self.products = np.zeros((len(spans.start), states, states))
        self.products[later] = products
        heads, after = spans.follows[0]
        alpha = _normal(self.model.start * self.emitted[self.steps[0]][heads])
        for t in range(1, SPAN):
            alpha = (alpha @ move) * self.emitted[self.steps[t]][heads]
            if t % NORMED == NORMED - 1:
                alpha = _normal(alpha)
        self.entry[after] = _normal(alpha)
        for here, after in spans.follows[1:]:
            self.entry[after] = _normal(np.einsum("ni,nij->nj", self.entry[here], self.products[here]))

    def _normed(self, t: int) -> slice:
        """Spans whose distributions are normed at step ``t``: all that reach it, or those that end there."""
        active = self.spans.active
        return slice(0 if t % NORMED == NORMED - 1 else active[t + 1], active[t])

    def _forward(self) -> None:
        spans, move = self.spans, self.model.move
        self.alpha = np.empty_like(self.emitted)
        self.scales = np.ones(len(self.emitted))
        alpha = np.where(spans.head[:, None], self.model.start, self.entry @ move)
        for t in range(spans.steps):
            step = self.steps[t]
            now = np.multiply(alpha[: spans.active[t]], self.emitted[step], out=self.alpha[step])
            some = self._normed(t)
            if some.start < some.stop:
                scale = now[some].sum(1)
                now[some] /= scale[:, None]
                self.scales[step][some] = scale
            if t + 1 < spans.steps:
                alpha = now[: spans.active[t + 1]] @ move

    def likelihoods(self) -> np.ndarray:
        """log10 of every text's probability as a sequence of classes."""
        out = np.zeros(len(self.tokens.first) - 1)
        logs = np.log10(self.scales * self.model.tops[self.classes])
        for t in range(self.spans.steps):
            np.add.at(out, self.spans.text[: self.spans.active[t]], logs[self.steps[t]])
        return out

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected states of every token of ``classes``, transitions, and first states."""
        spans, move = self.spans, self.model.move
        beta = np.ones_like(self.entry)
        for here, after in reversed(spans.follows):
            beta[here] = _normal(np.einsum("nij,nj->ni", self.products[after], beta[after]))
        for t in range(spans.steps):  # each span where it ends
            ends = slice(spans.active[t + 1], spans.active[t])
            beta[ends] /= (self.alpha[self.steps[t]][ends] * beta[ends]).sum(1, keepdims=True)
        share = np.empty_like(self.emitted)
        moves = np.zeros_like(move)
        for t in reversed(range(spans.steps)):
            step, n = self.steps[t], spans.active[t]
            np.multiply(self.alpha[step], beta[:n], out=share[step])
            seen = self.emitted[step] * beta[:n]
            some = self._normed(t)
            seen[some] /= self.scales[step][some, None]
            if t:
                moves += self.alpha[self.steps[t - 1]][:n].T @ seen
                np.matmul(seen, move.T, out=beta[:n])
            else:
                moves += self.entry.T @ seen  # nothing enters the spans at a text's head
        return share, moves * move, share[: len(spans.start)][spans.head].sum(0)


def _word_counts(batches):
    """Counts of words, combined over some millions of tokens before they leave the task."""
    held, size = [], 0

    def give() -> pa.RecordBatch:
        keys, times = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.signed(keys)), pa.array(times.astype(np.int64))], ["word", "n"])

    for batch in words.slices(batches, "_text"):
        held.append(Tokens(batch.column("_text")).hashes)
        size += len(held[-1])
        if size > HELD:
            yield give()
            held, size = [], 0
    if held:
        yield give()


SUMS = "part int, salt int, sums binary"


def _packed(values: np.ndarray, kind: str) -> bytes:
    """The rows of a table that are not all zero: how many, which, and their values."""
    rows = np.flatnonzero(values.any(1)).astype(np.int32)
    return np.int32(len(rows)).tobytes() + rows.tobytes() + values[rows].astype(kind).tobytes()


def _unpacked(body: bytes, states: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(body, np.int32, 1)[0])
    return np.frombuffer(body, np.int32, n, 4), np.frombuffer(body, kind, n * states, 4 + 4 * n).reshape(n, states)


def _expectations(shared):
    """Expected counts of a task, in parts of ``PART`` classes; the last part holds moves, starts, and the likelihood.

    Only classes that the task has met take room, in single precision; sums over tasks are in double precision.
    """

    def run(batches):
        model = shared.value
        states = len(model.start)
        emit, moves, starts, likelihood = np.zeros_like(model.emit), np.zeros_like(model.move), np.zeros(states), 0.0
        salt = None
        for batch in words.slices(batches, "_text", SLICE):
            salt = int(batch["salt"][0].as_py()) if salt is None else salt
            tokens = Tokens(batch.column("_text"))
            lattice = Lattice(model, tokens)
            share, m, s = lattice.expected()
            for k in range(states):
                emit[:, k] += np.bincount(lattice.classes, share[:, k], len(emit))
            moves, starts, likelihood = moves + m, starts + s, likelihood + lattice.likelihoods().sum()
        if salt is None:
            return
        parts = [_packed(emit[i : i + PART], "f4") for i in range(0, len(emit), PART)]
        parts.append(_packed(_rest(moves, starts, likelihood), "f4"))
        columns = [pa.array(range(len(parts)), pa.int32()), pa.array([salt] * len(parts), pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())], ["part", "salt", "sums"])

    return run


def _rest(moves: np.ndarray, starts: np.ndarray, likelihood: float) -> np.ndarray:
    return np.vstack([moves, starts, np.full(len(starts), likelihood)])


def _added(states: int, kind: str):
    """Sums of equal parts, which come in one piece."""

    def run(batches):
        now, total = None, None

        def give() -> pa.RecordBatch:
            arrays = [pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([_packed(total, "f8")], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["part", "salt", "sums"])

        for batch in batches:
            for part, salt, body in zip(*(batch[c].to_pylist() for c in ("part", "salt", "sums")), strict=True):
                if now != (part, salt):
                    if now is not None:
                        yield give()
                    now, total = (part, salt), np.zeros((PART, states))
                rows, values = _unpacked(body, states, kind)
                total[rows] += values
        if now is not None:
            yield give()

    return run


def _round(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float] | None:
    """Expected counts of all texts; what reaches the driver has the size of the model.

    Sums of ``FAN_IN`` tasks meet first, then the sums of these.
    """
    states = len(model.start)
    shared = texts.sparkSession.sparkContext.broadcast(model)
    group = F.floor(F.spark_partition_id() / FAN_IN).cast("int")
    sums = texts.select("_text", group.alias("salt")).mapInArrow(_expectations(shared), SUMS)
    sums = sums.repartition("part", "salt").sortWithinPartitions("part", "salt").mapInArrow(_added(states, "f4"), SUMS)
    sums = sums.withColumn("salt", F.lit(0)).repartition("part").sortWithinPartitions("part")
    found = sums.mapInArrow(_added(states, "f8"), SUMS).toArrow().sort_by("part")
    if not found.num_rows:
        return None
    tables = []
    for body in found["sums"].to_pylist():
        tables.append(np.zeros((PART, states)))
        rows, values = _unpacked(body, states, "f8")
        tables[-1][rows] = values
    emit, rest = np.concatenate(tables[:-1])[: len(model.emit)], tables[-1]
    return emit, rest[:states], rest[states], float(rest[states + 1, 0])


def _in_tasks(texts: DataFrame, tokens: int) -> DataFrame:
    """``texts`` in fewer tasks where they lie in many small parts: every task gives sums of up to the model's size."""
    tasks = max(4 * texts.sparkSession.sparkContext.defaultParallelism, -(-tokens // TASK_TOKENS))
    return texts.coalesce(tasks) if texts.rdd.getNumPartitions() > 2 * tasks else texts


def untrained(mass: np.ndarray, states: int = STATES) -> Model:
    """States that stay, and emit classes by their mass but for noise, so that they can part."""
    noise = np.random.default_rng(11).normal(0, SPREAD, (len(mass), states))
    emit = mass[:, None] * np.exp(noise)
    move = np.full((states, states), (1 - STAY) / max(states - 1, 1)) if states > 1 else np.ones((1, 1))
    if states > 1:
        np.fill_diagonal(move, STAY)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0), mass)


def learned(model: Model, emit: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> Model:
    """Maximum of the expected counts; a state that emitted n different classes gets n more tokens by the classes' mass."""
    share = model.mass / model.mass.sum()
    different = np.minimum(emit, 1).sum(0)
    emit = (emit + different * share[:, None]) / (emit.sum(0) + different)
    return Model(_normal(starts + 1), _normal(moves + 1), emit, model.mass, model.tokens, model.different)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): 64-bit hashes of all different tokens of ``docs`` and their counts."""
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{text}`").alias("_text"))
    return texts.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, counts: DataFrame, text: str = "text", states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Model of all texts of ``docs``, whose words' ``counts`` are written."""
    texts = docs.select(F.col(f"`{text}`").alias("_text"))
    kind = F.when(F.col("word") == END, CLASSES).otherwise(F.shiftrightunsigned("word", 64 - BITS))
    mass = counts.groupBy(kind.cast("int").alias("kind")).agg(
        F.sum(F.col("n") + 1).alias("mass"), F.sum("n").alias("n"), F.count("*").alias("v")
    )
    found = mass.toArrow()
    filled = np.ones(CLASSES + 1)
    filled[found["kind"].to_numpy()] += found["mass"].to_numpy()
    model = untrained(filled, states)
    model.tokens, model.different = int(sum(found["n"].to_pylist())), int(sum(found["v"].to_pylist()))
    texts = _in_tasks(texts, model.tokens)
    for _ in range(rounds):
        sums = _round(texts, model)
        if sums is None:
            break
        model = learned(model, *sums[:3])
    return model


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent words: those of 2**j or more for the least j that fits ``TABLE``."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("j")).count().collect()
    left, least = TABLE, 64
    for row in sorted(sizes, key=lambda r: -r["j"]):
        left -= row["count"]
        if left < 0:
            break
        least = row["j"]
    found = counts.where(F.floor(F.log2("n")) >= least).toArrow()
    keys = found["word"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], found["n"].to_numpy()[order]


class Counts:
    """Counts of the words of a sorted table, by the leading bits of their hashes."""

    def __init__(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(1, len(keys).bit_length()))
        self.keys, self.times = np.append(keys, np.uint64(0)), np.append(times, 0)
        found = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << (64 - int(self.shift)))
        self.first = np.append(0, np.cumsum(found))
        self.most = int(found.max())

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """0 for words that the table lacks."""
        out = np.zeros(len(hashes), np.int64)
        place = (hashes >> self.shift).astype(np.int64)
        at, stop = self.first[place], self.first[place + 1]
        left = np.flatnonzero(at < stop)
        for _ in range(self.most):
            if not len(left):
                break
            here = at[left]
            hit = self.keys[here] == hashes[left]
            out[left[hit]] = self.times[here[hit]]
            at[left] += 1
            left = left[~hit & (at[left] < stop[left])]
        return out


def _scores(shared, held):
    def run(batches):
        model, counts = shared.value, Counts(*held.value)
        mass = np.log10(model.mass)
        for batch in words.slices(batches, "_text", SLICE):
            tokens = Tokens(batch.column("_text"))
            lasts = tokens.first[:-1]
            likelihood = Lattice(model, tokens).likelihoods() - np.add.reduceat(mass[tokens.classes], lasts)
            n = counts.of(tokens.hashes)
            known = n > 0
            single = np.add.reduceat(np.log10(n + 1.0), lasts)
            owner = np.repeat(np.arange(batch.num_rows), tokens.sizes())[~known]
            rest = tokens.hashes[~known]
            order = np.lexsort((rest, owner))
            owner, rest = owner[order], rest[order]
            new = np.ones(len(rest), bool)
            new[1:] = (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1])
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(rest)))
            edges = np.searchsorted(owner[begin], np.arange(batch.num_rows + 1)).astype(np.int32)
            others = pa.StructArray.from_arrays([pa.array(words.signed(rest[begin])), pa.array(count.astype(np.int64))], ["word", "f"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(ALL), pa.array(tokens.sizes().astype(np.int64)), pa.array(np.add.reduceat(known.astype(np.int64), lasts)),
                    pa.array(single), pa.array(likelihood), pa.ListArray.from_arrays(pa.array(edges), others),
                ],
                [ALL, "n_tokens", "known", "single", "states", "rest"],
            )

    return run


SCORED = "n_tokens long, known long, single double, states double, rest array<struct<word:long,f:long>>"


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without text, with n_tokens, n_known, train_tokens, base_score of single words, and score of the model."""
    bound_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    own = [c for c in docs.columns if c != text]
    keyed = pack(docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text}`").alias(f"_{ALL}_text")))
    inner = F.struct(*[F.col(ALL).getField(c).alias(c) for c in own])
    keyed = keyed.select(inner.alias(ALL), F.col(ALL).getField(f"_{ALL}_text").alias("_text"))
    shared, held = context.broadcast(model), context.broadcast(_frequent(counts))
    schema = T.StructType([keyed.schema[ALL], *T._parse_datatype_string(SCORED).fields])
    scored = keyed.mapInArrow(_scores(shared, held), schema).withColumn("place", F.monotonically_increasing_id())
    scored = materialise(scored)
    rest = scored.select("place", F.inline("rest")).join(counts, "word")
    rest = rest.groupBy("place").agg(
        F.sum(F.col("f") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("f").alias("others")
    )
    met = scored.drop("rest").join(rest, "place", "left")
    single = F.col("single") + F.coalesce("more", F.lit(0.0))
    return unpack(
        met, own,
        n_tokens=F.col("n_tokens"),
        n_known=F.col("known") + F.coalesce("others", F.lit(0)),
        train_tokens=F.lit(model.tokens).cast("long"),
        base_score=single - F.col("n_tokens") * math.log10(model.unigram_total),
        score=F.col("states") + single,
    )


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


@query("op11_hidden_markov")
def op11_hidden_markov(spark, sf_dir):
    """Log likelihood of every document under the model of six sevenths of them, and under single words' shares."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    training = docs.where(~F.col("held_out"))
    counts = materialise(count_words(training))
    return score(docs, train(training, counts), counts)
