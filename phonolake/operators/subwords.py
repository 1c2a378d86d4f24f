"""Subword ids by merge ranks: byte-level pair merging as the rank files of public tokenizers define it.

A rank table has one row per token: its bytes and its id, which is its rank. A text is cut into pieces by a pattern, and
the parts of a piece are merged pair by pair, lowest rank first, leftmost of equal ones. Ranks are never learned here.

Cutting is a column expression. Merging runs on the distinct pieces of Arrow batches, ``STEP`` pieces in step, and nothing is
shuffled. A task holds the table of pairs and one batch, however many pieces it meets. A rank table belongs to a tokenizer and does not grow with
the data; its size is checked before it is sent to the tasks, and one beyond the check is refused.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from phonolake.functions import text as X
from phonolake.operators.vocab import UNKNOWN_ID, vocab_decode, vocab_encode
from phonolake.session import bound_batches

MOST_RANKS = 2_000_000
NO_RANK = np.iinfo(np.int64).max
#: Pieces that are merged in step.
STEP = 1 << 13
#: Bytes of a piece from which it is merged by itself, with a heap.
LONG = 64


def merge_ids(piece: bytes, ranks: dict[bytes, int], unknown: int = UNKNOWN_ID) -> list[int]:
    """Ids of one piece's parts once no adjacent pair is a token; time is n log n for n bytes."""
    if piece in ranks:
        return [ranks[piece]]
    size = len(piece)
    stop, before = list(range(1, size + 1)), list(range(-1, size - 1))  # of the part that starts there
    heap: list[tuple[int, int, int]] = []

    def offer(start: int, end: int) -> None:
        rank = ranks.get(piece[start:end])
        if rank is not None:
            heapq.heappush(heap, (rank, start, end))

    for i in range(size - 1):
        offer(i, i + 2)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = stop[start]
        if not 0 < middle < end or stop[middle] != end:
            continue  # one of the two has been merged since
        stop[start], stop[middle] = end, 0
        if end < size:
            before[end] = start
            offer(start, stop[end])
        if before[start] >= 0:
            offer(before[start], end)
    out, at = [], 0
    while at < size:
        out.append(ranks.get(piece[at : stop[at]], unknown))
        at = stop[at]
    return out


class Pairs:
    """Which two parts make which token. A part is a token, told by its place in ``tokens``, or any byte behind them."""

    def __init__(self, tokens: pa.Array, ids: pa.Array, unknown: int):
        self.tokens, self.unknown, places = tokens, unknown, {t: i for i, t in enumerate(tokens.to_pylist())}
        self.count, self.span = len(places), len(places) + 256
        self.ids = np.append(ids.to_numpy(), np.full(256, unknown)).astype(np.int32)
        self.ranks = np.append(ids.to_numpy().astype(np.int64), NO_RANK)  # the last, at -1, for no token
        self.bytes = np.array([places.get(bytes([c]), self.count + c) for c in range(256)], np.int32)
        part = lambda t: places.get(t) if len(t) > 1 else int(self.bytes[t[0]])
        halves = (
            (a * self.span + b, i)
            for t, i in places.items()
            for at in range(1, len(t))
            if (a := part(t[:at])) is not None and (b := part(t[at:])) is not None
        )
        found = np.fromiter(halves, np.dtype([("key", np.int64), ("token", np.int32)]))
        found = found[np.argsort(found["key"])]
        self.keys = np.append(found["key"], -1)  # the last is never met
        self.made = np.append(found["token"], -1).astype(np.int32)

    def token(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the tokens that parts make, -1 for none."""
        key = a.astype(np.int64) * self.span + b
        at = np.searchsorted(self.keys[:-1], key)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.made[at], -1)

    def merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Parts of pieces of ``data``, a row each, filled up with -1: in step, each piece's lowest pair is merged."""
        wide = int(sizes.max())
        inside = np.arange(wide) < sizes[:, None]
        parts = np.where(inside, self.bytes[data[np.where(inside, starts[:, None] + np.arange(wide), 0)]], -1)
        pairs = self.token(parts[:, :-1], parts[:, 1:])
        out, rows = np.full(parts.shape, -1, np.int32), np.arange(len(parts))
        while pairs.shape[1] and len(rows):
            ranks = self.ranks[pairs]
            at = ranks.argmin(axis=1)  # the leftmost of equal ones
            on = ranks[np.arange(len(at)), at] < NO_RANK
            if not on.all():
                out[rows[~on], : parts.shape[1]] = parts[~on]
                rows, parts, pairs, at = rows[on], parts[on], pairs[on], at[on]
            own, column = np.arange(len(at)), np.arange(parts.shape[1] - 1)
            new = pairs[own, at]
            parts = np.take_along_axis(parts, column + (column > at[:, None]), axis=1)
            parts[own, at] = new
            pairs = np.take_along_axis(pairs, column[:-1] + (column[:-1] >= at[:, None]), axis=1)
            for shift in (-1, 0):
                which = np.flatnonzero((at + shift >= 0) & (at + shift < pairs.shape[1]))
                left = at[which] + shift
                pairs[which, left] = self.token(parts[which, left], parts[which, left + 1])
        out[rows, : parts.shape[1]] = parts
        return out

    @cached_property
    def known(self) -> dict[bytes, int]:
        return dict(zip(self.tokens.to_pylist(), self.ids.tolist(), strict=False))

    def encode(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Lists of ids, and which of them each of the distinct ``pieces`` (binary) has."""
        if not len(pieces):
            return pa.array([], pa.list_(pa.int32())), np.empty(0, np.int64)
        which = pc.index_in(pieces, self.tokens).fill_null(-1).to_numpy()
        ends = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        starts, sizes = ends[:-1], np.diff(ends)
        rest = np.flatnonzero(which < 0)
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        order, counts, flat = [np.flatnonzero(which >= 0)], [], []
        counts.append(np.ones(len(order[0]), np.int64))
        flat.append(self.ids[which[order[0]]])
        short = int(np.searchsorted(sizes[rest], LONG))
        for at in range(0, short, STEP):
            own = rest[at : min(at + STEP, short)]
            parts = self.merge(data, starts[own], sizes[own]) if sizes[own[-1]] else np.full((len(own), 1), -1)
            order.append(own)
            counts.append((parts >= 0).sum(axis=1))
            flat.append(self.ids[parts[parts >= 0]])
        for i in rest[short:]:
            ids = merge_ids(pieces[int(i)].as_py(), self.known, self.unknown)
            order.append(np.array([i]))
            counts.append(np.array([len(ids)]))
            flat.append(np.array(ids, np.int32))
        place = np.empty(len(pieces), np.int64)
        place[np.concatenate(order)] = np.arange(len(pieces))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat))), place


def _merged(ranks: DataFrame, unknown: int):
    """Ids of lists of pieces, as a function on Arrow arrays."""
    bound_batches(ranks.sparkSession)
    ranks = ranks.where(F.col("token").isNotNull()).groupBy("token").agg(F.min("id").cast("int").alias("id"))
    count = ranks.count()
    if count > MOST_RANKS:
        raise ValueError(f"a rank table of {count} tokens; {MOST_RANKS} is the most that every task is made to hold")
    local = ranks.toArrow()
    pairs = Pairs(local["token"].combine_chunks(), local["id"].combine_chunks(), unknown)
    shared = ranks.sparkSession.sparkContext.broadcast(pairs)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = shared.value
        for rows in batches:
            pieces = rows.flatten().dictionary_encode()
            lists, place = pairs.encode(pieces.dictionary.cast(pa.binary()))
            lists = lists.take(pa.array(place[pieces.indices.to_numpy()]))
            sizes = pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            inner = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
            yield pa.ListArray.from_arrays(pa.array(inner[ends].astype(np.int32)), lists.flatten())

    return encode


def subword_encode(
    df: DataFrame,
    ranks: DataFrame,
    text: Column,
    out: str = "ids",
    added: str | None = X.ADDED_PATTERN,
    unknown: int = UNKNOWN_ID,
) -> DataFrame:
    """``df`` with the ids of ``text`` by a rank table (token binary, id); a null text has none.

    Tokens that ``added`` matches are cut out of the text first and are pieces of their own; their ids are in the rank
    table too, see ``as_ranks``. A byte that is no token gets ``unknown``.
    """
    return df.withColumn(out, _merged(ranks, unknown)(X.subword_pieces(text, added)))


def as_ranks(vocab: DataFrame) -> DataFrame:
    """A vocabulary of strings (token, id) as rows of a rank table."""
    return vocab.select(F.encode("token", "UTF-8").alias("token"), F.col("id").cast("int").alias("id"))


def subword_decode(
    df: DataFrame, ranks: DataFrame, id_col: str, arr: str = "ids", out: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Text of each row's ids (id, keep, out); bytes that are no UTF-8 become replacement characters."""
    hexed = ranks.select(F.hex("token").alias("token"), "id")
    rows = vocab_decode(df, hexed, id_col, arr, "_hex", unknown="EFBFBD", keep=keep)
    return rows.select(id_col, *(keep or []), F.decode(F.unhex(F.array_join("_hex", "")), "UTF-8").alias(out))


def encode_prompts(df: DataFrame, prompt: Column, vocab: DataFrame, id_col: str, out: str, keep: list[str]) -> DataFrame:
    """(id, keep, out) with the prompt's ids: of subwords for a rank table, of whole tokens for a vocabulary of strings."""
    if isinstance(vocab.schema["token"].dataType, BinaryType):
        return subword_encode(df, vocab, prompt, out).select(id_col, *keep, out)
    worded = df.withColumn("_words", X.text_tokens(prompt))
    return vocab_encode(worded, vocab, id_col, "_words", out, keep=keep)
