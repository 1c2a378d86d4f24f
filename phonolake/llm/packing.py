"""Packing along a space-filling curve.

A document is a bag of token ids. Random Gaussian directions, hashed from the ids, project it to three numbers; their
place on a Hilbert curve is its key. Documents are range-sorted by key, and the token streams of neighbours are laid
end to end and cut at every ``width`` tokens, so a sequence holds documents that lie close together and no padding is
needed. The tail is cut at powers of two, which need no padding either.

Only (key, row, length) is sorted; token ids move once, to meet their offset. The running offset is a sum inside each
range partition plus one start per partition; those starts, one number per partition, pass through the driver.

Defined results: null and empty texts are the end id alone; equal documents and equal keys are ordered by row; an empty
table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phonolake.llm import words
from phonolake.llm.tokens import encoder
from phonolake.llm.registry import query, table
from phonolake.session import materialise

WIDTH = 2048
END_ID = 1
DIMENSIONS = 3
LEVELS = 20


@functools.cache
def directions(size: int) -> np.ndarray:
    """A Gaussian direction per id; the same on every executor."""
    return np.random.default_rng(41).standard_normal((size, DIMENSIONS)).astype(np.float32)


def coordinates(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Projections of the documents, squashed to whole numbers of ``LEVELS`` bits."""
    pull = directions(1 << 16)[ids.astype(np.uint16)]
    sums = np.add.reduceat(pull, np.cumsum(counts) - counts, axis=0, dtype=np.float64)
    spread = sums / np.sqrt(counts)[:, None]
    unit = 1 / (1 + np.exp(-np.clip(spread, -30, 30) * 0.5))
    return np.minimum((unit * (1 << LEVELS)).astype(np.int64), (1 << LEVELS) - 1)


def hilbert_key(points: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Place of each point on the Hilbert curve: undo the rotations from the highest bit down, then Gray-decode."""
    x = points.T.copy()
    for bit in range(levels - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            high = (x[i] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(levels - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(levels - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis >> bit) & 1)
    return key


def _tokens(path: str):
    def run(batches):
        encode = encoder(path)
        for batch in words.slices(batches, "text"):
            ids, counts = encode(batch.column("text"), END_ID)
            keys = hilbert_key(coordinates(ids, counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(keys), words.binary_array(ids, counts)],
                ["doc_id", "doc_tokens", "_key", "_ids"],
            )

    return run


def place(docs: DataFrame) -> tuple[DataFrame, int]:
    """Per row its number of tokens before it along the curve, and the number of all tokens."""
    order = ["_key", "_row"]
    narrow = docs.select("_key", "_row", "doc_tokens").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(narrow.withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    sums = placed.groupBy("_part").agg(F.sum("doc_tokens").alias("n")).orderBy("_part").collect()
    starts = list(itertools.accumulate((r["n"] for r in sums), initial=0))
    known = [(r["_part"], start) for r, start in zip(sums, starts, strict=False)]
    offsets = docs.sparkSession.createDataFrame(known, "_part int, _start long")
    before = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.coalesce(F.sum("doc_tokens").over(before), F.lit(0)))
    placed = inside.join(F.broadcast(offsets), "_part")
    return placed.select("_row", (F.col("_start") + F.col("_inside")).alias("_base")), starts[-1]


def boundaries(total: int, width: int) -> list[int]:
    """Starts of the sequences behind the last full one: the rest in falling powers of two."""
    at, out = total - total % width, []
    while at < total:
        out.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return out


def _pieces(total: int, width: int, itemsize: int):
    full = total // width
    tail = boundaries(total, width)

    def cuts(base: int, n: int) -> list[int]:
        inner = range((base // width + 1) * width, min(base + n, full * width + 1), width)
        return [base, *inner, *(t for t in tail if base < t < base + n and t != full * width), base + n]

    def run(batches):
        for batch in batches:
            rows, bodies = [], []
            taken = (batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "_base", "_ids"))
            for doc, n, base, ids in zip(*taken, strict=True):
                whole = np.frombuffer(ids, f"<u{itemsize}").astype("<u4")
                at = cuts(base, n)
                for low, high in itertools.pairwise(at):
                    if low < full * width:
                        sequence, offset = divmod(low, width)
                    else:
                        k = int(np.searchsorted(tail, low, "right")) - 1
                        sequence, offset = full + k, low - tail[k]
                    rows.append((doc, low - base, high - low, n, sequence, offset))
                    bodies.append(whole[low - base : high - base].tobytes())
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns] + [pa.array(bodies, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, width: int = WIDTH) -> DataFrame:
    """Pieces of (doc_id, text) with their ids as little-endian unsigned 32-bit numbers, cut into sequences."""
    path = str(tokenizer)
    tokens = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tokens = tokens.mapInArrow(_tokens(path), "doc_id long, doc_tokens long, _key long, _ids binary")
    tokens = materialise(tokens.withColumn("_row", F.monotonically_increasing_id()))
    offsets, total = place(tokens)
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    itemsize = encoder(path).dtype.itemsize
    return tokens.drop("_key").join(offsets, "_row").mapInArrow(_pieces(total, width, itemsize), schema)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op9_hilbert_packing")
def op9_hilbert_packing(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens; equal texts give equal keys and so lie together."""
    import public_tokenizers

    return digest(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
