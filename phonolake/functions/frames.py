"""Frames of the seven-slot codec token layout on Arrow batches: layers to tokens and back, many rows at once.

The same results as ``codes.interleave`` and ``codes.layer_of``, whose expressions compute one entry at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from phonolake.functions import tokens as T
from phonolake.functions.codes import SLOT_SOURCE

LAYERS = StructType([StructField(f"l{n}", ArrayType(IntegerType())) for n in range(3)])
STRIDES = (1, 2, 4)


def ends_of(sizes: np.ndarray) -> np.ndarray:
    """Offsets of lists of these sizes."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … for each list of these sizes."""
    ends = ends_of(sizes)
    return np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)


def lists_of(sizes: np.ndarray, entries: np.ndarray, lost: np.ndarray | None = None) -> pa.Array:
    """Lists of ints from their entries in a row; entries beyond an int are an error."""
    flat = pa.array(entries, mask=lost).cast(pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends_of(sizes)).cast(pa.int32()), flat)


def _entries(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes (0 for null), entries (0 for null) and which are null, one null entry more at the end."""
    sizes = pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rows.flatten()
    lost = np.append(flat.is_null().to_numpy(zero_copy_only=False), True)
    return sizes, np.append(flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), 0), lost


def interleaved(base: int):
    """Tokens of the frames that all layers fill. A null layer does not end them: its entries are null."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def run(l0: pa.Array, l1: pa.Array, l2: pa.Array) -> pa.Array:
        layers, frames = [], np.full(len(l0), np.iinfo(np.int64).max)
        for rows, stride in zip((l0, l1, l2), STRIDES, strict=True):
            none = rows.is_null().to_numpy(zero_copy_only=False)
            layers.append((*_entries(rows), none))
            frames = np.where(none, frames, np.minimum(frames, layers[-1][0] // stride))
        frames[np.logical_and.reduce([none for *_, none in layers])] = 0
        at = within(frames)
        first = [np.repeat(ends_of(sizes)[:-1], frames) + at * stride for (sizes, *_), stride in zip(layers, STRIDES, strict=True)]
        for place, (_, entries, _, none) in zip(first, layers, strict=True):
            place[np.repeat(none, frames)] = len(entries) - 1
        out, gone = np.empty((len(at), T.SLOTS), np.int64), np.zeros((len(at), T.SLOTS), bool)
        for slot, (layer, _, step) in enumerate(SLOT_SOURCE):
            _, entries, lost, none = layers[layer]
            place = np.minimum(first[layer] + step, len(entries) - 1)
            out[:, slot] = entries[place] + (base + slot * T.CODEBOOK)
            gone[:, slot] = lost[place]
        return lists_of(frames * T.SLOTS, out.ravel(), gone.ravel() if gone.any() else None)

    return run


def layers_of(base: int):
    """The three layers of a token array; a trailing partial frame is left out."""

    @F.arrow_udf(LAYERS)
    def run(ids: pa.Array) -> pa.Array:
        sizes, entries, lost = _entries(ids)
        frames = sizes // T.SLOTS
        first = np.repeat(ends_of(sizes)[:-1], frames) + within(frames) * T.SLOTS
        layers = []
        for layer, stride in enumerate(STRIDES):
            slots = np.array([slot for slot, (source, _, _) in enumerate(SLOT_SOURCE) if source == layer])
            place = first[:, None] + slots
            codes, gone = entries[place] - (base + slots * T.CODEBOOK), lost[place].ravel()
            layers.append(lists_of(frames * stride, codes.ravel(), gone if gone.any() else None))
        return pa.StructArray.from_arrays(layers, ["l0", "l1", "l2"])

    return run


def interleave(l0: Column, l1: Column, l2: Column, base: int = T.AUDIO_BASE) -> Column:
    return interleaved(base)(l0, l1, l2)


def layers(ids: Column, base: int = T.AUDIO_BASE) -> Column:
    return layers_of(base)(ids)
