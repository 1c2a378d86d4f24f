"""Column expressions for the seven-slot codec token layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from phonolake.functions import tokens as T

# Slot j of a frame holds entry `at` of `stride` in its layer: (layer, stride, at).
SLOT_SOURCE = [(0, 1, 0), (1, 2, 0), (2, 4, 0), (2, 4, 1), (1, 2, 1), (2, 4, 2), (2, 4, 3)]


def idiv(a: Column, b: Column | int) -> Column:
    """Integer division."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def index_range(n: Column) -> Column:
    """[0, 1, …, n-1]; empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.expr("cast(array() as array<int>)"))


def empty_ints() -> Column:
    return F.expr("cast(array() as array<int>)")


def join_ints(arr: Column) -> Column:
    return F.array_join(arr.cast("array<string>"), ",")


def digest(arr: Column) -> Column:
    """Short comparable form of an integer array."""
    return F.md5(join_ints(arr))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    Spark may put the expression of a column in place of the column, also inside a lambda, where it would then be
    computed for every element. A lambda variable cannot be replaced.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _layers(l0: Column, l1: Column, l2: Column) -> Column:
    return F.struct(l0.alias("l0"), l1.alias("l1"), l2.alias("l2"))


def _whole_frames(v: Column) -> Column:
    """Number of frames that all three layers can fill."""
    return F.least(F.size(v["l0"]), F.shiftright(F.size(v["l1"]), 1), F.shiftright(F.size(v["l2"]), 2))


def _frame(v: Column, i: Column, base: int) -> Column:
    return F.array(
        *[
            F.get(v[f"l{layer}"], i * stride + at) + F.lit(base + slot * T.CODEBOOK)
            for slot, (layer, stride, at) in enumerate(SLOT_SOURCE)
        ]
    )


def interleave(l0: Column, l1: Column, l2: Column, base: int = T.AUDIO_BASE) -> Column:
    """Layer codes to one token array; what does not fill a frame is left out."""

    def body(v: Column) -> Column:
        return F.flatten(F.transform(index_range(_whole_frames(v)), lambda i: _frame(v, i, base)))

    return let(_layers(l0, l1, l2), body).cast("array<int>")


def changed_frames(l0: Column, l1: Column, l2: Column) -> Column:
    """Numbers of the frames whose first code differs from that of the frame before.

    Slot 0 is the first layer, so frames can be compared, and the length after removing repeats be known, before
    any token array is built.
    """

    def body(v: Column) -> Column:
        codes = v["l0"]
        return F.filter(
            index_range(_whole_frames(v)), lambda i: (i == 0) | (F.get(codes, i) != F.get(codes, i - 1))
        )

    return let(_layers(l0, l1, l2), body)


def interleave_frames(l0: Column, l1: Column, l2: Column, frames: Column, base: int = T.AUDIO_BASE) -> Column:
    """Token array of the given frames only."""
    both = F.struct(l0.alias("l0"), l1.alias("l1"), l2.alias("l2"), frames.alias("frames"))
    return let(both, lambda v: F.flatten(F.transform(v["frames"], lambda i: _frame(v, i, base)))).cast("array<int>")


def layer_of(ids: Column, layer: int, base: int = T.AUDIO_BASE) -> Column:
    """Codes of one layer out of a token array; a trailing partial frame is left out."""
    slots = [s for s, (source, _, _) in enumerate(SLOT_SOURCE) if source == layer]

    def body(v: Column) -> Column:
        frames = index_range(idiv(F.size(v), T.SLOTS))
        codes = lambda i: F.array(*[F.get(v, i * T.SLOTS + s) - F.lit(base + s * T.CODEBOOK) for s in slots])
        return F.flatten(F.transform(frames, codes))

    return let(ids, body).cast("array<int>")


def drop_repeated_frames(ids: Column) -> Column:
    """Drop each frame whose first token equals that of the frame before; null if a partial frame is left."""

    def body(v: Column) -> Column:
        first = lambda i: F.get(v, i * T.SLOTS)
        kept = F.filter(index_range(idiv(F.size(v), T.SLOTS)), lambda i: (i == 0) | (first(i) != first(i - 1)))
        joined = F.flatten(F.transform(kept, lambda i: F.slice(v, i * T.SLOTS + 1, T.SLOTS)))
        return F.when(F.size(v) % T.SLOTS == 0, joined)

    return let(ids, body)


def count_where(arr: Column, test) -> Column:
    return F.size(F.filter(arr, test))


def count_value(arr: Column, value: int) -> Column:
    return count_where(arr, lambda x: x == value)


def first_position(arr: Column, value: int) -> Column:
    """0-based position of the first ``value``, null if absent."""
    pos = F.array_position(arr, F.lit(value))
    return F.when(pos > 0, pos - 1)


def before_first(arr: Column, value: int) -> Column:
    """Entries before the first ``value``; all if absent."""
    place = F.struct(F.array_position(arr, F.lit(value)).cast("int").alias("at"), arr.alias("arr"))

    def body(v: Column) -> Column:
        return F.when(v["at"] > 0, F.slice(v["arr"], 1, F.greatest(v["at"] - 1, F.lit(0)))).otherwise(v["arr"])

    return let(place, body)


def first_n(arr: Column, n: int) -> Column:
    return F.slice(arr, 1, n)


def last_n(arr: Column, n: int) -> Column:
    return F.slice(arr, F.greatest(F.size(arr) - n, F.lit(0)) + 1, n)


def frames_of_samples(n_samples: Column) -> Column:
    """Frames after padding up to a whole number of 2048 samples."""
    return idiv(n_samples + (T.FRAME_SAMPLES - 1), T.FRAME_SAMPLES)


def prompt_a(prompt: Column) -> Column:
    tail = [T.END_OF_TEXT, T.END_OF_HUMAN, T.START_OF_AI, T.START_OF_SPEECH]
    return F.concat(F.array(F.lit(T.START_OF_HUMAN)), prompt, F.array(*map(F.lit, tail)))


def sequence_a(prompt: Column, audio: Column) -> Column:
    return F.concat(prompt_a(prompt), audio, F.array(F.lit(T.END_OF_SPEECH)))


def sequence_b(prompt: Column, audio: Column) -> Column:
    # The prompt part has the same five control tokens in both formats.
    return F.concat(prompt_a(prompt), audio, F.array(F.lit(T.END_OF_SPEECH), F.lit(T.END_OF_AI)))


def labels_b(ids: Column, prompt_len: Column) -> Column:
    """Ignore value for the prompt up to END_OF_HUMAN, then the ids themselves."""
    hidden = prompt_len + 3
    return F.concat(
        F.array_repeat(F.lit(T.IGNORE_LABEL), hidden), F.slice(ids, hidden + 1, F.size(ids) - hidden)
    )
