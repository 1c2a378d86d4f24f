"""Keyed processors that consume rows in ``seq`` order although a micro-batch does not keep it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from phonolake.functions.schema import struct


WAIT_BLOCK = 256
HELD = "held_"
KEEP_MS = 3_600_000


def with_key_type(output: Ty.StructType, stream: DataFrame, key: str) -> Ty.StructType:
    """``output`` with the type that ``key`` has in the stream."""
    kind = stream.schema[key].dataType
    return Ty.StructType([Ty.StructField(f.name, kind if f.name == key else f.dataType) for f in output])


class OrderedProcessor(StatefulProcessor):
    """Base of processors that fold the rows of a key in order of ``seq`` (from 0, without gaps).

    Rows that come too early wait in keyed state until the gap closes; repeated rows are ignored. Waiting rows are
    kept in blocks of 256 numbers, so a block costs one state access, and only the block that is next is held in
    memory. A subclass names its state and row fields and folds one row at a time. A key without new rows for
    ``timeout_ms`` is closed through :meth:`on_timeout`, and all its state goes; a key that was closed before keeps a
    mark for as long, by which late rows are ignored. ``None`` keeps all state: for runs over a bounded input, which
    timers would not let end.
    """

    state_schema: Ty.StructType
    row_fields: list[Ty.StructField]
    out_columns: list[str]

    def __init__(self, timeout_ms: int | None = KEEP_MS) -> None:
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        progress = struct(next_seq="long", closed="boolean").fields
        self.state = handle.getValueState("state", Ty.StructType(progress + self.state_schema.fields))
        row = Ty.StructType(struct(seq="long").fields + list(self.row_fields))
        rows = Ty.StructType([Ty.StructField("rows", Ty.ArrayType(row))])
        self.waiting = handle.getMapState("waiting", struct(block="long"), rows)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        next_seq, closed, *state = self.state.get() or (0, False, *self.start())
        state = list(state)
        self.block, self.held = None, {}
        for batch in rows:
            # An Arrow batch is bounded, so the rows in memory are.
            arrived = {} if closed else self._rows(batch, next_seq)
            out: list[tuple] = []
            while not closed:
                row = arrived.pop(next_seq, None) or self._held(next_seq)
                if row is None:
                    break
                closed = self.fold(key, next_seq, row, state, out)
                next_seq += 1
            if not closed:
                self._hold({s: r for s, r in arrived.items() if s > next_seq})
            if out:
                yield self.frame(out)
        if closed:
            self.waiting.clear()
        elif self.block is not None:
            self._drop_passed(next_seq)
        self.state.update((next_seq, closed, *state))
        if self.timeout_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Take over a key from the rows of :func:`open_keys`: one with its state, the others with waiting rows."""
        fields = struct(next_seq="long", closed="boolean").fields + self.state_schema.fields
        early = {}
        for row in initialState.to_dict("records"):
            if _plain(row["next_seq"], Ty.LongType()) is not None:
                self.state.update(tuple(_plain(row[f.name], f.dataType) for f in fields))
            else:
                cells = [_plain(row[f"{HELD}{f.name}"], f.dataType) for f in self.row_fields]
                early[int(row[f"{HELD}seq"])] = cells
        self.block, self.held = None, {}
        self._hold(early)
        if self.timeout_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)

    def _rows(self, batch: pd.DataFrame, next_seq: int) -> dict[int, list]:
        names = ["seq", *[f.name for f in self.row_fields]]
        found = {}
        for seq, *cells in batch[names].itertuples(index=False, name=None):
            if seq >= next_seq:
                found[int(seq)] = [_plain(v, f.dataType) for v, f in zip(cells, self.row_fields, strict=True)]
        return found

    def _held(self, seq: int) -> list | None:
        """Waiting row ``seq``; loads its block when it is the next one."""
        block = seq // WAIT_BLOCK
        if block != self.block:
            if self.block is not None:
                self._drop_passed(seq)
            self.block, self.held = block, self._load(block)
        return self.held.get(seq)

    def _load(self, block: int) -> dict[int, list]:
        stored = self.waiting.getValue((block,)) if self.waiting.containsKey((block,)) else None
        return {r[0]: list(r[1:]) for r in stored[0]} if stored else {}

    def _hold(self, early: dict[int, list]) -> None:
        blocks: dict[int, dict[int, list]] = {}
        for seq, row in early.items():
            blocks.setdefault(seq // WAIT_BLOCK, {})[seq] = row
        for block, rows in blocks.items():
            merged = {**(self.held if block == self.block else self._load(block)), **rows}
            self.waiting.updateValue((block,), ([(s, *merged[s]) for s in sorted(merged)],))
            if block == self.block:
                self.held = merged

    def _drop_passed(self, next_seq: int) -> None:
        """Forget the loaded block once all its numbers are used."""
        if self.held and next_seq >= (self.block + 1) * WAIT_BLOCK:
            self.waiting.removeKey((self.block,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        next_seq, closed, *state = self.state.get() or (0, True)
        out: list[tuple] = []
        if not closed:
            self.on_timeout(key, next_seq, list(state), out)
        self.waiting.clear()
        self.state.clear()
        if out:
            yield self.frame(out)

    def frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=self.out_columns, dtype=object)

    def close(self) -> None:
        pass

    def start(self) -> tuple:
        """State of a new key."""
        raise NotImplementedError

    def fold(self, key, seq: int, row: list, state: list, out: list[tuple]) -> bool:
        """Take one row, change ``state`` in place, append results; true closes the key."""
        raise NotImplementedError

    def on_timeout(self, key, seq: int, state: list, out: list[tuple]) -> None:
        """Called once when a key times out."""


def open_keys(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """State of all keys of a stopped query with an ordered processor, as a table that a new query can start from.

    One row per key with its state, and one per row that waits for a gap, whose columns begin with ``held_``.
    """

    def read(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    state = read("state").select(F.col("key").getField(key).alias(key), "value.*")
    waiting = read("waiting")
    if "user_map_value" in waiting.columns:
        block = F.col("user_map_value.rows")
    else:
        waiting = waiting.select("key", F.explode("map_value").alias("block", "value"))
        block = F.col("value.rows")
    held = waiting.select(F.col("key").getField(key).alias(key), F.explode(block).alias("row")).select(key, "row.*")
    held = held.select(key, *[F.col(c).alias(f"{HELD}{c}") for c in held.columns if c != key])
    return state.unionByName(held, allowMissingColumns=True)


PYTHON_TYPES = {Ty.LongType: int, Ty.IntegerType: int, Ty.DoubleType: float, Ty.BooleanType: bool}


def _plain(value, kind: Ty.DataType):
    """Python value of a pandas cell. A whole-number column with missing values arrives as floats, which state of a
    whole-number type would lose."""
    if value is None or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    convert = PYTHON_TYPES.get(type(kind))
    return convert(value) if convert else value
