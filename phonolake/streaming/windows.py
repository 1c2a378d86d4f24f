"""Decode windows of live token streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import tokens as T
from phonolake.functions.schema import struct
from phonolake.operators.codes import in_range
from phonolake.operators.generated import parse_tokens, window_layers
from phonolake.streaming.ordered import KEEP_MS, OrderedProcessor, with_key_type
from phonolake.streaming.sessions import use_rocksdb

WINDOW = T.SLOTS * T.WINDOW_FRAMES
WINDOW_OUTPUT = struct(request_id="long", token_index="long", codes="array<long>")


class WindowProcessor(OrderedProcessor):
    """Accepted codes of one request; a window of 28 codes with every seventh from the 28th on."""

    state_schema = struct(accepted="long", recent="array<long>")
    row_fields = struct(token_number="long").fields
    out_columns = WINDOW_OUTPUT.names

    def start(self) -> tuple:
        return (0, [])

    def fold(self, key, seq, row, state, out) -> bool:
        accepted, recent = state
        if row[0] is None:
            return False
        code = int(row[0]) - T.CUSTOM_TOKEN_SHIFT - (accepted % T.SLOTS) * T.CODEBOOK
        if code > 0:
            accepted += 1
            recent.append(code)
            if len(recent) >= 2 * WINDOW:
                del recent[:-WINDOW]
            if accepted % T.SLOTS == 0 and accepted >= WINDOW:
                out.append((key[0], accepted, recent[-WINDOW:]))
            state[:] = [accepted, recent]
        return False


def stream_windows(events: DataFrame, timeout_ms: int | None = KEEP_MS) -> DataFrame:
    """Valid windows of a stream of token events (request_id, seq, text); same rows as the batch operator.

    Ids keep their type. The state of a request goes when it has had no event for ``timeout_ms``.
    """
    use_rocksdb(events)
    parsed = parse_tokens(events).select("request_id", "seq", "token_number")
    windows = parsed.groupBy("request_id").transformWithStateInPandas(
        statefulProcessor=WindowProcessor(timeout_ms),
        outputStructType=with_key_type(WINDOW_OUTPUT, events, "request_id"),
        outputMode="Append",
        timeMode="None" if timeout_ms is None else "ProcessingTime",
    )
    return window_layers(windows.where(F.forall("codes", lambda c: in_range(c, "lenient"))))
