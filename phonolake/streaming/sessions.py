"""Live text sessions: messages in, sentences and session events out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.functions import text as X
from phonolake.functions import tokens as T
from phonolake.functions.schema import struct
from phonolake.operators.sessions import MESSAGE_SCHEMA, RESET, STICKY
from phonolake.session import ROCKSDB_PROVIDER
from phonolake.streaming.ordered import KEEP_MS, OrderedProcessor, with_key_type

CONFIG_FIELDS = {
    "voice": "string",
    "repetition_penalty": "double",
    "max_tokens": "int",
    "temperature": "double",
    "top_p": "double",
    "split_granularity": "string",
    "response_format": "string",
    "stream_audio": "boolean",
}
SESSION_OUTPUT = struct(
    session_id="long",
    seq="long",
    kind="string",
    sentence_index="long",
    sentence_text="string",
    **CONFIG_FIELDS,
    error="string",
)
CONFIG = list(CONFIG_FIELDS)


class SessionProcessor(OrderedProcessor):
    """Sentence buffer, configuration and end of one session.

    Rows out: ``configured``, ``sentence``, ``error`` (unknown message type), ``done`` and, when a session times out,
    ``disconnected``, which drops what is left in the buffer.
    """

    state_schema = struct(buffer="string", sentences="long", **CONFIG_FIELDS)
    row_fields = list(MESSAGE_SCHEMA.fields)
    out_columns = SESSION_OUTPUT.names

    def start(self) -> tuple:
        return ("", 0, *STICKY.values(), *RESET.values())

    def fold(self, key, seq, row, state, out) -> bool:
        message = dict(zip((f.name for f in self.row_fields), row, strict=True))
        kind = message["type"]
        if kind == "session.config":
            self._configure(message, state)
            self._emit(out, key, seq, "configured", state)
        elif kind == "input.text":
            pieces, state[0] = X.ready_pieces(state[0] + (message["text"] or ""), self._granularity(state))
            self._sentences(out, key, seq, pieces, state)
        elif kind == "input.done":
            self._sentences(out, key, seq, X.rest_pieces(state[0], self._granularity(state)), state)
            state[0] = ""
            self._emit(out, key, seq, "done", state)
            return True
        else:
            self._emit(out, key, seq, "error", state, error=f"unsupported message type: {kind}")
        return False

    def on_timeout(self, key, seq, state, out) -> None:
        self._emit(out, key, seq, "disconnected", state)

    @staticmethod
    def _granularity(state) -> str:
        return state[2 + CONFIG.index("split_granularity")]

    @staticmethod
    def _configure(message, state) -> None:
        given = dict(message, voice=message["voice"] or message["speaker"] or None)
        for i, name in enumerate(CONFIG, start=2):
            if name in RESET:
                state[i] = RESET[name] if given[name] is None else given[name]
            elif given[name] is not None:
                state[i] = given[name]

    def _sentences(self, out, key, seq, pieces, state) -> None:
        for piece in pieces:
            self._emit(out, key, seq, "sentence", state, index=state[1], text=piece)
            state[1] += 1

    @staticmethod
    def _emit(out, key, seq, kind, state, index=None, text=None, error=None) -> None:
        index = state[1] if kind in ("done", "disconnected") else index
        out.append((key[0], seq, kind, index, text, *state[2:], error))


def segment_sessions(
    messages: DataFrame, timeout_ms: int | None = KEEP_MS, handed_over: DataFrame | None = None
) -> DataFrame:
    """Session events of a stream of messages (session_id, seq, type, …); ids keep their type.

    A session without messages for ``timeout_ms`` is closed, and its state goes; that of a done session does as well.
    ``handed_over`` are the open sessions of a stopped query, see ``open_keys``: the new query goes on where that one
    stopped, and takes the messages that it had not seen.
    """
    use_rocksdb(messages)
    return messages.groupBy("session_id").transformWithStateInPandas(
        statefulProcessor=SessionProcessor(timeout_ms),
        outputStructType=with_key_type(SESSION_OUTPUT, messages, "session_id"),
        outputMode="Append",
        timeMode="None" if timeout_ms is None else "ProcessingTime",
        initialState=None if handed_over is None else handed_over.groupBy("session_id"),
    )


def use_rocksdb(stream: DataFrame) -> None:
    """Keyed state of these operators needs the RocksDB store; it also keeps large state out of the heap."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def stream_session_totals(chunks: DataFrame, time: str | None = None, keep: str = "1 day") -> DataFrame:
    """Running totals per session of a stream of chunks (session_id, sentence_index, bytes, error).

    Run it in update mode. A sentence fails at most once, with its last chunk row. With an event-time column ``time``
    totals are of sessions of chunks less than ``keep`` apart, and their state goes once the watermark has passed;
    without one it stays for good, which is meant for bounded input.
    """
    key = ["session_id"]
    if time is not None:
        key.append(F.session_window(time, keep))
        chunks = chunks.withWatermark(time, keep)
    return chunks.groupBy(*key).agg(
        (F.max("sentence_index") + 1).alias("total_sentences"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.count_if("error").alias("failed_sentences"),
    )
