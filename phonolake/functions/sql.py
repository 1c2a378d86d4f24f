"""The main column functions under SQL names, as SQL functions without Python in their evaluation."""

from __future__ import annotations

from pyspark.sql import SparkSession

from phonolake.functions import text as X
from phonolake.functions import tokens as T


def _literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def _whitespace() -> str:
    return "concat(" + ", ".join(f"char({ord(c)})" if ord(c) < 256 else _literal(c) for c in T.WHITESPACE) + ")"


def _sentences(granularity: str) -> str:
    pieces = f"regexp_extract_all(text, {_literal(X.piece_pattern(granularity))}, 0)"
    return f"filter(transform({pieces}, p -> btrim(p, {_whitespace()})), p -> p <> '')"


FUNCTIONS = {
    "text_sentences(text STRING)": ("ARRAY<STRING>", _sentences("sentence")),
    "text_clauses(text STRING)": ("ARRAY<STRING>", _sentences("clause")),
    "token_frames(tokens ARRAY<INT>)": (
        "ARRAY<ARRAY<INT>>",
        f"transform(if(size(tokens) >= {T.SLOTS}, sequence(0, size(tokens) div {T.SLOTS} - 1), "
        f"cast(array() as array<bigint>)), i -> slice(tokens, cast(i * {T.SLOTS} + 1 as int), {T.SLOTS}))",
    ),
    "token_number(text STRING)": (
        "BIGINT",
        f"try_cast(regexp_extract(btrim(text, {_whitespace()}), {_literal(X.LAST_TOKEN_PATTERN)}, 1) as bigint)",
    ),
    "voice_prompt(speaker STRING, text STRING)": (
        "STRING",
        "if(coalesce(speaker, '') <> '', concat(speaker, ': ', text), text)",
    ),
}


def _rows_of(call: str) -> str:
    return f"SELECT e.pos, e.col FROM (SELECT {call} AS items) t, LATERAL posexplode(t.items) AS e(pos, col)"


#: Functions that give rows, to be used in FROM, also laterally.
TABLE_FUNCTIONS = {
    "sentence_rows(text STRING)": ("sentence_index INT, sentence_text STRING", _rows_of(_sentences("sentence"))),
    "clause_rows(text STRING)": ("sentence_index INT, sentence_text STRING", _rows_of(_sentences("clause"))),
    "frame_rows(tokens ARRAY<INT>)": (
        "frame INT, tokens ARRAY<INT>",
        _rows_of(FUNCTIONS["token_frames(tokens ARRAY<INT>)"][1]),
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Create the temporary functions in the session and return their signatures."""
    for signature, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    for signature, (columns, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")
    return [*FUNCTIONS, *TABLE_FUNCTIONS]
