"""Queries over generated token streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.operators import generated as ops
from phonolake.plans import inputs as I
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query

# The fold in SQL: a list of parsed (seq, number) per request is reduced to the list of accepted (seq, code).
_CODE = "y.n - 10 - (x.k % 7) * 4096"
_ACCEPT_SQL = {
    "parse": f"{_CODE} > 0 AND {_CODE} <= 4096",
    "compat": f"{_CODE} > 0",
    "strict": f"{_CODE} >= 0 AND {_CODE} <= 4095",
}


def fold_sql(mode: str, events: str = "token_events") -> dict[str, str]:
    return {
        "parsed": f"""
            SELECT request_id, seq, max(try_cast(nullif(regexp_extract(text, '<custom_token_([0-9+-]+)>$', 1), '')
              AS BIGINT)) AS n FROM {events} GROUP BY request_id, seq""",
        "folded": f"""
            SELECT request_id, list_reduce(list({{'k': 0::BIGINT, 'n': n, 'seq': seq, 'out': []::STRUCT(seq BIGINT,
                idx BIGINT, code BIGINT)[]}} ORDER BY seq), lambda x, y: CASE WHEN {_ACCEPT_SQL[mode]}
                THEN {{'k': x.k + 1, 'n': y.n, 'seq': y.seq,
                  'out': list_append(x.out, {{'seq': y.seq, 'idx': x.k, 'code': {_CODE}}})}} ELSE x END,
                {{'k': 0::BIGINT, 'n': 0::BIGINT, 'seq': 0::BIGINT, 'out': []::STRUCT(seq BIGINT, idx BIGINT,
                code BIGINT)[]}}).out AS codes FROM parsed WHERE n IS NOT NULL GROUP BY request_id""",
        "accepted": """
            SELECT request_id, c.seq AS seq, c.idx AS idx, (c.idx % 7)::INTEGER AS slot, c.code AS code
            FROM (SELECT request_id, unnest(codes) AS c FROM folded)""",
    }


def _extract(mode: str):
    @query(
        f"extract_codes_{mode}",
        with_inputs("SELECT request_id, seq, idx, slot, code FROM accepted", **fold_sql(mode)),
    )
    def run(spark, sf_dir):
        return ops.extract_codes(I.token_events(spark, sf_dir), mode)


def _extract_uneven(mode: str):
    @query(
        f"extract_codes_uneven_{mode}",
        with_inputs("SELECT request_id, seq, idx, slot, code FROM accepted", **fold_sql(mode, "uneven_events")),
    )
    def run(spark, sf_dir):
        """Blocks of eight events, so that gaps take out parts of blocks and whole ones."""
        return ops.extract_codes(I.uneven_events(spark, sf_dir), mode, width=8)


for _mode in ops.ACCEPT:
    _extract(_mode)
    _extract_uneven(_mode)

WINDOWS_SQL = fold_sql("compat") | {
    "frame_rows": """
        SELECT request_id, idx // 7 AS frame, list(code ORDER BY idx) AS c FROM accepted
        GROUP BY 1, 2 HAVING count(*) = 7""",
    "window_rows": """
        SELECT request_id, (frame + 1) * 7 AS token_index, flatten(w) AS w FROM
          (SELECT request_id, frame, list(c) OVER (PARTITION BY request_id ORDER BY frame
             ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS w FROM frame_rows) WHERE len(w) = 4""",
    "windows": "SELECT * FROM window_rows WHERE len(list_filter(w, lambda c: c < 0 OR c > 4096)) = 0",
}


def _pick(slots: list[int]) -> str:
    return "[" + ", ".join(f"w[{f * 7 + s + 1}]" for f in range(4) for s in slots) + "]"


@query(
    "decode_windows",
    with_inputs(
        f"""SELECT request_id, token_index, array_to_string({_pick([0])}, ',') AS l0,
              array_to_string({_pick([1, 4])}, ',') AS l1, array_to_string({_pick([2, 3, 5, 6])}, ',') AS l2,
              2048 AS sample_from, 4096 AS sample_to, 4096 AS chunk_bytes FROM windows""",
        **WINDOWS_SQL,
    ),
)
def decode_windows(spark, sf_dir):
    rows = ops.decode_windows(ops.extract_codes(I.token_events(spark, sf_dir), "compat"))
    return rows.withColumns({f"l{n}": C.join_ints(F.col(f"l{n}")) for n in range(3)})


@query(
    "decoder_report",
    with_inputs(
        """SELECT request_id, events_seen, invalid_events, coalesce(parsed_tokens, 0) AS parsed_tokens,
             coalesce(audio_chunks, 0) AS audio_chunks, coalesce(audio_chunks, 0) * 4096 AS audio_bytes,
             first_audio_token_index, array_to_string(list_transform(range(least(coalesce(audio_chunks, 0), 12)),
               lambda i: 4096), ',') AS audio_chunk_sizes
           FROM (SELECT request_id, count(*) AS events_seen, count(*) FILTER (n IS NULL) AS invalid_events
                 FROM parsed GROUP BY 1)
           LEFT JOIN (SELECT request_id, count(*) AS parsed_tokens FROM accepted GROUP BY 1) USING (request_id)
           LEFT JOIN (SELECT request_id, count(*) AS audio_chunks, min(token_index) AS first_audio_token_index
                      FROM windows GROUP BY 1) USING (request_id)""",
        **WINDOWS_SQL,
    ),
)
def decoder_report(spark, sf_dir):
    rows = ops.decoder_report(I.token_events(spark, sf_dir))
    return rows.withColumn("audio_chunk_sizes", C.join_ints(F.col("audio_chunk_sizes")))


@query(
    "engine_report",
    with_inputs(
        """SELECT request_id, count(*) AS callback_count,
             string_agg(seq || ':' || length(text) || ':' || right(text, 120), '|' ORDER BY seq)
               FILTER (seq < 8) AS samples,
             length(max_by(text, seq))::INTEGER AS final_text_len,
             len(regexp_extract_all(max_by(text, seq), '<custom_token_[0-9]+>'))::INTEGER AS custom_token_count,
             right(max_by(text, seq), 500) AS final_text_tail
           FROM token_events GROUP BY 1"""
    ),
)
def engine_report(spark, sf_dir):
    rows = ops.engine_report(I.token_events(spark, sf_dir))
    sample = lambda s: F.concat_ws(":", s["seq"].cast("string"), s["len"].cast("string"), s["tail"])
    joined = F.array_join(F.transform("stream_text_samples", sample), "|")
    return rows.withColumn("samples", joined).drop("stream_text_samples")
