"""Queries over codec token arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.functions import tokens as T
from phonolake.operators import codes as ops
from phonolake.plans import inputs as I
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query


def audio(spark, sf_dir):
    return ops.interleave_codes(I.codes(spark, sf_dir)).select("utt_id", "audio_ids")


@query(
    "interleave_codes",
    with_inputs(
        """SELECT utt_id, len(fr)::INTEGER AS frames, md5(array_to_string(flatten(fr), ',')) AS ids_md5 FROM frames"""
    ),
)
def interleave_codes(spark, sf_dir):
    rows = audio(spark, sf_dir)
    return rows.select(
        "utt_id",
        C.idiv(F.size("audio_ids"), T.SLOTS).cast("int").alias("frames"),
        C.digest(F.col("audio_ids")).alias("ids_md5"),
    )


# Layers as a faulty encoder may give them: a missing last code in one language, an over-range code in another.
FAULTY_SQL = {
    "faulty": """
        SELECT c.utt_id, l0, CASE WHEN d.lang = 'de' THEN l1[:len(l1) - 1] ELSE l1 END AS l1,
          CASE WHEN d.lang = 'fr' THEN list_concat(l2[:len(l2) - 1], [4097]) ELSE l2 END AS l2
        FROM codes c JOIN documents d ON d.doc_id = c.utt_id"""
}


def faulty(spark, sf_dir):
    rows = I.codes(spark, sf_dir, "lang")
    short1, short2 = F.slice("l1", 1, F.size("l1") - 1), F.slice("l2", 1, F.size("l2") - 1)
    return rows.select(
        "utt_id",
        "l0",
        F.when(F.col("lang") == "de", short1).otherwise(F.col("l1")).alias("l1"),
        F.when(F.col("lang") == "fr", F.concat(short2, F.array(F.lit(4097)))).otherwise(F.col("l2")).alias("l2"),
    )


@query(
    "interleave_strict",
    with_inputs(
        """SELECT utt_id, error, CASE WHEN error IS NULL THEN len(l0) * 7 END::INTEGER AS n_tokens
           FROM (SELECT *, CASE WHEN len(l1) <> 2 * len(l0) OR len(l2) <> 4 * len(l0) THEN 'layer_lengths'
             WHEN len(list_filter(list_concat(list_concat(l0, l1), l2), lambda c: c < 0 OR c > 4096)) > 0
             THEN 'code_range' END AS error FROM faulty)""",
        **FAULTY_SQL,
    ),
)
def interleave_strict(spark, sf_dir):
    rows = ops.interleave_codes(faulty(spark, sf_dir), "strict")
    return rows.select("utt_id", "error", F.size("audio_ids").alias("n_tokens"))


def _validate_sql(lo: int, hi: int) -> str:
    bad = ", ".join(
        f"len(list_filter(l{n}, lambda c: c < {lo} OR c > {hi}))::INTEGER AS invalid_l{n}" for n in range(3)
    )
    total = "invalid_l0 + invalid_l1 + invalid_l2 = 0 AS valid"
    return with_inputs(f"SELECT *, {total} FROM (SELECT utt_id, {bad} FROM faulty)", **FAULTY_SQL)


def _validate(mode):
    lo, hi = ops.CODE_RANGES[mode]

    @query(f"validate_codes_{mode}", _validate_sql(lo, hi))
    def run(spark, sf_dir):
        rows = ops.validate_codes(faulty(spark, sf_dir), mode)
        return rows.select("utt_id", "invalid_l0", "invalid_l1", "invalid_l2", "valid")


for _mode in ops.CODE_RANGES:
    _validate(_mode)


@query(
    "deinterleave_codes",
    with_inputs(
        "SELECT utt_id, "
        + ", ".join(f"md5(array_to_string(l{n}, ',')) AS l{n}_md5" for n in range(3))
        + " FROM codes"
    ),
)
def deinterleave_codes(spark, sf_dir):
    rows = ops.deinterleave_codes(audio(spark, sf_dir))
    return rows.select("utt_id", *[C.digest(F.col(f"l{n}")).alias(f"l{n}_md5") for n in range(3)])


@query(
    "dedup_frames",
    with_inputs(
        """SELECT utt_id, (len(audio_ids) // 7)::INTEGER AS frames, md5(array_to_string(audio_ids, ',')) AS ids_md5
           FROM deduped"""
    ),
)
def dedup_frames(spark, sf_dir):
    rows = ops.dedup_frames(audio(spark, sf_dir))
    ids = F.col("deduped_ids")
    return rows.select("utt_id", C.idiv(F.size(ids), T.SLOTS).cast("int").alias("frames"), C.digest(ids).alias("ids_md5"))


@query("roundtrip_check", "SELECT count(*) AS n, count(*) AS same FROM documents")
def roundtrip_check(spark, sf_dir):
    rows = ops.roundtrip_check(I.codes(spark, sf_dir))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("same").alias("same"))


@query(
    "audio_token_split",
    with_inputs(
        """SELECT utt_id, len(a)::INTEGER AS n_audio, len(s)::INTEGER AS stray_count,
             array_to_string(s[:20], ',') AS stray
           FROM (SELECT utt_id, list_filter(ids, lambda t: t BETWEEN 128266 AND 156937) AS a,
                   list_filter(ids, lambda t: t NOT BETWEEN 128266 AND 156937) AS s FROM generated)"""
    ),
)
def audio_token_split(spark, sf_dir):
    rows = ops.audio_token_split(I.generated(spark, sf_dir))
    return rows.select(
        "utt_id", F.size("audio_ids").alias("n_audio"), "stray_count", C.join_ints(F.col("stray_ids")).alias("stray")
    )


TRIMMED_SQL = {
    "trimmed": """
        SELECT utt_id, ids, list_contains(ids, 128258) AS has_eos,
          CASE WHEN list_contains(ids, 128258) THEN ids[:list_position(ids, 128258) - 1] ELSE ids END AS t
        FROM generated"""
}


@query(
    "trim_at_eos",
    with_inputs(
        "SELECT utt_id, has_eos, len(t)::INTEGER AS n, md5(array_to_string(t, ',')) AS ids_md5 FROM trimmed",
        **TRIMMED_SQL,
    ),
)
def trim_at_eos(spark, sf_dir):
    rows = ops.trim_at_eos(I.generated(spark, sf_dir))
    ids = F.col("trimmed_ids")
    return rows.select("utt_id", "has_eos", F.size(ids).alias("n"), C.digest(ids).alias("ids_md5"))


@query(
    "min_tokens_filter",
    with_inputs("SELECT utt_id, len(t)::INTEGER AS n FROM trimmed WHERE len(t) >= 7", **TRIMMED_SQL),
)
def min_tokens_filter(spark, sf_dir):
    rows = ops.min_tokens_filter(ops.trim_at_eos(I.generated(spark, sf_dir)), "trimmed_ids")
    return rows.select("utt_id", F.size("trimmed_ids").alias("n"))


_SPECIAL = {"eos": 128258, "eoai": 128262, "sos": 128257, "pad": 128263}
TOKEN_REPORT_SQL = ", ".join(
    [
        "len(ids)::INTEGER AS n_tokens",
        "array_to_string(ids[:14], ',') AS first_14",
        "array_to_string(ids[greatest(len(ids) - 13, 1):], ',') AS last_14",
        "list_min(ids)::INTEGER AS min_token",
        "list_max(ids)::INTEGER AS max_token",
    ]
    + [
        f"len(list_filter(ids, lambda t: t = {v}))::INTEGER AS {n}_count, "
        f"(nullif(list_position(ids, {v}), 0) - 1)::BIGINT AS {n}_first"
        for n, v in _SPECIAL.items()
    ]
)


@query("token_report", with_inputs(f"SELECT utt_id, {TOKEN_REPORT_SQL} FROM generated"))
def token_report(spark, sf_dir):
    return ops.token_report(I.generated(spark, sf_dir)).drop("ids")


def _layer_report_sql(source: str) -> str:
    parts = []
    for n in range(3):
        parts += [
            f"len(l{n})::INTEGER AS n_l{n}",
            f"list_min(l{n})::INTEGER AS min_l{n}",
            f"list_max(l{n})::INTEGER AS max_l{n}",
            f"len(list_filter(l{n}, lambda c: c < 0 OR c > 4095))::INTEGER AS invalid_l{n}",
        ]
    return f"SELECT *, invalid_l0 + invalid_l1 + invalid_l2 = 0 AS valid FROM (SELECT utt_id, {', '.join(parts)} FROM {source})"


LAYERS_SQL = TRIMMED_SQL | {
    "layers": """
        SELECT utt_id, list_transform(range(len(t) // 7), lambda i: t[7 * i + 1] - 128266) AS l0,
          flatten(list_transform(range(len(t) // 7), lambda i: [t[7 * i + 2] - 132362, t[7 * i + 5] - 144650])) AS l1,
          flatten(list_transform(range(len(t) // 7), lambda i: [t[7 * i + 3] - 136458, t[7 * i + 4] - 140554,
            t[7 * i + 6] - 148746, t[7 * i + 7] - 152842])) AS l2
        FROM trimmed"""
}


@query("layer_report", with_inputs(_layer_report_sql("layers"), **LAYERS_SQL))
def layer_report(spark, sf_dir):
    rows = ops.deinterleave_codes(ops.trim_at_eos(I.generated(spark, sf_dir)), "trimmed_ids")
    return ops.layer_report(rows).drop("ids", "trimmed_ids", "has_eos", "l0", "l1", "l2")


@query(
    "inference_report",
    with_inputs(
        f"""SELECT g.*, r.* EXCLUDE (utt_id), s.has_eos, len(s.t)::INTEGER AS n_trimmed,
              CASE WHEN len(s.t) < 7 THEN 'too_short' END AS error,
              len(list_filter(s.ids, lambda t: t NOT BETWEEN 128266 AND 156937))::INTEGER AS stray_count,
              CASE WHEN len(s.t) >= 7 AND r.valid THEN r.n_l0 * 2048 / 24000 END AS duration_s
            FROM (SELECT utt_id, {TOKEN_REPORT_SQL} FROM generated) g JOIN ({_layer_report_sql('layers')}) r USING (utt_id)
            JOIN trimmed s USING (utt_id)""",
        **LAYERS_SQL,
    ),
)
def inference_report(spark, sf_dir):
    rows = ops.inference_report(I.generated(spark, sf_dir))
    return rows.drop("ids", "trimmed_ids", "audio_ids", "stray_ids", "l0", "l1", "l2")
