"""Queries that shape training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from phonolake.functions import codes as C
from phonolake.operators import shaping as ops
from phonolake.operators.ordered import with_row_index
from phonolake.plans import inputs as I
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query


@query(
    "row_index_groups",
    with_inputs(
        """SELECT utt_id, length, i AS row_idx, i // 512 AS shard, i // 12 AS batch_id FROM
             (SELECT *, row_number() OVER (ORDER BY length, utt_id) - 1 AS i FROM lengths)"""
    ),
)
def row_index_groups(spark, sf_dir):
    rows = with_row_index(I.lengths(spark, sf_dir), ["length", "utt_id"])
    return ops.assign_groups(ops.assign_groups(rows, 512, "shard"), 12, "batch_id")


def mix_sets(spark, sf_dir):
    """English documents as the first set, all others as the second."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.where(F.col("lang") == "en"), docs.where(F.col("lang") != "en")


MIX_SQL = {
    "set1": "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents WHERE lang = 'en'",
    "set2": "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents WHERE lang <> 'en'",
    "sizes": "SELECT (SELECT count(*) FROM set1) AS n1, (SELECT count(*) FROM set2) AS n2 FROM range(1)",
}


@query(
    "mix_by_ratio",
    with_inputs(
        """SELECT doc_id, lang, (k // 8) * 12 + k % 8 AS mix_pos, 1 AS mix_source FROM set1 CROSS JOIN sizes
           WHERE k < least(n1 // 8, n2 // 4) * 8
           UNION ALL
           SELECT doc_id, lang, (k // 4) * 12 + 8 + k % 4, 2 FROM set2 CROSS JOIN sizes WHERE k < least(n1 // 8, n2 // 4) * 4""",
        **MIX_SQL,
    ),
)
def mix_by_ratio(spark, sf_dir):
    d1, d2 = mix_sets(spark, sf_dir)
    return ops.mix_by_ratio(d1, d2, ["doc_id"], ["doc_id"], 2, 4, ["doc_id"])


@query(
    "mix_by_schedule",
    with_inputs(
        """SELECT doc_id, lang, CASE WHEN k < 80 THEN (k // 8) * 12 + k % 8 ELSE 120 + ((k - 80) // 4) * 8 + k % 4 END
             AS mix_pos, 1 AS mix_source FROM set1 CROSS JOIN sizes WHERE k < 80 + least((n1 - 80) // 4, (n2 - 40) // 4) * 4
           UNION ALL
           SELECT doc_id, lang, CASE WHEN k < 40 THEN (k // 4) * 12 + 8 + k % 4
             ELSE 120 + ((k - 40) // 4) * 8 + 4 + k % 4 END, 2
           FROM set2 CROSS JOIN sizes WHERE k < 40 + least((n1 - 80) // 4, (n2 - 40) // 4) * 4""",
        **MIX_SQL,
    ),
)
def mix_by_schedule(spark, sf_dir):
    d1, d2 = mix_sets(spark, sf_dir)
    return ops.mix_by_schedule(d1, d2, ["doc_id"], ["doc_id"], [(2, 1, 10), (1, 1, None)], 4, ["doc_id"])


BATCH_SQL = {
    "batched": """
        SELECT *, i // 12 AS batch_id, max(len(input_ids)) OVER (PARTITION BY i // 12) AS padded_len,
          bool_and(labels IS NOT NULL) OVER (PARTITION BY i // 12) AS all_labelled
        FROM (SELECT *, row_number() OVER (ORDER BY len(input_ids), utt_id) - 1 AS i FROM sequences)"""
}


def _pad_sql(labels: str) -> str:
    fill = "list_transform(range(padded_len - len(input_ids)), lambda i: {})"
    return with_inputs(
        f"""SELECT utt_id, batch_id, padded_len::INTEGER AS padded_len,
              md5(array_to_string(list_concat(input_ids, {fill.format('128263::BIGINT')}), ',')) AS ids_md5,
              (padded_len - len(input_ids))::INTEGER AS pad_count,
              len(input_ids)::INTEGER AS mask_sum,
              md5(array_to_string(list_concat({labels}, {fill.format('-100::BIGINT')}), ',')) AS labels_md5
            FROM batched""",
        **BATCH_SQL,
    )


def _pad(mode: str, labels: str):
    @query(f"pad_batches_{mode}", _pad_sql(labels))
    def run(spark, sf_dir):
        rows = I.sequences(spark, sf_dir).withColumn("length", F.size("input_ids"))
        rows = ops.padded_batches(rows, ["length", "utt_id"], ["utt_id"], 12, mode)
        return rows.select(
            "utt_id",
            "batch_id",
            "padded_len",
            C.digest(F.col("input_ids")).alias("ids_md5"),
            "pad_count",
            F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
            C.digest(F.col("labels")).alias("labels_md5"),
        )


_pad("pretrain", "CASE WHEN all_labelled THEN labels ELSE input_ids END")
_pad("finetune", "input_ids")


@query(
    "pad_batches_labelled",
    with_inputs(
        """SELECT batch_id, max(n)::INTEGER AS padded_len, sum(max_n - n)::BIGINT AS pad_count,
             sum(n - n // 2)::BIGINT AS learned
           FROM (SELECT *, max(n) OVER (PARTITION BY batch_id) AS max_n FROM
             (SELECT len(input_ids) AS n, (row_number() OVER (ORDER BY utt_id) - 1) // 12 AS batch_id FROM sequences
              WHERE labels IS NOT NULL)) GROUP BY 1"""
    ),
)
def pad_batches_labelled(spark, sf_dir):
    rows = I.sequences(spark, sf_dir).where(F.col("labels").isNotNull())
    rows = rows.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))
    padded = ops.pad_batches(ops.batches(rows, ["utt_id"], 12, ["utt_id"]), "labelled")
    learned = F.size(F.filter("labels", lambda x: x != -100))
    return padded.groupBy("batch_id").agg(
        F.max("padded_len").alias("padded_len"),
        F.sum("pad_count").alias("pad_count"),
        F.sum(learned).alias("learned"),
    )


def _waste_sql(name: str, order: str) -> str:
    return f"""
        SELECT '{name}' AS batching, count(*) AS batches, sum(longest * n)::BIGINT AS total_tokens,
          sum(used)::BIGINT AS used_tokens, (sum(longest * n) - sum(used)) / sum(longest * n) AS waste
        FROM (SELECT max(length) AS longest, count(*) AS n, sum(length) AS used
              FROM (SELECT length, (row_number() OVER (ORDER BY {order}) - 1) // 12 AS b FROM lengths) GROUP BY b)"""


@query(
    "padding_report",
    with_inputs(f"{_waste_sql('sorted', 'length, utt_id')} UNION ALL {_waste_sql('unsorted', 'utt_id')}"),
)
def padding_report(spark, sf_dir):
    return ops.padding_report(I.lengths(spark, sf_dir), "length", "utt_id", 12)


PACK_BLOCK = 8192


@query(
    "pack_sequences",
    with_inputs(
        f"""SELECT p // {PACK_BLOCK} AS block_id, count(*)::INTEGER AS n_tokens, count(DISTINCT utt_id) AS n_sequences,
              md5(string_agg(token, ',' ORDER BY p)) AS ids_md5
            FROM (SELECT utt_id, unnest(input_ids) AS token, start + generate_subscripts(input_ids, 1) - 1 AS p
                  FROM (SELECT utt_id, input_ids, sum(len(input_ids)) OVER (ORDER BY utt_id) - len(input_ids) AS start
                        FROM sequences WHERE len(input_ids) > 0)) GROUP BY 1"""
    ),
)
def pack_sequences(spark, sf_dir):
    rows = ops.pack_sequences(I.sequences(spark, sf_dir), ["utt_id"], PACK_BLOCK)
    return rows.select(
        "block_id", F.size("input_ids").alias("n_tokens"), "n_sequences", C.digest(F.col("input_ids")).alias("ids_md5")
    )


def _steps(name: str, ratio: int, audio: str):
    @query(
        name,
        f"""SELECT event_id AS global_step, round(value / 10, 4) AS loss, m AS modality,
              row_number() OVER (PARTITION BY m ORDER BY event_id) - 1 AS modality_step
            FROM (SELECT *, CASE WHEN {audio} THEN 'audio' ELSE 'text' END AS m FROM events)""",
    )
    def run(spark, sf_dir):
        log = I.table(spark, sf_dir, "events").select(
            F.col("event_id").alias("global_step"), F.round(F.col("value") / 10, 4).alias("loss")
        )
        return ops.classify_steps(log, ratio)


_steps("classify_steps", 2, "event_id % 3 = 0")
_steps("classify_steps_audio_only", 0, "true")
