"""Training-set shaping: shards and batches, ratio mixing, padding, packing and step logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phonolake.functions import tokens as T
from phonolake.functions.codes import idiv
from phonolake.operators.joins import fits_broadcast
from phonolake.operators.ordered import index_rows, join_on, number_rows, running_sum, with_row_index
from phonolake.session import materialise

#: Places of sequences that are sent to every executor, so that token arrays need not move to them.
MOST_PLACES = 4_000_000


def assign_groups(df: DataFrame, size: int, out: str, index: str = "row_idx") -> DataFrame:
    """Number of the group of ``size`` consecutive rows."""
    return df.withColumn(out, idiv(F.col(index), size))


def batches(df: DataFrame, order: list, batch_size: int, key: list[str] | None = None) -> DataFrame:
    return assign_groups(with_row_index(df, order, key=key), batch_size, "batch_id")


def _phase(d1, d2, index, from1, from2, start, cycles, r1, r2, block):
    """Rows of one mixing phase with their place in the output."""
    b1, b2 = r1 * block, r2 * block
    cycle = b1 + b2
    parts = []
    for df, first, width, lead, source in ((d1, from1, b1, 0, 1), (d2, from2, b2, b1, 2)):
        if not width:
            continue
        k = F.col(index) - first
        rows = df.where(F.col(index).between(first, first + cycles * width - 1))
        place = idiv(k, width) * cycle + lead + k % width + start
        parts.append(rows.withColumns({"mix_pos": place, "mix_source": F.lit(source)}))
    return parts


def mix_by_ratio(
    d1: DataFrame,
    d2: DataFrame,
    order1: list,
    order2: list,
    ratio: int,
    block: int,
    key: list[str] | None = None,
) -> DataFrame:
    """Cycles of ``ratio * block`` rows of the first set and ``block`` of the second; whole cycles only."""
    if ratio <= 0:
        raise ValueError("ratio must be above 0; with 0 the second set is used alone")
    return mix_by_schedule(d1, d2, order1, order2, [(ratio, 1, None)], block, key)


def mix_by_schedule(
    d1: DataFrame,
    d2: DataFrame,
    order1: list,
    order2: list,
    schedule: list[tuple],
    block: int,
    key: list[str] | None = None,
) -> DataFrame:
    """Mix in phases (parts of set 1, parts of set 2, cycles); ``None`` cycles run as long as both sets last.

    The place ``mix_pos`` of a row follows from its index, so nothing but the indexing shuffles; sort by it to
    write the set in order. ``key`` names columns that identify a row in both sets, see ``index_rows``.
    """
    (i1, n1), (i2, n2) = index_rows(d1, order1, "_k", key), index_rows(d2, order2, "_k", key)
    used1 = used2 = start = 0
    parts = []
    for r1, r2, wanted in schedule:
        if r1 < 0 or r2 < 0 or r1 + r2 == 0:
            raise ValueError(f"bad ratio {r1}:{r2}")
        limits = [(n - u) // (r * block) for n, u, r in ((n1, used1, r1), (n2, used2, r2)) if r]
        cycles = min(limits if wanted is None else [*limits, wanted])
        parts += _phase(i1, i2, "_k", used1, used2, start, cycles, r1, r2, block)
        used1, used2 = used1 + cycles * r1 * block, used2 + cycles * r2 * block
        start += cycles * (r1 + r2) * block
    mixed = parts[0]
    for part in parts[1:]:
        mixed = mixed.unionByName(part)
    return mixed.drop("_k")


def _batch_facts(df: DataFrame, batch: str) -> DataFrame:
    """Longest row of the batch, and whether all its rows have a mask and labels."""
    # A batch has a fixed number of rows, so this window has no hot partition.
    of_batch = Window.partitionBy(batch)
    return df.withColumns(
        {
            "padded_len": F.max("_len").over(of_batch),
            "_all_mask": F.min("_has_mask").over(of_batch),
            "_all_labels": F.min("_has_labels").over(of_batch),
        }
    ).drop("_len", "_has_mask", "_has_labels")


def _row_facts(df: DataFrame) -> dict:
    return {
        "_len": F.size("input_ids"),
        "_has_mask": F.col("attention_mask").isNotNull() if "attention_mask" in df.columns else F.lit(False),
        "_has_labels": F.col("labels").isNotNull() if "labels" in df.columns else F.lit(False),
    }


def _fill(df: DataFrame, mode: str, pad: int) -> DataFrame:
    if mode not in ("pretrain", "finetune", "labelled"):
        raise ValueError(f"unknown mode {mode}")
    size = F.size("input_ids")
    mask, labels = F.array_repeat(F.lit(1), size), F.col("input_ids")
    if "attention_mask" in df.columns:
        given = F.col("attention_mask").cast("array<int>")
        mask = given if mode == "labelled" else F.when(F.col("_all_mask"), given).otherwise(mask)
    if "labels" in df.columns and mode != "finetune":
        given = F.col("labels").cast("array<int>")
        labels = given if mode == "labelled" else F.when(F.col("_all_labels"), given).otherwise(labels)
    fill = F.col("padded_len") - size
    return df.withColumns(
        {
            "attention_mask": F.concat(mask, F.array_repeat(F.lit(0), fill)),
            "labels": F.concat(labels, F.array_repeat(F.lit(T.IGNORE_LABEL), fill)),
            "input_ids": F.concat("input_ids", F.array_repeat(F.lit(pad), fill)),
            "pad_count": fill,
        }
    ).drop("_all_mask", "_all_labels")


def pad_batches(df: DataFrame, mode: str = "pretrain", pad: int = T.PAD, batch: str = "batch_id") -> DataFrame:
    """Pad ``input_ids``, ``attention_mask`` and ``labels`` to the longest row of the batch.

    ``pretrain`` uses given labels if every row of the batch has them, else the ids; ``finetune`` always the ids;
    ``labelled`` always the given labels and mask. A mask is used if every row has one, else it is all ones.
    """
    return _fill(_batch_facts(df.withColumns(_row_facts(df)), batch), mode, pad)


def padded_batches(
    df: DataFrame, order: list, key: list[str], batch_size: int, mode: str = "pretrain", pad: int = T.PAD
) -> DataFrame:
    """Batch rows in ``order`` and pad them as :func:`pad_batches` does.

    Index, batches and their longest rows are found on a narrow table; the token arrays move once, when that table
    is joined back by ``key``.
    """
    facts = _row_facts(df)
    narrow = materialise(df.withColumns(facts).select(*dict.fromkeys([*order, *key, *facts])))
    placed = _batch_facts(batches(narrow, order, batch_size), "batch_id")
    extra = [c for c in placed.columns if c in key or c not in df.columns]
    return _fill(join_on(df, placed.select(*extra), key), mode, pad)


def padding_waste(df: DataFrame, length: str, order: list, batch_size: int) -> DataFrame:
    """Share of padding when rows are batched in ``order``."""
    placed = batches(df.select(*dict.fromkeys([length, *order])), order, batch_size)
    per = placed.groupBy("batch_id").agg(
        F.max(length).alias("longest"), F.count(F.lit(1)).alias("rows"), F.sum(length).alias("used")
    )
    totals = per.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum(F.col("longest") * F.col("rows")).cast("long").alias("total_tokens"),
        F.sum("used").cast("long").alias("used_tokens"),
    )
    return totals.withColumn("waste", (F.col("total_tokens") - F.col("used_tokens")) / F.col("total_tokens"))


def padding_report(df: DataFrame, length: str, tie_break: str, batch_size: int) -> DataFrame:
    """Padding with rows batched by length and in input order."""
    by_length = padding_waste(df, length, [length, tie_break], batch_size).withColumn("batching", F.lit("sorted"))
    as_is = padding_waste(df, length, [tie_break], batch_size).withColumn("batching", F.lit("unsorted"))
    return by_length.unionByName(as_is)


def pack_sequences(df: DataFrame, order: list, block_len: int = T.MAX_LEN_A, ids: str = "input_ids") -> DataFrame:
    """Chain all sequences end to end and cut blocks of ``block_len``; only the last block may be short.

    ``order`` names columns that identify a row. Places are found on a table of lengths; if these are few enough to send
    out, the token arrays move once, to their blocks, otherwise once more to meet their place.
    """
    used = df.where(F.size(ids) > 0).select(*dict.fromkeys([*order, ids]))
    narrow = with_row_index(materialise(used.select(*order, F.size(ids).cast("long").alias("_n"))), order)
    placed = running_sum(narrow, [], "row_idx", F.col("_n"), "start").select(*order, "start")
    placed = F.broadcast(placed) if fits_broadcast(narrow, MOST_PLACES) else placed
    placed = join_on(used, placed, order)
    last = idiv(F.col("start") + F.size(ids) - 1, block_len)
    rows = placed.select("start", ids, F.explode(F.sequence(idiv(F.col("start"), block_len), last)).alias("block_id"))
    # Part of the sequence inside the block; a block holds at most block_len pieces.
    lo = F.greatest(F.col("block_id") * block_len - F.col("start"), F.lit(0).cast("long"))
    hi = F.least((F.col("block_id") + 1) * block_len - F.col("start"), F.size(ids).cast("long"))
    piece = F.slice(ids, (lo + 1).cast("int"), (hi - lo).cast("int"))
    pieces = rows.select("block_id", "start", piece.alias("piece"))
    return pieces.groupBy("block_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("start", "piece"))), lambda p: p["piece"])).alias(
            "input_ids"
        ),
        F.count(F.lit(1)).alias("n_sequences"),
    )


def classify_steps(log: DataFrame, ratio: int, step: str = "global_step") -> DataFrame:
    """Modality of each logged step and its running number inside the modality."""
    audio = F.lit(True) if ratio <= 0 else F.col(step) % (ratio + 1) == 0
    tagged = log.withColumn("modality", F.when(audio, "audio").otherwise("text"))
    return number_rows(tagged, ["modality"], step, "modality_step")
