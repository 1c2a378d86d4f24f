"""Quality rules learned as an ordered decision list.

Statistics of a text (lengths, symbols, repeated lines and words) are computed for every whole document. Rules for low
quality are learned from labelled statistics by sequential covering: a conjunction of thresholds grows by the condition
of the highest information gain, is pruned from its end on rows it was not grown on, is accepted if it is precise there,
and its rows are taken out before the next rule grows. The list is emitted as one ordered Spark expression.

Rules are fitted on at most about ``SAMPLE`` labelled rows, drawn by a hash; everything else covers all rows.

Defined results: null text has no words; a document without label is judged like any other; several labels of one id
count as bad if one is; labels without quality and ids without document are ignored; without two classes the list is
empty and keeps all. Columns with the names of the statistics are replaced, all others stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.llm import words
from phonolake.llm.columns import pack, unpack
from phonolake.llm.registry import query, table
from phonolake.session import materialise

SAMPLE = 50_000
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "words_per_line"]
THRESHOLDS = 64
MAX_RULES = 12
MAX_CONDITIONS = 4
LEAST_PRECISION = 0.9
LEAST_ROWS = 5
BREAK = words.Pattern(b"\n", lower=False)

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _statistics(column: pa.Array) -> pa.StructArray:
    data, offsets = words.raw(column)
    found = words.Words(data, offsets, words.PLAIN)
    lead = (data < 0x80) | (data >= 0xC0)
    chars = _per_text(lead & found.pattern.inside[data], offsets)

    lines = words.Words(data, offsets, BREAK)
    with_word = np.searchsorted(found.starts, lines.ends) > np.searchsorted(found.starts, lines.starts)
    owner = lines.owners()
    keys = words.mix(lines.hashes + words.mix(owner.astype(np.uint64)))
    first = np.zeros(len(lines), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    counted = _per_text(with_word, lines.first)
    dup = _per_text(with_word & ~first, lines.first)

    hashes, at = found.windows(WINDOW)
    keys = words.mix(hashes + words.mix(found.owners()[at].astype(np.uint64)))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[times[which] > 1]
    change = np.zeros(len(found) + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + WINDOW, -1)
    repeated = _per_text(np.cumsum(change[:-1]) > 0, found.first)
    values = [found.counts(), chars, _per_text(_symbol[data], offsets), counted, dup, repeated]
    return pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], STATISTICS)


def _text_statistics(column: pa.Array) -> pa.Array:
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    parts = [_statistics(part.column("text")) for part in words.slices([batch], "text")]
    return pa.concat_arrays(parts) if parts else _statistics(column)


def add_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    counted = F.arrow_udf(_text_statistics, ", ".join(f"{name} long" for name in STATISTICS))
    result = pack(docs, _statistics=counted.asNondeterministic()(F.col(text)))
    return unpack(result, docs.columns, **{n: F.col("_statistics").getField(n) for n in STATISTICS})


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Ratios by which rules can decide at any length of text."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / n,
        "words_per_line": F.col("n_words") / lines,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: np.ndarray) -> np.ndarray:
        values = rows[:, FEATURES.index(self.feature)]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; the first that holds rejects, a text that meets none is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def column(self) -> Column:
        """Number of the first rule that holds, 0 for none."""
        chosen = F.lit(0)
        for i in range(len(self.rules), 0, -1):
            holds = F.lit(True)
            for condition in self.rules[i - 1]:
                holds = holds & condition.column()
            chosen = F.when(holds, i).otherwise(chosen)
        return chosen

    def __str__(self) -> str:
        return "\n".join(f"{i}: " + " and ".join(map(str, r)) for i, r in enumerate(self.rules, 1))


def covered(rule: list[Condition], rows: np.ndarray) -> np.ndarray:
    out = np.ones(len(rows), bool)
    for condition in rule:
        out &= condition.holds(rows)
    return out


def _candidates(rows: np.ndarray):
    for k, name in enumerate(FEATURES):
        values = np.unique(rows[:, k])
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) > THRESHOLDS:
            middle = np.unique(np.quantile(rows[:, k], np.linspace(0, 1, THRESHOLDS + 2)[1:-1]))
        for threshold in middle.tolist():
            yield Condition(name, True, threshold)
            yield Condition(name, False, threshold)


def _grow(rows: np.ndarray, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS and not bad.all():
        best, most = None, 0.0
        before = np.log2(bad.mean())
        for condition in _candidates(rows):
            holds = condition.holds(rows)
            hits = int((bad & holds).sum())
            if hits >= LEAST_ROWS:
                gain = hits * (np.log2(hits / holds.sum()) - before)
                if gain > most + 1e-9:
                    best, most = condition, gain
        if best is None:
            break
        holds = best.holds(rows)
        values = rows[:, FEATURES.index(best.feature)]
        upper = holds if best.above else ~holds
        gap = (values[~upper].max(), values[upper].min())  # both sides have rows, the gain is positive
        rule.append(Condition(best.feature, best.above, float(sum(gap) / 2)))
        rows, bad = rows[holds], bad[holds]
    return rule


def _worth(rule: list[Condition], rows: np.ndarray, bad: np.ndarray) -> tuple[float, int]:
    """Precision with one good row added, and the bad rows that the rule covers."""
    holds = covered(rule, rows)
    hits = int((holds & bad).sum())
    return hits / (holds.sum() + 1), hits


def learn_rules(rows: np.ndarray, bad: np.ndarray) -> DecisionList:
    """``rows``: one line of ``FEATURES`` per labelled text, ``bad``: whether it is of low quality."""
    found = DecisionList()
    rng = np.random.default_rng(11)
    while len(found.rules) < MAX_RULES and bad.sum() >= 2 * LEAST_ROWS and not bad.all():
        grows = rng.random(len(rows)) < 2 / 3
        if not bad[grows].any() or not bad[~grows].any():
            break
        rule = _grow(rows[grows], bad[grows])
        ends = [rule[:n] for n in range(1, len(rule) + 1)]
        if not ends:
            break
        rule = max(ends, key=lambda r: (*_worth(r, rows[~grows], bad[~grows]), -len(r)))
        precision, hits = _worth(rule, rows[~grows], bad[~grows])
        if hits < LEAST_ROWS or precision < LEAST_PRECISION * hits / (hits + 1):
            break
        found.rules.append(rule)
        left = ~covered(rule, rows)
        rows, bad = rows[left], bad[left]
    return found


def learn(stats: DataFrame, labels: DataFrame) -> DecisionList:
    """Rules from ``stats`` (doc_id and statistics) and ``labels`` (doc_id, quality 0 or 1)."""
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    joined = stats.join(marks, "doc_id").where(~base_failed()).dropDuplicates(["doc_id", *STATISTICS])
    total = joined.count()
    draw = F.pmod(F.xxhash64("doc_id", *STATISTICS), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(total, 1)))
    values = features()
    sample = joined.where(draw).select(*[values[f].alias(f) for f in FEATURES], (F.col("_quality") == 0).alias("bad"))
    sample = sample.toPandas().sort_values([*FEATURES, "bad"], ignore_index=True)
    return learn_rules(sample[FEATURES].to_numpy(float), sample["bad"].to_numpy(bool))


def judge(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """``stats`` with base_failed, rule (number of the rule that rejects, 0 for none) and kept."""
    judged = stats.withColumns({"base_failed": base_failed(), "rule": rules.column()})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


@query("op3_decision_list")
def op3_decision_list(spark, sf_dir):
    """Statistics of every document, judged by the base rules and by the rules learned from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = materialise(add_statistics(docs).select("doc_id", *STATISTICS))
    rules = learn(stats, table(spark, sf_dir, "labels"))
    return judge(stats, rules)
