"""Language identification by averaged hashed subword embeddings under a linear softmax.

A text is lower-cased; its subwords are the runs of three and four bytes of words, with one separator allowed at either
end. Each is hashed to one of ``BUCKETS`` embeddings; their mean goes through a linear softmax. Both are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled texts, drawn by a hash: about
``PER_LANGUAGE`` different ones of each language, or all there are, and ``SAMPLE`` in all, which many languages share
evenly. Every labelled language is a class. Of a long text, ``TEXT_BUCKETS`` of its buckets are taken, drawn by a hash too, so
the sample has at most ``SAMPLE * TEXT_BUCKETS`` numbers. A fifth of it is kept out of the training to fit a
temperature, so that scores are probabilities, and a threshold below which a prediction is rejected: the score that all but
``LOST`` of its correctly named texts reach.

For prediction, embeddings and softmax are multiplied out, so a subword costs one table row. Every whole text is
read, very long ones as batches of their own; the score of a text depends on its text alone.

Defined results: a null text or one without letters is ``und`` with score 0 and rejected, as is every text where no
labelled text exists to learn from; a text whose letters give no subword gets the classes' prior; a null id counts as
empty text in the split; equal rows get equal results; an empty table gives an empty one. Other columns are kept, whatever
their names; columns of the names that are added are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phonolake.llm import words
from phonolake.llm.columns import pack, unpack
from phonolake.llm.registry import query, table

BUCKETS = 1 << 15
DIMENSION = 16
PER_LANGUAGE = 600
SAMPLE = 20_000
TEXT_BUCKETS = 4096
EPOCHS = 5
RATE = 0.1
BATCH = 32
LOST = 0.001
ROUNDING = 1e-6
UNKNOWN = "und"

_letters = np.zeros(256, bool)
_letters[97:123] = True
_letters[128:] = True


def subwords(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of all texts, and where each text's buckets start (one more at the end)."""
    data, offsets = words.raw(column)
    data = words.LOWER.fold[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[upper] += 0x20  # accented capitals
    data[~_letters[data]] = 0x20
    data = np.insert(data, offsets, 0x20)
    edges = offsets + np.arange(len(offsets))
    inside = data != 0x20
    triple = np.flatnonzero(inside[1:-1])  # the middle is a letter
    wide = data.astype(np.uint32)
    pair = wide[:-1] | (wide[1:] << np.uint32(8))
    three = pair[triple] | (wide[triple + 2] << np.uint32(16))
    quad = triple[:-1][(triple[1:] == triple[:-1] + 1)]  # two letters in the middle
    four = pair[quad] | (pair[quad + 2] << np.uint32(16))
    at = np.concatenate([triple, quad])
    order = np.argsort(at, kind="stable")
    grams = np.concatenate([_bucket(three, 0x9E3779B1), _bucket(four, 0x85EBCA6B)])[order]
    return grams, np.searchsorted(at[order], edges)


def _bucket(grams: np.ndarray, factor: int) -> np.ndarray:
    mixed = grams * np.uint32(factor)
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - 15)).astype(np.int32)


def has_letters(column: pa.Array) -> np.ndarray:
    """Whether a text has a letter: by its ASCII letters, and by its characters only where it has none."""
    data, offsets = words.raw(column)
    folded = words.LOWER.fold[data]
    seen = np.concatenate([[0], np.cumsum((folded >= 97) & (folded <= 122))])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(c.isalpha() for c in column[i].as_py() or "")
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # per bucket its share of the scores
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        scores = (means + self.bias) / self.temperature
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)

    def means(self, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean table row of each text."""
        counts = np.diff(first)
        sums = np.zeros((len(counts), len(self.languages)))
        filled = counts > 0
        if filled.any():
            for k in range(len(self.languages)):
                picked = np.ascontiguousarray(self.table[:, k])[grams]
                sums[filled, k] = np.add.reduceat(picked, first[:-1][filled], dtype=np.float64)
        return sums / np.maximum(counts, 1)[:, None]


def fit(texts: list[tuple[str, np.ndarray, np.ndarray, bool]]) -> Model | None:
    """Model from (language, buckets, weights that sum to 1, whether kept for calibration)."""
    languages = sorted({t[0] for t in texts})
    if not languages:
        return None
    label = np.array([languages.index(t[0]) for t in texts])
    kept = np.array([t[3] for t in texts])
    training = np.flatnonzero(~kept) if (~kept).any() else np.arange(len(texts))
    rng = np.random.default_rng(5)
    embed = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION))
    embed_grad = np.full(BUCKETS, 1e-8)
    top, bias = np.zeros((DIMENSION, len(languages))), np.zeros(len(languages))
    top_grad, bias_grad = np.full_like(top, 1e-8), np.full_like(bias, 1e-8)
    for _ in range(EPOCHS):
        order = rng.permutation(training)
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            grams = np.concatenate([texts[i][1] for i in part])
            weight = np.concatenate([texts[i][2] for i in part])[:, None]
            sizes = np.array([len(texts[i][1]) for i in part])
            first = np.cumsum(sizes) - sizes
            hidden = np.add.reduceat(embed[grams] * weight, first, axis=0)
            scores = hidden @ top + bias
            scores = np.exp(scores - scores.max(1, keepdims=True))
            error = scores / scores.sum(1, keepdims=True)
            error[np.arange(len(part)), label[part]] -= 1
            back = np.repeat(error @ top.T, sizes, axis=0) * weight
            by = np.argsort(grams, kind="stable")
            firsts = np.flatnonzero(np.diff(grams[by], prepend=-1))
            step, rows = np.add.reduceat(back[by], firsts, axis=0), grams[by][firsts]
            embed_grad[rows] += (step**2).mean(1)
            embed[rows] -= RATE * step / np.sqrt(embed_grad[rows])[:, None]
            slope = hidden.T @ error
            top_grad += slope**2
            top -= RATE * slope / np.sqrt(top_grad)
            bias_grad += error.sum(0) ** 2
            bias -= 0.1 * RATE * error.sum(0) / np.sqrt(bias_grad)
    model = Model(languages, (embed @ top).astype(np.float32), bias)
    held = np.flatnonzero(kept) if kept.any() else training
    return _calibrated(model, [texts[i] for i in held], label[held])


def _calibrated(model: Model, texts: list, label: np.ndarray) -> Model:
    means = np.stack([t[2] @ model.table[t[1]] for t in texts])
    rows = np.arange(len(texts))

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(np.maximum(model.probabilities(means)[rows, label], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.2, 20, 41), key=loss))
    found = model.probabilities(means)
    right = found.argmax(1) == label
    if right.any():
        model.threshold = float(np.quantile(found.max(1)[right], LOST)) - ROUNDING
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


SAMPLE_ROW = "lang string, keep boolean, grams binary, weights binary"


def _features(batches):
    for batch in words.slices(batches, "text"):
        grams, first = subwords(batch.column("text"))
        for i, (lang, keep) in enumerate(zip(batch["lang"].to_pylist(), batch["keep"].to_pylist(), strict=True)):
            rows, counts = np.unique(grams[first[i] : first[i + 1]], return_counts=True)
            if len(rows) > TEXT_BUCKETS:
                drawn = np.sort(np.argsort(rows.astype(np.uint32) * np.uint32(0x9E3779B1), kind="stable")[:TEXT_BUCKETS])
                rows, counts = rows[drawn], counts[drawn]
            if len(rows):
                weights = (counts / counts.sum()).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([keep]), pa.array([rows.tobytes()], pa.binary()),
                     pa.array([weights.tobytes()], pa.binary())],
                    ["lang", "keep", "grams", "weights"],
                )


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Model of the rows with text and language. What reaches the driver is the bounded sample's bucket counts."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    different = rows.select("lang", F.xxhash64("text").alias("copy"), draw.alias("draw")).distinct()
    counts = different.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect()
    if not counts:
        return None
    most = min(PER_LANGUAGE, max(1, SAMPLE // len(counts)))
    # One text of each language at least: the one drawn first.
    shares = {r["lang"]: max(min(1.0, most / r["n"]), r["least"]) for r in counts}
    shares = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    sample = rows.where(draw <= F.coalesce(F.element_at(shares, F.col("lang")), F.lit(-1.0)))
    # Languages of few texts learn from all of them.
    many = F.col("lang").isin([r["lang"] for r in counts if r["n"] >= 5])
    keep = many & (F.pmod(F.xxhash64("text", F.lit(1)), F.lit(5)) == 0)
    # Equal texts are drawn together, so one of each is taken; copies are combined before they move.
    sample = sample.dropDuplicates(["lang", "text"])
    found = sample.select("text", "lang", keep.alias("keep")).mapInArrow(_features, SAMPLE_ROW).collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["grams"]), bytes(r["weights"])))
    return fit(
        [(r["lang"], np.frombuffer(r["grams"], np.int32), np.frombuffer(r["weights"], np.float32), r["keep"]) for r in found]
    )


RESULT = "lang_pred string, score double, rejected boolean"
_RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def _predict(model: Model | None, column: pa.Array) -> pa.Array:
    known = has_letters(column)
    if model is None:
        known[:] = False
    names, scores = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
    if known.any():
        chances = model.probabilities(model.means(*subwords(column)))
        best = chances.argmax(1)
        names[known] = np.array(model.languages, object)[best[known]]
        scores[known] = np.minimum(chances.max(1)[known], 1.0)
    rejected = ~known | (scores < (model.threshold if model else 0))
    arrays = [pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)]
    return pa.StructArray.from_arrays(arrays, fields=list(_RESULT))


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected. The model is ``BUCKETS`` numbers for each language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def found(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [_predict(shared.value, part.column("text")) for part in words.slices([batch], "text")]
        return pa.concat_arrays(parts) if parts else pa.array([], _RESULT)

    result = pack(docs, _found=found.asNondeterministic()(F.col(text)))  # else a filter runs it again
    return unpack(result, docs.columns, **{f.name: F.col("_found").getField(f.name) for f in _RESULT})


@query("op5_subword_language")
def op5_subword_language(spark, sf_dir):
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out")))
    return predict(docs.select("doc_id", "held_out", "text"), model).drop("text")
