"""Quality of documents by a factorisation machine.

Features of a text: its words, hashed into buckets (the square root of a word's count over the text's norm), and its
structure and length statistics, each cut into ranges that are one feature each.  The score is the logistic of
w0 + sum w_f x_f + sum over pairs <v_f, v_g> x_f x_g; the pairs cost linear time, as half of
(sum v_f x_f)^2 - sum (v_f x_f)^2 in every one of the few dimensions.

Trained with AdaGrad on the driver, on at most ``sample`` labelled documents: those whose ids hash lowest, and of these
as many as have no more than ``most`` bytes of features together.  Only their features go there: no more than BUCKETS +
statistics entries each, whatever the length of the text.  Scoring is one narrow pass over whole texts.

Defined results: null, empty and blank texts have no words, only statistics, and get a score; rows with equal texts
get equal scores; a null doc_id is scored and never trained on; contradicting labels of one doc_id both count; without
any usable label every score is 0.5; an empty table gives an empty result; extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cosecha.llm import words as W
from cosecha.llm.work import fresh, saved

BUCKETS = 1 << 14
FACTORS = 8
SAMPLE = 6000
SAMPLE_BYTES = 256 << 20
BATCH = 64
STEPS = 1200  # batches; with few labels, each row comes round more often
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
BINS = 12

_CLASS = np.zeros((7, 256), np.float32)
_CLASS[0, 65:91] = 1  # upper case
_CLASS[1, 97:123] = 1  # lower case
_CLASS[2, 48:58] = 1  # digits
_CLASS[3, 128:] = 1  # beyond ASCII
_CLASS[4, [10, 13]] = 1  # line ends
_CLASS[5, [33, 44, 46, 58, 59, 63]] = 1  # punctuation of prose
_CLASS[6, [*range(35, 39), *range(40, 44), 47, 60, 61, 62, 64, *range(91, 97), *range(123, 127)]] = 1  # symbols


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(statistics from 0 to 1 by text, word buckets, their values, offsets by text) of a batch of texts."""
    hashes, bounds, starts, ends, data = W.word_hashes(column)
    n = len(column)
    _, offsets = W.text_buffer(column)
    sizes, counts = np.diff(offsets), np.diff(bounds)
    owner = np.repeat(np.arange(n), counts)
    per_word, per_byte = np.maximum(counts, 1), np.maximum(sizes, 1)

    def of_bytes(table: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.float64)
        np.cumsum(table[data], out=total[1:])
        return (total[offsets[1:]] - total[offsets[:-1]]) / per_byte

    def of_words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, n) / per_word

    key = owner * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
    slots, number = np.unique(key, return_counts=True)
    where = slots // BUCKETS
    exact = np.lexsort((hashes, owner))
    h, o = hashes[exact], owner[exact]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    run = np.diff(np.append(np.flatnonzero(fresh), len(h)))
    top = np.zeros(n)
    np.maximum.at(top, o[fresh], run)
    doubled = np.zeros(len(hashes))
    doubled[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    lengths = (ends - starts).astype(float)
    columns = [
        np.log1p(counts) / 12,
        np.log1p(sizes) / 16,
        np.bincount(owner, lengths, n) / per_word / 20,
        np.sqrt(np.maximum(np.bincount(owner, lengths**2, n) / per_word - (np.bincount(owner, lengths, n) / per_word) ** 2, 0)) / 10,
        of_words(lengths == 1),
        np.bincount(o[fresh], minlength=n) / per_word,
        top / per_word,
        of_words(doubled),
        of_words((_CLASS[6] > 0)[last]),
        of_words(last == 33),
        of_words(np.isin(last, [44, 46])),
        *(of_bytes(t) for t in _CLASS),
    ]
    value = np.sqrt(number)
    norm = np.sqrt(np.bincount(where, number, n))
    return np.clip(np.stack(columns, 1), 0, 1), slots % BUCKETS, value / norm[where], np.searchsorted(where, np.arange(n + 1))


N_STATISTICS = 11 + len(_CLASS)


@dataclass
class Machine:
    """w0, w and v of the model, and the inner edges of each statistic's ranges."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    edges: np.ndarray

    def features(self, stats: np.ndarray, slots: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature, value, text) triples."""
        n = len(stats)
        ranges = np.stack([np.searchsorted(e, stats[:, k], "right") for k, e in enumerate(self.edges)], 1)
        ranges = BUCKETS + np.arange(N_STATISTICS) * BINS + ranges
        feature = np.concatenate([slots, ranges.ravel()])
        value = np.concatenate([values, np.full(ranges.size, N_STATISTICS**-0.5)])
        text = np.concatenate([np.repeat(np.arange(n), np.diff(bounds)), np.repeat(np.arange(n), N_STATISTICS)])
        return feature, value, text

    def raw(self, feature: np.ndarray, value: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        out = self.bias + np.bincount(text, self.weights[feature] * value, n)
        sums = np.empty((n, FACTORS))
        for k in range(FACTORS):
            x = self.factors[feature, k] * value
            sums[:, k] = np.bincount(text, x, n)
            out += 0.5 * (sums[:, k] ** 2 - np.bincount(text, x * x, n))
        return out, sums

    def score(self, column: pa.Array) -> np.ndarray:
        stats, *words = statistics(column)
        return _logistic(self.raw(*self.features(stats, *words), len(column))[0])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.pieces(batch, "text"):
            stats, slots, values, bounds = statistics(part.column("text"))
            cut = lambda x, at: [x[a:b].astype(np.float32 if x.dtype.kind == "f" else np.int32).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            columns = [part.column("place"), part.column("label"), pa.array(cut(stats.ravel(), np.arange(len(part) + 1) * N_STATISTICS), pa.binary()), pa.array(cut(slots, bounds), pa.binary()), pa.array(cut(values, bounds), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "label", "stats", "slots", "vals"])


def fold(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, steps: int = STEPS, seed: int = 5, most: int = SAMPLE_BYTES) -> Machine:
    """Fits on at most ``sample`` labelled rows outside the held-out fold, those with the lowest hashes of their ids, and
    on at most ``most`` bytes of word features, in the same order."""
    chosen = labels.where("quality in (0, 1) and doc_id is not null").where(fold("doc_id") != HELD_OUT)
    chosen = chosen.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("label"), F.xxhash64("doc_id", "quality").alias("place"))
    chosen = F.broadcast(chosen.orderBy("place", "label_id").limit(sample))  # at most ``sample`` rows of three numbers
    labelled = docs.select("doc_id", "text").join(chosen, docs["doc_id"] == F.col("label_id")).select("place", "label", "text")
    rows = saved(labelled.mapInArrow(_sparse, "place long, label double, stats binary, slots binary, vals binary").withColumn("tie", F.xxhash64("slots", "vals")), "labelled")
    # at most ``sample`` rows of three numbers in order
    sizes = rows.select("place", "tie", (F.length("slots") + F.length("vals")).alias("bytes")).orderBy("place", "tie", "bytes").limit(sample)
    held = F.sum("bytes").over(Window.orderBy("place", "tie", "bytes").rowsBetween(Window.unboundedPreceding, 0))
    n = sizes.select(held.alias("held")).where(F.col("held") <= most).count()
    rows = rows.orderBy("place", "tie", "slots").limit(n).toArrow()
    n = len(rows)
    model = Machine(0.0, np.zeros(BUCKETS + N_STATISTICS * BINS), np.zeros((BUCKETS + N_STATISTICS * BINS, FACTORS)), np.zeros((N_STATISTICS, BINS - 1)))
    if not n:
        return model
    rng = np.random.Generator(np.random.PCG64(seed))
    y = rows.column("label").to_numpy()
    stats = np.stack([np.frombuffer(x, np.float32) for x in rows.column("stats").to_pylist()]).astype(float)
    model.edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    slots = [np.frombuffer(x, np.int32) for x in rows.column("slots").to_pylist()]
    values = [np.frombuffer(x, np.float32) for x in rows.column("vals").to_pylist()]
    model.bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    model.factors = rng.normal(0, 0.05, model.factors.shape)
    square_w, square_v = np.full(len(model.weights), 1e-2), np.full(model.factors.shape, 1e-2)
    for _ in range(-(-steps // -(-n // BATCH))):
        order = rng.permutation(n)
        for k in range(0, n, BATCH):
            own = order[k : k + BATCH]
            bounds = np.concatenate([[0], np.cumsum([len(slots[i]) for i in own])])
            f, x, t = model.features(stats[own], np.concatenate([slots[i] for i in own]), np.concatenate([values[i] for i in own]), bounds)
            out, sums = model.raw(f, x, t, len(own))
            miss = (_logistic(out) - y[own]) / len(own) ** 0.5
            model.bias -= 0.02 * miss.mean()
            used, at = np.unique(f, return_inverse=True)
            g = np.bincount(at, miss[t] * x) + 1e-4 * model.weights[used]
            square_w[used] += g * g
            model.weights[used] -= 0.1 * g / np.sqrt(square_w[used])
            for j in range(FACTORS):
                own_v = model.factors[f, j]
                g = np.bincount(at, miss[t] * x * (sums[t, j] - own_v * x)) + 1e-4 * model.factors[used, j]
                square_v[used, j] += g * g
                model.factors[used, j] -= 0.05 * g / np.sqrt(square_v[used, j])
    model.weights, model.factors = model.weights.astype(np.float32), model.factors.astype(np.float32)
    return model


def scored(docs: DataFrame, model: Machine, name: str = "quality_score") -> DataFrame:
    """``docs`` with the column ``name``; all other columns stay."""
    (text,) = fresh(docs, "quality_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, text):
                keep = [i for i, column in enumerate(part.schema.names) if column != text]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), pa.array(model.score(part.column(text)))], names=[*(part.schema.names[i] for i in keep), name])

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.withColumn(text, F.col("text")).mapInArrow(run, schema)


def op5(spark, sf_dir: str) -> DataFrame:
    """One row per document: fold, score and class."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    slim = docs.withColumn("held_out", fold("doc_id") == HELD_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "text"):
                score = model.score(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``."""
    (score,) = fresh(docs, "quality_score")
    return scored(docs, train(docs, labels), score).where(F.col(score) >= threshold).drop(score)
