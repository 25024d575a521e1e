"""Quality scores by logistic regression on hashed word n-grams.

Words and runs of punctuation are hashed, alone and in pairs, into a weight
vector of fixed size. All pairs of a word with itself share one place, so that
stuttering text is told by words never seen in training. A text's features are its n-gram counts divided by their
total, so a text's length plays no part. Training follows the regularised
leader: one update a training row, each weight with a rate of its own, and
weights that don't earn their keep stay exactly zero. Scoring is a sparse dot
product, the mean weight of a text's n-grams.

Training uses at most ``TRAINING_ROWS`` labelled rows (see ``labelled``) and
runs as one stream of batches in one task; the model, the weights other than
zero, is at most ``2 ** BITS`` numbers and is broadcast.

Defined results: null and empty texts have no n-grams and get the score of the
intercept; without any labelled row every score is 0.5; null ids and repeated
rows pass through; labels and all columns but the text are no input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import blocks, held_out, small_batches
from reelstar.llm.labelled import training_rows

TRAINING_ROWS = 16_000
BITS = 20
#: Feature values of a text sum up to this for each n-gram order.
SCALE = 32.0
#: Token hashes that a task remembers, and characters worked on at a time.
MEMORY = 200_000
CHARS = 1_000_000
#: Stands for every pair of a token with itself.
REPEATED = np.uint64(1)

_TOKEN = re.compile(r"\w+|[^\w\s]+")


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        h = self[token] = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return h


def features(texts: list[str | None], bits: int = BITS, known: _Hashes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of all texts, and how many each text has. ``known``
    are token hashes to go on with: a task's own, gone when it ends."""
    known = _Hashes() if known is None else known
    if len(known) > MEMORY:
        known.clear()
    found = [_TOKEN.findall(t or "") for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    one = np.fromiter((h for f in found for h in map(known.__getitem__, f)), np.uint64, int(sizes.sum()))
    shift = np.uint64(64 - bits)
    slots = np.empty(2 * len(one), np.int64)
    # token i of a text takes place 2i, the pair that it starts 2i + 1
    slots[0::2] = (one * np.uint64(0x9E3779B97F4A7C15)) >> shift
    pair = one.copy()
    pair[:-1] = one[:-1] * np.uint64(0xD6E8FEB86659FD93) + (one[1:] ^ (one[1:] >> np.uint64(29)))
    pair[:-1][one[:-1] == one[1:]] = REPEATED
    slots[1::2] = (pair * np.uint64(0xA0761D6478BD642F)) >> shift
    keep = np.ones(len(slots), bool)
    ends = np.cumsum(sizes)
    keep[2 * ends[sizes > 0] - 1] = False                     # a text's last token starts no pair
    return slots[keep], np.maximum(2 * sizes - 1, 0)


@dataclass
class Model:
    slots: np.ndarray
    weights: np.ndarray
    intercept: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float64)
        w[self.slots] = self.weights
        return w


class Ftrl:
    """Follow-the-regularised-leader updates for logistic loss."""

    def __init__(self, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.3, l2: float = 0.02):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << bits) + 1)                    # the last place is the intercept
        self.n = np.zeros((1 << bits) + 1)

    def weight(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == len(self.z) - 1, 0.0, self.l1)
        shrunk = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, shrunk)

    def update(self, slots: np.ndarray, y: int) -> None:
        at, count = np.unique(slots, return_counts=True)
        x = np.r_[count * (SCALE / max(1, len(slots))), 1.0]
        at = np.r_[at, len(self.z) - 1]
        w = self.weight(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows: int = TRAINING_ROWS,
        id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> Model:
    spark = docs.sparkSession
    small_batches(spark)
    # one stream in hash order: bounded by ``rows``, a batch in memory at a time
    train = (training_rows(docs, labels, label_col, rows, id_col, text_col)
             .repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id", F.xxhash64("_t")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, seen, known = Ftrl(bits), 0, _Hashes()
        for pdf in batches:
            texts, ys = pdf["_t"].tolist(), pdf["_y"].to_numpy()
            for a, b in blocks(texts, CHARS):
                slots, sizes = features(texts[a:b], bits, known)
                for own, y in zip(np.split(slots, np.cumsum(sizes)[:-1]), ys[a:b], strict=True):
                    model.update(own, int(y))
                    seen += 1
        if seen:
            at = np.arange(1 << bits)
            w = model.weight(at)
            at = np.flatnonzero(w)
            yield pd.DataFrame({"slots": [at.astype("<i8").tobytes()], "weights": [w[at].astype("<f8").tobytes()],
                                "intercept": model.weight(np.array([1 << bits]))})

    found = train.mapInPandas(run, "slots binary, weights binary, intercept double").collect()
    if not found:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, bits)
    m = found[0]
    return Model(np.frombuffer(bytes(m.slots), "<i8"), np.frombuffer(bytes(m.weights), "<f8"), m.intercept, bits)


def score_texts(texts: list[str | None], dense: np.ndarray, intercept: float, bits: int = BITS,
                known: _Hashes | None = None) -> np.ndarray:
    slots, sizes = features(texts, bits, known)
    total = np.r_[0.0, np.cumsum(dense[slots])]
    ends = np.cumsum(sizes)
    dot = (total[ends] - total[ends - sizes]) * SCALE / np.maximum(sizes, 1)
    return 1 / (1 + np.exp(-np.clip(dot + intercept, -35, 35)))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` in place of all
    columns but the id."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, known = shared.value, _Hashes()
        dense = m.dense()
        for pdf in batches:
            texts = pdf["_t"].tolist()
            out = np.zeros(len(texts))
            for a, b in blocks(texts, CHARS):
                out[a:b] = score_texts(texts[a:b], dense, m.intercept, m.bits, known)
            yield pd.DataFrame({"_id": pdf["_id"], "score": out})

    scored = (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
              .mapInPandas(run, f"_id {kind}, score double"))
    return scored.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that reach the threshold, all columns unchanged."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, _Hashes()
        dense = m.dense()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            good = np.zeros(len(texts), bool)
            for a, b in blocks(texts, CHARS):
                good[a:b] = score_texts(texts[a:b], dense, m.intercept, m.bits, known) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
