"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

A document's features are its words, pairs of neighbours and pairs with one word between, hashed into 2^``BITS`` columns
(present or not).  Each column has its own learning rate; the L1 penalty leaves most weights at 0, so the fitted
weights are a short list that is broadcast to score every text.  Learning goes document by document in one task over
a bounded sample of labelled rows (``SAMPLE``, about 20,000), in an order given by a hash; its state has a fixed size.
Every fifth row is kept aside to calibrate the probabilities (a line through the log odds).

Defined cases: null and empty texts have no features and get the bias alone; with no usable labels every score is 0.5, with
labels of one kind near that kind; fewer than 50 rows are not calibrated; of rows that repeat an id one is learnt (the smallest
text hash); repeated rows get equal scores; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import bounded_sample, chunks, fold, fresh, label_table, labelled_rows, map_text
from pricemart.llm.tokens import BASE, Words, mix, owners, words

BITS = 20
SAMPLE = 20_000
EPOCHS = 3
ALPHA, BETA, L1 = 3.0, 1.0, 4.0
#: places of the bias and of the calibration line after the columns
BIAS, SLOPE, SHIFT = range(1 << BITS, (1 << BITS) + 3)


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, column) of every word, pair and skip-pair of a chunk, with repeats."""
    own, h = owners(w.offsets), w.hashes
    text, col = [own], [mix(h + np.uint64(1))]
    for gap in (1, 2):
        same = own[gap:] == own[:-gap]
        text.append(own[gap:][same])
        col.append(mix(h[:-gap][same] * np.uint64(BASE) + h[gap:][same] + np.uint64(gap)))
    return np.concatenate(text), (np.concatenate(col) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal state: one (z, n) per column and one for the bias, which has no penalty."""

    def __init__(self):
        self.z, self.n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
        self.slope, self.shift = 1.0, 0.0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        penalty = L1 * (at != BIAS)
        w = (np.sign(z) * penalty - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA)
        return np.where(np.abs(z) <= penalty, 0.0, w)

    def odds(self, columns: np.ndarray) -> float:
        return float(self.weights(np.append(columns, BIAS)).sum())

    def learn(self, columns: np.ndarray, label: int) -> None:
        at = np.append(columns, BIAS)
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g

    def calibrate(self, z: np.ndarray, y: np.ndarray) -> None:
        """Newton steps for slope and shift of the log odds, held near 1 and 0."""
        z, v = np.clip(z, -30, 30), np.array([1.0, 0.0])
        x = np.stack([z, np.ones(len(z))])
        for _ in range(50):
            p = sigmoid(v @ x)
            v = v - np.linalg.solve((x * (p * (1 - p) + 1e-6)) @ x.T + 1e-3 * np.eye(2), x @ (p - y) + 1e-3 * (v - [1, 0]))
        if v[0] > 0:
            self.slope, self.shift = float(v[0]), float(v[1])

    def sparse(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.union1d(np.flatnonzero(np.abs(self.z) > L1), [BIAS])
        return np.append(at, [SLOPE, SHIFT]), np.append(self.weights(at), [self.slope, self.shift])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(examples: list[tuple[np.ndarray, int]]) -> Ftrl:
    model = Ftrl()
    aside = examples[::5] if len(examples) >= 50 else []
    learnt = [x for i, x in enumerate(examples) if i % 5] if aside else examples
    for _ in range(EPOCHS):
        for columns, label in learnt:
            model.learn(columns, label)
    if aside:
        model.calibrate(np.array([model.odds(c) for c, _ in aside]), np.array([y for _, y in aside]))
    return model


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", learn: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(columns, weights) other than 0, then bias, slope and shift, learnt from the labels that ``learn`` (a condition on doc_id) allows."""
    known = label_table(labels, label_col)
    known = bounded_sample(known.where(learn) if learn is not None else known, sample)
    rows = labelled_rows(docs, known, id_col, text_col)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct columns of each document."""
        for batch in batches:
            for part in chunks(batch, "text"):
                text, col = features(words(part.column(1)))
                both = np.unique(text * (1 << BITS) + col)
                ends = np.searchsorted(both, np.arange(1, part.num_rows + 1) * (1 << BITS))
                cols = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(both % (1 << BITS), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), cols], names=["doc_id", "label", "cols"])

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []                           # at most the sample: 4 bytes a feature
        for batch in batches:
            off = batch.column(2).offsets.to_numpy()
            flat = batch.column(2).values.to_numpy()
            examples += [(flat[a:b].copy(), y) for a, b, y in zip(off, off[1:], batch.column(1).to_pylist())]
        at, w = train(examples).sparse()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w)], names=["col", "weight"])

    kind = rows.schema["doc_id"].dataType
    hashed_rows = rows.select("doc_id", "text", "label").mapInArrow(
        hashed, T.StructType([T.StructField("doc_id", kind), T.StructField("label", T.IntegerType()), T.StructField("cols", T.ArrayType(T.IntegerType()))]))
    ordered = hashed_rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    found = ordered.mapInArrow(learnt, "col long, weight double").toArrow()
    if not found.num_rows:
        return np.array([BIAS, SLOPE, SHIFT]), np.array([0.0, 1.0, 0.0])
    return found.column("col").to_numpy(), found.column("weight").to_numpy()


def score(w: Words, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at, weight = model
    dense = np.zeros(SHIFT + 1)
    dense[at] = weight
    text, col = features(w)
    some = dense[col] != 0
    both = np.unique(text[some] * (1 << BITS) + col[some])
    z = np.bincount(both >> BITS, dense[both % (1 << BITS)], len(w.offsets) - 1) + dense[BIAS]
    return sigmoid(np.clip(z, -30, 30) * dense[SLOPE] + dense[SHIFT])


def with_score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 in the new column ``name`` (with underscores in front where ``docs`` has it)."""
    name, = fresh(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_text(docs, text_col, [T.StructField(name, T.DoubleType())],
                    lambda texts: [pa.array(score(words(texts), shared.value))])


def held_out(id_col: str = "doc_id") -> Column:
    return fold(id_col, 3) == 1


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of each document; labels of held-out ids are not learnt."""
    slim = docs.select("doc_id", "text")
    scored = with_score(slim, fit(slim, labels, "toxic", ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
