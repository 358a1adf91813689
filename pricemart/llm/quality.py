"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Tokens are runs of letters and digits and runs of signs, hashed into ``BUCKETS`` buckets.  Each bucket has a sparse random
index vector; its context vector is the sum of the index vectors of its neighbours over the whole corpus.  Tasks sum
up a table of fixed size (``BUCKETS`` x ``DIM``), the tables are added slice by slice, and the result (a fixed size)
is broadcast.  A document is the weighted mean and spread of its tokens' vectors.  A network with one hidden layer is fitted
with numpy on a bounded sample of labelled rows (``SAMPLE``, about 20,000 rows of a few numbers each), and a temperature
fitted on a part of them kept aside calibrates its probabilities.

Defined cases: null and empty texts pool to zeros and get the network's answer to that; with no usable labels, or labels
of one kind only, every score is the smoothed share of label 1; of rows that repeat an id one is learnt (the smallest text
hash); repeated rows get equal scores; other columns are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import bounded_sample, chunks, fold, fresh, label_table, labelled_rows, map_text
from pricemart.llm.tokens import ALNUM_OR_SIGNS, SAME, mix, owners, words

BUCKETS = 1 << 15
DIM = 32
NONZERO = 4                 # entries of an index vector that are 1 or -1
REACH = 2                   # neighbours to either side
SLICE = 1024                # buckets that travel in one row
SAMPLE = 20_000             # labelled rows that a fit takes at most (in expectation)
HIDDEN = 32
FEATURES = 2 * DIM + 2


def _index() -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, BUCKETS * NONZERO + 1, dtype=np.uint64)).reshape(BUCKETS, NONZERO)
    return (x % np.uint64(DIM)).astype(np.int64), np.where(x >> np.uint64(63), 1.0, -1.0)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    w = words(texts, ALNUM_OR_SIGNS, SAME)
    return (w.hashes % np.uint64(BUCKETS)).astype(np.int64), w.offsets


def contexts(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the neighbours' index vectors for each bucket, flat; the last column counts the bucket's tokens."""
    dims, signs = _index()
    own = owners(offsets)
    at, add = [ids * (DIM + 1) + DIM], [np.ones(len(ids))]
    for gap in range(1, REACH + 1):
        near = own[gap:] == own[:-gap]
        a, b = ids[:-gap][near], ids[gap:][near]
        for x, y in ((a, b), (b, a)):
            at.append((x[:, None] * (DIM + 1) + dims[y]).ravel())
            add.append(signs[y].ravel())
    return np.bincount(np.concatenate(at), np.concatenate(add), BUCKETS * (DIM + 1))


def context_table(texts: DataFrame) -> np.ndarray:
    """Context sums of the whole corpus (BUCKETS x DIM, and the token counts).  ``texts`` has one column."""
    width = DIM + 1
    name = texts.columns[0]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * width)
        for batch in batches:
            for part in chunks(batch, name):
                ids, offsets = _tokens(part.column(0))
                if len(ids):
                    total += contexts(ids, offsets)
        for i in range(0, BUCKETS, SLICE):
            own = total[i * width:(i + SLICE) * width].astype(np.int64)
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // SLICE], pa.int32()), pa.array([zlib.compress(own.tobytes(), 1)])],
                                                 names=["slice", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(zlib.decompress(b), np.int64)
                have[i] = have[i] + x if i in have else x
        for i, x in have.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)])], names=["slice", "sums"])

    out = np.zeros((BUCKETS, width), np.int64)
    schema = "slice int, sums binary"
    for i, b in texts.mapInArrow(fill, schema).repartition("slice").mapInArrow(add, schema).toLocalIterator():
        out[i * SLICE:(i + 1) * SLICE] = np.frombuffer(zlib.decompress(b), np.int64).reshape(-1, width)
    return out


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Unit vectors of the buckets (their mean context, less the mean of all tokens) and, last, their weight a / (a + p)."""
    n = table[:, DIM].astype(np.float64)
    total = max(n.sum(), 1.0)
    v = table[:, :DIM] / np.maximum(n, 1.0)[:, None]
    v -= table[:, :DIM].sum(0) / total
    v[n == 0] = 0
    v /= np.maximum(np.sqrt((v * v).sum(1)), 1e-9)[:, None]
    return np.hstack([v, (1e-3 / (1e-3 + n / total))[:, None]]).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """(texts x FEATURES): weighted mean and spread of the vectors, length of the mean, log of the number of tokens."""
    ids, offsets = _tokens(texts)
    out = np.zeros((len(offsets) - 1, FEATURES), np.float32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        v = vectors[ids]
        w = v[:, DIM:]
        at = offsets[:-1][full]
        total = np.add.reduceat(w, at, axis=0)
        mean = np.add.reduceat(v[:, :DIM] * w, at, axis=0) / total
        spread = np.sqrt(np.maximum(np.add.reduceat(v[:, :DIM] ** 2 * w, at, axis=0) / total - mean ** 2, 0))
        out[full] = np.hstack([mean, spread, np.sqrt((mean ** 2).sum(1, keepdims=True)), np.log1p(np.diff(offsets)[full])[:, None]])
    return out


class Network:
    """Inputs -> HIDDEN rectified units -> probability of label 1, calibrated by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 60, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4):
        self.prior = (float(y.sum()) + 0.5) / (len(y) + 1.0)
        self.flat = len(np.unique(y)) < 2
        if self.flat:
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        aside = order[:max(1, len(y) // 5)] if len(y) >= 50 else order
        train = order[len(aside):] if len(y) >= 50 else order
        self.mid, self.scale = x[train].mean(0), x[train].std(0) + 1e-6
        x = self._scaled(x)
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(epochs):
            for i in range(0, len(train), batch):
                pick = rng.choice(train, min(batch, len(train)), replace=False) if i == 0 else train[i:i + batch]
                xb, yb = x[pick], y[pick]
                h = np.maximum(xb @ p[0] + p[1], 0)
                d = (1 / (1 + np.exp(-(h @ p[2] + p[3][0]))) - yb) / len(pick)
                back = np.outer(d, p[2]) * (h > 0)
                grads = [xb.T @ back + decay * p[0], back.sum(0), h.T @ d + decay * p[2], np.array([d.sum()])]
                step += 1
                for a, g, mm, ss in zip(p, grads, m, s):
                    mm += 0.1 * (g - mm)
                    ss += 0.001 * (g * g - ss)
                    a -= rate * (mm / (1 - 0.9 ** step)) / (np.sqrt(ss / (1 - 0.999 ** step)) + 1e-8)
            rng.shuffle(train)
        self.p, self.heat = p, 1.0
        z, t = self._logit(x[aside]), y[aside]
        heats = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, z / h) - t * z / h) for h in heats]
        self.heat = float(heats[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mid) / self.scale, -8, 8)

    def _logit(self, scaled: np.ndarray) -> np.ndarray:
        return np.maximum(scaled @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._logit(self._scaled(x.astype(np.float64))) / self.heat, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", learn: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors of all ``docs`` and the network fitted on the labels of the rows that ``learn`` (a condition on
    doc_id) allows."""
    spark = docs.sparkSession
    vectors = word_vectors(context_table(docs.select(F.col(text_col).alias("text"))))
    known = label_table(labels, label_col)
    known = bounded_sample(known.where(learn) if learn is not None else known, sample)
    rows = labelled_rows(docs, known, id_col, text_col)
    shared = spark.sparkContext.broadcast(vectors)

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.FixedSizeListArray.from_arrays(pa.array(pooled(texts, shared.value).ravel()), FEATURES).cast(pa.list_(pa.float32()))]

    found = map_text(rows, "text", [T.StructField("x", T.ArrayType(T.FloatType()))], run).select("doc_id", "label", "x").toArrow()
    order = np.argsort(found.column("doc_id").to_numpy(), kind="stable")      # the fit doesn't depend on the order of tasks
    x = np.array(found.column("x").to_pylist(), np.float64).reshape(-1, FEATURES)[order]
    return vectors, Network(x, found.column("label").to_numpy()[order].astype(np.float64))


def with_score(docs: DataFrame, model: tuple[np.ndarray, Network], name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 in the new column ``name`` (with underscores in front where ``docs`` has it)."""
    name, = fresh(docs, name)
    vectors, net = model
    shared = docs.sparkSession.sparkContext.broadcast(vectors)      # of a fixed size; the network is a few thousand numbers

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(net.score(pooled(texts, shared.value)).astype(np.float64))]

    return map_text(docs, text_col, [T.StructField(name, T.DoubleType())], run)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label_col: str = "quality", learn: Column | None = None) -> DataFrame:
    """``docs`` without the documents whose score is below ``threshold``; columns stay as they are."""
    name = fresh(docs, "_quality")[0]
    scored = with_score(docs, fit(docs, labels, label_col, learn), name)
    return scored.where(F.col(name) >= threshold).select(*docs.columns)


def held_out(id_col: str = "doc_id") -> Column:
    return fold(id_col, 5) == 0


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of each document; labels of held-out ids are not learnt."""
    slim = docs.select("doc_id", "text")
    scored = with_score(slim, fit(slim, labels, "quality", ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
