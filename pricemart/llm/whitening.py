"""Embedding whitening: spectral divide-and-conquer on the covariance by polar decompositions (QDWH).

Spark sums up the vectors and, in a second pass, the products of their deviations; both sums are exact integers, so the
covariance doesn't depend on partitions.  The d x d matrix is split on the driver: the polar factor U of V - shift * I, by
dynamically weighted Halley steps, gives the spectral projector (U + I) / 2 of all eigenvalues above the shift; a
basis of its range and one of the complement are two invariant subspaces, and the blocks of V on them are split again until
each is one component (or diagonal).  The components, scaled by their eigenvalues, are broadcast, and each vector is whitened
where it lies.

Entries are fixed-point numbers: c becomes floor(scale * c) + shift, a long.

Defined cases: a null vector, a null or non-finite entry, an entry whose fixed-point number isn't a long, an empty vector and a
vector of another length than most (ties: the longer length) drop the row; repeated rows count as often as they are;
components whose eigenvalue is rounding noise (below d * 2^-50 of the largest) aren't returned, so equal vectors or a single one have
none; equal eigenvalues have any orthonormal basis of their space; null ids stay; an empty table has no rows.  The size of
what is collected and broadcast is d * d numbers (``MAX_DIM`` bounds d); a longer vector raises a ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import arrow_schema, fresh, staged

MAX_DIM = 2048
SCALE, SHIFT = 64, 1_000_000
LIMB = 40                       # bits of a limb of an exact sum
SMALL = 1 << 21                 # deviations below it: their products are summed exactly in double precision


# ---- exact sums

def _limbs(values: list[int]) -> list[list[int]]:
    """Whole numbers of any size as four limbs of 40 bits (the highest signed), so that tasks' sums are added as longs."""
    mask = (1 << LIMB) - 1
    return [*([(int(x) >> (LIMB * i)) & mask for x in values] for i in range(3)), [int(x) >> (3 * LIMB) for x in values]]


def _whole(limbs) -> int:
    return sum(int(x) << (LIMB * i) for i, x in enumerate(limbs))


def fixed_point(vectors: pa.Array, dim: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that count, their fixed-point entries): a boolean per row and a matrix of longs."""
    size = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    keep = size == dim
    rows = vectors.filter(pa.array(keep))
    flat = rows.flatten()
    c = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(scale * c)
        good = (np.abs(x) < 2.0 ** 61).all(1) if len(c) else np.zeros(0, bool)          # also false for NaN
    keep[keep] = good
    return keep, x[good].astype(np.int64) + shift


def _sum_rows(vectors: DataFrame, dim: int, scale: int, shift: int, centre: list[int] | None) -> dict:
    """Exact sums over all rows by (i, j): i = -1: of entry j (and j = -1: the number of rows); with ``centre`` also the
    products of entries i <= j, less the centre.  One row per pair and task is shuffled, whatever the rows."""
    low = np.array(centre if centre is not None else [0] * dim, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(dim)
        n, sums, products, big = 0, np.zeros(dim, object), np.zeros(len(upper[0]), np.int64), np.zeros(len(upper[0]), object)
        for batch in batches:
            _, x = fixed_point(batch.column(0), dim, scale, shift)
            n += len(x)
            y = x - low
            sums += y.astype(object).sum(0) if len(y) and np.abs(y).max() >= SMALL else y.sum(0).astype(object)
            if centre is None or not len(y):
                continue
            if np.abs(y).max() < SMALL:
                for i in range(0, len(y), 1024):                # 2^42 * 2^10 < 2^53: exact, also by BLAS
                    part = y[i:i + 1024].astype(np.float64)
                    products += (part.T @ part)[upper].astype(np.int64)
                    if np.abs(products).max() >= 1 << 61:
                        big, products = big + products.astype(object), np.zeros_like(products)
            else:
                wide = y.astype(object)
                big = big + (wide.T @ wide)[upper]
        if not n:
            return
        i = [-1] * (dim + 1) + (upper[0].tolist() if centre is not None else [])
        j = [-1, *range(dim)] + (upper[1].tolist() if centre is not None else [])
        values = [n, *sums] + ([*(big + products.astype(object))] if centre is not None else [])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(x, pa.int64()) for x in _limbs(values))],
                                         names=["i", "j", "a", "b", "c", "d"])

    parts = vectors.mapInArrow(run, "i int, j int, a long, b long, c long, d long")
    rows = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in "abcd"]).collect()          # d * d / 2 rows
    return {(r.i, r.j): _whole((r.a, r.b, r.c, r.d)) for r in rows}


class Fit(NamedTuple):
    n: int
    total: list[int]            # exact sum of every dimension
    covariance: np.ndarray
    values: np.ndarray          # eigenvalues, falling
    vectors: np.ndarray         # components as columns


def covariance(n: int, centre: list[int], sums: list[int], products: dict) -> np.ndarray:
    """The covariance with divisor n, each entry rounded once: sums are of entries less ``centre``."""
    d = len(sums)
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = (n * products[i, j] - sums[i] * sums[j]) / (n * n)          # whole numbers, one rounding
    return v


# ---- QDWH

def polar(a: np.ndarray, most: int = 60) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley steps."""
    d, eps = len(a), np.finfo(float).eps
    x = a / np.linalg.norm(a, "fro")
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x), "fro")               # not above the smallest singular value
    except np.linalg.LinAlgError:
        low = eps
    low = float(min(max(low, eps), 1.0)) if np.isfinite(low) else eps
    for _ in range(most):
        square = low * low
        weight = (4 * (1 - square) / (square * square)) ** (1 / 3)
        h = np.sqrt(1 + weight) + 0.5 * np.sqrt(max(8 - 4 * weight + 8 * (2 - square) / (square * np.sqrt(1 + weight)), 0.0))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(d)]))
        new = (b / c) * x + (h - b / c) / np.sqrt(c) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * square) / (1 + c * square))
        moved, x = np.linalg.norm(new - x, "fro"), new
        if moved < 1e-6 and 1 - low < 10 * eps:                         # convergence is cubic
            break
    return x


def _range(projector: np.ndarray, rank: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of its complement, by subspace iteration from random columns."""
    d = len(projector)
    start = np.random.default_rng(seed).standard_normal((d, d))
    basis, _ = np.linalg.qr(np.hstack([projector @ start[:, :rank], (np.eye(d) - projector) @ start[:, rank:]]))
    one, _ = np.linalg.qr(projector @ basis[:, :rank])
    rest = basis[:, rank:] - one @ (one.T @ basis[:, rank:])
    two, _ = np.linalg.qr(rest - projector @ rest)
    two, _ = np.linalg.qr(two - one @ (one.T @ two))
    return one, two


def spectrum(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; eigenvectors as columns) of a symmetric matrix, by spectral divide-and-conquer."""
    d = len(v)
    eps, out = np.finfo(float).eps, []
    noise = eps * (np.linalg.norm(v, "fro") if d else 0.0)
    work = [(np.eye(d), 0)] if d else []
    while work:
        basis, failed = work.pop()
        k = basis.shape[1]
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        if k == 1 or np.linalg.norm(block - np.diag(np.diag(block)), "fro") <= noise * 2 ** failed:
            out += [(block[i, i], basis[:, i]) for i in range(k)]
            continue
        # A shift between two entries of the diagonal lies inside the spectrum; wide gaps near the middle come first.
        diagonal = np.sort(np.diag(block))
        gaps = sorted(range(1, k), key=lambda i: (-(diagonal[i] - diagonal[i - 1]) * min(i, k - i), i))
        for i in gaps[:4]:
            shifted = block - (diagonal[i] + diagonal[i - 1]) / 2 * np.eye(k)
            u = polar(shifted)
            rank = int(round(float(np.trace(u) + k) / 2))
            if not 0 < rank < k:
                continue
            one, two = _range((u + np.eye(k)) / 2, rank, k)
            if np.linalg.norm(one.T @ block @ two, "fro") <= 16 * k * 2 ** failed * (noise + eps * np.linalg.norm(block, "fro")):
                work += [(basis @ one, 0), (basis @ two, 0)]
                break
        else:                                               # equal diagonals, or shifts at eigenvalues: mix and try again
            turn, _ = np.linalg.qr(np.random.default_rng(failed).standard_normal((k, k)))
            work.append((basis @ turn, failed + 1))
    order = sorted(range(d), key=lambda i: -out[i][0])
    values = np.array([out[i][0] for i in order])
    vectors = np.column_stack([out[i][1] for i in order]) if d else np.zeros((0, 0))
    return values, vectors


# ---- fit and whitening

def fit(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> Fit | None:
    """Mean, covariance and components of a frame of one array column; ``None`` if no row counts."""
    name = vectors.columns[0]
    lengths = (vectors.where(F.size(name) > 0).groupBy(F.size(name).alias("d")).agg(F.count("*").alias("n"))
               .orderBy(F.desc("n"), F.desc("d")).first())
    if lengths is None:
        return None
    dim = lengths.d
    if dim > MAX_DIM:
        raise ValueError(f"vectors of {dim} entries; at most {MAX_DIM}")
    first = _sum_rows(vectors, dim, scale, shift, None)
    if not first:
        return None
    n, total = first[-1, -1], [first[-1, j] for j in range(dim)]
    centre = [round(s / n) for s in total]                              # a whole number beside the mean: products stay small and exact
    second = _sum_rows(vectors, dim, scale, shift, centre)
    v = covariance(n, centre, [second[-1, j] for j in range(dim)], second)
    values, components = spectrum(v)
    real = int((values > max(values[0], 0) * dim * 2.0 ** -50).sum()) if values[0] > 0 else 0
    return Fit(n, total, v, values[:real], components[:, :real])


def whiten(rows: DataFrame, vec_col: str = "embedding", most: int = 32, scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, Fit | None]:
    """(``rows`` that count with ``whitened``, an array of up to ``most`` doubles, and ``deviation``, the exact sum of squares of
    n * x - S or null beyond a long; the fit).  Where ``rows`` has these names the new ones get underscores in front."""
    found = fit(rows.select(F.col(vec_col).cast("array<double>").alias("v")), scale, shift)
    names = fresh(rows, "whitened", "deviation")
    schema = arrow_schema(rows, [T.StructField(names[0], T.ArrayType(T.DoubleType())), T.StructField(names[1], T.LongType())])
    if found is None:
        return rows.sparkSession.createDataFrame([], schema), None
    n, dim = found.n, len(found.total)
    centre = np.array([s // n for s in found.total], np.int64)
    rest = np.array([(s - n * c) / n for s, c in zip(found.total, centre.tolist())])           # S / n = centre + rest, rest in [0, 1)
    left = [s - n * c for s, c in zip(found.total, centre.tolist())]
    by = found.vectors[:, :most] / np.sqrt(found.values[:most])
    at, n_in = rows.columns.index(vec_col), len(rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = fixed_point(batch.column(at).cast(pa.list_(pa.float64())), dim, scale, shift)
            part = batch.filter(pa.array(keep))
            y = x - centre
            w = (y - rest) @ by
            deviation = _deviations(y, n, left)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * by.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n_in)), lists, pa.array(deviation, pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema), found


def _deviations(y: np.ndarray, n: int, left: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * y - left)^2, exact; ``None`` beyond a long."""
    if not len(y):
        return []
    biggest = n * (int(np.abs(y).max()) + 1)
    if biggest * biggest * len(left) < 1 << 63:
        z = n * y - np.array(left, np.int64)
        return (z * z).sum(1).tolist()
    z = n * y.astype(object) - np.array(left, object)
    return [int(s) if s < 1 << 63 else None for s in (z * z).sum(1)]


def identity_error(whitened: DataFrame, column: str = "whitened") -> float | None:
    """The largest absolute entry of the covariance of ``column`` (divisor n, centred) minus the identity, from the rows."""
    w = whitened.select(F.col(column).alias("w"))

    def run(batches: Iterator[pa.RecordBatch], mean: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            part = x.sum(0) if mean is None else ((x - mean).T @ (x - mean)).ravel()
            n, total = n + len(x), part if total is None else total + part
        if n and len(total):
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(total), pa.int64()), pa.array(range(len(total)), pa.int32()), pa.array(total)],
                                             names=["n", "i", "s"])

    def summed(mean: np.ndarray | None) -> tuple[int, np.ndarray]:
        rows = (w.mapInArrow(lambda b: run(b, mean), "n long, i int, s double").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
                .orderBy("i").collect())                                # at most 32 * 32 rows
        return (rows[0].n if rows else 0), np.array([r.s for r in rows])

    n, s = summed(None)
    if not n:
        return None
    _, c = summed(s / n)
    return float(np.abs(c.reshape(len(s), len(s)) / n - np.eye(len(s))).max())


def report(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = 32) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each row and component."""
    spark = rows.sparkSession
    slim = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    white, found = whiten(slim, "v", most)
    if found is None:
        share, n, error = np.zeros(0), 0, None
    else:
        white = staged(spark, white.drop("v"), "whitened")
        n, error = found.n, identity_error(white)
        share = found.values[:most] / np.trace(found.covariance) if len(found.values) else np.zeros(0)
    explained = F.array(*[F.lit(float(x)) for x in share]) if len(share) else F.array().cast("array<double>")
    return (white.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("i", "whitened"))
            .select("vec_id", (F.col("i") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                    F.element_at(explained, F.col("i") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error")))
