"""Periodic runs of words, by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at least
``least`` words and ``times`` periods.  On the plane of (word, lag) a run of period q and length L is a diagonal of L - q
matches at lag q.  The DP walks the words in order; each word's earlier occurrence increments the match length of the
active diagonal at that lag, and a diagonal that ends after enough matches emits its run at once.

Sparse: of a word's earlier occurrences only those can lie on a sufficient diagonal whose context agrees too.  A run of
period q holds at least 2q matches, so for a level g (16, 32, 64, ... words) and periods of (g/2, g] the g words from a
place on must recur at that lag; and within a run they recur at no shorter lag, since two periods of a stretch of that
length give a common shorter one.  So the *latest* earlier occurrence of the g words is the one to follow, one active
diagonal a level, whatever the number of occurrences of a frequent word.  n words cost n log n, not n times the
frequency.  The g words of a place are named exactly by pairs of names of half their length.

All texts of a chunk are walked together with numpy; a level only holds the texts long enough for its periods.

Defined cases: null, empty and white-space texts have no words and no runs; a text is one row and its memory grows with
its own length only; ties and repeated rows are rows like others; words are told apart by 64-bit hashes, and every
run found is compared word by word, byte by byte, before it counts.
"""

from __future__ import annotations

import hashlib
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import chunks, fresh, map_text
from pricemart.llm.tokens import NON_SPACE, SAME, ngrams, words

LEAST = 24              # words of a run
TIMES = 3               # periods of a run
LEVEL = 16              # words of context on the first level


class Runs(NamedTuple):
    text: np.ndarray    # the text of each run
    start: np.ndarray   # its first word, counted in the text
    length: np.ndarray
    period: np.ndarray


def _names(keys: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers from 0 on."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _lags(names: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How far back the latest earlier place of the same name lies (0: none); ``place`` ascends."""
    order = np.sort(names * (int(place[-1]) + 1) + place)       # by name, then place
    name, at = np.divmod(order, int(place[-1]) + 1)
    back = np.zeros(int(place[-1]) + 1, np.int64)
    same = name[1:] == name[:-1]
    back[at[1:][same]] = (at[1:] - at[:-1])[same]
    return back[place]


def find(hashes: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> Runs:
    """The runs of every text; text i has the words ``hashes[offsets[i]:offsets[i + 1]]``."""
    if least < LEVEL + LEVEL // 2 or times < 3:
        raise ValueError("runs have at least 24 words and 3 periods")
    found: list[tuple[np.ndarray, ...]] = []
    first, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    text = np.flatnonzero(end - first >= least)
    g = LEVEL
    names = place = None
    while len(text):
        # places whose g words lie inside their text; texts too short for periods above g / 2 are left out
        count = end[text] - first[text] - g + 1
        ends = np.cumsum(count)
        new = np.arange(int(ends[-1])) - np.repeat(ends - count, count) + np.repeat(first[text], count)
        owner = np.repeat(text, count)
        if names is None:
            # texts are apart: their number is part of the name
            names = _names(ngrams(hashes, g)[new] + np.uint64(0x9E3779B97F4A7C15) * owner.astype(np.uint64))
        else:
            by_place = np.zeros(int(place[-1]) + 1, np.int64)
            by_place[place] = names
            names = _names(by_place[new] * len(place) + by_place[new + g // 2])
        place = new
        lag = _lags(names, place)
        # diagonals: neighbours at one lag, in one text
        edge = np.ones(len(place) + 1, bool)
        edge[1:-1] = (lag[1:] != lag[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(edge)
        a, b = at[:-1], at[1:] - 1
        q = lag[a]
        start, length = place[a] - q, place[b] - place[a] + g + q
        good = (q > (g // 2 if g > LEVEL else 0)) & (q <= g) & (length >= np.maximum(least, times * q))
        found.append((owner[a][good], start[good], length[good], q[good]))
        g *= 2
        # the next level looks for periods above g / 2: a text holds ``times`` of them
        text = text[end[text] - first[text] >= np.maximum(times * (g // 2 + 1), g)]
    if not found:
        z = np.zeros(0, np.int64)
        return Runs(z, z, z, z)
    owner, start, length, period = (np.concatenate([f[i] for f in found]) for i in range(4))
    order = np.lexsort((period, start))
    owner, start, length, period = owner[order], start[order], length[order], period[order]
    return Runs(owner, start - first[owner], length, period)


def best(start: list[int], length: list[int], period: list[int]) -> int | None:
    """The run of the greatest length / period, compared exactly; ties: smallest start, then period."""
    top = None
    for i in range(len(start)):
        if top is not None:
            left, right = length[i] * period[top], length[top] * period[i]
            if left < right or left == right and (start[i], period[i]) >= (start[top], period[top]):
                continue
        top = i
    return top


def text_words(texts: pa.Array) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text (bytes), and the hashes and offsets of all."""
    w = words(texts, NON_SPACE, SAME)
    raw, at = w.data.tobytes(), np.concatenate([[0], np.cumsum(_sizes(texts))])
    return [raw[a:b].split() for a, b in zip(at[:-1].tolist(), at[1:].tolist())], w.hashes, w.offsets


def _sizes(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def verified(ws: list[bytes], start: list[int], length: list[int], period: list[int]) -> list[int]:
    """The numbers of the runs that hold on the words themselves."""
    return [i for i in range(len(start))
            if ws[start[i]:start[i] + length[i] - period[i]] == ws[start[i] + period[i]:start[i] + length[i]]]


def _collapse(ws: list[bytes], start: list[int], length: list[int], period: list[int]) -> list[bytes]:
    """The words that no run holds after its first period."""
    out, at = [], 0
    for a, b in sorted((s + q, s + n) for s, n, q in zip(start, length, period)):
        if a > at:
            out += ws[at:a]
        at = max(at, b)
    return out + ws[at:]


NAMES = ("n_words", "runs", "best", "collapsed")
TYPES = (T.LongType(), T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])),
         T.IntegerType(), T.StringType())
_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _columns(texts: pa.Array, change=None, least: int = LEAST, times: int = TIMES) -> list[pa.Array]:
    lists, hashes, offsets = text_words(texts)
    if change is not None:
        pick = [change(i, len(ws)) for i, ws in enumerate(lists)]
        lists = [ws if p is None else [ws[j] for j in p.tolist()] for ws, p in zip(lists, pick)]
        hashes = np.concatenate([hashes[a:b] if p is None else hashes[a:b][p]
                                 for a, b, p in zip(offsets[:-1].tolist(), offsets[1:].tolist(), pick)] or [hashes])
    found = find(hashes, offsets, least, times)
    at = np.searchsorted(found.text, np.arange(len(lists) + 1))
    runs, top, short = [], [], []
    for i, ws in enumerate(lists):
        mine = slice(at[i], at[i + 1])
        s, n, q = found.start[mine].tolist(), found.length[mine].tolist(), found.period[mine].tolist()
        sure = verified(ws, s, n, q)
        s, n, q = [s[j] for j in sure], [n[j] for j in sure], [q[j] for j in sure]
        runs.append([{"start": x, "length": y, "period": z} for x, y, z in zip(s, n, q)])
        top.append(best(s, n, q))
        short.append(b" ".join(_collapse(ws, s, n, q) if s else ws).decode())
    return [pa.array([len(ws) for ws in lists], pa.int64()), pa.array(runs, _RUN), pa.array(top, pa.int32()), pa.array(short, pa.string())]


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period by start and period), best (the place in ``runs`` of the
    run of the greatest length / period) and collapsed (the words outside repetitions, joined by a space).

    Where ``docs`` has one of these names, the new column's name gets underscores in front."""
    fields = [T.StructField(n, t) for n, t in zip(fresh(docs, *NAMES), TYPES)]
    return map_text(docs, text_col, fields, lambda texts: _columns(texts, None, least, times))


def collapse(docs: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with each run cut to its first period in ``text_col``; texts without runs and all columns stay as they are."""
    def cut(texts: pa.Array) -> list[pa.Array]:
        _, runs, _, short = _columns(texts, None, least, times)
        return [pa.array([s if r else None for s, r in zip(short.to_pylist(), runs.to_pylist())], pa.string())]

    new, = fresh(docs, "_short")
    done = map_text(docs, text_col, [T.StructField(new, T.StringType())], cut)
    return done.select(*[(F.coalesce(new, c) if c == text_col else F.col(c)).alias(c) for c in docs.columns])


def periodic_places(doc_id, n: int) -> np.ndarray | None:
    """The query's change of some documents (one in ten, by their id; null: none): the words whose copies make them
    periodic."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_runs, the best run (start, length, period, exponent_milli), runs_sha256 and collapsed_sha256 of each document."""
    schema = T.StructType([docs.schema[id_col], *[T.StructField(n, T.LongType()) for n in
                           ("n_runs", "start", "length", "period", "exponent_milli")],
                           T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType())])
    slim = docs.select(F.col(id_col), F.col(text_col).alias("_text"))

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "_text"):
                ids = part.column(0).to_pylist()
                _, runs, top, short = _columns(part.column(1), lambda i, n: periodic_places(ids[i], n))
                runs, top = runs.to_pylist(), top.to_pylist()
                best_run = [r[t] if t is not None else None for r, t in zip(runs, top)]
                cols = [pa.array([len(r) for r in runs], pa.int64())]
                cols += [pa.array([b and b[k] for b in best_run], pa.int64()) for k in ("start", "length", "period")]
                cols.append(pa.array([b and 1000 * b["length"] // b["period"] for b in best_run], pa.int64()))
                lines = ("".join(f"{x['start']},{x['length']},{x['period']}\n" for x in r) for r in runs)
                cols.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines], pa.string()))
                cols.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in short.to_pylist()], pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=schema.names)

    return slim.mapInArrow(run, schema)
