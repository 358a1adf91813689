"""Repeated passages by sparse suffix arrays.

Words are runs of non-space characters.  A suffix is kept where the hash of its first ``KEY`` words is the smallest of some
window of ``length - KEY + 1`` neighbours, so every passage of ``length`` words holds a kept suffix, and equal passages hold
the same ones.  The kept suffixes of the corpus are sorted (a range shuffle) and neighbours compared: equal keys
mark candidates.  Candidates are then extended: around each one every stretch of ``length`` words to its left and right
that holds it is hashed, the stretches are sorted in the same way, and neighbours that are equal are repeated passages.
Overlapping ones are joined to spans as long as they reach.

The sort key ends with document and position, so a key that a third of all suffixes share is dealt to many tasks; groups
that lie across two partitions are settled from the partitions' first and last rows.

Defined cases: null texts and texts of fewer than ``length`` words have no passages; a passage counts as repeated at any two
places, also of one document; the first place is the smallest (id, text hash, position), null ids first; rows that agree in id and text
repeat each other and share one entry; an empty table gives no rows.  Keys and stretches are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import chunks, fresh, staged
from pricemart.llm.tokens import NON_SPACE, SAME, Words, ngrams, owners, starts_inside, words

LENGTH = 50                 # words of a passage
KEY = 16                    # words of a suffix that its key covers


def _running(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over n neighbours from each position on; shorter by n - 1."""
    size = 1
    while size * 2 <= n:
        x = pick(x[:-size], x[size:])
        size *= 2
    return x if size == n else pick(x[:len(x) - (n - size)], x[n - size:])


def kept_suffixes(w: Words, length: int = LENGTH, key: int = KEY) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys) of the suffixes at minimisers; positions run over all words of the chunk."""
    whole = starts_inside(w.offsets, length)            # starts of stretches that lie in one text
    if not whole.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = ngrams(w.hashes, key)
    span = length - key + 1
    low = np.where(whole, _running(h, span, np.minimum), np.uint64(0))
    pad = np.zeros(span - 1, np.uint64)
    best = _running(np.concatenate([pad, low, pad]), span, np.maximum)      # over the stretches that hold a position
    at = np.flatnonzero((best == h) & starts_inside(w.offsets, key) & (best > 0))
    return at, h[at]


def repeated(rows: DataFrame) -> DataFrame:
    """The rows (h, doc_id, text_hash, pos) whose h is there twice or more, with ``later``: it isn't the first of them."""
    spark = rows.sparkSession
    order = ["h", "doc_id", "text_hash", "pos"]
    rows = staged(spark, rows.select(*order), "suffixes")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.BooleanType()) for n in ("later", "twin", "edge"))])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """later: equal to the row before; twin: equal to a neighbour; edge: first or last row of the partition."""
        held, before, begun = None, None, False

        def out(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch | None:
            """``batch`` but for its last row, unless it is the end; ``before`` is the h in front of it."""
            h = batch.column(0).to_numpy()
            same = h[1:] == h[:-1]
            later = np.concatenate([[before is not None and h[0] == before], same])
            twin = later | np.concatenate([same, [False]])
            edge = np.zeros(len(h), bool)
            edge[0] = not begun
            edge[-1] |= last
            keep = np.flatnonzero(twin | edge)
            if not last:
                keep = keep[keep < len(h) - 1]
            if not len(keep):
                return None
            part = batch.take(pa.array(keep))
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(later[keep]), pa.array(twin[keep]), pa.array(edge[keep])], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            made = out(both, False)
            if made is not None:
                yield made
            if both.num_rows > 1:
                before, begun = both.column(0)[both.num_rows - 2].as_py(), True
            held = both.slice(both.num_rows - 1)
        if held is not None:
            made = out(held, True)
            if made is not None:
                yield made

    found = staged(spark, ordered.mapInArrow(compare, schema), "neighbours")
    inner = found.where("twin and not edge").select(*order, "later")
    edges = found.where("edge")                         # two rows of each partition at most
    group = edges.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_hash", "pos")).alias("low"))
    here = F.struct("doc_id", "text_hash", "pos")
    outer = (edges.join(group, "h").where(F.col("twin") | (F.col("n") > 1))
             .select(*order, (F.col("later") | (here > F.col("low"))).alias("later")))
    return inner.unionByName(outer)


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, key: int = KEY) -> DataFrame:
    """One row per document with repeated passages: doc_id, text_hash, spans (array of (start word, words)) and later_spans, what
    of them isn't a first occurrence."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    fields = [T.StructField("h", T.LongType()), slim.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("pos", T.LongType())]
    row = T.StructType(fields)

    def emit(part: pa.RecordBatch, w: Words, at: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        own = owners(w.offsets)[at]
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), part.column(0).take(pa.array(own)), part.column(1).take(pa.array(own)),
                                           pa.array(at - w.offsets[own], pa.int64())], names=row.names)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                w = words(part.column(2), NON_SPACE, SAME)
                at, h = kept_suffixes(w, length, key)
                if len(at):
                    yield emit(part, w, at, h)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every stretch of ``length`` words that holds a candidate."""
        for batch in batches:
            for part in chunks(batch, "text"):
                w = words(part.column(2), NON_SPACE, SAME)
                held = part.column(3)
                at = held.values.to_numpy()[held.offsets[0].as_py():held.offsets[-1].as_py()] + np.repeat(
                    w.offsets[:-1], np.diff(held.offsets.to_numpy()))
                whole = starts_inside(w.offsets, length)
                step = np.zeros(len(w.hashes) + 1, np.int64)
                np.add.at(step, np.maximum(at - (length - key), 0), 1)
                np.add.at(step, at + 1, -1)
                near = np.flatnonzero((np.cumsum(step)[:len(whole)] > 0) & whole)
                if len(near):
                    yield emit(part, w, near, ngrams(w.hashes, length)[near])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(starts: list[int]) -> list[tuple[int, int]]:
            out: list[list[int]] = []
            for s in sorted(starts):
                if out and s <= out[-1][1]:
                    out[-1][1] = s + length
                else:
                    out.append([s, s + length])
            return [(a, b - a) for a, b in out]

        kind = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))
        for batch in batches:
            cols = [pa.array([[{"start": a, "n": n} for a, n in joined(x)] for x in batch.column(i).to_pylist()], kind) for i in (2, 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["doc_id", "text_hash", "spans", "later_spans"])

    candidates = repeated(slim.mapInArrow(suffixes, row))
    by_doc = candidates.groupBy("doc_id", "text_hash").agg(F.collect_list("pos").alias("at")).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.array_sort(F.array_distinct("at")).alias("at"))
    holders = slim.join(by_doc, slim["doc_id"].eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t"))).select("doc_id", "text_hash", "text", "at")
    found = repeated(holders.mapInArrow(stretches, row))
    by_doc = found.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("all"), F.collect_set(F.when(F.col("later"), F.col("pos"))).alias("some"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("n", T.LongType())]))
    return by_doc.mapInArrow(spans, T.StructType([slim.schema["doc_id"], T.StructField("text_hash", T.LongType()),
                                                  T.StructField("spans", span), T.StructField("later_spans", span)]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the later occurrences of repeated passages cut from their texts; columns stay as they are."""
    i, h, cut, d, t = fresh(docs, "_i", "_h", "_cut", "_d", "_t")
    found = passages(docs, id_col, text_col, length).select(F.col("doc_id").alias(d), F.col("text_hash").alias(t), F.col("later_spans").alias(cut))
    rows = docs.withColumns({i: F.col(id_col), h: F.xxhash64(F.col(text_col))})
    both = rows.join(found, F.col(i).eqNullSafe(F.col(d)) & (F.col(h) == F.col(t)), "left").select(*docs.columns, cut)
    names = docs.columns
    place, n_in = names.index(text_col), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                texts = part.column(place).to_pylist()
                w = words(part.column(place), NON_SPACE, SAME)
                sizes = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in texts])])
                for r, gone in enumerate(part.column(n_in).to_pylist()):
                    if gone:
                        base, at, out = int(w.offsets[r]), int(sizes[r]), []
                        for s in gone:
                            out.append(w.data[at:w.starts[base + s["start"]]].tobytes())
                            at = int(w.ends[base + s["start"] + s["n"] - 1])
                        texts[r] = b"".join([*out, w.data[at:sizes[r + 1]].tobytes()]).decode()
                cols = [part.column(c) if c != place else pa.array(texts, pa.string()) for c in range(n_in)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return both.mapInArrow(run, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_spans, n_repeated, n_later (words in all spans, and in those that aren't first occurrences) and spans as text
    ("start+words") of each document with repeated passages."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return passages(docs).select("doc_id", F.size("spans").cast("long").alias("n_spans"), total(F.col("spans")).alias("n_repeated"),
                                 total(F.col("later_spans")).alias("n_later"),
                                 F.array_join(F.transform("spans", lambda x: F.concat_ws("+", x["start"].cast("string"), x["n"].cast("string"))), ",").alias("spans"))
