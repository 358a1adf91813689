"""Line removal: lines that many documents share.

A line's key is the line without white space at both ends and with A-Z lower-cased.  Three passes over the texts:

1. every task puts the hashes of its documents' distinct keys into two Bloom filters, one for keys seen once and
   one for keys seen twice; filters of all tasks are merged slice by slice (a key seen once in two tasks
   counts as seen twice);
2. only keys that the second filter suspects are shuffled, summed in each task first, for the exact number
   of documents and the first occurrence;
3. lines with a confirmed key are dropped.

The filters have a fixed number of bits (``LOG2_BITS``), whatever the corpus.  When a corpus fills them, more keys are
suspected and shuffled; results never change.  Confirmed keys are broadcast while they stay below
``BROADCAST_BYTES``; beyond that they meet the suspected lines in a shuffle join (same results).

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars`` code points are never dropped;
a key counts once per row, so repeated rows count as so many documents; a null text stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import fresh, map_text, staged

LOG2_BITS = 27
SLICE = 1 << 17                 # bytes of a filter that travel in one row
PROBES = 3
FLUSH = 50_000                  # keys that a task counts before it hands them on
BROADCAST_BYTES = 32 << 20
WHITE = b" \t\n\x0b\x0c\r"


def keys_of(text: str | None, min_chars: int = 1) -> list[bytes | None]:
    """The key of each line; None for one that is too short."""
    out = []
    for line in (text or "").encode().split(b"\n"):
        key = line.strip(WHITE).lower()
        out.append(key if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars) and key else None)
    return out


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)


def _probes(h: np.ndarray, log2_bits: int) -> np.ndarray:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64((1 << log2_bits) - 1)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _put(bits: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bits, (at >> np.uint64(3)).ravel(), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8).ravel())


def suspects(texts: DataFrame, min_chars: int = 1, log2_bits: int = LOG2_BITS) -> np.ndarray:
    """The merged filter of keys seen twice, as packed bits (a fixed size).  ``texts`` has one column."""
    size = (1 << log2_bits) // 8
    step = min(SLICE, size)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for batch in batches:
            found = [h for text in batch.column(0).to_pylist() for h in {k for k in keys_of(text, min_chars) if k}]
            if not found:
                continue
            h, n = np.unique(_hashes(found), return_counts=True)
            at = _probes(h, log2_bits)
            _put(twice, at[_has(once, at) | (n > 1)])
            _put(once, at)
        for i in range(0, size, step):
            a, b = once[i:i + step], twice[i:i + step]
            if a.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // step], pa.int32()), pa.array([zlib.compress(a.tobytes(), 1)]),
                                                  pa.array([zlib.compress(b.tobytes(), 1)])], names=["slice", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                if i not in have:
                    have[i] = a.copy(), b.copy()
                else:
                    once, twice = have[i]
                    twice |= b | (once & a)
                    once |= a
        for i, (_, twice) in have.items():
            if twice.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)])],
                                                 names=["slice", "twice"])

    merged = (texts.mapInArrow(fill, "slice int, once binary, twice binary").repartition("slice")
              .mapInArrow(merge, "slice int, twice binary"))
    bits = np.zeros(size, np.uint8)
    for i, b in merged.toLocalIterator():           # one slice at a time, ``size`` bytes in all
        bits[i * step:(i + 1) * step] = np.frombuffer(zlib.decompress(b), np.uint8)
    return bits


def repeated_keys(docs: DataFrame, min_docs: int, min_chars: int = 1, log2_bits: int = LOG2_BITS) -> tuple[DataFrame, object]:
    """(key, n_docs, first_id, first_line) of keys in at least ``min_docs`` documents, and the broadcast filter.
    ``docs`` has doc_id and text; the first occurrence is the smallest (doc_id, line), null ids first."""
    bits = docs.sparkSession.sparkContext.broadcast(suspects(docs.select("text"), min_chars, log2_bits))
    id_type = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("n", T.LongType()),
                        T.StructField("doc_id", id_type), T.StructField("line", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        kind = pa.int64()

        def flush():
            rows = list(held.items())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([v[0] for _, v in rows], pa.int64()),
                                               pa.array([v[1][1] for _, v in rows], kind), pa.array([v[1][2] for _, v in rows], pa.int64())],
                                              names=["key", "n", "doc_id", "line"])

        for batch in batches:
            kind = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                first: dict[bytes, int] = {}
                for i, k in enumerate(keys_of(text, min_chars)):
                    if k:
                        first.setdefault(k, i)
                if not first:
                    continue
                sure = _has(bits.value, _probes(_hashes(first), log2_bits))
                for (k, i), s in zip(first.items(), sure):
                    if s:
                        place = (doc is not None, doc, i)
                        if (have := held.get(k)) is None:
                            held[k] = [1, place]
                        else:
                            have[0] += 1
                            if (place[0], place[1] if place[0] else 0, i) < (have[1][0], have[1][1] if have[1][0] else 0, have[1][2]):
                                have[1] = place
            if len(held) >= FLUSH:
                yield flush()
        if held:
            yield flush()

    found = (docs.select("doc_id", "text").mapInArrow(count, out).groupBy("key")
             .agg(F.sum("n").alias("n_docs"), F.min(F.struct("doc_id", "line")).alias("first")))
    return found.where(F.col("n_docs") >= min_docs).select(
        "key", "n_docs", F.col("first.doc_id").alias("first_id"), F.col("first.line").alias("first_line")), bits


def drop_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, keep: str = "none", id_col: str = "doc_id",
               text_col: str = "text", log2_bits: int = LOG2_BITS, broadcast_bytes: int = BROADCAST_BYTES,
               prefix: str = "") -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text (names after ``prefix``).  Every line whose key is in at least
    ``min_docs`` documents goes; with ``keep="first"`` the first occurrence in the corpus stays.  Where ``docs`` has one of
    these names, the new column's name gets underscores in front."""
    if keep not in ("none", "first"):
        raise ValueError(keep)
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keys, bits = repeated_keys(slim, min_docs, min_chars, log2_bits)
    keys = staged(spark, keys, "line-keys")
    size = keys.agg(F.sum(F.length("key") + 64)).first()[0] or 0
    fields = [T.StructField(n, t) for n, t in zip(fresh(docs, prefix + "n_lines", prefix + "n_dropped", prefix + "kept_text"),
                                                  (T.LongType(), T.LongType(), T.StringType()))]
    places = docs.columns.index(text_col), docs.columns.index(id_col)
    n_in = len(docs.columns)
    schema = T.StructType([*docs.schema.fields, *fields])

    def rows(batch, goes) -> pa.RecordBatch:
        """goes(row, line number, key) for each line of each text."""
        n_lines, n_dropped, kept = [], [], []
        for r, text in enumerate(batch.column(places[0]).to_pylist()):
            lines = (text or "").split("\n")
            out = [line for i, (line, k) in enumerate(zip(lines, keys_of(text, min_chars))) if not (k and goes(r, i, k))]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(out))
            kept.append(None if text is None else "\n".join(out))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n_in)), pa.array(n_lines, pa.int64()),
                                           pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    if size <= broadcast_bytes:
        known = spark.sparkContext.broadcast({bytes(k): (d, i) for k, d, i in keys.select("key", "first_id", "first_line").collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = known.value
            for batch in batches:
                ids = batch.column(places[1]).to_pylist()
                yield rows(batch, lambda r, i, k: k in first and not (keep == "first" and first[k] == (ids[r], i)))

        return docs.mapInArrow(run, schema)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, at, key = [], [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                own = [(i, k) for i, k in enumerate(keys_of(text, min_chars)) if k]
                if own:
                    sure = _has(bits.value, _probes(_hashes(k for _, k in own), log2_bits))
                    for (i, k), s in zip(own, sure):
                        if s:
                            where.append(r)
                            at.append(i)
                            key.append(k)
            if where:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where)), pa.array(at, pa.int64()),
                                                  pa.array(key, pa.binary()), batch.column(2).take(pa.array(where))],
                                                 names=["place", "at", "key", "doc_id"])

    place, drops = fresh(docs, "place", "drops")
    keyed = docs.withColumn(place, F.concat_ws("-", F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    hits = (keyed.select(F.col(place).alias("place"), F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
            .dropDuplicates(["place"])
            .mapInArrow(lines, T.StructType([T.StructField("place", T.StringType()), T.StructField("at", T.LongType()),
                                             T.StructField("key", T.BinaryType()), T.StructField("doc_id", docs.schema[id_col].dataType)]))
            .join(keys, "key"))
    if keep == "first":
        hits = hits.where(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("at") == F.col("first_line"))))
    hits = hits.groupBy(F.col("place").alias(place)).agg(F.collect_set("at").alias(drops))    # at most a text's lines

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = [set(x or ()) for x in batch.column(n_in).to_pylist()]
            yield rows(batch, lambda r, i, k: i in gone[r])

    return keyed.join(hits, place, "left").select(*docs.columns, drops).mapInArrow(cut, schema)


def report(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of each document."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return drop_lines(slim, min_docs, min_chars, **more).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))
