"""Mixture-controlled packing: documents in sequences of ``seq_len`` tokens, by deficit round-robin over source queues.

Every source has a queue of its documents' tokens.  Each window (one sequence) is a round over the queues in order: a
queue's credit is its share of the window plus the deficit it carries, it serves the whole tokens of that credit, and
what is below one token is carried to the next window.  Served tokens stay within one token of a source's target over
every stretch of windows, and a window is always full.  Sources whose share of a window is below one token share the
last queue, one after another.

Carried deficits are exact fractions that only depend on the window's place: after t tokens of a phase of P tokens, the
queues up to the j-th have served floor(t * P_j / P), P_j being their part.  So any task knows the deficits at any window
without running those before it: they pass from partition to partition without a sequential pass, and a document finds
its windows from its place in its queue alone.

Shares are given weights, or by default the sources' own parts of all tokens, so that all queues run dry together.  With
weights a source that runs dry ends a phase, and the others share its part from there on; sources without a weight
come last, by their own sizes.  The last, partial window is cut into sequences of powers of two, which need no padding.

Spark: texts are tokenised once, each row with its place among the rows of its source in its task (a written table); one
row for each task and source is summed up over range-dealt blocks to places in the queues; pieces are cut row by row
and shuffled once, by sequence.  A hot source is just a long queue, met by all tasks.  The driver holds the sources with a
token or more a window (``seq_len`` at most) and those with a weight.

Defined cases: a null or empty text has the end id only; a null source is a source of its own, before the others; null and
repeated ids and repeated rows are documents like others; an empty table has no sequences; extra columns aren't read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import chunks, staged
from pricemart.llm.pieces import PieceTable, with_end

SEQ_LEN = 2048
ROWS_OUT = 4096                 # rows in an Arrow batch of results


# ---- tokens and places in the queues

def tokenized(docs: DataFrame, tokenizer: str, end_id: int, drops_space: bool, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, part (task), at (tokens of the source's rows before this one in the task), n_tokens, ids (little-endian
    bytes), one row per document; no shuffle."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    schema = T.StructType([*slim.schema.fields[:2], T.StructField("part", T.LongType()), T.StructField("at", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, table = TaskContext.get().partitionId(), PieceTable.shared(tokenizer, drops_space)
        kind = id_kind(table.size, end_id)
        served: dict[str | None, int] = {}
        for batch in batches:
            for rows in chunks(batch, "text"):
                ids, ends = table.encode(rows.column(2))
                ids, ends = with_end(ids.astype(kind), ends, end_id)
                sizes, at = np.diff(ends), []
                for source, n in zip(rows.column(1).to_pylist(), sizes.tolist()):
                    at.append(served.get(source, 0))
                    served[source] = at[-1] + n
                raw, byte = ids.tobytes(), (ends * kind.itemsize).tolist()
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array([part] * len(sizes), pa.int64()), pa.array(at, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array([raw[a:b] for a, b in zip(byte, byte[1:])], pa.binary())], names=schema.names)

    return slim.mapInArrow(run, schema)


def id_kind(vocabulary: int, end_id: int) -> np.dtype:
    return np.dtype("<u2") if max(vocabulary, end_id + 1) <= 1 << 16 else np.dtype("<u4")


def queues(rows: DataFrame) -> DataFrame:
    """source, part, base: tokens of all rows before these in the order (source, part), over all sources.

    One row for each task and source.  Blocks of them are dealt by range and summed up apart, so no task sees all."""
    spark = rows.sparkSession
    sums = rows.groupBy("source", "part").agg(F.sum("n_tokens").alias("n")).repartitionByRange("source", "part")
    sums = staged(spark, sums.withColumn("block", F.spark_partition_id().cast("long")), "queue-blocks")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)             # one row per block
    blocks = sums.groupBy("block").agg(F.sum("n").alias("m")).select("block", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("block").orderBy("source", "part").rowsBetween(Window.unboundedPreceding, -1)
    local = sums.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return staged(spark, local.join(blocks, "block").select("source", "part", "n", (F.col("first") + F.col("inside")).alias("base")), "queues")


# ---- the plan: phases of constant shares

def in_order(sources) -> list:
    return sorted(sources, key=lambda s: (s is not None, s or ""))


class Phase:
    """Queues with constant shares, from token ``first`` of all on: ``part[source]`` is (low, high, place): the queue has
    ``low:high`` of the phase's ``size`` tokens, the source's own begin at ``place`` of the queue.  ``rest``: the same of the
    first source that isn't listed."""

    def __init__(self, first: int, amounts: dict, seq_len: int, others: int = 0):
        self.first, self.size, self.part = first, sum(amounts.values()) + others, {}
        low, place, small = 0, 0, []
        for s in in_order(amounts):
            if amounts[s] * seq_len < self.size:
                small.append(s)
            else:
                self.part[s] = (low, low + amounts[s], 0)
                low += amounts[s]
        for s in small:
            self.part[s] = (low, self.size, place)
            place += amounts[s]
        self.rest = (low, self.size, place)
        self.amounts = amounts


def phases(sizes: dict, weights: dict, others: int, seq_len: int) -> list[Phase]:
    """The phases of the sources ``sizes`` (tokens by source; ``others``: of all sources not listed).

    A phase of given weights ends where a queue runs dry; sources without a weight and the others follow by their sizes."""
    left, out, at = {s: n for s, n in sizes.items() if n}, [], 0
    while True:
        open_ = [s for s in in_order(left) if weights.get(s, 0) > 0]
        if not open_:
            break
        dry = min(open_, key=lambda s: left[s] / weights[s])
        amounts = {s: min(left[s], round(left[dry] * weights[s] / weights[dry])) for s in open_} | {dry: left[dry]}
        out.append(Phase(at, {s: n for s, n in amounts.items() if n}, seq_len))
        at += out[-1].size
        left = {s: n - amounts.get(s, 0) for s, n in left.items() if n > amounts.get(s, 0)}
    if left or others:
        out.append(Phase(at, left, seq_len, others))
    return out


def tail_edges(total: int, seq_len: int) -> list[int]:
    """Edges of the sequences of the last, partial window: 0 and on by powers of two, the largest first."""
    rest, out = total % seq_len, [0]
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            out.append(out[-1] + (1 << bit))
    return out


def cut(s: int, n: int, queue: tuple[int, int, int], phase: Phase, seq_len: int) -> Iterator[tuple[int, int, int]]:
    """The windows of n tokens from place s of a queue on: (length, window, offset in the window) one after another."""
    low, high, place = queue
    size, k0 = phase.size, phase.first // seq_len
    last = (phase.first + size - 1) // seq_len - k0                             # windows 0..last of the phase

    def edge(i: int) -> int:
        return min(size, (k0 + i) * seq_len - phase.first) if i else 0

    def served(i: int) -> int:
        t = edge(i)
        return t * high // size - t * low // size

    s, end, i = s + place, s + place + n, 0
    while s < end:
        if i > last or served(i + 1) <= s or not i:                             # the window that serves token s
            a, b = i, last
            while a < b:
                mid = (a + b) // 2
                if served(mid + 1) > s:
                    b = mid
                else:
                    a = mid + 1
            i = a
        x, y = edge(i), edge(i + 1)
        take = min(end, served(i + 1)) - s
        earlier = y * low // size - x * low // size                             # tokens of earlier queues in this window
        yield take, k0 + i, phase.first + x - (k0 + i) * seq_len + earlier + s - served(i)
        s, i = s + take, i + 1


class Plan:
    """Windows of any document, by its source and its place ``at`` in the order of all sources."""

    def __init__(self, bounds: dict, weights: dict, total: int, seq_len: int):
        """``bounds``: (tokens of all sources before, tokens) of the listed sources."""
        self.seq_len, self.total, self.bounds = seq_len, total, bounds
        self.tail = tail_edges(total, seq_len)
        self.phases = phases({s: n for s, (_, n) in bounds.items()}, weights, total - sum(n for _, n in bounds.values()), seq_len)
        self.listed = in_order(bounds)
        self.before = [0]
        for s in self.listed:
            self.before.append(self.before[-1] + bounds[s][1])
        self.keys = [(s is not None, s or "") for s in self.listed]

    def windows(self, source: str | None, at: int, n: int) -> Iterator[tuple[int, int, int]]:
        if source not in self.bounds:
            phase = self.phases[-1]
            low, high, place = phase.rest
            ahead = self.before[bisect_right(self.keys, (source is not None, source or ""))]
            yield from cut(at - ahead, n, (low, high, place), phase, self.seq_len)
            return
        s = at - self.bounds[source][0]
        for phase in self.phases:
            have = phase.amounts.get(source, 0)
            take = max(0, min(n, have - s))
            if take:
                yield from cut(s, take, phase.part[source], phase, self.seq_len)
                s, n = s + take, n - take
            s -= have

    def pieces(self, source: str | None, at: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of a document's pieces; the last window's are cut at its powers of two."""
        start, full = 0, self.total // self.seq_len
        for length, k, offset in self.windows(source, at, n):
            while length:
                if k < full:
                    take, sequence, first = length, k, 0
                else:
                    i = bisect_right(self.tail, offset) - 1
                    take, sequence, first = min(length, self.tail[i + 1] - offset), full + i, self.tail[i]
                yield start, take, sequence, offset - first
                start, length, offset = start + take, length - take, offset + take


# ---- the operator

PIECE = T.StructType([T.StructField("source", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("start", "length", "offset", "doc_tokens")]])


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, weights: dict | None = None, seq_len: int = SEQ_LEN, drops_space: bool = False,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Sequences of all documents: sequence_id, n_tokens, ids (little-endian, without padding) and pieces, an array in their
    order of (doc_id, source, start, length, offset, doc_tokens).

    ``weights``: target shares by source; ``None``: the sources' own sizes.  ``seq_len``: a power of two."""
    if seq_len < 1 or seq_len & (seq_len - 1):
        raise ValueError("seq_len is a power of two")
    spark = docs.sparkSession
    rows = tokenized(docs, tokenizer, end_id, drops_space, id_col, text_col, source_col)
    rows = staged(spark, rows, "token-rows")
    places = queues(rows)
    bounds = places.groupBy("source").agg(F.min("base").alias("first"), F.sum("n").alias("size"))
    total = bounds.agg(F.sum("size")).first()[0] or 0
    named = F.col("source").isin([s for s in weights or {} if s is not None]) | (F.col("source").isNull() & F.lit(None in (weights or {})))
    free = bounds.where(~F.coalesce(named, F.lit(False))).agg(F.sum("size")).first()[0] or 0
    listed = bounds.where(F.coalesce(named, F.lit(False)) | (F.col("size") * seq_len >= free))
    plan = Plan({r["source"]: (r["first"], r["size"]) for r in listed.collect()}, weights or {}, total, seq_len)
    width = id_kind(PieceTable(tokenizer, drops_space, 1).size, end_id).itemsize
    joined = rows.join(places.select(F.col("source").alias("s"), F.col("part").alias("p"), "base"),
                       F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    doc_id = rows.schema["doc_id"]
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), doc_id, *PIECE.fields, T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, (doc, source, at, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                ids = memoryview(batch.column(4)[i].as_buffer())
                for start, length, k, offset in plan.pieces(source, at, n):
                    out.append((k, doc, source, start, length, offset, n, bytes(ids[start * width:(start + length) * width])))
                if len(out) >= ROWS_OUT:
                    yield _batch(out, schema, batch.schema.types[0])
                    out = []
            if out:
                yield _batch(out, schema, batch.schema.types[0])

    cut_up = joined.select("doc_id", "source", (F.col("base") + F.col("at")).alias("at"), "n_tokens", "ids").mapInArrow(run, schema)
    return _assemble(cut_up, doc_id)


def _batch(rows: list[tuple], schema: T.StructType, id_type: pa.DataType) -> pa.RecordBatch:
    types = [pa.int64(), id_type, pa.string(), *[pa.int64()] * 4, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)


def _assemble(pieces: DataFrame, doc_id: T.StructField) -> DataFrame:
    """One row per sequence: its pieces meet by one shuffle, in order; a sequence holds ``seq_len`` tokens at most."""
    fields = [doc_id, *PIECE.fields]
    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("pieces", T.ArrayType(T.StructType(fields)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, arrow = [], None, None

        def close(slices: list[pa.RecordBatch]) -> pa.RecordBatch:
            """Whole sequences only."""
            t = pa.Table.from_batches(slices).combine_chunks()
            k = t.column(0).to_numpy()
            first = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])
            length = np.concatenate([[0], np.cumsum(t.column("length").to_numpy())])
            ids = t.column("ids").combine_chunks()
            byte = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
            raw = memoryview(ids.buffers()[2])
            items = pa.StructArray.from_arrays([t.column(i).combine_chunks() for i in range(1, 7)], fields=[t.schema.field(i) for i in range(1, 7)])
            return pa.RecordBatch.from_arrays(
                [pa.array(k[first[:-1]]), pa.array(np.diff(length[first])),
                 pa.array([bytes(raw[byte[a]:byte[b]]) for a, b in zip(first[:-1], first[1:])], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), items)], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(0).to_numpy()
            cut_at = int(np.searchsorted(k, k[-1]))                             # the last sequence may go on in the next batch
            if cut_at or (held and key != k[-1]):
                held.append(batch.slice(0, cut_at))
                held = [b for b in held if b.num_rows]
                if held:
                    yield close(held)
                held = []
            held.append(batch.slice(cut_at))
            key = k[-1]
        if held:
            yield close(held)

    width = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(width, "sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(run, schema)


def padded(sequences: DataFrame, seq_len: int = SEQ_LEN, width: int = 2) -> DataFrame:
    """``sequences`` with ``ids`` filled with zero bytes: to a power of two as they are, else to ``seq_len`` ids."""
    n = F.when(F.bit_count("n_tokens") == 1, F.col("n_tokens")).otherwise(F.lit(seq_len))
    fill = F.unhex(F.repeat(F.lit("00"), ((n - F.col("n_tokens")) * width).cast("int")))
    return sequences.withColumn("ids", F.concat("ids", fill))


def report(docs: DataFrame, tokenizer: str, end_id: int = 1, weights: dict | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and source of each piece, from the packed sequences."""
    sequences = pack(docs, tokenizer, end_id, weights, seq_len)
    doc_id = docs.schema["doc_id"]
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([T.StructField("doc_id", doc_id.dataType), *[T.StructField(n, T.LongType()) for n in names], T.StructField("source", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc, sequence = [], []
            for k, n, ids, offsets, lengths in zip(*(batch.column(i).to_pylist() for i in range(5))):
                wide = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes()
                crc += [zlib.crc32(wide[4 * o:4 * (o + m)]) for o, m in zip(offsets, lengths)]
                sequence += [k] * len(offsets)
            piece = batch.column(5).flatten()
            cols = dict(zip((f.name for f in piece.type), piece.flatten())) | {"ids_crc32": pa.array(crc, pa.int64()), "sequence_id": pa.array(sequence, pa.int64())}
            yield pa.RecordBatch.from_arrays([cols[n] for n in schema.names], names=schema.names)

    return sequences.select("sequence_id", "n_tokens", "ids", "pieces.offset", "pieces.length", "pieces").mapInArrow(run, schema)
