"""Token ids in Arrow stream files of equal-length sequences.

Documents are put in ascending id order by a range shuffle; each partition encodes its documents, appends the end
id, packs the ids into sequences of ``seq_len`` and writes one file in the Arrow stream format.  A record batch has
``rows`` sequences: a fixed-size list of ids and one of mask bits (false: padding after the last id of the file).  All
batches of a file have equal byte length, so sequence i is found by arithmetic and read from a memory map without a
copy.  Ids take 16 bits when the vocabulary allows it.

Files go to a folder all executors share, first under a name of their own, then renamed: a task that is lost or runs
twice leaves whole files only.  The index (document, file, offset, number of ids) is a Parquet table beside them.

Defined cases: a null or empty text has the end id only; repeated ids follow each other, ordered by their texts' hash;
null ids come first; an empty table gives an empty index and no files.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import chunks, staged
from pricemart.llm.pieces import PieceTable, with_end
from pricemart.session import scratch_path

SEQ_LEN = 1024
ROWS = 32                       # sequences in a record batch


class Encoder:
    """ids of single texts, by a table of pieces."""

    def __init__(self, path: str, drops_space: bool = False):
        self.table = PieceTable(path, drops_space)
        self.tok = self.table.tok

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, at = self.table.encode(pa.array(texts, pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def id_type(vocabulary: int) -> pa.DataType:
    return pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()


def file_schema(kind: pa.DataType, seq_len: int) -> pa.Schema:
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", kind, nullable=False), seq_len), nullable=False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), seq_len), nullable=False)])


class _Writer:
    def __init__(self, sink, kind: pa.DataType, seq_len: int, rows: int):
        self.schema, self.kind, self.seq_len, self.rows = file_schema(kind, seq_len), kind, seq_len, rows
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n = 0

    def _batch(self, ids: np.ndarray) -> None:
        full = np.zeros(self.rows * self.seq_len, ids.dtype)
        full[:len(ids)] = ids
        mask = np.arange(len(full)) < len(ids)
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(v, t), type=self.schema.field(i).type)
                  for i, (v, t) in enumerate(((full, self.kind), (mask, pa.bool_())))]
        self.out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n += len(ids)
        size = self.rows * self.seq_len
        if self.n >= size:
            every = np.concatenate(self.held)
            for i in range(0, len(every) - size + 1, size):
                self._batch(every[i:i + size])
            rest = every[len(every) // size * size:].copy()
            self.held, self.n = [rest], len(rest)

    def close(self) -> None:
        if self.n:
            self._batch(np.concatenate(self.held))
        self.out.close()


class TokenFile:
    """Random access to a file's sequences.  On a local or mounted folder arrays are views of a memory map."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.file))
        self.first = self.file.tell()
        self.seq_len = self.schema.field("ids").type.list_size
        head = pa.ipc.read_message(self.file)
        self.step = self.file.tell() - self.first
        self.rows = pa.ipc.read_record_batch(head, self.schema).num_rows
        self.at, self.batch = -1, None

    def _load(self, i: int) -> pa.RecordBatch:
        if i != self.at:
            self.file.seek(self.first + i * self.step)
            self.batch = pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)
            self.at = i
        return self.batch

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and mask of sequence i."""
        b, r, n = self._load(i // self.rows), i % self.rows, self.seq_len
        ids = b.column(0).flatten().to_numpy(zero_copy_only=True)[r * n:(r + 1) * n]
        return ids, b.column(1).flatten()[r * n:(r + 1) * n].to_numpy(zero_copy_only=False)

    def tokens(self, at: int, n: int) -> np.ndarray:
        """n ids from position ``at`` of the file on."""
        size, parts = self.rows * self.seq_len, []
        while n > 0:
            ids = self._load(at // size).column(0).flatten().to_numpy(zero_copy_only=True)
            take = ids[at % size:at % size + n]
            parts.append(take)
            at, n = at + len(take), n - len(take)
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint32)])


def write(docs: DataFrame, out: str, tokenizer: str, end_id: int, drops_space: bool = False, id_col: str = "doc_id",
          text_col: str = "text", seq_len: int = SEQ_LEN, rows: int = ROWS) -> DataFrame:
    """Write ``docs`` below the URI or path ``out``; returns the index: doc_id, part, at (offset in the file),
    n_tokens, file."""
    uri = out if "://" in out or out.startswith("file:") else f"file://{out}"
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = slim.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("part", T.LongType()), T.StructField("at", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("file", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table = PieceTable.shared(tokenizer, drops_space)
        kind = id_type(max(table.size, end_id + 1))
        fs, base = pafs.FileSystem.from_uri(uri)
        target, own = f"{base}/part-{part:08d}.arrows", f"{base}/_part-{part:08d}-{uuid.uuid4().hex}"
        sink = writer = None
        at = 0
        for batch in batches:
            if writer is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(own)
                writer = _Writer(sink, kind, seq_len, rows)
            sizes = []
            for texts in chunks(batch, "text"):
                ids, ends = table.encode(texts.column(1))
                ids, ends = with_end(ids.astype(kind.to_pandas_dtype()), ends, end_id)
                writer.add(ids)
                sizes.append(np.diff(ends))
            sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            ends = at + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([part] * len(sizes), pa.int64()), pa.array(ends - sizes, pa.int64()),
                                              pa.array(sizes, pa.int64()), pa.array([f"{uri}/part-{part:08d}.arrows"] * len(sizes), pa.string())],
                                             names=schema.names)
            at = int(ends[-1]) if len(sizes) else at
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(own, target)

    return staged(docs.sparkSession, ordered.mapInArrow(run, schema), "token-index")


def with_start(index: DataFrame) -> DataFrame:
    """The index with ``start``: ids of all documents before this one.  One row per file is summed up in order."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return index.join(parts, "part").withColumn("start", F.col("base") + F.col("at")).drop("base")


def read_back(index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    spark = index.sparkSession
    schema = T.StructType([index.schema["doc_id"], T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            crcs = []
            for uri, at, n in zip(*(batch.column(i).to_pylist() for i in (4, 3, 2))):
                if uri != name:
                    name, file = uri, TokenFile(uri)
                crcs.append(zlib.crc32(file.tokens(at, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(crcs, pa.int64())], names=schema.names)

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (with_start(index).select("doc_id", "start", "n_tokens", "at", "file").repartition(width, "file")
            .sortWithinPartitions("file", "at").mapInArrow(run, schema))


def report(docs: DataFrame, tokenizer: str, end_id: int = 1, drops_space: bool = True, out: str | None = None) -> DataFrame:
    """Write ``docs`` to token files (below the shared checkpoint folder unless ``out`` is given) and read them back."""
    spark: SparkSession = docs.sparkSession
    return read_back(write(docs, out or scratch_path(spark, "token-files"), tokenizer, end_id, drops_space))
