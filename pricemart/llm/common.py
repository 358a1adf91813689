"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.session import scratch_path

ARROW_ROWS = 1000           # rows in an Arrow batch handed to a Python worker
CHUNK_BYTES = 1 << 20       # text bytes that one vectorised step works on


def configure(spark: SparkSession) -> None:
    """Session settings of this subpackage: small Arrow batches keep Python workers' memory bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: lineage is cut, a lost executor
    re-reads the files."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_schema(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    return T.StructType([*df.schema.fields, *fields])


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold about ``limit`` bytes (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy()
    ends = np.cumsum(sizes, dtype="int64")
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_text(df: DataFrame, text_col: str, fields: list[T.StructField],
             fn: Callable[[pa.Array], list[pa.Array]], keep: Callable | None = None) -> DataFrame:
    """Append columns that ``fn`` computes from the texts, chunk by chunk; no shuffle.

    ``fields`` must not clash with the columns of ``df``.  ``fn`` gets an Arrow string array and returns one
    array per field."""
    names = [f.name for f in fields]
    clash = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    n_in = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                new = fn(part.column(part.schema.get_field_index(text_col)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n_in)), *new],
                                                 names=[*part.schema.names, *names])

    return df.mapInArrow(run, arrow_schema(df, fields))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def label_table(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label 0/1), one row per id: rows with a null id or label go, of unequal labels the larger stays."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))


def fold(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as the text '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(labelled: DataFrame, bound: int, id_col: str = "doc_id") -> DataFrame:
    """About ``bound`` labelled rows at most, picked by a hash of the id (all of them when there are fewer).

    The count is exact; a Bernoulli draw by hash then keeps ``bound`` rows in expectation, so the size is
    bounded whatever the number of labels."""
    n = labelled.count()
    if n <= bound:
        return labelled
    cut = int(bound / n * (1 << 31))
    return labelled.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 31)) < cut)


def labelled_rows(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and label of the documents in ``known`` (doc_id, label; one row per id, few enough to broadcast), one
    row per id: of rows that repeat an id the one with the smallest text hash.  Tasks fold their own rows first, so an id
    that many rows share sends one row per task."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return rows.groupBy("doc_id", "label").agg(one).select("doc_id", F.col("one.text").alias("text"), "label")
