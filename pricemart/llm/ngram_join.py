"""N-gram Jaccard join: MinHash banding, then verification on full n-gram sets.

A document's set holds the 64-bit hashes of its 5-word shingles (1 to 4 words: one shingle of all).  Documents of equal sets are
folded into one node first, so exact copies cost one row each.  ``banding`` picks rows and bands for the wanted recall at
the threshold; nodes that share a band's hash are candidates.  Candidates that hang together are grouped into
components, and every node's text travels once to its component, where all pairs are compared on their full sets.  A
component of more than ``BLOCK`` nodes or ``BLOCK_BYTES`` of text is cut into blocks, and each pair of blocks is a group of its own: no group outgrows a
task, and pairs are counted inside tasks, never emitted.

Result: for every document its class (documents connected by links) and its number of links, i.e. of other documents whose
Jaccard similarity is at least the threshold, exact copies included.

Defined cases: null texts and texts without words have no shingles: no links, a class of their own; class_id is the smallest
non-null id of the class; repeated rows are documents like others (copies); an empty table gives no rows.  Sets are told
apart by a 64-bit fingerprint.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import chunks, fresh, map_text, staged
from pricemart.llm.graph import components
from pricemart.llm.tokens import Words, mix, ngrams, words

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BLOCK = 512
BLOCK_BYTES = 16 << 20          # of text in a block, where it has several nodes


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(rows, bands): as many rows as ``max_hashes`` allows, with so many bands that a pair at the threshold shares
    one with the wanted probability."""
    best = 1, max_hashes
    for rows in range(1, max_hashes + 1):
        p = threshold ** rows
        bands = math.ceil(math.log(1 - recall) / math.log(1 - p)) if p < 1 else 1
        if rows * bands > max_hashes:
            break
        best = rows, bands
    return best


def shingle_sets(w: Words, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    g = ngrams(w.hashes, n)
    out = []
    for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist()):
        out.append(np.unique(g[a:b - n + 1] if b - a >= n else ngrams(w.hashes[a:b], b - a) if b > a else g[:0]))
    return out


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)


def signature(s: np.ndarray, rows: int, bands: int, by: np.ndarray) -> np.ndarray:
    """Band hashes of a set: minima of rows * bands hash functions, folded band by band."""
    low = np.full(rows * bands, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 4096):                    # bounded memory for very long texts
        low = np.minimum(low, mix(s[i:i + 4096, None] * by[None, :]).min(0))
    low = low.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, i])
    return key.view(np.int64)


def links(sets: list[np.ndarray], threshold: float, cross: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the others whose Jaccard similarity is at least ``threshold``; with ``cross`` (a side per set) only
    those of the other side."""
    sizes = np.array([len(s) for s in sets])
    own = np.repeat(np.arange(len(sets)), sizes)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(inverse, kind="stable")
    holders = own[order]                                # the sets that hold each value, value by value
    first = np.concatenate([[0], np.cumsum(counts)])
    ends = np.cumsum(sizes)
    for i in range(len(sets)):
        v = inverse[ends[i] - sizes[i]:ends[i]]
        v = v[counts[v] > 1]
        n = counts[v]
        at = np.repeat(first[v] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(v) else np.zeros(0, np.int64)
        common = np.bincount(holders[at], minlength=len(sets))
        near = common >= threshold * (sizes + sizes[i] - common) - 1e-9
        near[i] = False
        if cross is not None:
            near &= cross != cross[i]
        yield i, np.flatnonzero(near)


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Groups (comp, i, j) arrive one after another; a row for each node: its links and the root of its linked nodes.
    A group of two blocks counts links between them only, also where one of them has no nodes."""
    names = ["node", "links", "root"]

    def close(group: list[tuple], across: bool) -> pa.RecordBatch:
        nodes = {r[0]: r for r in group}                # repeated rows of one node
        rows = list(nodes.values())
        sets = []
        for i in range(0, len(rows), 64):
            sets += shingle_sets(words(pa.array([r[2] for r in rows[i:i + 64]], pa.string())))
        side = np.array([r[3] for r in rows])
        weight = np.array([r[1] for r in rows], np.int64)
        root = list(range(len(rows)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        total = np.zeros(len(rows), np.int64)
        for i, near in links(sets, threshold, side if across else None):
            total[i] = weight[near].sum()
            for j in near[near > i].tolist():
                a, b = top(i), top(j)
                if a != b:
                    root[b] = a
        ids = np.array([r[0] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total), pa.array(ids[[top(i) for i in range(len(rows))]])], names=names)

    key, group = None, []
    for batch in batches:
        cols = [batch.column(i) for i in range(7)]
        for comp, i, j, node, copies, side, text in zip(*(c.to_pylist() for c in cols)):
            if (comp, i, j) != key:
                if group:
                    yield close(group, key[1] != key[2])
                key, group = (comp, i, j), []
            group.append((node, copies, text, side))
    if group:
        yield close(group, key[1] != key[2])


def groups(found: DataFrame, slim: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(comp, i, j, node, copies, side, text): each node's text once in every pair of blocks it belongs to.

    ``found`` has root, node, copies and place (doc_id, text_hash, bytes) of the candidates.  Repeated rows of a place are
    one row before texts are copied."""
    by_bytes = F.least(F.ceil(F.sum("place.bytes") / block_bytes), F.count("*"))
    sizes = found.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / block), by_bytes, F.lit(1)).cast("int").alias("blocks"))
    members = found.join(sizes, "root").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = members.join(slim, (slim["doc_id"].eqNullSafe(F.col("place.doc_id"))) & (slim["text_hash"] == F.col("place.text_hash")))
    once = texts.select("root", "node", "copies", "side", "blocks", "text").dropDuplicates(["node"])
    return (once.select("root", "node", "copies", "side", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select(F.col("root").alias("comp"), F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
                    "node", "copies", "side", "text"))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
             block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, text_hash, class (a number), class_id, n_links."""
    spark = docs.sparkSession
    rows, bands = banding(threshold, recall)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    sized = slim.withColumn("bytes", F.octet_length("text"))

    def shingled(texts: pa.Array) -> list[pa.Array]:
        by = _multipliers(rows * bands)
        nodes, keys = [], []
        for s in shingle_sets(words(texts)):
            nodes.append(int(mix(mix(s).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s))).view(np.int64)[0]) if len(s) else None)
            keys.append(signature(s, rows, bands, by) if len(s) else np.zeros(0, np.int64))
        ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        return [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys), pa.int64()))]

    marked = map_text(sized, "text", [T.StructField("node", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))], shingled).drop("text")
    marked = staged(spark, marked, "shingled")
    nodes = (marked.where("node is not null").groupBy("node")
             .agg(F.count("*").alias("copies"), F.min("doc_id").alias("low_id"), F.min(F.struct("doc_id", "text_hash", "bytes")).alias("place"),
                  F.first("keys").alias("keys")))
    nodes = staged(spark, nodes, "shingle-nodes")
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    found = components(buckets.join(shared, "key").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")))
    found = staged(spark, found.join(nodes.select("node", "copies", "place"), "node"), "candidates")
    pairs = groups(found, slim, block, block_bytes)
    verified = (pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "comp", "i", "j").sortWithinPartitions("comp", "i", "j", "node")
                .mapInArrow(lambda b: _verify(b, threshold), "node long, links long, root long"))
    verified = staged(spark, verified, "links")
    roots = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = roots.join(verified.groupBy("node").agg(F.sum("links").alias("links")), "node")
    every = (nodes.select("node", "copies", "low_id").join(linked, "node", "left")
             .select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("class"), "low_id"))
    every = staged(spark, every, "classes")
    lowest = every.groupBy("class").agg(F.min("low_id").alias("class_id"))
    return (marked.select("doc_id", "text_hash", "node").join(every.join(lowest, "class").drop("low_id"), "node", "left")
            .select("doc_id", "text_hash", "class", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and n_links of each document."""
    return classify(docs).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one of the smallest id (null first); columns stay as they are.  Rows that
    agree in id and text are one document; documents without words all stay."""
    place, low, mark = fresh(docs, "_id", "_hash", "_row")
    found = classify(docs, id_col, text_col, threshold)
    found = found.select(F.struct(F.col("doc_id").alias("id"), "text_hash").alias("p"), "class")
    winners = found.where("class is not null").groupBy("class").agg(F.min("p").alias("p")).select("p")
    winners = winners.unionByName(found.where("class is null").select("p").distinct()).select(
        F.col("p.id").alias(place), F.col("p.text_hash").alias(low))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias(mark), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"))
    kept = rows.join(winners, F.col("id").eqNullSafe(F.col(place)) & (F.col("h") == F.col(low)), "left_semi").dropDuplicates(["id", "h"])
    return kept.select(*[F.col(mark)[c].alias(c) for c in docs.columns])
