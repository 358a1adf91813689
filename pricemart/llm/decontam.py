"""Benchmark decontamination: a broadcast hash set of the benchmark's normalised word n-grams.

Every text is scanned for windows of 10 words (an item of fewer words is one window of its own length).  Windows
whose hash is in the set are verified word by word; words inside a verified window are hit.  Hit spans or whole
documents can be removed.

The set with its words is broadcast only while the benchmark's texts stay below ``BROADCAST_BYTES`` and the set built from
them, by estimate, below ``SET_BYTES``.  Of a larger benchmark only the sorted 8-byte hashes are broadcast, ``MAX_HASHES`` at a time
(more are dealt into slices, each with a scan of its own): windows whose hash is among them, and no others, are shuffled with
their words and joined with the benchmark's windows on the words.  The same hits either way.

Defined cases: a null or empty text has no words and no hits; null or empty items have no windows; items that repeat
an id count once; a null item id is written as ''; repeated documents are each judged; other columns are kept, and where one has the name
of a new column the new one gets underscores in front.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.llm.common import chunks, fresh, map_text, staged
from pricemart.llm.tokens import Words, flat, ngrams, owners, starts_inside, token_bytes, words

WINDOW = 10
BROADCAST_BYTES = 64 << 20      # of benchmark text
SET_BYTES = 96 << 20            # of the built set at the driver's peak; Python workers hold about a third
WINDOW_BYTES = 1300             # measured at that peak: a window's objects besides its words
MAX_HASHES = 8_000_000          # 64 MB broadcast


class Grams:
    """The benchmark's windows: for each length the sorted hashes, and the words and items behind each."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        grams: dict[int, dict[bytes, set[str]]] = {}
        self.hashes: dict[int, np.ndarray] = {}
        self.behind: dict[tuple[int, int], list[tuple[bytes, tuple[str, ...]]]] = {}
        of: dict[tuple[int, bytes], int] = {}
        for item, text in items:
            w = words(pa.array([text], pa.string()))
            n = len(w.hashes)
            if not n:
                continue
            size = min(window, n)
            h = ngrams(w.hashes, size)
            toks = [token_bytes(w, i) for i in range(n)]
            for i in range(n - size + 1):
                g = b" ".join(toks[i:i + size])
                grams.setdefault(size, {}).setdefault(g, set()).add(item)
                of[size, g] = int(h[i])
        for size, by in grams.items():
            for g, ids in by.items():
                self.behind.setdefault((size, of[size, g]), []).append((g, tuple(sorted(ids))))
            self.hashes[size] = np.array(sorted({of[size, g] for g in by}), np.uint64)


def find(w: Words, hashes: dict[int, np.ndarray], behind: dict) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """(first token, number of tokens, items) of each verified window; hashes and behind are those of ``Grams``."""
    for size, keys in hashes.items():
        g = ngrams(w.hashes, size)
        if not len(g):
            continue
        at = np.searchsorted(keys, g)
        at[at == len(keys)] = 0
        for i in np.flatnonzero((keys[at] == g) & starts_inside(w.offsets, size)):
            found = b" ".join(token_bytes(w, j) for j in range(i, i + size))
            for gram, ids in behind[size, int(g[i])]:
                if gram == found:
                    yield int(i), size, ids


def _covered(n: int, found: list[tuple[int, int]]) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    for at, size in found:
        step[at] += 1
        step[at + size] -= 1
    return np.cumsum(step[:n]) > 0


def _cut(w: Words, hit: np.ndarray, a: int, b: int, lo: int, hi: int) -> str:
    """Bytes lo:hi of the chunk without the runs of hit tokens among a:b (a run goes with the gaps inside it)."""
    out, at, i = [], lo, a
    while i < b:
        if hit[i]:
            j = i
            while j + 1 < b and hit[j + 1]:
                j += 1
            out.append(w.data[at:w.starts[i]].tobytes())
            at = int(w.ends[j])
            i = j
        i += 1
    out.append(w.data[at:hi].tobytes())
    return b"".join(out).decode()


#: columns that ``scan`` appends
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("items", T.ArrayType(T.StringType())), T.StructField("clean_text", T.StringType())]


def item_rows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    return benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
                            F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()


def set_sizes(items: DataFrame, window: int = WINDOW) -> tuple[int, int]:
    """(bytes of text, estimated bytes of ``Grams``) of ``items``; every window counts, also repeated ones."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column(0)
                n = np.diff(words(texts).offsets)
                size = np.minimum(n, window)
                text = np.diff(flat(texts)[1])
                built = np.where(n > 0, (n - size + 1) * WINDOW_BYTES + size * text, 0)
                yield pa.RecordBatch.from_arrays([pa.array([int(text.sum())], pa.int64()), pa.array([int(built.sum())], pa.int64())],
                                                 names=["text", "built"])

    found = items.select("text").mapInArrow(measured, "text long, built long").agg(F.sum("text"), F.sum("built")).first()
    return found[0] or 0, found[1] or 0


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, prefix: str = "",
         broadcast_bytes: int = BROADCAST_BYTES, with_text: bool = True, set_bytes: int = SET_BYTES, max_hashes: int = MAX_HASHES,
         names: list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted ids of the items found) and clean_text (hit spans removed;
    null for a null text).  ``prefix`` goes before the four names; ``names``: others, that ``docs`` doesn't have."""
    spark = docs.sparkSession
    items = item_rows(benchmark)
    size, built = set_sizes(items, window)
    names = names or fresh(docs, *[prefix + f.name for f in FIELDS])
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, FIELDS)]
    if size > broadcast_bytes or built > set_bytes:
        return _joined(docs, items, text_col, window, fields, with_text, max_hashes)
    grams = Grams([tuple(r) for r in items.collect()], window)
    shared = spark.sparkContext.broadcast((grams.hashes, grams.behind))

    def run(texts: pa.Array) -> list[pa.Array]:
        w = words(texts)
        hashes, behind = shared.value
        own = owners(w.offsets)
        spans, ids = [], [set() for _ in range(len(texts))]
        for at, n, found in find(w, hashes, behind):
            spans.append((at, n))
            ids[own[at]].update(found)
        hit = _covered(len(own), spans)
        return _columns(texts, w, hit, ids, with_text)

    return map_text(docs, text_col, fields, run)


def _columns(texts: pa.Array, w: Words, hit: np.ndarray, ids: list[set[str]], with_text: bool) -> list[pa.Array]:
    sums = np.concatenate([[0], np.cumsum(hit)])
    n_hit = sums[w.offsets[1:]] - sums[w.offsets[:-1]]
    if not with_text:
        clean = pa.nulls(len(texts), pa.string())
    elif not hit.any():
        clean = texts
    else:
        clean = texts.to_pylist()
        _, at = flat(texts)
        for i in np.flatnonzero(n_hit):
            clean[i] = _cut(w, hit, int(w.offsets[i]), int(w.offsets[i + 1]), int(at[i]), int(at[i + 1]))
        clean = pa.array(clean, pa.string())
    return [pa.array(np.diff(w.offsets), pa.int64()), pa.array(n_hit, pa.int64()),
            pa.array([sorted(x) for x in ids], pa.list_(pa.string())), clean]


def _gram(w: Words, i: int, size: int) -> bytes:
    return b" ".join(token_bytes(w, j) for j in range(i, i + size))


def _joined(docs: DataFrame, items: DataFrame, text_col: str, window: int, fields: list, with_text: bool, max_hashes: int) -> DataFrame:
    """The way for a benchmark whose set isn't broadcast: suspected windows of documents meet the benchmark's by their words."""
    spark = docs.sparkSession

    def item_windows(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                w = words(part.column(1))
                names = part.column(0).to_pylist()
                for i, name in enumerate(names):
                    a, b = int(w.offsets[i]), int(w.offsets[i + 1])
                    if b == a:
                        continue
                    n = min(window, b - a)
                    h = ngrams(w.hashes[a:b], n).view(np.int64)
                    toks = [token_bytes(w, j) for j in range(a, b)]
                    grams = [b" ".join(toks[j:j + n]) for j in range(len(h))]
                    yield pa.RecordBatch.from_arrays([pa.array([n] * len(h), pa.int32()), pa.array(h), pa.array(grams, pa.binary()),
                                                      pa.array([name] * len(h), pa.string())], names=["size", "h", "gram", "item"])

    wanted = staged(spark, items.select("item_id", "text").mapInArrow(item_windows, "size int, h long, gram binary, item string").distinct(),
                    "benchmark-windows")
    hashes = wanted.select("size", "h").distinct()
    slices = max(1, -(-hashes.count() // max_hashes))
    md5 = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))

    def suspects(i: int) -> DataFrame:
        """(text, at, size, gram) of the documents' windows whose hash is in slice i; repeated texts and windows fold."""
        found = hashes.where(F.pmod(F.xxhash64("h"), F.lit(slices)) == i).toArrow()             # ``max_hashes`` or so
        size, h = found.column(0).to_numpy(), found.column(1).to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast({int(n): np.sort(h[size == n]) for n in np.unique(size)})

        def run(batches):
            for batch in batches:
                for part in chunks(batch, "text"):
                    w, rows = words(part.column(1)), []
                    own = owners(w.offsets)
                    for n, keys in shared.value.items():
                        g = ngrams(w.hashes, n)
                        if len(g):
                            at = np.searchsorted(keys, g)
                            at[at == len(keys)] = 0
                            rows += [(int(own[j]), int(j - w.offsets[own[j]]), n, _gram(w, int(j), n))
                                     for j in np.flatnonzero((keys[at] == g) & starts_inside(w.offsets, n))]
                    if rows:
                        r, at, n, gram = zip(*rows)
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(r)), pa.array(at, pa.int64()), pa.array(n, pa.int32()),
                                                          pa.array(gram, pa.binary())], names=["md5", "at", "size", "gram"])

        return docs.select(md5.alias("md5"), F.col(text_col).alias("text")).mapInArrow(run, "md5 string, at long, size int, gram binary").distinct()

    every = suspects(0)
    for i in range(1, slices):
        every = every.unionByName(suspects(i))
    key, ids, spans = fresh(docs, "md5", "ids", "spans")
    hits = (every.join(wanted.select("size", "gram", "item"), ["size", "gram"])
            .groupBy(F.col("md5").alias(key)).agg(F.collect_set("item").alias(ids), F.collect_set(F.struct("at", "size")).alias(spans)))
    both = docs.withColumn(key, md5).join(staged(spark, hits, "benchmark-hits"), key, "left")
    n_in = len(docs.columns)
    place = docs.columns.index(text_col)
    names = [*docs.columns, *(f.name for f in fields)]

    def finish(batches):
        for batch in batches:
            for part in chunks(batch, text_col):
                texts, m = part.column(place), part.num_columns
                w = words(texts)
                found = [set(x or ()) for x in part.column(m - 2).to_pylist()]
                hit = [(s["at"] + int(w.offsets[i]), s["size"]) for i, x in enumerate(part.column(m - 1).to_pylist()) for s in x or ()]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n_in)),
                                                  *_columns(texts, w, _covered(len(w.hashes), hit), found, with_text)],
                                                 names=names)

    return both.select(*docs.columns, ids, spans).mapInArrow(finish, T.StructType([*docs.schema.fields, *fields]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "document", text_col: str = "text") -> DataFrame:
    """``docs`` without hit documents (``remove="document"``), or with the hit spans cut from their texts
    (``remove="span"``).  Columns stay as they are."""
    names = fresh(docs, *[f"_leak_{f.name}" for f in FIELDS])
    found = scan(docs, benchmark, text_col, with_text=remove == "span", names=names)
    if remove == "document":
        return found.where(F.col(names[1]) == 0).select(*docs.columns)
    if remove != "span":
        raise ValueError(remove)
    return found.withColumn(text_col, F.col(names[3])).select(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           broadcast_bytes: int = BROADCAST_BYTES, max_hashes: int = MAX_HASHES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = scan(slim, benchmark, broadcast_bytes=broadcast_bytes, with_text=False, max_hashes=max_hashes)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
