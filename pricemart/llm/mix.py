"""Mixing sources to target weights, with DataFrame functions only.

Every source gets a target number of words: the sources' weights share ``share`` times all words, no target passes
``max_epochs`` times its source's words, and what is over is shared again by weight among the others.  A source is
then taken whole as often as its target allows (complete epochs); the rest of the target is filled by weighted sampling
without replacement: each document draws an exponential key -ln(u) / quality, documents are sorted by key within their
source, sizes are summed up in that order, and documents are taken while the middle of theirs lies below the rest.  So a
source ends within half a document of its target.  u comes from a hash of the id: reruns agree.

No source is sorted in one task.  Spark's range shuffle deals (source, key, id, size) into even ranges of about ``RANGE_ROWS``
documents, whatever the qualities; the ranges' sums give each range its start, and a window sorts each (source, range) alone.
Sources themselves are numbered and filled up in such ranges.  Selected documents are a prefix of the order, so one
cutoff per source decides, and texts are never shuffled.

Defined cases: null texts have size 0; the null source is a source, last in order; a null, zero or negative quality comes
last; rows that agree in source, id and size share one decision (they are summed first); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemart.llm.common import staged
from pricemart.operators.buckets import BUCKET, TIE_BREAK, ranged
from pricemart.operators.keys import with_surrogate_key
from pricemart.session import default_parallelism

SPACE = r"[\x20\x09-\x0D]+"
SIGNS = r"[#*$%&|<>!]+"
RANGE_ROWS = 1_000_000      # rows of a range that one task sorts


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters (null: 0)."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"\A{SPACE}|{SPACE}\z", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def sign_quality(text: Column) -> Column:
    """A document's sampling weight: the fourth power of the share of characters that are no signs, 0.05 at least."""
    n = F.length(text)
    plain = F.length(F.regexp_replace(text, SIGNS, "")).cast("double") / F.when(n > 0, n)
    return F.greatest(F.lit(0.05), F.coalesce(plain * plain * plain * plain, F.lit(0.05)))


def exponential_key(id_text: Column, quality: Column) -> Column:
    """-ln(u) / quality, with u in (0, 1] from 52 bits of the id's MD5."""
    u = (F.conv(F.substring(F.md5(id_text.cast("binary")), 1, 13), 16, 10).cast("double") + 1) / float(1 << 52)
    return F.when(quality > 0, -F.log(u) / quality).otherwise(F.lit(float("inf")))


def _before(rows: DataFrame, order: Sequence[str], ranges: int, by: Sequence[str] = (), **sums: str) -> DataFrame:
    """``rows`` with sums of columns over the rows before them (in their series ``by``) in ``order``; ``sums``: name=column.

    Spark's range shuffle deals the rows evenly, whatever their values; a window sorts each range alone, and a table with a
    row for each range (and series) holds what lies before it."""
    x = ranged(rows, [*by, *order], ranges)
    names = list(sums)
    totals = x.groupBy(*by, BUCKET).agg(*[F.sum(sums[n]).alias(n) for n in names])
    earlier = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(c).alias(f"_at_{c}") for c in (*by, BUCKET)],
                           *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_start_{n}") for n in names])
    inside = Window.partitionBy(*by, BUCKET).orderBy(*order, TIE_BREAK).rowsBetween(Window.unboundedPreceding, -1)
    local = x.withColumns({n: F.coalesce(F.sum(sums[n]).over(inside), F.lit(0)) for n in names})
    same = F.lit(True)
    for c in (*by, BUCKET):
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    return local.join(starts, same).select(*rows.columns, *[(F.col(n) + F.col(f"_start_{n}")).alias(n) for n in names])


def _ranges(n: int) -> int:
    return max(1, -(-n // RANGE_ROWS))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """``sizes`` (source, source_size: one row per source) with weight and target.

    Sources may be many (hosts): they are numbered and summed up in ranges of their order, too."""
    count, words = sizes.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = with_surrogate_key(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_place", 0, _ranges(count))
    x = placed.withColumn("weight", F.get(cycle, (F.col("_place") % len(weights)).cast("int")))
    x = staged(sizes.sparkSession, x.withColumn("_ratio", F.col("source_size") * float(max_epochs) / F.col("weight")), "mix-weights")
    # Sources fill up in the order of cap / weight; the level is that of the first that doesn't.
    full = _before(x, ["_ratio", "_null", "source"], _ranges(count), _words="source_size", _weights="weight")
    all_weights = x.agg(F.sum("weight")).first()[0] or 0.0
    level = (F.lit(float(share) * (words or 0)) - F.col("_words") * float(max_epochs)) / (F.lit(all_weights) - F.col("_weights"))
    found = (full.withColumn("_level", level).where("_level < _ratio")
             .agg(F.min(F.struct("_ratio", "_null", "source", "_level"))["_level"]).first()[0])
    cap = F.col("source_size") * float(max_epochs)
    return x.select("source", "source_size", "weight", (cap if found is None else F.least(cap, F.lit(found) * F.col("weight"))).alias("target"))


def _slim(docs: DataFrame, quality: Column, source_col: str, id_col: str, text_col: str) -> list[Column]:
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return [F.col(source_col).alias("source"), id_text.alias("id"), word_count(F.col(text_col)).alias("size"),
            exponential_key(id_text, quality).alias("key")]


def plan(slim: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """One row per source: source, source_size, target, epochs and the cutoff (key, id, size) of the fractional epoch.

    ``slim`` has source, id, size and key, one row per document."""
    spark = slim.sparkSession
    per_source = staged(spark, slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-sources")
    goal = targets(per_source.select("source", "source_size"), weights, share, max_epochs)
    p = (per_source.select(F.col("source").alias("_s"), "n").join(goal, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
         .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
         .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    p = staged(spark, p, "mix-targets")
    at = p.where("rest > 0").select(F.col("source").alias("_s"), "rest")
    rows = (slim.groupBy("source", "key", "id", "size").agg((F.col("size") * F.count("*")).alias("mass"))
            .join(at, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    n = p.where("rest > 0").agg(F.sum("n")).first()[0] or 0
    ranges = max(_ranges(n), default_parallelism(spark))
    taken = (_before(rows, ["key", "id", "size"], ranges, ["source"], before="mass")
             .where(F.col("before") + F.col("mass") / 2 <= F.col("rest")))
    cut = taken.groupBy(F.col("source").alias("_s")).agg(F.max(F.struct("key", "id", "size")).alias("cutoff"))
    # Written, so that its size is known: joins with it are broadcast while it is small, and skewed joins that Spark splits beyond.
    return staged(spark, p.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left")
                  .select("source", "source_size", "target", "epochs", "cutoff"), "mix-plan")


def _planned(docs: DataFrame, weights: Sequence[float], share: float, max_epochs: float, quality: Column | None,
             source_col: str, id_col: str, text_col: str) -> tuple[list[Column], DataFrame]:
    slim = _slim(docs, quality if quality is not None else sign_quality(F.col(text_col)), source_col, id_col, text_col)
    return slim, plan(staged(docs.sparkSession, docs.select(*slim), "mix-sizes"), weights, share, max_epochs)


def _copies() -> Column:
    inside = F.struct("key", "id", "size") <= F.col("cutoff")
    return F.col("epochs") + F.coalesce(inside, F.lit(False)).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
        quality: Column | None = None, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed corpus: rows of ``docs`` with their columns, each as often as the mix takes it (0 times: not at all)."""
    slim, p = _planned(docs, weights, share, max_epochs, quality, source_col, id_col, text_col)
    names = docs.columns
    p = p.select(F.col("source").alias("_s"), "epochs", "cutoff")
    whole = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), *slim)
    out = whole.join(p, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_n", F.explode(F.array_repeat(F.lit(1), _copies().cast("int"))))
    return out.select(*[F.col("_row")[c].alias(c) for c in names])


def report(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
           quality: Column | None = None, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, source_size, target and taken (size times copies) of each document."""
    q = quality if quality is not None else sign_quality(F.col(text_col))
    slim = staged(docs.sparkSession, docs.select(F.col(id_col).alias("doc_id"), *_slim(docs, q, source_col, id_col, text_col)), "mix-sizes")
    p = plan(slim, weights, share, max_epochs).withColumnRenamed("source", "_s")
    return (slim.join(p, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken")))
