"""Connected components of an edge table, as rounds of joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemart.llm.common import staged


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of ``edges`` (a long, b long): root is the smallest node of its component.

    Alternating large-star and small-star rounds; every step is a written table in the shared folder.  Each join has
    one row per node on one side, read from its own table, so a node with very many edges is a skewed join that Spark
    splits."""
    spark = edges.sparkSession
    now = staged(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = staged(spark, both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "lows")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(spark, large, "large-star")
        low = staged(spark, large.groupBy("a").agg(F.min("b").alias("m")), "lows")
        small = (large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        after = staged(spark, small, "edges")
        before, mark, now = mark, _mark(after), after
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
