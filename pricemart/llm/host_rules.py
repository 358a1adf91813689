"""Quality rules with host verdicts, with DataFrame functions only.

Each document's counts come from its own text, inside its row.  Rule failures are then summed by host (one row per
host, after a partial sum in every task); each rule's failure rate is shrunk towards the mean of all hosts with a beta
prior whose strength comes from the spread of the hosts' rates; a host whose shrunk rate passes ``max_rate`` in any rule
fails, and its verdict is joined back to its documents.

Defined cases: null and empty texts have no words, so they fail the base rule; null hosts are one host; repeated rows each
count; with no spread between hosts the prior has the strength ``EVEN``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemart.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8                  # words of a repeated window
EVEN = 100.0                # strength of the prior when all hosts have one rate


def _let(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that are in the text twice or more."""

    def covered(marked: Column) -> Column:      # sorted starts of the repeated windows
        own = F.transform(marked, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(marked, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    def starts(pairs: Column) -> Column:        # (hash, start) in order: equal hashes are neighbours
        same = F.filter(pairs, lambda x, j: F.coalesce(F.get(pairs, j - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(pairs, j + 1)["h"] == x["h"], F.lit(False)))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def counted(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            _let(pairs, lambda p: _let(starts(p), covered)))

    def windows(ids: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(ids) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ids, i, WINDOW)))

    return F.when(F.size(words) < WINDOW + 1, 0).otherwise(
        _let(F.transform(words, lambda w: F.xxhash64(w)), lambda ids: _let(windows(ids), counted)))


def counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of a text."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    lines = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    words = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("rep")))
    return _let(F.struct(words.alias("w"), lines.alias("l")), lambda x: F.struct(
        x["w"]["n"].cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        x["l"]["n"].cast("long").alias("n_lines"),
        x["l"]["dup"].cast("long").alias("n_dup_lines"),
        x["w"]["rep"].cast("long").alias("n_repeat_words")))


#: rule name -> failure, over the columns of ``counts``
RULES = {
    "short": "n_words < 20",
    "repetitive": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE = ("short", "repetitive")


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Beta prior (a, b) of each rule by the moments of the hosts' rates; ``hosts`` has n and one count per rule."""
    rate = {r: F.col(r) / F.col("n") for r in RULES}
    row = hosts.agg(*[F.avg(x).alias(f"m_{r}") for r, x in rate.items()], *[F.var_pop(x).alias(f"v_{r}") for r, x in rate.items()]).first()
    out = {}
    for r in RULES:
        m, v = row[f"m_{r}"] or 0.0, row[f"v_{r}"] or 0.0
        strength = max(m * (1 - m) / v - 1, 0.01) if v > 1e-12 else EVEN
        out[r] = m * strength, (1 - m) * strength
    return out


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_rate: float = 0.5,
          id_col: str = "doc_id") -> DataFrame:
    """doc_id, host, the counts, one boolean per rule, base_failed, host_failed and kept of each document."""
    spark = docs.sparkSession
    x = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), counts(F.col(text_col)).alias("c"))
    x = x.select("doc_id", "host", "c.*").withColumns({r: F.expr(e) for r, e in RULES.items()})
    x = staged(spark, x, "rule-counts")         # texts are read once; what follows reads these few columns
    hosts = x.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    hosts = staged(spark, hosts, "host-counts")
    bad = F.lit(False)
    for r, (a, b) in priors(hosts).items():
        bad = bad | ((F.col(r) + F.lit(a)) / (F.col("n") + F.lit(a + b)) > max_rate)
    verdicts = hosts.select(F.col("host").alias("_h"), bad.alias("host_failed"))
    base = F.col(BASE[0]) | F.col(BASE[1])
    return (x.join(verdicts, F.col("host").eqNullSafe(F.col("_h")), "left").drop("_h")
            .withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def report(docs: DataFrame, host_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept of each document."""
    return judge(docs, host_col, text_col, id_col=id_col).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
