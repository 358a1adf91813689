"""Extract -> transform -> load: the batch job over landed snapshots.

Actions: one emptiness probe per feed, one write per checked feed and per output.
The checked feeds (one row per key, good or with a reason) and the joined fact are staged once as written tables
in the scratch folder (removed at the end), so the raw-volume work (scans and the dedupe shuffles) runs once per feed and
the joins once; every output reads the staged rows, and a lost executor only
recomputes from the staged files.  Counts come from Observations on the writes.
Nothing is lost silently: rows in = duplicates + quarantined + rejected + loaded, feed by feed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.config import DEFAULT_SPEC, MartSpec
from pricemart.operators.keys import with_surrogate_key
from pricemart.plans import mart
from pricemart.plans.transform import assemble, check_feeds, good_rows, monthly_summary, quarantined
from pricemart.session import job_scratch, staged
from pricemart.sinks import publish
from pricemart.sinks import warehouse as wh
from pricemart.sources import envelope as env


@dataclass
class EtlOutputs:
    dim_benchmark: str
    dim_rates: str
    fact: str
    summary: str
    quarantine: str
    rejects: str
    dim_date: str
    dim_fuel_type: str
    counts: dict = field(default_factory=dict)      # rows written, by output
    read: dict = field(default_factory=dict)        # by feed: rows read, and rows after the dedupe
    overflow: dict = field(default_factory=dict)    # by table: values that don't fit their declared type


OUTPUTS = ("dim_benchmark", "dim_rates", "fact", "summary", "quarantine", "rejects", "dim_date", "dim_fuel_type")


def _observed_write(df: DataFrame, path: str, name: str, counts: dict, cluster_by=(), sort_within=(), partition_by=()) -> None:
    """Write ``df`` and record its row count from an ``Observation`` attached to the
    write itself (no second pass over the data).  The observation sits above the
    layout step: a range repartition runs a sampling job over its input, which
    would otherwise count the rows twice."""
    obs = Observation(f"rows_{name}")
    laid_out = wh.layout(df, cluster_by, sort_within)
    wh.write_table(laid_out.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by=partition_by)
    counts[name] = obs.get["rows"]


def _keep_pos(df: DataFrame) -> list:
    return ["_pos"] if "_pos" in df.columns else []


def read_feeds(spark: SparkSession, raw_root: str, layout: str = "snapshot", multiline: bool = False):
    """The three landed feeds (every snapshot under each folder) as typed frames.

    ``layout='snapshot'`` reads the native Parquet snapshots; ``'envelope'`` reads
    reference-style JSON envelopes (``multiline`` for one object per file)."""
    if layout == "envelope":
        # SC19: values are cast the way the ETL casts them (Spark's cast to double;
        # try_cast so a bad value is NULL instead of an ANSI error).
        b = env.read_envelopes(spark, f"{raw_root}/benchmark", env.BENCHMARK_RECORD, multiline).select(
            "period", F.col("value").try_cast("double").alias("brent_usd_per_barrel"), "fetched_at", "_pos")
        r = env.read_envelopes(spark, f"{raw_root}/rates", env.RATES_RECORD, multiline).select(
            "period", F.col("usd_lkr_avg").try_cast("double").alias("usd_lkr_rate"), "fetched_at", "_pos")
        p = env.read_envelopes(spark, f"{raw_root}/prices", env.PRICES_RECORD, multiline).select(
            "period", "fuel_type", F.col("price_lkr").try_cast("double").alias("price_lkr"), "fetched_at", "_pos")
        return b, r, p
    b = env.read_snapshots(spark, f"{raw_root}/benchmark")
    r = env.read_snapshots(spark, f"{raw_root}/rates")
    p = env.read_snapshots(spark, f"{raw_root}/prices")
    b = b.select("period", F.col("value").cast("double").alias("brent_usd_per_barrel"), "fetched_at", *_keep_pos(b))
    r = r.select("period", F.col("usd_lkr_avg").cast("double").alias("usd_lkr_rate"), "fetched_at", *_keep_pos(r))
    p = p.select("period", "fuel_type", F.col("price_lkr").cast("double").alias("price_lkr"), "fetched_at",
                 *_keep_pos(p))
    return b, r, p


def _load(df: DataFrame, schema: T.StructType, key, path: str, name: str, out: EtlOutputs, rejects: list, cluster_by=(), sort_within=(),
          partition_by=()) -> None:
    """Write the conforming rows of ``df`` (a written table: it is scanned, not computed again); its rejected rows join
    ``rejects``, values that don't fit are counted.  ``partition_by``: columns outside ``schema``, whose values are folders of the table."""
    if key:
        out.overflow[name] = {c: n for c, n in wh.overflow_counts(df, schema).first().asDict().items() if n}
        ok, bad = wh.conform(df, schema, key)
    else:                                               # counted by the write itself, above which rows are dropped
        seen = Observation(f"overflow_{name}")
        flagged = wh.flagged(df.observe(seen, *wh.overflow_columns(df, schema)), schema, partition_by)
        ok, bad = flagged.where("_reject is null").drop("_reject"), wh.flagged(df, schema).where("_reject is not null")
    _observed_write(ok, path, name, out.counts, cluster_by, sort_within, partition_by)
    if not key:
        out.overflow[name] = {c: n for c, n in seen.get.items() if n}
    rejects.append(_reject_rows(bad, schema, name))


def _reject_rows(bad: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    return bad.select(F.lit(name).alias("tbl"), F.to_json(F.struct(*[f.name for f in schema.fields])).alias("row"),
                      F.col("_reject").alias("reason"))


def _insert(df: DataFrame, schema: T.StructType, key, path: str, name: str, old: str | None, rejects: list) -> str:
    """The path of a table that is inserted when empty: ``old`` if that has rows, else ``path`` with the conforming rows of ``df``.
    Rejected rows join ``rejects``."""
    ok, bad = wh.conform(df, schema, key)
    rejects.append(_reject_rows(bad, schema, name))
    if old is not None and not df.sparkSession.read.schema(schema).parquet(old).isEmpty():
        return old
    wh.write_table(ok, path)
    return path


def run_etl(spark: SparkSession, raw_root: str, out_root: str, spec: MartSpec = DEFAULT_SPEC,
            layout: str = "snapshot", multiline: bool = False) -> EtlOutputs:
    """Load the whole star below ``out_root``: both series dimensions, fact, summary, the date and category
    dimensions (inserted when empty), the quarantine of all feeds and the rejects of all tables, and register
    the BI view ``vw_price_vs_benchmark`` over them.

    All tables go to a version folder of this load and are published by one commit at the end (``sinks.publish``): a load
    that breaks leaves the star as it was."""
    base = publish.current(spark, out_root)
    version = publish.new_version(out_root)
    with job_scratch(spark):
        out = _write_star(spark, raw_root, version, base, spec, layout, multiline)
    publish.publish(spark, out_root, {n: getattr(out, n) for n in OUTPUTS}, base)
    mart.register_views(spark, spark.read.parquet(out.fact), spark.read.schema(wh.DATE_DIM_SCHEMA).parquet(out.dim_date),
                        spark.read.schema(wh.CATEGORY_DIM_SCHEMA).parquet(out.dim_fuel_type))
    return out


def _write_star(spark: SparkSession, raw_root: str, version: str, base: publish.Release, spec: MartSpec, layout: str, multiline: bool) -> EtlOutputs:
    feeds = dict(zip(("benchmark", "rates", "prices"), read_feeds(spark, raw_root, layout, multiline)))
    for name, df in feeds.items():
        env.require_rows(df, name)
    out = EtlOutputs(*(f"{version}/{n}" for n in OUTPUTS))
    c, rejects = out.counts, []

    # Each raw feed is scanned and shuffled once; every output below reads the staged tables.
    rows_in = {n: Observation(f"in_{n}") for n in feeds}
    checked = check_feeds(*(df.observe(rows_in[n], F.count(F.lit(1)).alias("rows")) for n, df in feeds.items()), spec)
    staged_feeds = []
    for name, df in zip(feeds, checked):
        kept = Observation(f"kept_{name}")
        staged_feeds.append(staged(spark, df.observe(kept, F.count(F.lit(1)).alias("rows")), f"checked-{name}"))
        out.read[name] = {"rows": rows_in[name].get["rows"], "distinct": kept.get["rows"]}
    benchmark, rates, prices = good_rows(tuple(staged_feeds), spec)

    # Dimensions first (conformed to the declared types), then facts.
    _load(benchmark, wh.BENCHMARK_DIM_SCHEMA, wh.PERIOD_KEY, out.dim_benchmark, "dim_benchmark", out, rejects, sort_within=["period"])
    _load(rates, wh.RATES_DIM_SCHEMA, wh.PERIOD_KEY, out.dim_rates, "dim_rates", out, rejects, sort_within=["period"])
    out.dim_date = _insert(mart.dim_date(spark, spec=spec), wh.DATE_DIM_SCHEMA, wh.DATE_DIM_KEY, out.dim_date, "dim_date",
                           base.tables.get("dim_date"), rejects)
    out.dim_fuel_type = _insert(mart.dim_category(spark, spec.category_rows), wh.CATEGORY_DIM_SCHEMA, wh.CATEGORY_DIM_KEY, out.dim_fuel_type,
                                "dim_fuel_type", base.tables.get("dim_fuel_type"), rejects)
    _observed_write(quarantined(tuple(staged_feeds)), out.quarantine, "quarantine", c)
    # The two joins of the fact run once, here; ids, rejects and the summary read what they gave.
    fact = staged(spark, assemble(benchmark, rates, prices, spec), "fact")
    # One folder for each range of its key: a file holds a span of periods, so a scan of some months skips the others by
    # their footers, and the view's ranges are the folders.
    keyed = staged(spark, with_surrogate_key(fact, ["period", "fuel_type"], name="fact_id", range_name=mart.RANGE), "keyed-fact")
    _load(keyed, wh.FACT_SCHEMA, (), out.fact, "fact", out, rejects, sort_within=[mart.RANGE, "fact_id"],
          partition_by=[mart.RANGE])                                # fact_id is unique
    _load(staged(spark, monthly_summary(fact), "summary"), wh.SUMMARY_SCHEMA, wh.SUMMARY_KEY, out.summary, "summary", out, rejects,
          cluster_by=["year", "month"])
    every = rejects[0]
    for r in rejects[1:]:
        every = every.unionByName(r)
    _observed_write(every, out.rejects, "rejects", c)
    return out


def balance(spark: SparkSession, out: EtlOutputs) -> DataFrame:
    """One row per feed: rows_in = duplicates + quarantined + rejected + loaded."""
    quarantine = spark.read.parquet(out.quarantine).groupBy("feed").agg(F.count(F.lit(1)).alias("n"))
    bad = {r.feed: r.n for r in quarantine.collect()}                               # three rows
    rejects = {r.tbl: r.n for r in spark.read.parquet(out.rejects).groupBy("tbl").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = {"benchmark": "dim_benchmark", "rates": "dim_rates", "prices": "fact"}
    rows = [(feed, n["rows"], n["rows"] - n["distinct"], bad.get(feed, 0), rejects.get(table[feed], 0), out.counts[table[feed]])
            for feed, n in out.read.items()]
    return spark.createDataFrame(rows, "feed string, rows_in long, duplicates long, quarantined long, rejected long, loaded long")
