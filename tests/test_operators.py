"""Operator unit tests on small frames: golden values from FIXTURES.md and properties."""

import datetime as dt
import random
from fractions import Fraction

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricemart.config import Bounds
from pricemart.operators import (
    calendar_fill, forward_fill, keep_first, pct_change, previous_value, priority_merge, quality_counts,
    next_value, ranged, record_is_valid, resample_monthly, source_cascade, split_valid, tag_source, with_surrogate_key,
    with_tie_break,
)
from pricemart.operators.change import calendar_previous
from pricemart.plans.transform import transform
from pricemart.sinks.warehouse import FACT_SCHEMA, conform, insert_if_empty


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_forward_fill_golden_and_two_phase(spark):
    vals = [None, 1.0, None, None, 3.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    for buckets in (1, 2, 3, 8):
        out = forward_fill(df, ["v"], ["i"], buckets=buckets).orderBy("i")
        assert [r.v for r in out.collect()] == [None, 1.0, 1.0, 1.0, 3.0, 3.0]


def test_forward_fill_matches_single_window(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "user_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    ref = ev.select("event_id", F.last("value", True).over(w).alias("ref"))
    got = forward_fill(ev, ["value"], ["ts", "event_id"], by=["user_id"], buckets=7)
    diff = got.join(ref, "event_id").where(~F.col("value").eqNullSafe(F.col("ref")))
    assert diff.count() == 0
    # idempotent and never changes a non-null value
    again = forward_fill(got, ["value"], ["ts", "event_id"], by=["user_id"], buckets=5)
    assert again.join(got.withColumnRenamed("value", "v1"), "event_id").where(
        ~F.col("value").eqNullSafe(F.col("v1"))).count() == 0


def test_calendar_fill_golden(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1), 1.0), (dt.date(2022, 3, 1), 3.0)], "period date, r double")
    out = calendar_fill(df, "period", ["r"], buckets=1).orderBy("period")
    assert rows(out, "period", "r") == [(dt.date(2022, 1, 1), 1.0), (dt.date(2022, 2, 1), 1.0),
                                        (dt.date(2022, 3, 1), 3.0)]


def test_change_golden_and_bucketed_lag(spark):
    df = spark.createDataFrame([(i, "A", p) for i, p in enumerate([100.0, 110.0, 0.0, 50.0])],
                               "i int, k string, p double")
    for buckets in (1, 2, 4):
        out = previous_value(df, "p", ["i"], by=["k"], name="prev", buckets=buckets)
        out = out.withColumn("pct", pct_change("p", "prev")).orderBy("i")
        assert rows(out, "prev", "pct") == [(None, None), (100.0, 10.0), (110.0, -100.0), (0.0, None)]


def test_bucketed_lag_matches_window(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    ref = ev.select("event_id", F.lag("value").over(w).alias("ref"))
    got = previous_value(ev, "value", ["ts", "event_id"], by=["event_type"], name="prev", buckets=9)
    assert got.join(ref, "event_id").where(~F.col("prev").eqNullSafe(F.col("ref"))).count() == 0


def test_calendar_previous(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1), "A", 1.0), (dt.date(2022, 3, 1), "A", 3.0),
                                (dt.date(2022, 4, 1), "A", 4.0)], "period date, k string, p double")
    out = calendar_previous(df, "p", "period", by=["k"], name="prev").orderBy("period")
    assert [r.prev for r in out.collect()] == [None, None, 3.0]


def test_keep_first_deterministic(spark):
    df = spark.createDataFrame([("2022-01", "2024-01-01", 1, 10.0), ("2022-01", "2024-01-02", 2, 11.0),
                                ("2022-01", "2024-01-02", 1, 12.0), ("2022-02", None, 1, 5.0),
                                ("2022-02", "2024-01-01", 2, 6.0)],
                               "period string, fetched_at string, pos int, v double")
    df = df.withColumn("fetched_at", F.to_date("fetched_at"))
    out = keep_first(df, ["period"], [("fetched_at", False), ("pos", True)]).orderBy("period")
    assert rows(out, "period", "v") == [("2022-01", 12.0), ("2022-02", 6.0)]
    # independent of shuffle width and input order
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    out2 = keep_first(df.orderBy(F.rand(7)), ["period"], [("fetched_at", False), ("pos", True)]).orderBy("period")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert rows(out2, "period", "v") == rows(out, "period", "v")


def test_surrogate_key_equals_row_number(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderpriority")
    got = with_surrogate_key(o, ["o_orderpriority", "o_orderkey"], name="id", buckets=6)
    ref = o.select("o_orderkey", F.row_number().over(Window.orderBy("o_orderpriority", "o_orderkey")).alias("ref"))
    j = got.join(ref, "o_orderkey")
    assert j.count() == o.count() and j.where(F.col("id") != F.col("ref")).count() == 0


def test_resample_golden(spark):
    daily = spark.createDataFrame([("2023-01-05", 365.2), ("2023-01-06", 367.6), ("2023-01-07", 0.0),
                                   ("2023-01-08", None), ("2023", 1.0)], "date string, usd_lkr double")
    assert rows(resample_monthly(daily), "period", "usd_lkr_avg", "sample_count") == [("2023-01", 366.4, 2)]


def test_validate_records_golden(spark):
    recs = [("2022-01", 83.41), ("2022-02", 299.99), ("abcd-ef", 50.0), ("2022-1", 1.0), ("2022/01", 1.0),
            ("2022-03", 0.0), ("2022-04", 300.0), ("2022-05", -1.0), ("2022-06", None)]
    df = spark.createDataFrame(recs, "period string, value double")
    valid, removed = split_valid(df, record_is_valid("period", "value", Bounds(0.0, 300.0)))
    assert sorted(rows(valid, "period")) == [("2022-01",), ("2022-02",), ("abcd-ef",)]
    assert removed.count() == 6
    assert rows(quality_counts(df, record_is_valid()), "kept", "removed") == [(3, 6)]


def test_priority_merge_and_cascade(spark):
    a = spark.createDataFrame([("2022-03", "LP_92", 317.0, 0), ("2022-03", "LP_92", 320.0, 1)],
                              "period string, fuel_type string, price_lkr double, _pos long")
    b = spark.createDataFrame([("2022-03", "LP_92", 300.0, 0), ("2022-02", "LP_92", 290.0, 0)],
                              "period string, fuel_type string, price_lkr double, _pos long")
    m = priority_merge([tag_source(a, 0, "scrape"), tag_source(b, 1, "csv")], ["period", "fuel_type"])
    assert sorted(rows(m, "period", "price_lkr", "source")) == [("2022-02", 290.0, "csv"), ("2022-03", 317.0, "scrape")]
    empty = a.limit(0)
    assert sorted(rows(source_cascade([empty, b, a]), "price_lkr")) == [(290.0,), (300.0,)]
    assert rows(source_cascade([empty, empty]), "price_lkr") == []
    assert sorted(rows(source_cascade([empty, b, a], probe=False), "price_lkr")) == [(290.0,), (300.0,)]
    built = []
    lazy = lambda: built.append(1) or a
    assert sorted(rows(source_cascade([b, lazy]), "price_lkr")) == [(290.0,), (300.0,)] and built == []


def test_fact_row_golden(spark):
    bench = spark.createDataFrame([("2022-03", 83.5)], "period string, brent_usd_per_barrel double")
    rates = spark.createDataFrame([("2022-03", 365.4)], "period string, usd_lkr_rate double")
    prices = spark.createDataFrame([("2022-03", " lp_92", 317.0), ("2022-04", "LP_92", 320.0)],
                                   "period string, fuel_type string, price_lkr double")
    res = transform(bench, rates, prices)
    got = {r.period: r for r in res.fact.collect()}
    r = got[dt.date(2022, 3, 1)]
    assert (r.fuel_type, r.price_usd, r.crude_cost_pct) == ("LP_92", 0.8675, 60.54)
    r2 = got[dt.date(2022, 4, 1)]
    assert r2.price_usd is None and r2.crude_cost_pct is None
    assert rows(res.summary, "year", "month", "record_count") == [("2022", "03", 1), ("2022", "04", 1)] or \
        sorted(rows(res.summary, "year", "month", "record_count")) == [("2022", "03", 1), ("2022", "04", 1)]


def test_transform_quarantines_impossible_month(spark):
    bench = spark.createDataFrame([("2022-03", 83.5)], "period string, brent_usd_per_barrel double")
    rates = spark.createDataFrame([("2022-03", 365.4)], "period string, usd_lkr_rate double")
    prices = spark.createDataFrame([("2022-13", "LP_92", 317.0), ("2022-03", "LP_92", 2000.0)],
                                   "period string, fuel_type string, price_lkr double")
    res = transform(bench, rates, prices)
    assert res.fact.count() == 0
    assert sorted((r.period_text, r.value, r.reason) for r in res.quarantine.collect()) == [
        ("2022-03", 2000.0, "out of range"), ("2022-13", 317.0, "impossible month")]


def test_quarantine_holds_all_feeds_with_their_texts(spark):
    meta = "fetched_at string, _pos long"
    bench = spark.createDataFrame([("2022-13", 83.5, "2024-01-02", 3), ("2022-03", None, "2024-01-02", 4), ("2022-04", 80.0, "2024-01-02", 5)],
                                  f"period string, brent_usd_per_barrel double, {meta}")
    rates = spark.createDataFrame([("2022-77", 365.4, "2024-01-02", 1)], f"period string, usd_lkr_rate double, {meta}")
    prices = spark.createDataFrame([("2022-00", " lp_92", 317.0, "2024-01-02", 9), (None, "LP_92", 3.0, "2024-01-02", 8)],
                                   f"period string, fuel_type string, price_lkr double, {meta}")
    res = transform(bench, rates, prices)
    got = sorted(((r.feed, r.period_text, r.label, r.fuel_type, r.value, r.fetched_at, r.position, r.reason) for r in res.quarantine.collect()), key=str)
    assert got == sorted([("benchmark", "2022-13", None, None, 83.5, "2024-01-02", "3", "impossible month"),
                          ("benchmark", "2022-03", None, None, None, "2024-01-02", "4", "missing value"),
                          ("rates", "2022-77", None, None, 365.4, "2024-01-02", "1", "impossible month"),
                          ("prices", "2022-00", " lp_92", "LP_92", 317.0, "2024-01-02", "9", "impossible month"),
                          ("prices", None, "LP_92", "LP_92", 3.0, "2024-01-02", "8", "missing value")], key=str)
    assert res.dim_benchmark.count() == 1 and res.dim_rates.count() == 0 and res.fact.count() == 0


def test_conform_rejects_duplicate_keys_and_long_texts(spark):
    from pricemart.sinks.warehouse import T, varchar
    schema = T.StructType([T.StructField("k", T.IntegerType(), False), varchar("v", 3)])
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (2, "c"), (3, "long"), (None, "x"), (4, None)], "k int, v string")
    ok, bad = conform(df, schema, key=["k"])
    assert sorted(r.k for r in ok.collect()) == [1, 2, 4]
    assert sorted((r.k or 0, r["_reject"]) for r in bad.collect()) == [
        (0, "null in NOT NULL column: k"), (1, "duplicate primary key"), (2, "duplicate primary key"), (2, "duplicate primary key"),
        (3, "text too long: v")]


def test_rounding_is_one_step_and_means_count_what_they_sum(spark):
    from pricemart.functions.exact import exact_mean, round_half_up
    df = spark.createDataFrame([(0.00004999999999,), (0.00005,), (2.675,), (-1.00005,)], "x double")
    assert [r.r for r in df.select(round_half_up("x", 4).alias("r")).collect()] == [0.0, 0.0001, 2.675, -1.0001]

    def mean(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").repartition(3).agg(exact_mean("x").alias("m")).first().m
    assert mean(1e21, 2.0, None) == 5e20 + 1 and mean(1e-9, 3e-9) == 2e-9 and mean(1e300, 1e300) == 1e300
    assert mean(None) is None and mean(float("nan"), 2.0, float("-inf")) == 2.0 and mean(*[0.1] * 10) == 0.1
    assert mean(9.99e19, 1.0) == 4.995e19 and mean(-5e-324) == -5e-324 and mean(0.0, -4.0, 1.0) == -1.0
    values = [random.Random(5).uniform(-1, 1) * 10.0 ** (i % 25 - 9) for i in range(400)]
    exact = sum(map(Fraction, map(repr, values))) / len(values)
    assert mean(*values) == mean(*values[::-1]) and abs(Fraction(mean(*values)) - exact) <= abs(exact) * Fraction(1, 10 ** 15)


def test_conform_overflow_and_insert_if_empty(spark):
    fact = spark.createDataFrame([(1, dt.date(2022, 3, 1), "LP_92", 317.0, 0.0001, 365.4, 83.5, 1234.5)],
                                 "fact_id long, period date, fuel_type string, price_lkr double, price_usd double, "
                                 "usd_lkr_rate double, brent_usd_per_barrel double, crude_cost_pct double")
    ok, bad = conform(fact, FACT_SCHEMA)
    r = ok.collect()[0]
    assert r.crude_cost_pct is None and str(r.price_lkr) == "317.00" and bad.count() == 0
    src = spark.createDataFrame([(1,), (2,)], "x int")
    assert insert_if_empty(src, src.limit(0)).count() == 2
    assert insert_if_empty(src, src).count() == 0


def test_sql_view_matches_dataframe_view(spark):
    import __spark_entry__ as E
    from pricemart.plans import mart
    from pricemart.queries.star import _dims
    fact = E.queries()["fact_prices"](spark, "/root/testdata/sf0.001")
    dates, cats = _dims(spark)
    a = mart.price_vs_benchmark_view(fact, dates, cats)
    b = mart.register_views(spark, fact, dates, cats).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_etl_counts_from_observations(spark):
    from pricemart.plans.etl import run_etl
    from pricemart.plans import ingest
    from pricemart.session import scratch_path
    raw = scratch_path(spark, "raw")
    b = spark.createDataFrame([("2022-03", 83.5, "api")], "period string, value double, source string")
    r = spark.createDataFrame([("2022-03", 365.4, 20)], "period string, usd_lkr_avg double, sample_count long")
    p = spark.createDataFrame([("2022-03", "LP_92", 317.0, "scrape", 0), ("2022-13", "LP_92", 300.0, "scrape", 1)],
                              "period string, fuel_type string, price_lkr double, source string, _pos long")
    for df, name in ((b, "benchmark"), (r, "rates"), (p, "prices")):
        ingest.land(df, f"{raw}/{name}", "2024-01-01")
    out = run_etl(spark, raw, scratch_path(spark, "mart"))
    assert out.counts == {"dim_benchmark": 1, "dim_rates": 1, "quarantine": 1, "fact": 1, "summary": 1, "rejects": 0}
    assert out.read["prices"] == {"rows": 2, "distinct": 2}
    from pricemart.plans.etl import balance
    for r in balance(spark, out).collect():
        assert r.rows_in == r.duplicates + r.quarantined + r.rejected + r.loaded
    assert spark.read.parquet(out.dim_date).count() == 192 and spark.read.parquet(out.dim_fuel_type).count() == 8
    assert spark.table("vw_price_vs_benchmark").count() == 1
    again = run_etl(spark, raw, out.fact.removesuffix("/fact"))          # a second run doesn't insert the dimensions again
    assert spark.read.parquet(again.dim_date).count() == 192
    row = spark.read.parquet(out.fact).first()
    assert (row.fact_id, str(row.price_usd), str(row.crude_cost_pct)) == (1, "0.8675", "60.54")


def test_etl_reports_rejected_dimension_rows(spark):
    from dataclasses import replace

    from pricemart.config import DEFAULT_SPEC
    from pricemart.plans import ingest
    from pricemart.plans.etl import run_etl
    from pricemart.session import scratch_path
    raw = scratch_path(spark, "raw")
    for name, df in (("benchmark", spark.createDataFrame([("2022-03", 83.5)], "period string, value double")),
                     ("rates", spark.createDataFrame([("2022-03", 365.4)], "period string, usd_lkr_avg double")),
                     ("prices", spark.createDataFrame([("2022-03", "LP_92", 317.0, 0)],
                                                      "period string, fuel_type string, price_lkr double, _pos long"))):
        ingest.land(df, f"{raw}/{name}", "2024-01-01")
    spec = replace(DEFAULT_SPEC, category_rows=(("LP_92", "PETROL", "x" * 151), ("LP_95", "PETROL", "a"), ("LP_95", "PETROL", "b"),
                                                ("LAD", None, "c"), ("LSD", "DIESEL", "d")))
    out = run_etl(spark, raw, scratch_path(spark, "mart"), spec)
    rows = [(r.tbl, r.reason) for r in spark.read.parquet(out.rejects).collect()]
    assert sorted(rows) == [("dim_fuel_type", "duplicate primary key"), ("dim_fuel_type", "null in NOT NULL column: fuel_category"),
                            ("dim_fuel_type", "text too long: description")]
    assert out.counts["rejects"] == 3
    assert sorted(r.fuel_type_key for r in spark.read.parquet(out.dim_fuel_type).collect()) == ["LP_95", "LSD"]


def test_hot_series_is_spread_over_buckets(spark):
    """One series holding half of all rows still lands in many ordered buckets (tasks)."""
    df = spark.range(0, 20000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
                                      F.col("id").alias("t"))
    per_bucket = ranged(df, ["k", "t"], 16).where("k = 0").groupBy("_b").count().collect()
    assert len(per_bucket) >= 7
    assert max(r["count"] for r in per_bucket) <= 2 * 20000 / 16 + 200


def test_transform_intent_flags(spark):
    from pricemart.config import MartSpec
    bench = spark.createDataFrame([("2022-01", 80.0), ("2022-02", 81.0), ("2022-03", 82.0)],
                                  "period string, brent_usd_per_barrel double")
    rates = spark.createDataFrame([("2022-01", 360.0), ("2022-03", 370.0)], "period string, usd_lkr_rate double")
    prices = spark.createDataFrame([("2022-02", "lp_92", 300.0, 0), ("2022-02", "LP_92", 310.0, 1)],
                                   "period string, fuel_type string, price_lkr double, _pos long")
    # as written (Q1, Q3): dedupe before UPPER/TRIM keeps both rows; February has no rate
    res = transform(bench, rates, prices)
    got = sorted((r.fuel_type, r.price_lkr, r.usd_lkr_rate) for r in res.fact.collect())
    assert got == [("LP_92", 300.0, None), ("LP_92", 310.0, None)]
    # intent: standardise first (one row per key), calendar fill (February gets January's rate)
    res = transform(bench, rates, prices, MartSpec(standardise_first=True, calendar_fill=True))
    got = sorted((r.fuel_type, r.price_lkr, r.usd_lkr_rate) for r in res.fact.collect())
    assert got == [("LP_92", 300.0, 360.0)]
    assert res.dim_rates.count() == 3


def test_etl_reads_reference_style_envelopes(spark):
    import json
    import os
    from pricemart.plans.etl import run_etl
    from pricemart.session import scratch_path
    raw = scratch_path(spark, "raw-env")
    local = raw[len("file:"):] if raw.startswith("file:") else raw
    feeds = {
        "benchmark": [{"period": "2022-03", "value": 83.5, "source": "api"}],
        "rates": [{"period": "2022-03", "usd_lkr_avg": 365.4, "sample_count": 22}],
        "prices": [{"period": "2022-03", "fuel_type": "LP_92", "price_lkr": 317.0, "source": "scrape"},
                   {"period": "2022-03", "fuel_type": "LP_95", "price_lkr": "bad", "source": "scrape"}],
    }
    for feed, records in feeds.items():
        os.makedirs(f"{local}/{feed}", exist_ok=True)
        with open(f"{local}/{feed}/2024-01-01.json", "w") as fh:
            json.dump({"source": feed, "fetched_at": "2024-01-01", "records": records}, fh, indent=2)
    out = run_etl(spark, raw, scratch_path(spark, "mart-env"), layout="envelope", multiline=True)
    rows_ = spark.read.parquet(out.fact).collect()
    assert [(r.fuel_type, str(r.price_usd)) for r in rows_] == [("LP_92", "0.8675")]


def test_an_empty_rerun_of_a_landed_day_raises(spark):
    import pytest
    from pricemart.plans import ingest
    from pricemart.session import scratch_path
    path = scratch_path(spark, "rerun")
    df = spark.createDataFrame([("2022-01", 1.0)], "period string, value double")
    assert ingest.land(df, path, "2024-01-01").count() == 1
    with pytest.raises(RuntimeError, match="0 records"):
        ingest.land(df.limit(0), path, "2024-01-01")


def test_ingest_benchmark_counts_from_observation(spark):
    from pricemart.plans import ingest
    from pricemart.session import scratch_path
    api = spark.createDataFrame([("2022-01", 83.41, "api"), ("2022-1", 1.0, "api"), ("2022-03", 300.0, "api")],
                                "period string, value double, source string")
    landed, removed, counts = ingest.ingest_benchmark(api, api.limit(0), scratch_path(spark, "bench"), "2024-01-01")
    assert counts == {"kept": 1, "removed": 2}
    assert landed.count() == 1 and removed.count() == 2


def test_forward_fill_range_frame_peers(spark):
    # order 2 has two peers, one non-null: with the RANGE frame both see 5.0
    df = spark.createDataFrame([(0, 1, None), (1, 2, 5.0), (2, 2, None), (3, 3, None), (4, 4, 7.0), (5, 4, None)],
                               "id int, o int, v double")
    for buckets in (1, 2, 3):
        out = forward_fill(df, ["v"], ["o"], frame="range", buckets=buckets).orderBy("id")
        assert [r.v for r in out.collect()] == [None, 5.0, 5.0, 5.0, 7.0, 7.0]


def test_hot_tie_group_is_split(spark):
    """Half of all rows share one order value; with the row-hash tie-break they still spread
    over many buckets, and the bucketed fill equals one window ordered the same way."""
    df = spark.range(0, 20000).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("t"),
        F.when(F.col("id") % 5 == 0, F.col("id").cast("double")).alias("v"))
    assert ranged(df, ["t"], 16).where("t = 0").select("_b").distinct().count() >= 7
    tb = with_tie_break(df)
    w = Window.orderBy("t", "_tb").rowsBetween(Window.unboundedPreceding, 0)
    ref = tb.select("id", F.last("v", True).over(w).alias("ref"))
    got = forward_fill(df, ["v"], ["t"], buckets=16)
    assert got.join(ref, "id").where(~F.col("v").eqNullSafe(F.col("ref"))).count() == 0


def test_results_do_not_depend_on_buckets_or_input_order(spark):
    """Rows that tie on the order key, NULL keys and NULL series: every number of buckets and every
    input order gives the same rows."""
    rows_in = [(i, None if i % 11 == 0 else i % 4, None if i % 13 == 0 else "ABC"[i % 3], float(i) if i % 3 else None)
               for i in range(200)]
    df = spark.createDataFrame(rows_in, "i int, o int, s string, v double")
    ops = [lambda d, n: forward_fill(d, ["v"], ["o"], by=["s"], buckets=n),
           lambda d, n: forward_fill(d, ["v"], ["o"], buckets=n),
           lambda d, n: forward_fill(d, ["v"], ["o"], by=["s"], frame="range", buckets=n),
           lambda d, n: previous_value(d, "v", ["o"], by=["s"], buckets=n),
           lambda d, n: next_value(d, "v", ["o"], buckets=n),
           lambda d, n: with_surrogate_key(d, ["o"], buckets=n)]
    for op in ops:
        results = [sorted(map(tuple, op(d, n).collect()), key=str)
                   for d in (df, df.orderBy(F.rand(3)).repartition(5)) for n in (1, 2, 8)]
        assert all(r == results[0] for r in results) and len(results[0]) == 200


def test_previous_value_tells_null_from_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 4.0)], "i int, v double")
    for n in (1, 4):
        got = previous_value(df, "v", ["i"], name="p", buckets=n).orderBy("i")
        assert [r.p for r in got.collect()] == [None, 1.0, None, 3.0]


def test_calendar_fill_bucketed_per_series(spark):
    rows_in = [(dt.date(2022, m, 1), s, float(m)) for s in ("A", "B") for m in (1, 4, 5, 9) if not (s == "B" and m == 4)]
    df = spark.createDataFrame(rows_in, "period date, s string, r double")
    for buckets in (1, 3):
        out = calendar_fill(df, "period", ["r"], by=["s"], buckets=buckets)
        got = {(r.s, r.period.month): r.r for r in out.collect()}
        assert len(got) == 18                          # months 1..9 for both series
        assert got[("A", 3)] == 1.0 and got[("A", 8)] == 5.0 and got[("B", 4)] == 1.0 and got[("B", 9)] == 9.0


def test_calendar_fill_null_series_and_other_columns(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1), None, 1.0, "a"), (dt.date(2022, 3, 1), None, None, "b"), (None, "S", 9.0, "c"),
                                (dt.date(2022, 5, 1), "S", 2.0, "d"), (dt.date(2022, 5, 1), "S", 2.0, "d")],
                               "period date, s string, r double, note string")
    for buckets in (1, 3):
        got = calendar_fill(df, "period", ["r"], by=["s"], buckets=buckets)
        assert got.columns == df.columns
        assert sorted(((r.s, r.period.month, r.r, r.note) for r in got.collect()), key=str) == sorted(
            [(None, 1, 1.0, "a"), (None, 2, 1.0, None), (None, 3, 1.0, "b"), ("S", 5, 2.0, "d"), ("S", 5, 2.0, "d")], key=str)


def test_calendar_previous_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1), None, 5.0), (dt.date(2022, 1, 1), None, 4.0), (dt.date(2022, 2, 1), None, 6.0)],
                               "period date, k string, p double")
    out = calendar_previous(df, "p", "period", by=["k"], name="prev").orderBy("period", "p")
    assert [(r.p, r.prev) for r in out.collect()] == [(4.0, None), (5.0, None), (6.0, 4.0)]


def test_view_and_function_agree_on_ties(spark):
    """10, 20, 30 in one month and 40 in the next, and a hot category over many ranges: one definition, one window's answer."""
    from pyspark.sql import Window

    from pricemart.operators.keys import with_surrogate_key
    from pricemart.plans import mart
    rows = [(f"2022-{1 + i // 400:02d}-01", "A" if i % 3 else "B", float(i * 7 % 100), i) for i in range(1200)]
    fact = spark.createDataFrame(rows, "p string, fuel_type string, price_lkr double, k int").select(
        F.to_date("p").alias("period"), "fuel_type", "price_lkr", *[F.lit(1.0).alias(c) for c in (
            "price_usd", "brent_usd_per_barrel", "usd_lkr_rate", "crude_cost_pct")], "k")
    loaded = with_surrogate_key(fact, ["period", "fuel_type"], buckets=7, range_name=mart.RANGE)
    dates = mart.dim_date(spark, "2022-01-01", 3)
    cats = spark.createDataFrame([("A", "x"), ("B", "y")], "fuel_type_key string, fuel_category string")
    view = mart.register_views(spark, loaded, dates, cats, "vw_ties")
    plan = spark.sql("EXPLAIN FORMATTED SELECT * FROM vw_ties").first()[0]
    assert "range_no" in plan
    a = sorted((tuple(r) for r in view.collect()), key=str)
    assert a == sorted((tuple(r) for r in mart.price_vs_benchmark_view(loaded, dates, cats).collect()), key=str)
    assert a == sorted((tuple(r) for r in mart.price_vs_benchmark_view(loaded.drop(mart.RANGE), dates, cats, buckets=3).collect()), key=str)
    one = loaded.withColumn("want", F.lag("price_lkr").over(Window.partitionBy("fuel_type").orderBy("fact_id")))
    want = sorted((r.fuel_type, r.price_lkr, -1.0 if r.want is None else r.want) for r in one.collect())
    assert want == sorted((r.fuel_type, r.price_lkr, -1.0 if r.prev_month_price_lkr is None else r.prev_month_price_lkr) for r in view.collect())


def test_calendar_fill_deals_its_rows_once(spark, monkeypatch):
    """One range shuffle and one written table for both the fill and the next month."""
    from pricemart.operators import fill
    calls = []
    real = fill.ranged
    monkeypatch.setattr(fill, "ranged", lambda *a: calls.append(1) or real(*a))
    df = spark.createDataFrame([("a", "2022-01-01", 1.0, "x"), ("a", "2022-04-01", None, "y"), ("a", "2022-04-01", 3.0, "z"), ("b", "2022-02-01", None, "w"),
                                (None, "2022-01-01", 7.0, "v"), (None, "2022-03-01", 8.0, "u"), ("a", None, 5.0, "t")], "s string, p string, v double, k string")
    df = df.withColumn("p", F.col("p").cast("date"))
    for buckets in (1, 5):
        calls.clear()
        out = fill.calendar_fill(df, "p", ["v"], by=["s"], buckets=buckets)
        assert len(calls) == 1
        got = sorted(((r.s or "", str(r.p)[:7], r.k or "") for r in out.collect()))
        assert got == [("", "2022-01", "v"), ("", "2022-02", ""), ("", "2022-03", "u"), ("a", "2022-01", "x"), ("a", "2022-02", ""), ("a", "2022-03", ""),
                       ("a", "2022-04", "y"), ("a", "2022-04", "z"), ("b", "2022-02", "w")]
        assert sorted(r.v for r in out.where("s = 'a' and p < '2022-04-01'").collect()) == [1.0, 1.0, 1.0]
