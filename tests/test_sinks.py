"""Sinks and small helpers: warehouse writes, key checks, overflow counts, look-back months, table helpers."""

import datetime as dt

from pricemart.session import scratch_path
from pricemart.sinks import warehouse as wh
from pricemart.sources.lookback import lookback_filter, month_window


def test_write_table_overwrite_append_partitioned(spark):
    path = scratch_path(spark, "tbl")
    df = spark.createDataFrame([(2022, "A", 1.0), (2023, "B", 2.0)], "year int, k string, v double")
    wh.write_table(df, path, partition_by=["year"], sort_within=["k"])
    wh.write_table(df.limit(1), path, mode="append", partition_by=["year"])
    back = spark.read.parquet(path)
    assert back.count() == 3 and back.where("year = 2023").count() == 1
    wh.write_table(df.limit(1), path, mode="overwrite", partition_by=["year"])
    assert spark.read.parquet(path).count() == 1


def test_write_table_cluster_by(spark):
    path = scratch_path(spark, "clustered")
    df = spark.range(0, 5000).selectExpr("id % 97 AS k", "id AS v").repartition(7)
    wh.write_table(df, path, cluster_by=["k"])
    back = spark.read.parquet(path)
    assert back.count() == 5000
    # files hold contiguous, non-overlapping key ranges
    import pyspark.sql.functions as F
    spans = back.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    spans = sorted((r.lo, r.hi) for r in spans.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_check_unique_and_overflow(spark):
    df = spark.createDataFrame([(1, 2.0, 999.99), (1, 3.0, 1000.0), (2, 4.0, None)], "k int, v double, pct double")
    assert [tuple(r) for r in wh.check_unique(df, ["k"]).collect()] == [(1, 2)]
    schema = wh.T.StructType([wh.T.StructField("pct", wh.T.DecimalType(5, 2))])
    assert wh.overflow_counts(df, schema).first()["pct"] == 1


def test_lookback_and_month_window(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2023, 12, 31),), (dt.date(2024, 1, 2),),
                                (dt.date(2021, 12, 31),)], "d date")
    got = sorted(r.d for r in lookback_filter(df, "d", "2024-01-01", 730).collect())
    assert got == [dt.date(2022, 1, 1), dt.date(2023, 12, 31)]
    p = spark.createDataFrame([("2021-12",), ("2022-01",), ("2024-01",), ("2024-02",)], "period string")
    assert sorted(r.period for r in month_window(p, "period", "2024-01-01", 730).collect()) == ["2022-01", "2024-01"]


def test_a_broken_load_leaves_the_old_star(spark):
    """Two published tables; a load that breaks between them changes nothing, the next one replaces both."""
    import pytest

    from pricemart.sinks import publish
    root = scratch_path(spark, "star")
    assert publish.current(spark, root).number == 0
    with pytest.raises(KeyError):
        publish.read(spark, root, "a")

    def load(value, breaks=False):
        base, version = publish.current(spark, root), publish.new_version(root)
        wh.write_table(spark.createDataFrame([(value,)], "v int"), f"{version}/a")
        if breaks:
            raise RuntimeError("lost")
        wh.write_table(spark.createDataFrame([(value,)], "v int"), f"{version}/b")
        return publish.publish(spark, root, {"a": f"{version}/a", "b": f"{version}/b"}, base)

    load(1)
    old = publish.current(spark, root)
    with pytest.raises(RuntimeError):
        load(2, breaks=True)
    assert [publish.read(spark, root, t).first().v for t in "ab"] == [1, 1]
    load(3)
    assert [publish.read(spark, root, t).first().v for t in "ab"] == [3, 3]
    assert [publish.read(spark, root, t, release=old).first().v for t in "ab"] == [1, 1]      # a reader of the old release goes on
    with pytest.raises(publish.commits.ConflictError):                                         # a load that began before the last one
        publish.publish(spark, root, {}, old)
    load(4)
    assert len(publish.prune(spark, root, keep=1)) >= 2 and publish.read(spark, root, "b").first().v == 4


def test_the_etl_publishes_its_star_at_once(spark, monkeypatch):
    import pytest

    from pricemart.plans import etl, ingest
    from pricemart.sinks import publish
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "mart")

    def feeds(price, day):
        for name, df in (("benchmark", spark.createDataFrame([("2022-03", 83.5)], "period string, value double")),
                         ("rates", spark.createDataFrame([("2022-03", 365.4)], "period string, usd_lkr_avg double")),
                         ("prices", spark.createDataFrame([("2022-03", "LP_92", price, 0)],
                                                          "period string, fuel_type string, price_lkr double, _pos long"))):
            ingest.land(df, f"{raw}/{name}", day)

    feeds(317.0, "2024-01-01")
    etl.run_etl(spark, raw, root)
    feeds(400.0, "2024-01-02")
    summary = etl.monthly_summary
    monkeypatch.setattr(etl, "monthly_summary", lambda fact: 1 / 0)                 # breaks after the fact was written
    with pytest.raises(ZeroDivisionError):
        etl.run_etl(spark, raw, root)
    tables = publish.current(spark, root)
    assert tables.number == 1 and set(tables.tables) == set(etl.OUTPUTS)
    prices = lambda: (float(publish.read(spark, root, "fact").first().price_lkr), float(publish.read(spark, root, "summary").first().avg_price_lkr))
    assert prices() == (317.0, 317.0)
    monkeypatch.setattr(etl, "monthly_summary", summary)
    etl.run_etl(spark, raw, root)
    assert prices() == (400.0, 400.0) and publish.current(spark, root).number == 2
    assert publish.current(spark, root).tables["dim_date"] == tables.tables["dim_date"]        # inserted when empty: the old one stays


def test_an_append_happens_once(spark):
    import pytest

    from pricemart.sinks import ledger
    root = scratch_path(spark, "appended")
    schema = wh.T.StructType([wh.T.StructField("fact_id", wh.T.LongType()), wh.T.StructField("k", wh.T.StringType())])
    assert ledger.read(spark, root, schema).count() == 0
    a, b = (spark.createDataFrame([(x,) for x in xs], "k string") for xs in ("ba", "dce"))
    assert ledger.append_once(a, root, "one", ["k"]).appended
    again = ledger.append_once(a, root, "one", ["k"])
    assert not again.appended and (again.rows, again.first_id, again.last_id) == (2, 1, 2)
    assert ledger.append_once(a.limit(0), root, "none", ["k"]).first_id is None
    # a load that broke before its commit is not seen, and its ids are given again
    real = ledger.commits.commit
    ledger.commits.commit = lambda *x: 1 / 0
    try:
        with pytest.raises(ZeroDivisionError):
            ledger.append_once(b, root, "two", ["k"])
    finally:
        ledger.commits.commit = real
    assert ledger.read(spark, root, schema).count() == 2
    assert ledger.append_once(b, root, "two", ["k"]).last_id == 5
    assert sorted(tuple(r) for r in ledger.read(spark, root, schema).collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]


def test_files_of_the_loaded_fact_hold_spans_of_periods(spark):
    """Files of the fact don't overlap in their ids, and a month's scan carries its filter to them."""
    from pyspark.sql import functions as F

    from pricemart.plans import etl, ingest
    from pricemart.sinks import publish
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "mart")
    months = [f"{2015 + i // 12}-{1 + i % 12:02d}" for i in range(96)]
    for name, df in (("benchmark", spark.createDataFrame([(m, 80.0) for m in months], "period string, value double")),
                     ("rates", spark.createDataFrame([(m, 300.0) for m in months], "period string, usd_lkr_avg double")),
                     ("prices", spark.createDataFrame([(m, f, 300.0 + i, i) for i, m in enumerate(months) for f in ("LP_92", "LAD", "LP_95")],
                                                      "period string, fuel_type string, price_lkr double, _pos long"))):
        ingest.land(df, f"{raw}/{name}", "2024-01-01")
    out = etl.run_etl(spark, raw, root)
    spans = spark.read.parquet(out.fact).groupBy(F.input_file_name().alias("f")).agg(
        F.min("fact_id").alias("lo"), F.max("fact_id").alias("hi"), F.min("period").alias("first"), F.max("period").alias("last")).orderBy("lo").collect()
    assert len(spans) > 3 and all(a.hi < b.lo and a.last <= b.first for a, b in zip(spans, spans[1:]))
    fact = publish.read(spark, root, "fact", wh.FACT_SCHEMA)
    assert fact.columns == wh.FACT_SCHEMA.fieldNames() and fact.count() == 288
    plan = fact.where("period = '2016-05-01'")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(period), EqualTo(period,2016-05-01)]" in plan
    assert fact.where("period = '2016-05-01'").count() == 3
