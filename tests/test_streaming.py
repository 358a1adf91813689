"""Incremental snapshot folding with Structured Streaming."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.session import scratch_path
from pricemart.sources.envelope import write_snapshot
from pricemart.streaming import fold_latest

SCHEMA = T.StructType([T.StructField("period", T.StringType()), T.StructField("v", T.DoubleType()),
                       T.StructField("_pos", T.LongType()), T.StructField("fetched_at", T.DateType())])


def test_fold_latest_is_incremental(spark):
    raw, state, ckpt = (scratch_path(spark, n) for n in ("raw", "state", "ckpt"))
    day1 = spark.createDataFrame([("2022-01", 1.0, 0), ("2022-02", 2.0, 0)], "period string, v double, _pos long")
    write_snapshot(day1.withColumn("fetched_at", F.lit("2024-01-01")), raw)
    order = [("fetched_at", False), ("_pos", True)]
    out = fold_latest(spark, raw, SCHEMA, ["period"], order, state, checkpoint=ckpt)
    assert sorted((r.period, r.v) for r in out.collect()) == [("2022-01", 1.0), ("2022-02", 2.0)]
    day2 = spark.createDataFrame([("2022-01", 9.0, 1), ("2022-01", 8.0, 0)], "period string, v double, _pos long")
    write_snapshot(day2.withColumn("fetched_at", F.lit("2024-01-02")), raw)
    out = fold_latest(spark, raw, SCHEMA, ["period"], order, state, checkpoint=ckpt)
    assert sorted((r.period, r.v) for r in out.collect()) == [("2022-01", 8.0), ("2022-02", 2.0)]
    # two micro-batches, one per landing: the second saw only the new day's files
    versions = sorted(r[0] for r in spark.read.parquet(state).select("state_version").distinct().collect())
    assert len(versions) == 2


def test_a_stream_that_starts_anew_sees_later_rows(spark):
    """Another checkpoint (its batches count from 0 again), and the default one of two runs."""
    order = [("fetched_at", False), ("_pos", True)]

    def land(raw, value, day):
        write_snapshot(spark.createDataFrame([("2022-01", value, 0)], "period string, v double, _pos long").withColumn("fetched_at", F.lit(day)), raw)

    for checkpoints in (["a", "b", "c", "d"], [None] * 4):
        raw, state, base = (scratch_path(spark, n) for n in ("raw", "state", "ckpt"))
        for i, c in enumerate(checkpoints):
            land(raw, float(i), f"2024-01-0{i + 1}")
            out = fold_latest(spark, raw, SCHEMA, ["period"], order, state, checkpoint=c and f"{base}/{c}")
            assert [r.v for r in out.collect()] == [float(i)]
        assert spark.read.parquet(state).select("state_version").distinct().count() == 2           # older ones are removed


def test_only_a_missing_path_means_no_state(spark):
    import os
    import pytest
    from pricemart.session import scratch_path
    from pricemart.streaming.snapshots import latest_version
    path = scratch_path(spark, "state")
    assert latest_version(spark, path) is None
    folder = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(f"{folder}/state_version=1")
    with open(f"{folder}/state_version=1/part-0.parquet", "w") as fh:
        fh.write("not a table")
    with pytest.raises(Exception):
        latest_version(spark, path)


def test_a_cluster_needs_a_shared_folder():
    import pytest
    from pricemart.session import ensure_checkpoint_dir

    class Cluster:
        master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda k, d=None: d)

        def getCheckpointDir(self):
            return None

    Cluster.sparkContext = Cluster()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())
