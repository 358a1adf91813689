"""Warehouse tables: declared schemas, conforming casts, full-refresh and append loads.

The declared schemas are the star's DDL (types, text lengths, NOT NULL, primary key).
``conform`` casts a frame to a declared schema (a value that does not fit, e.g.
DECIMAL(5,2) overflow, becomes NULL and can be counted), and routes rows that break
NOT NULL, a text length or the primary key to a rejects frame.  Loads overwrite the data only, never
the table definition (Q11).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def varchar(name: str, length: int, nullable: bool = True) -> T.StructField:
    """A text column of at most ``length`` bytes."""
    return T.StructField(name, T.StringType(), nullable, {"length": length})


DATE_DIM_SCHEMA = T.StructType([
    T.StructField("date_key", T.DateType(), False),
    T.StructField("year", T.ShortType(), False),
    T.StructField("quarter", T.ShortType(), False),
    T.StructField("month", T.ShortType(), False),
    varchar("month_name", 10, False),
    T.StructField("is_crisis_period", T.BooleanType(), True),
])
CATEGORY_DIM_SCHEMA = T.StructType([
    varchar("fuel_type_key", 30, False),
    varchar("fuel_category", 20, False),
    varchar("description", 150),
])
BENCHMARK_DIM_SCHEMA = T.StructType([
    T.StructField("period", T.DateType(), False),
    T.StructField("brent_usd_per_barrel", T.DecimalType(8, 2), False),
])
RATES_DIM_SCHEMA = T.StructType([
    T.StructField("period", T.DateType(), False),
    T.StructField("usd_lkr_rate", T.DecimalType(10, 4), False),
])
FACT_SCHEMA = T.StructType([
    T.StructField("fact_id", T.LongType(), False),
    T.StructField("period", T.DateType(), False),
    varchar("fuel_type", 30, False),
    T.StructField("price_lkr", T.DecimalType(10, 2), False),
    T.StructField("price_usd", T.DecimalType(10, 4), True),
    T.StructField("usd_lkr_rate", T.DecimalType(10, 4), True),
    T.StructField("brent_usd_per_barrel", T.DecimalType(8, 2), True),
    T.StructField("crude_cost_pct", T.DecimalType(5, 2), True),
])
SUMMARY_SCHEMA = T.StructType([
    T.StructField("year", T.ShortType(), False),
    T.StructField("month", T.ShortType(), False),
    varchar("fuel_type", 30, False),
    T.StructField("avg_price_lkr", T.DecimalType(10, 2), True),
    T.StructField("avg_brent_usd", T.DecimalType(8, 2), True),
    T.StructField("avg_usd_lkr", T.DecimalType(10, 4), True),
    T.StructField("record_count", T.IntegerType(), True),
])


#: primary keys of the declared tables
DATE_DIM_KEY, CATEGORY_DIM_KEY, PERIOD_KEY, SUMMARY_KEY = ["date_key"], ["fuel_type_key"], ["period"], ["year", "month", "fuel_type"]


def _cast(df: DataFrame, schema: T.StructType) -> list[Column]:
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]


def flagged(df: DataFrame, schema: T.StructType, also: Sequence[str] = ()) -> DataFrame:
    """Every row of ``df`` cast to ``schema``, with ``_reject``: why it can't be loaded (NULL: it can), keys aside.
    ``also``: columns that are kept as they are."""
    reason = F.lit(None).cast("string")
    for f in schema.fields:
        if "length" in f.metadata:
            reason = F.when(F.octet_length(f.name) > f.metadata["length"], f"text too long: {f.name}").otherwise(reason)
    for f in schema.fields:
        if not f.nullable:
            reason = F.when(F.col(f.name).isNull(), f"null in NOT NULL column: {f.name}").otherwise(reason)
    return df.select(*_cast(df, schema), *also).withColumn("_reject", reason)


def conform(df: DataFrame, schema: T.StructType, key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Cast ``df`` to ``schema`` -> (conforming rows, rejected rows with ``_reject``, the reason).

    A value that cannot be represented becomes NULL (``try_cast``); a NULL in a NOT
    NULL column, a text longer than its declared length and a further row of the same primary ``key``
    reject the row, so conforming and rejected rows together are the rows of ``df``.  Of rows with one
    key the one with the smallest row hash stays."""
    names = [f.name for f in schema.fields]
    rows = flagged(df, schema)
    ok, rejected = rows.where("_reject is null").drop("_reject"), rows.where("_reject is not null")
    if not key:
        return ok, rejected
    hashed = ok.withColumn("_h", F.xxhash64(*names))
    several = hashed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("_h").alias("_low")).where("_n > 1")
    joined = hashed.join(several, list(key), "left")
    twins = joined.where("_n is not null").groupBy(*names, (F.col("_h") == F.col("_low")).alias("_first")).agg(F.count(F.lit(1)).alias("_c"))
    further = twins.withColumn("_reject", F.explode(F.array_repeat(
        F.lit("duplicate primary key"), (F.col("_c") - F.col("_first").cast("int")).cast("int"))))
    ok = joined.where("_n is null").select(*names).unionByName(twins.where("_first").select(*names))
    return ok, rejected.unionByName(further.select(*names, "_reject"))


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary-key violations: key values that occur more than once (with counts)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def overflow_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many non-null values do not fit the declared type (one row)."""
    return df.agg(*overflow_columns(df, schema))


def overflow_columns(df: DataFrame, schema: T.StructType) -> list[Column]:
    return [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
            for f in schema.fields if f.name in df.columns]


def layout(df: DataFrame, cluster_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> DataFrame:
    """File layout before a write: range clustering + sort, or a sort inside partitions."""
    if cluster_by:
        return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    if sort_within:
        return df.sortWithinPartitions(*sort_within)
    return df


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                sort_within: Sequence[str] = (), cluster_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Full refresh (``overwrite``) or ``append`` of a table's data at ``path``.

    Layout (the warehouse's distribution/sort keys, re-aimed for files):
    ``cluster_by`` range-partitions the rows by those columns and sorts each
    partition (contiguous, sorted files: Parquet min/max statistics then skip
    files for range predicates on them); ``sort_within`` only sorts inside the
    existing partitions (no shuffle); ``partition_by`` writes one folder per value
    of a coarse column (partition pruning)."""
    writer = layout(df, cluster_by, sort_within).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "overwrite",
               num_partitions: int | None = None, batch_size: int = 10000) -> None:
    """JDBC load that keeps the target's DDL: overwrite uses ``truncate`` (Q11)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if mode == "overwrite":
        w = w.option("truncate", "true")
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def insert_if_empty(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows to insert into ``target``: all of ``source`` when ``target`` is empty, else none.

    ``NOT EXISTS (SELECT 1 FROM target LIMIT 1)``: a one-row probe of the target
    (``limit(1)``), then a left-anti join on a constant key; the probe side has at
    most one row, so it is broadcast."""
    probe = F.broadcast(target.limit(1).select(F.lit(1).alias("_probe")))
    return (source.withColumn("_probe", F.lit(1))
                  .join(probe, on="_probe", how="left_anti")
                  .drop("_probe"))


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, empty when there is none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def load_if_empty(source: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Append ``source`` to the table at ``path`` when that has no rows; returns the table."""
    spark = source.sparkSession
    insert_if_empty(source, read_if_there(spark, path, schema)).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
