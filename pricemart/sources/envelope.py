"""Snapshot envelopes: ``{source, fetched_at, records: [...]}`` JSON documents.

The reference lands one multi-line JSON object per feed and day and reads the
whole directory back.  Here:
  * ``read_envelopes`` reads envelopes with an explicit schema (no inference, so an
    empty ``records`` array cannot break the schema), ``posexplode``s the records
    and keeps ``fetched_at`` and the record position for deterministic dedupe;
    ``multiline=True`` reads the reference's layout of objects over several lines (a large file by many tasks, its texts
    staged), the default reads JSON Lines (one envelope per line, splittable);
  * ``write_envelopes`` writes JSON Lines envelopes partitioned by ``fetched_at``;
    a day's records are numbered in their listed order and cut into envelopes of at most ``max_records``,
    so no single row or task has to hold a whole day and the order survives a round trip;
  * files are scanned as text for their top-level objects, so no object is skipped: several objects in a file or on a line
    are all read, with ``multiline=True`` in files of either layout.  An object that isn't an envelope, or what else
    a file holds, stops the read or, if so wished, is kept with its path (``corrupt_envelopes``);
  * ``write_snapshot``/``read_snapshots`` are the native layout: Parquet, one row
    per record, partitioned by ``fetched_at`` with dynamic partition overwrite
    (a same-day re-run replaces that day only) and partition pruning on read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.operators.keys import with_surrogate_key
from pricemart.session import staged

BENCHMARK_RECORD = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("source", T.StringType()),
])
RATES_RECORD = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("usd_lkr_avg", T.StringType()),
    T.StructField("sample_count", T.StringType()),
])
PRICES_RECORD = T.StructType([
    T.StructField("period", T.StringType()),
    T.StructField("fuel_type", T.StringType()),
    T.StructField("price_lkr", T.StringType()),
    T.StructField("source", T.StringType()),
])


def envelope_schema(record: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("records", T.ArrayType(record)),
    ])


_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'          # a JSON string; it holds no line breaks
_SPACE = " \t\n\x0b\f\r"                           # what \s matches


def _lines(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    return spark.read.text(path if isinstance(path, str) else list(path), **options)


def _stretches(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, value): the files' texts, cut where a line that begins with ``{`` follows one that ends with ``}``.

    Spark splits the files at such lines, so no task holds a file, however long; a text is as long as its object.  Where
    the line before has no end brace, or a string is open, the texts are put together again.  Places are numbered while the
    texts are staged, as a second read of the files could split them otherwise."""
    value = F.col("value")
    quotes = F.regexp_replace(value, r'\\.', "")
    parts = _lines(spark, path, lineSep="\n{").select(
        F.input_file_name().alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value",
        F.endswith(F.rtrim(value, F.lit(_SPACE)), F.lit("}")).alias("ends"),
        ((F.length(quotes) - F.length(F.replace(quotes, F.lit('"')))) % 2).alias("odd"))
    parts = staged(spark, parts, "stretches")
    order = Window.partitionBy("path").orderBy("block", "n")       # short rows; the texts join later
    closed = parts.select("path", "block", "n", "ends", (F.sum("odd").over(order) % 2 == 0).alias("closed"))
    begins = F.coalesce(F.lag(F.col("ends") & F.col("closed")).over(order), F.lit(True))
    numbered = closed.select("path", "block", "n", begins.cast("int").alias("begins")).select(
        "path", "block", "n", F.sum("begins").over(order).alias("object"))
    whole = parts.join(numbered, ["path", "block", "n"]).groupBy("path", "object").agg(
        F.sort_array(F.collect_list(F.struct("block", "n", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n{")
    return whole.select("path", F.when(F.col("object") > 1, F.concat(F.lit("{"), text)).otherwise(text).alias("value"))


def scan_objects(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """(path, text, whole) of every top-level object of the files, and of anything else that stands between them.

    A begin brace right after an end brace (white space aside) only stands between top-level objects, so texts are cut
    there, strings passed over.  ``whole``: it is one balanced object with nothing before or after it."""
    lines = _stretches(spark, path) if multiline else _lines(spark, path).select(F.input_file_name().alias("path"), "value")
    parted = F.regexp_replace("value", rf"({_STRING})|(\}})\s*+(?=\{{)", "$1$2\n")       # also after strings, where it is white space
    some = F.filter(F.split(parted, r"(?<=\})\n(?=\{)"), lambda t: ~F.rlike(t, F.lit(r"^[\s\x{FEFF}]*$")))
    # outer, as for an inner explode Spark filters by the array's size and computes the array twice; the filter stays right above it
    objects = lines.select("path", F.explode_outer(some).alias("text")).where(F.col("text").isNotNull())
    bare = F.regexp_replace(F.regexp_replace("text", _STRING, "0"), r"^\x{FEFF}", "")
    # its own projection: the conditions below would each compute it again
    objects = objects.select("path", F.regexp_replace("text", r"^\x{FEFF}", "").alias("text"), bare.alias("bare"))
    bare = F.col("bare")

    def count(ch):
        return F.length(bare) - F.length(F.replace(bare, F.lit(ch), F.lit("")))
    # an unended string leaves its quote; after an object's end only a comma, an end or nothing may stand
    good = (F.rlike(bare, F.lit(r"^\s*\{")) & F.endswith(F.rtrim(bare, F.lit(_SPACE)), F.lit("}")) & ~F.contains(bare, F.lit('"'))
            & ~F.rlike(bare, F.lit(r"\}\s*+[^\s,\]}]")) & (count("{") == count("}")) & (count("[") == count("]")))
    return objects.select("path", "text", good.alias("whole"))


def _parsed(spark: SparkSession, path: str | Sequence[str], record: T.StructType, multiline: bool) -> DataFrame:
    schema = envelope_schema(record).add("_corrupt", T.StringType())
    parsed = F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = scan_objects(spark, path, multiline).withColumn("e", parsed)
    return out.withColumn("bad", ~F.col("whole") | F.col("e").isNull() | F.col("e._corrupt").isNotNull())


def corrupt_envelopes(spark: SparkSession, path: str | Sequence[str], record: T.StructType, multiline: bool = False) -> DataFrame:
    """(path, text) of what isn't an envelope in the files: the quarantine beside ``read_envelopes(..., corrupt="keep")``."""
    return _parsed(spark, path, record, multiline).where("bad").select("path", "text")


def read_envelopes(spark: SparkSession, path: str | Sequence[str], record: T.StructType,
                   multiline: bool = False, corrupt: str = "fail") -> DataFrame:
    """Envelope files -> one row per record: record fields (as typed in ``record``),
    ``envelope_source``, ``fetched_at`` (DATE) and ``_pos`` = (part, index).

    ``multiline``: objects may go over several lines (files of JSON Lines are read right too).  What isn't an envelope stops the
    read, or is left to ``corrupt_envelopes`` with ``corrupt="keep"``."""
    if corrupt not in ("fail", "keep"):
        raise ValueError("corrupt must be 'fail' or 'keep'")
    df = _parsed(spark, path, record, multiline)
    if corrupt == "keep":
        df = df.where(~F.col("bad"))
    else:
        stop = F.raise_error(F.concat(F.lit("malformed envelope in "), F.col("path"), F.lit(": "), F.substring("text", 1, 200)))
        df = df.withColumn("e", F.when(F.col("bad"), stop.cast(df.schema["e"].dataType)).otherwise(F.col("e")))
    ex = df.select("e.source", "e.fetched_at", "e.part", "e.records").select(      # outer: see scan_objects
        F.col("source").alias("envelope_source"), "fetched_at", "part", F.posexplode_outer("records").alias("_idx", "r"))
    ex = ex.where(F.col("_idx").isNotNull())
    return ex.select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in record.fields],
        "envelope_source",
        F.try_to_date("fetched_at", "yyyy-MM-dd").alias("fetched_at"),
        F.struct(F.coalesce("part", F.lit(0)).alias("part"), F.col("_idx").cast("long").alias("idx")).alias("_pos"),
    )


def write_envelopes(records: DataFrame, path: str, source: str, fetched_at: str = "fetched_at",
                    order: Sequence[str] = (), max_records: int = 5000, mode: str = "overwrite") -> None:
    """Write ``records`` (with a ``fetched_at`` text column) as JSON Lines envelopes,
    one folder per ``fetched_at``; a day's records, in the order of ``order`` (ties and no order: of a row
    hash), are cut into envelopes of exactly ``max_records`` and a smaller last one."""
    payload = [c for c in records.columns if c != fetched_at]
    listed = with_surrogate_key(records, [fetched_at, *order], name="_n")
    first = listed.groupBy(F.col(fetched_at).alias("_d")).agg(F.min("_n").alias("_first"))
    chunked = listed.join(first, F.col(fetched_at).eqNullSafe(F.col("_d"))).withColumn(
        "part", F.floor((F.col("_n") - F.col("_first")) / max_records).cast("long"))
    env = chunked.groupBy(fetched_at, "part").agg(
        F.sort_array(F.collect_list(F.struct("_n", F.struct(*payload).alias("_r")))).alias("_rs"))
    out = env.select(F.lit(source).alias("source"), F.col(fetched_at).alias("fetched_at"), "part",
                     F.transform("_rs", lambda x: x["_r"]).alias("records"),
                     F.col(fetched_at).alias("_day"))
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("_day").json(path))


def write_snapshot(records: DataFrame, path: str, fetched_at: str = "fetched_at") -> None:
    """Native snapshot sink: Parquet partitioned by ``fetched_at``; re-running a day
    overwrites only that day's partition (dynamic partition overwrite)."""
    (records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(fetched_at).parquet(path))


def read_snapshots(spark: SparkSession, path: str, since: str | None = None, fetched_at: str = "fetched_at") -> DataFrame:
    """All snapshots under ``path`` (the union of every day); ``since`` prunes partitions."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.where(F.col(fetched_at) >= F.lit(since).cast(df.schema[fetched_at].dataType))
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when a feed is empty (one cheap probe: ``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        raise RuntimeError(f"{what}: 0 records; check that ingestion ran")
    return df
