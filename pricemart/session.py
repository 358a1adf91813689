"""Session helpers: a configured SparkSession and a shared scratch folder.

On a cluster the scratch folder is the shared ``spark.checkpoint.dir`` the
cluster names; without that setting a cluster run stops with an error.  A folder
of our own is set only on a local master (tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Generated methods above 8000 bytes of bytecode are never JIT-compiled by HotSpot;
    # let Spark fall back per stage instead of running them interpreted (~30% on the
    # parsing queries), and let the JIT compile the large ones that remain.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}

RUNTIME_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_conf(spark: SparkSession) -> None:
    """SQL settings the library relies on that can be set on an existing session."""
    for k, v in RUNTIME_SQL_CONF.items():
        spark.conf.set(k, v)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pricemart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only when unset on a local master.

    Works on classic sessions (``SparkContext.setCheckpointDir``) and on sessions
    without a SparkContext handle (Spark Connect), where the folder is only used
    as the root of the library's scratch paths."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext on the client)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="pricemart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_made: ContextVar[list[str] | None] = ContextVar("pricemart_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/pricemart-scratch/{name}-{uuid.uuid4().hex[:12]}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders that are made inside this block are removed at its end, whether it succeeds or not.

    Only those: what a caller made before, what live DataFrames read and what other applications keep below the
    same checkpoint folder stays.  Frames made inside the block can't be read after it."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lies; a missing one is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the scratch folder and read it back: what follows doesn't compute it again, and a
    lost executor re-reads the files."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def default_parallelism(spark: SparkSession) -> int:
    """Shuffle width the session is configured for."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        return int(os.environ.get("PRICEMART_PARTITIONS", "200"))
