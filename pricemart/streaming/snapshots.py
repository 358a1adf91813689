"""Fold newly landed snapshot files into a "latest row per key" table, incrementally.

The reference re-reads its whole raw directory on every run (SRC15).  Here a
file-source stream over the native snapshot folder (Parquet partitioned by
``fetched_at``) picks up only files it has not seen (the stream's checkpoint
remembers them), and each micro-batch is folded into the current state with
the same deterministic ``keep_first`` as the batch job: state = keep_first(state
UNION batch).  State versions are folders of their own (``state_version=<n>``), written under another name and
renamed when whole, so a batch never overwrites the table it reads and a version is there wholly or not at all.  The next version is
the largest + 1, whatever the stream's own batch numbers: a batch that is run again, or a stream that starts anew because
its checkpoint is lost, folds the same rows again, which changes nothing.  The checkpoint lies beside the state, so
another application goes on where the last one stopped.  The state has one row per key, not per landed record; versions
before the last ``keep`` are removed.

Cost: every micro-batch rewrites the whole state (O(keys), not O(history)); for
key spaces much larger than the batches, run the fold per coarse key range
(several state paths) so a batch rewrites only the ranges it touches.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.operators.dedupe import keep_first
from pricemart.session import remove_path
from pricemart.sinks import commits


def versions(spark: SparkSession, state_path: str) -> list[int]:
    """Numbers of the state versions under ``state_path``, oldest first."""
    names = (re.fullmatch(r"state_version=(\d+)", n) for n in commits.folders(spark, state_path))
    return sorted(int(m.group(1)) for m in names if m)


def latest_version(spark: SparkSession, state_path: str) -> DataFrame | None:
    """The newest state version under ``state_path`` (None before the first batch)."""
    found = versions(spark, state_path)
    return spark.read.parquet(f"{state_path}/state_version={found[-1]}") if found else None


def fold_latest(spark: SparkSession, raw_path: str, schema: T.StructType, keys: Sequence[str],
                order: Sequence[tuple[str, bool]], state_path: str, checkpoint: str | None = None,
                max_files_per_trigger: int | None = None, keep: int = 2) -> DataFrame:
    """Run the stream until every landed file is processed (``availableNow``) and return
    the latest state.  ``schema`` must include the partition column (``fetched_at``); the checkpoint is by default in the
    state's own folder, the last ``keep`` (2 at least) versions of the state are kept."""
    checkpoint = checkpoint or f"{state_path}/_checkpoint"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(raw_path)

    def fold(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        found = versions(session, state_path)
        current = latest_version(session, state_path)
        merged = batch if current is None else current.unionByName(batch)
        own = f"{state_path}/_new-{uuid.uuid4().hex}"
        keep_first(merged, keys, order).write.parquet(own)
        fs, source = commits.file_system(session, own)
        if not fs.rename(source, commits.file_system(session, f"{state_path}/state_version={found[-1] + 1 if found else 1}")[1]):
            raise RuntimeError(f"{state_path}: a state version could not be put in place")
        for old in found[:len(found) + 1 - max(keep, 2)]:
            remove_path(session, f"{state_path}/state_version={old}")

    q = (stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_version(spark, state_path)
