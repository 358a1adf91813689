"""Safe full refresh of several tables: every load writes a folder of its own, one commit publishes them together.

A plain overwrite deletes a table before it writes the new one, so a job that breaks leaves it empty and a star half
old, half new.  Here a load writes ``root/versions/<load>/<table>``; the tables of the newest commit in
``root/_published`` are the current ones.  A load that breaks before its commit changes nothing for readers, and a reader
that has resolved its paths keeps its version until it is pruned.  A table that a load didn't write anew may be published
again from an older version.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pricemart.session import remove_path
from pricemart.sinks import commits

LOG, VERSIONS = "_published", "versions"


@dataclass(frozen=True)
class Release:
    """What is published: its number (0: nothing yet) and the path of every table."""
    number: int
    tables: Mapping[str, str]


def current(spark: SparkSession, root: str) -> Release:
    number, entry = commits.last(spark, f"{root}/{LOG}")
    return Release(number, {n: _full(root, p) for n, p in (entry or {"tables": {}})["tables"].items()})


def _full(root: str, path: str) -> str:
    return path if "://" in path or path.startswith(("/", "file:")) else f"{root}/{path}"


def new_version(root: str) -> str:
    """A fresh folder for a load's tables."""
    return f"{root}/{VERSIONS}/{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, tables: Mapping[str, str], base: Release) -> Release:
    """Publish ``tables`` (name -> path) as the release after ``base``, the one the load started from; tables of ``base`` that
    aren't named stay as they are.  Raises ``ConflictError`` when another load has published since."""
    every = {**base.tables, **tables}
    short = {n: p.removeprefix(f"{root}/") for n, p in every.items()}
    commits.commit(spark, f"{root}/{LOG}", base.number + 1, {"tables": short})
    return Release(base.number + 1, every)


def read(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None, release: Release | None = None) -> DataFrame:
    """The published rows of ``table`` (of ``release``: tables read by one release belong together)."""
    found = release or current(spark, root)
    if table not in found.tables:
        raise KeyError(f"{root}: no published table {table}")
    if schema is None:
        return spark.read.parquet(found.tables[table])
    return spark.read.schema(schema).parquet(found.tables[table]).select(*schema.fieldNames())      # without columns that are folders


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove versions that none of the last ``keep`` releases reads and that are older than the newest of them (a younger one
    may be a running load); returns their paths.  The log itself stays."""
    kept = commits.entries(spark, f"{root}/{LOG}")[-max(keep, 1):]
    used = {p.split("/")[1] for _, e in kept for p in e["tables"].values() if p.startswith(f"{VERSIONS}/")}
    gone = [f"{root}/{VERSIONS}/{v}" for v in commits.folders(spark, f"{root}/{VERSIONS}") if v not in used and used and v < max(used)]
    for path in gone:
        remove_path(spark, path)
    return gone
