"""Appends that happen once: a ledger of load ids, and surrogate ids that go on from the table's largest.

A load's rows go to ``root/loads/<n>-...``, a folder of its own, and count from the moment the ledger (``root/_ledger``) has
its load id.  The same load id again appends nothing; a load that broke before its commit left rows that no reader sees;
two loads at once get different places in the ledger or one of them stops.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.operators.keys import with_surrogate_key
from pricemart.sinks import commits
from pricemart.sinks.warehouse import write_table

LOG, LOADS = "_ledger", "loads"


@dataclass(frozen=True)
class Load:
    load_id: str
    rows: int
    first_id: int | None        # of its surrogate ids; None: no rows
    last_id: int                # the table's largest id after it
    path: str
    appended: bool = True       # False: the load id was in the ledger already


def loads(spark: SparkSession, root: str) -> list[Load]:
    """The loads of the table, oldest first."""
    return [Load(e["load_id"], e["rows"], e["first_id"], e["last_id"], f"{root}/{e['path']}", False)
            for _, e in commits.entries(spark, f"{root}/{LOG}")]


def append_once(df: DataFrame, root: str, load_id: str, order: Sequence[str], id_name: str = "fact_id") -> Load:
    """Append ``df`` as the load ``load_id`` with ``id_name``: ids in the order of ``order``, from the largest of the table on.
    A load id that is in the ledger appends nothing; its first load is returned."""
    spark = df.sparkSession
    before = loads(spark, root)
    for load in before:
        if load.load_id == load_id:
            return load
    top = before[-1].last_id if before else 0
    name = f"{LOADS}/{len(before) + 1:08d}-{uuid.uuid4().hex[:8]}"
    seen = Observation("append")
    keyed = with_surrogate_key(df, order, name=id_name, start=top + 1)
    write_table(keyed.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/{name}", mode="errorifexists")
    rows = seen.get["rows"]
    load = Load(load_id, rows, top + 1 if rows else None, top + rows, f"{root}/{name}")
    commits.commit(spark, f"{root}/{LOG}", len(before) + 1,
                   {"load_id": load_id, "rows": rows, "first_id": load.first_id, "last_id": load.last_id, "path": name})
    return load


def read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of all loads in the ledger."""
    paths = [load.path for load in loads(spark, root)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
