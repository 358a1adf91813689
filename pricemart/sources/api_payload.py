"""Landed API payloads: ``{"response": {"data": [{"period": .., "value": ..}, ..]}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.functions.numbers import parse_float
from pricemart.operators.quality import parse_then_filter

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("period", T.StringType()),
            T.StructField("value", T.StringType()),
        ]))),
    ])),
])


def payload_items(payload_json) -> Column:
    """``response.data`` of a payload text as an array, empty when absent (path with default)."""
    c = F.col(payload_json) if isinstance(payload_json, str) else payload_json
    parsed = F.from_json(c, PAYLOAD_SCHEMA)
    return F.coalesce(parsed["response"]["data"], F.array().cast(PAYLOAD_SCHEMA["response"].dataType["data"].dataType))


def payload_records(payloads: DataFrame, payload_col: str = "payload", source: str = "api",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload documents -> benchmark records (period, value DOUBLE, source).

    Items with an empty period or a NULL value are skipped; a value that is not a
    number is skipped; the item index is kept as ``_idx``."""
    ex = payloads.select(*keep, F.posexplode(payload_items(payload_col)).alias("_idx", "it"))
    ex = ex.where(F.col("it.period").isNotNull() & (F.col("it.period") != "") & F.col("it.value").isNotNull())
    out = parse_then_filter(ex, {"period": F.col("it.period"), "value": parse_float(F.col("it.value"))},
                            keep=[*keep, "_idx"])
    return out.select(*keep, "_idx", "period", "value", F.lit(source).alias("source"))


def page(df: DataFrame, order: list[str], offset: int = 0, length: int = 5000) -> DataFrame:
    """Sorted page of a result: ``ORDER BY order OFFSET offset LIMIT length``."""
    return df.orderBy(*order).offset(offset).limit(length)
