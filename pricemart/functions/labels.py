"""Category labels: header text -> standard category, and label standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemart.config import FUEL_NAME_MAP
from pricemart.functions.text import normalise_label, py_strip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_category(c, name_map=FUEL_NAME_MAP) -> Column:
    """Header text -> standard category name.

    Lower-cased stripped text; headers naming a date, or blank, give NULL; the
    first map key contained in the header wins; otherwise the stripped header in
    upper snake case.
    """
    stripped = py_strip(_c(c))
    h = F.lower(stripped)
    expr = F.when(F.contains(h, F.lit("date")) | (h == F.lit("")), F.lit(None).cast("string"))
    for key, name in name_map:
        expr = expr.when(F.contains(h, F.lit(key)), F.lit(name))
    return expr.otherwise(normalise_label(stripped))


def standardise_label(c) -> Column:
    """``UPPER(TRIM(c))`` (Spark ``trim`` removes spaces only, as in the reference's ETL)."""
    return F.upper(F.trim(_c(c)))
