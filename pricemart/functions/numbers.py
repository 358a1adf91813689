"""Messy numeric text -> double, as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemart.config import Bounds
from pricemart.functions.exact import in_bounds
from pricemart.functions.text import py_strip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_price(c, bounds: Bounds = Bounds(0.0, 1500.0, hi_inclusive=True)) -> Column:
    """Messy price text -> double or NULL.

    Steps: keep only ``[0-9.,]``; if both ``,`` and ``.`` occur the comma is a
    thousands separator (removed), a lone comma is a decimal point; with several
    dots only the first two parts are kept; parse; keep values inside ``bounds``
    (default (0, 1500]).  Reproduces the reference's quirks: ``"1,200"`` -> 1.2,
    ``"Rs. 137.00"`` -> 0.137, ``"-5"`` -> 5.0.  The null tokens (``-``, ``N/A``,
    dashes, blank) and surrounding whitespace need no separate step: they contain
    no digit and reduce to ``''``.

    Written as a chain in which every step uses the previous one once, so the
    expression costs one pass per step however it is nested (codegen does not
    share subexpressions inside conditional branches)."""
    kept = F.regexp_replace(_c(c), "[^0-9.,]", "")
    # every comma goes when a dot occurs anywhere: commas with a dot after them, then
    # (on the reversed text) commas with a dot before them
    dot_after = ",(?=[0-9.,]*\\.)"
    no_thousands = F.reverse(F.regexp_replace(F.reverse(F.regexp_replace(kept, dot_after, "")), dot_after, ""))
    unified = F.replace(no_thousands, F.lit(","), F.lit("."))      # a lone comma is a decimal point
    two_parts = F.regexp_extract(unified, "^[^.]*(\\.[^.]*)?", 0)
    value = two_parts.try_cast("double")
    return F.when(in_bounds(value, bounds), value)


# A decimal literal as Python's float() reads it (ASCII digits, optional
# underscores between digits, sign, fraction, exponent).
_FLOAT_RE = "^[+-]?(([0-9](_?[0-9])*)(\\.([0-9](_?[0-9])*)?)?|\\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"


def parse_rate(c, bounds: Bounds = Bounds(0.0, 1000.0, hi_inclusive=True)) -> Column:
    """Rate text -> double or NULL: thousands commas removed, stripped, parsed as a
    decimal literal, kept inside ``bounds`` (default (0, 1000]); NaN/inf rejected (Q5)."""
    text = py_strip(F.replace(_c(c), F.lit(","), F.lit("")))
    value = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    ok = F.regexp_like(text, F.lit(_FLOAT_RE))
    return F.when(ok & in_bounds(value, bounds), value)


_SPECIAL_FLOAT_RE = "(?i)^[+-]?(nan|inf|infinity)$"


def parse_float(c) -> Column:
    """Text -> double as Python's ``float()`` reads it (surrounding whitespace allowed,
    underscores between digits, ``nan``/``inf``); anything else -> NULL.  Unlike
    ``try_cast`` it rejects Java-only forms such as ``12d`` or hex floats."""
    text = py_strip(_c(c))
    value = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    ok = F.regexp_like(text, F.lit(_FLOAT_RE)) | F.regexp_like(text, F.lit(_SPECIAL_FLOAT_RE))
    return F.when(ok, value)
