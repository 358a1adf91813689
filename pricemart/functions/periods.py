"""Date text -> dates and ``YYYY-MM`` periods, as native Column expressions.

Python ``strptime`` formats are matched exactly: each format becomes an
anchored regular expression with the same alternatives Python uses for its
directives (``%d`` takes one or two digits, ``%Y`` exactly four, month names
are case-insensitive, a space matches one or more whitespace characters), and
calendar validity is checked by ``try_to_date``.  Formats are tried in order, those that no text can
confuse at once; the first valid one wins.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemart.config import PERIOD_FORMATS, PY_WHITESPACE_CLASS, RATE_DATE_FORMATS

# English month names as Python's C locale spells them.
MONTH_ABBR = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_FULL = ("january", "february", "march", "april", "may", "june", "july", "august",
              "september", "october", "november", "december")

_DIRECTIVES = {
    "d": "( [1-9]|3[01]|[12][0-9]|0[1-9]|[1-9])",
    "m": "(1[0-2]|0[1-9]|[1-9])",
    "Y": "((?!0000)[0-9]{4})",
    "b": "(" + "|".join(MONTH_ABBR) + ")",
    "B": "(" + "|".join(MONTH_FULL) + ")",
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _compile(fmt: str) -> tuple[str, list[str]]:
    """Python strptime format -> (regex of its text, directive per group)."""
    out, groups, i = [], [], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%":
            code = fmt[i + 1]
            out.append(_DIRECTIVES[code])
            groups.append(code)
            i += 2
        elif ch.isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            out.append(PY_WHITESPACE_CLASS + "+")
        else:
            out.append(re.escape(ch))
            i += 1
    return "".join(out), groups


def _groups(formats) -> list[list[str]]:
    """Formats that one regular expression can try at once, groups in the order of their first format.

    The formats of a group have the same kind of month and all or none of them a day; no text fits two of
    them, as their separators or the places of the year differ (``%d/%m/%Y`` and ``%m/%d/%Y`` don't meet in a
    group).  Formats of different groups share texts only in that last case, so the order is kept."""
    def shape(fmt):
        return re.sub("%[dm]", "2", fmt)
    out: list[tuple[tuple, list[str]]] = []
    for fmt in formats:
        kind = next(code for code in "mbB" if f"%{code}" in fmt), "%d" in fmt
        for key, own in out:
            if key == kind and shape(fmt) not in map(shape, own):
                own.append(fmt)
                break
        else:
            out.append((kind, [fmt]))
    return [own for _, own in out]


def _one_group(text: Column, formats: list[str]) -> Column:
    """DATE if the whole (stripped) text matches one of the formats and names a real calendar day, else NULL.

    A chain in which each step uses the previous one once (no common
    subexpressions to eliminate): ``regexp_extract`` gives the matching text or
    '' (-> NULL), ``regexp_replace`` rewrites it to ``Y/M/D`` (month names kept; a part that another
    format would have filled is empty), and ``try_to_date`` checks the calendar.  Texts that do not match
    never reach the datetime parser (a failed parse is an exception inside the JVM).  Month names match
    case-insensitively, as in Python; surrounding whitespace is absorbed, as the callers strip first."""
    ws = PY_WHITESPACE_CLASS
    bodies, refs, n = [], {"Y": "", "month": "", "d": ""}, 0
    for fmt in formats:
        body, codes = _compile(fmt)
        bodies.append(body)
        for code in codes:
            n += 1
            refs[code if code in refs else "month"] += f"${n}"
    named = "m" not in _compile(formats[0])[1]
    rx = f"{'(?i)' if named else ''}^{ws}*(?:{'|'.join(bodies)}){ws}*$"
    matched = F.nullif(F.regexp_extract(text, rx, 0), F.lit(""))
    ymd = F.replace(F.regexp_replace(matched, rx, f"{refs['Y']}/{refs['month']}/{refs['d'] or '1'}"), F.lit(" "), F.lit(""))
    return F.try_to_date(ymd, f"yyyy/{'M' if not named else 'MMM' if '%b' in formats[0] else 'MMMM'}/d")


def parse_with_formats(c, formats) -> Column:
    """First calendar-valid parse of ``c`` by the formats, in order -> DATE (or NULL)."""
    tries = [_one_group(_c(c), own) for own in _groups(formats)]
    return F.coalesce(*tries) if len(tries) > 1 else tries[0]


def parse_period(c, formats=PERIOD_FORMATS) -> Column:
    """Mixed date text -> ``YYYY-MM`` string or NULL.

    The stripped text is tried against the formats in order; if none parses,
    two regex fallbacks apply without checking the month (``2022-13`` stays
    ``2022-13``, ``03/22/2026`` gives ``2026-22``): a 4-digit year followed by a
    2-digit month, then a day-month-year shape.
    """
    raw = _c(c)
    parsed = F.date_format(parse_with_formats(raw, formats), "yyyy-MM")
    ym = F.regexp_extract(raw, "[0-9]{4}[./-][0-9]{2}", 0)
    fb1 = F.regexp_replace(F.nullif(ym, F.lit("")), "^([0-9]{4}).", "$1-")
    dmy = F.regexp_extract(raw, "[0-9]{2}[./-][0-9]{2}[./-][0-9]{4}", 0)
    fb2 = F.regexp_replace(F.nullif(dmy, F.lit("")), "^..(.)(..).(....)$", "$3-$2")
    return F.coalesce(parsed, fb1, fb2)


def parse_rate_date(c, formats=RATE_DATE_FORMATS) -> Column:
    """Daily-rate date text -> DATE, formats tried in order (day-first before month-first)."""
    return parse_with_formats(_c(c), formats)


def slash_date_to_month(c) -> Column:
    """Benchmark CSV period: ``M/D/YYYY`` -> ``YYYY-MM``; other text kept; then the first 7
    characters.  A slash text with fewer than three parts yields NULL (row skipped)."""
    text = _c(c)
    parts = F.split(text, "/")
    month = F.get(parts, 0)
    month2 = F.when(F.length(month) < 2, F.lpad(month, 2, "0")).otherwise(month)
    rebuilt = F.when(F.size(parts) >= 3, F.concat(F.get(parts, 2), F.lit("-"), month2))
    normal = F.when(F.contains(text, F.lit("/")), rebuilt).otherwise(text)
    return F.substring(normal, 1, 7)


def period_to_date(c) -> Column:
    """``YYYY-MM`` -> first-of-month DATE; impossible months give NULL (Q4) instead of an error."""
    return F.try_to_date(_c(c), "yyyy-MM")
