"""Text renderers for stand-in inputs, emitted as SQL for either engine.

Only formatting of existing column values; integer arithmetic keeps the text
identical on Spark and DuckDB.
"""

from __future__ import annotations

_PATTERNS = {  # name: (Spark pattern, DuckDB pattern)
    "ymd": ("yyyy-MM-dd", "%Y-%m-%d"),
    "dmy_slash": ("dd/MM/yyyy", "%d/%m/%Y"),
    "dmy_dash": ("dd-MM-yyyy", "%d-%m-%Y"),
    "dmy_dot": ("dd.MM.yyyy", "%d.%m.%Y"),
    "mdy_slash": ("MM/dd/yyyy", "%m/%d/%Y"),
    "ym": ("yyyy-MM", "%Y-%m"),
    "y": ("yyyy", "%Y"),
    "mon_y": ("MMM yyyy", "%b %Y"),
    "month_y": ("MMMM yyyy", "%B %Y"),
    "m_slash_y": ("MM/yyyy", "%m/%Y"),
    "dmy_dot_short": ("d.M.yyyy", "%-d.%-m.%Y"),
    "mdy_short": ("M/d/yyyy", "%-m/%-d/%Y"),
}


def dfmt(col: str, name: str, engine: str) -> str:
    sp, dk = _PATTERNS[name]
    return f"date_format({col}, '{sp}')" if engine == "spark" else f"strftime({col}, '{dk}')"


def s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def money(cents: str, thousands: bool = False) -> str:
    """``cents`` (a BIGINT expression) as ``W.FF``; with ``thousands`` as ``T,WWW.FF`` above 999."""
    whole = f"CAST(floor(({cents}) / 100) AS BIGINT)"
    frac = f"lpad({s(f'({cents}) % 100')}, 2, '0')"
    plain = f"concat({s(whole)}, '.', {frac})"
    if not thousands:
        return plain
    th = f"concat({s(f'CAST(floor({whole} / 1000) AS BIGINT)')}, ',', lpad({s(f'{whole} % 1000')}, 3, '0'), '.', {frac})"
    return f"CASE WHEN {whole} >= 1000 THEN {th} ELSE {plain} END"


def cents(col: str) -> str:
    return f"CAST(ROUND({col} * 100) AS BIGINT)"
