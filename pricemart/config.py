"""Parameters of the price-intelligence domain.

The values under "Fixed values" must equal what the reference computes with,
so results match; everything else is a parameter with a default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must match the reference for identical results)
# ---------------------------------------------------------------------------

# Ordered header-substring -> standard fuel name map (first match wins).
FUEL_NAME_MAP: tuple[tuple[str, str], ...] = (
    ("lp 95", "LP_95"),
    ("lp 92", "LP_92"),
    ("lad", "AUTO_DIESEL"),
    ("lsd", "SUPER_DIESEL"),
    (" lk", "KEROSENE"),
    ("lk", "KEROSENE"),
    ("lik", "ILO_KEROSENE"),
    ("fur. 800", "FURNACE_800"),
    ("fur 800", "FURNACE_800"),
    ("fur. 1500", "FURNACE_1500"),
    ("fur 1500", "FURNACE_1500"),
)

# A table is the price table when its text contains any of these keywords.
FUEL_TABLE_KEYWORDS: tuple[str, ...] = ("lp", "diesel", "lad", "lsd", "kerosene", "fur", "92", "95")

# Date formats tried in order by the retail-price period parser (Python strptime codes).
PERIOD_FORMATS: tuple[str, ...] = (
    "%d.%m.%Y",
    "%d/%m/%Y",
    "%d-%m-%Y",
    "%Y-%m-%d",
    "%b-%Y",
    "%b %Y",
    "%B-%Y",
    "%B %Y",
    "%m/%Y",
)

# Date formats tried in order by the daily exchange-rate parser.
RATE_DATE_FORMATS: tuple[str, ...] = ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%m/%d/%Y")

# CSV header aliases, in the order they are tried (first non-empty wins).
BENCHMARK_CSV_PERIOD_ALIASES: tuple[str, ...] = ("period", "Period", "date", "Date")
BENCHMARK_CSV_VALUE_ALIASES: tuple[str, ...] = ("value", "Value", "price", "Price")
RATE_CSV_CURRENCY_ALIASES: tuple[str, ...] = ("Currency", "currency")
RATE_CSV_DATE_ALIASES: tuple[str, ...] = ("Date", "date", "DATE", "Period")
RATE_CSV_RATE_ALIASES: tuple[str, ...] = (
    "Mid Rate", "mid_rate", "Exchange Rate", "exchange_rate",
    "Selling Rate", "selling_rate", "usd_lkr", "Rate",
)
PRICE_CSV_DATE_ALIASES: tuple[str, ...] = ("period", "Period", "date", "Date")
PRICE_CSV_FUEL_ALIASES: tuple[str, ...] = ("fuel_type", "Fuel Type", "fuel", "Fuel")
PRICE_CSV_PRICE_ALIASES: tuple[str, ...] = ("price_lkr", "Price LKR", "price", "Price")

# Fuel type dimension: (fuel_type_key, fuel_category, description), 8 static rows.
FUEL_TYPE_ROWS: tuple[tuple[str, str, str], ...] = (
    ("LP_95", "PETROL", "Octane 95 — premium petrol, Lanka IOC brand"),
    ("LP_92", "PETROL", "Octane 92 — standard petrol, most common grade"),
    ("AUTO_DIESEL", "DIESEL", "LAD — Lanka Auto Diesel, automotive use"),
    ("SUPER_DIESEL", "DIESEL", "LSD — Lanka Super Diesel, low-sulphur grade"),
    ("KEROSENE", "KEROSENE", "LK — Lanka Kerosene, domestic cooking use"),
    ("ILO_KEROSENE", "KEROSENE", "LIK — Illuminating Kerosene, lighting use"),
    ("FURNACE_800", "FURNACE", "FUR 800 — Furnace oil 800 cSt, industrial"),
    ("FURNACE_1500", "FURNACE", "FUR 1500 — Furnace oil 1500 cSt, industrial"),
)

LITRES_PER_BARREL = 159.0

# Date dimension: 192 months from 2015-01-01; crisis flag for 2022.
DATE_DIM_START = "2015-01-01"
DATE_DIM_MONTHS = 192
CRISIS_START = "2022-01-01"
CRISIS_END = "2022-12-31"

# Source look-back window and API page size.
LOOKBACK_DAYS = 730

# Python's str.strip() whitespace set, as a regex class usable by Java and RE2.
PY_WHITESPACE_CLASS = (
    "[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)


# ---------------------------------------------------------------------------
# Parameters of a run (defaults = the reference's domain)
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Bounds:
    """A numeric validity range; ``lo_inclusive``/``hi_inclusive`` make each end explicit."""

    lo: float
    hi: float
    lo_inclusive: bool = False
    hi_inclusive: bool = False


@dataclass(frozen=True)
class MartSpec:
    """Domain parameters of the transform and the star schema."""

    benchmark_bounds: Bounds = Bounds(0.0, 300.0)          # open (0, 300)
    price_bounds: Bounds = Bounds(0.0, 1500.0)             # open (0, 1500)
    litres_per_barrel: float = LITRES_PER_BARREL
    date_dim_start: str = DATE_DIM_START
    date_dim_months: int = DATE_DIM_MONTHS
    crisis_start: str = CRISIS_START
    crisis_end: str = CRISIS_END
    category_rows: tuple[tuple[str, str, str], ...] = field(default=FUEL_TYPE_ROWS)
    standardise_first: bool = False      # Q1: the reference dedupes before UPPER/TRIM
    calendar_fill: bool = False          # Q3: densify months before the FX forward fill


DEFAULT_SPEC = MartSpec()
