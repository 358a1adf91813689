"""Golden vectors for the scalar Column functions (hand-derived from the reference's code)."""

from pyspark.sql import functions as F

from pricemart.functions import (
    clean_price, map_category, parse_period, parse_rate, parse_rate_date,
    slash_date_to_month, period_to_date, standardise_label, round_half_up,
)
from pricemart.functions.text import cell_text, py_strip

CLEAN_PRICE = [
    ("137.00", 137.0), ("137,00", 137.0), ("137.00.00", 137.0), ("1,200.50", 1200.5),
    ("-", None), ("N/A", None), ("n/a", None), ("–", None), ("—", None), ("", None), (None, None),
    ("abc", None), (".", None), ("1,200", 1.2), ("1,200,500", 1.2), ("Rs. 137.00", 0.137),
    ("Rs 137", 137.0), ("-5", 5.0), ("0", None), ("1500", 1500.0), ("1500.01", None),
    ("  317.00 \t", 317.0), ("\xa0250\xa0", 250.0),
    ("1.200,50", 1.2005), ("5,00.10", 500.1), ("12,345.67,89", None),
]

PARSE_PERIOD = [
    ("22.03.2026", "2026-03"), ("22/03/2026", "2026-03"), ("22-03-2026", "2026-03"),
    ("2026-03-22", "2026-03"), ("Mar-2026", "2026-03"), ("Mar 2026", "2026-03"),
    ("Mar  2026", "2026-03"), ("March-2026", "2026-03"), ("March 2026", "2026-03"),
    ("03/2026", "2026-03"), ("1.2.2024", "2024-02"), ("mar-2026", "2026-03"),
    ("2022-01", "2022-01"), ("2022.01", "2022-01"), ("2024/03/15", "2024-03"),
    ("2022-13", "2022-13"), ("03/22/2026", "2026-22"), ("30/02/2024", "2024-02"),
    ("Updated 22.03.2026", "2026-03"), ("2026-03-22 10:00", "2026-03"),
    ("2022-1", None), ("Sept 2026", None), ("22.03.26", None), ("junk", None),
    (" 29.02.2024 ", "2024-02"), ("29.02.2023", "2023-02"), ("MARCH 2026", "2026-03"),
]

MAP_CATEGORY = [
    ("LP 95", "LP_95"), ("lp 92", "LP_92"), ("LAD", "AUTO_DIESEL"), ("LSD", "SUPER_DIESEL"),
    ("LK", "KEROSENE"), ("LIK", "ILO_KEROSENE"), ("FUR. 800", "FURNACE_800"),
    ("Fur 1500", "FURNACE_1500"), ("Date", None), ("Effective Date", None), ("", None),
    ("Petrol 92", "PETROL_92"), ("LP95", "LP95"), ("Bulk", "KEROSENE"),
]

RATE_ROWS = [
    ("2023-01-05", "365.20", "2023-01-05", 365.2), ("05/01/2023", "365", "2023-01-05", 365.0),
    ("05/13/2023", "365", "2023-05-13", 365.0), ("05.01.2023", "1,000.00", "2023-01-05", 1000.0),
    ("2023-01-05", "1000.01", "2023-01-05", None), ("2023-01-05", "0", "2023-01-05", None),
    ("2023-01-05", "-1", "2023-01-05", None), ("2023-01-05", "abc", "2023-01-05", None),
    ("2023-01-05", "nan", "2023-01-05", None), ("2023/01/05", "365", None, 365.0),
    ("2023-01-05", " 1_000 ", "2023-01-05", 1000.0), ("2023-01-05", "12d", "2023-01-05", None),
]


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_clean_price(spark):
    got = _eval(spark, [i for i, _ in CLEAN_PRICE], clean_price)
    assert got == [o for _, o in CLEAN_PRICE]


def test_parse_period(spark):
    got = _eval(spark, [i for i, _ in PARSE_PERIOD], parse_period)
    assert got == [o for _, o in PARSE_PERIOD]


def test_map_category(spark):
    got = _eval(spark, [i for i, _ in MAP_CATEGORY], map_category)
    assert got == [o for _, o in MAP_CATEGORY]


def test_parse_rate_and_date(spark):
    dates = _eval(spark, [r[0] for r in RATE_ROWS], lambda c: F.date_format(parse_rate_date(c), "yyyy-MM-dd"))
    rates = _eval(spark, [r[1] for r in RATE_ROWS], parse_rate)
    assert dates == [r[2] for r in RATE_ROWS]
    assert rates == [r[3] for r in RATE_ROWS]


def test_slash_date_to_month(spark):
    ins = ["01/15/2022", "1/15/2022", "2022-01-15", "2022-01", "01/2022"]
    assert _eval(spark, ins, slash_date_to_month) == ["2022-01", "2022-01", "2022-01", "2022-01", None]


def test_period_to_date_and_labels(spark):
    got = _eval(spark, ["2022-03", "2022-13", None], lambda c: F.date_format(period_to_date(c), "yyyy-MM-dd"))
    assert got == ["2022-03-01", None, None]
    assert _eval(spark, [" lp_92 ", "LP_92", "\tlp_92"], standardise_label) == ["LP_92", "LP_92", "\tLP_92"]


def test_strip_and_cell_text(spark):
    assert _eval(spark, ["\t a \n", "\xa0x　"], py_strip) == ["a", "x"]
    html = ["<td class='p'> 1,200 <b> 50 </b></td>", "<th>LP&nbsp;95</th>", "<td></td>"]
    assert _eval(spark, html, cell_text) == ["1,20050", "LP\xa095", ""]


def test_round_half_up(spark):
    vals = [0.12345, 2.675, 1.005, -2.5, None]
    got = _eval(spark, vals, lambda c: round_half_up(c, 2), "double")
    assert got == [0.12, 2.68, 1.01, -2.5, None]
    assert _eval(spark, [0.00005], lambda c: round_half_up(c, 4), "double") == [0.0001]
