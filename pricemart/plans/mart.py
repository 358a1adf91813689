"""Star schema: dimensions, the BI view, top-k preview, row counts, key reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemart.config import DEFAULT_SPEC, MartSpec
from pricemart.operators.keys import with_surrogate_key

DIM_CATEGORY_SCHEMA = "fuel_type_key string, fuel_category string, description string"


def dim_date(spark: SparkSession, start: str | None = None, months: int | None = None,
             crisis_start: str | None = None, crisis_end: str | None = None,
             spec: MartSpec = DEFAULT_SPEC) -> DataFrame:
    """Monthly date dimension: ``months`` first-of-month dates from ``start``.

    Columns: date_key DATE, year/quarter/month SMALLINT, month_name ('Jan'..),
    is_crisis_period BOOLEAN (date_key BETWEEN crisis_start AND crisis_end)."""
    start = start or spec.date_dim_start
    months = months or spec.date_dim_months
    lo = crisis_start or spec.crisis_start
    hi = crisis_end or spec.crisis_end
    d0 = F.to_date(F.lit(start))
    seq = F.sequence(d0, F.add_months(d0, months - 1), F.expr("INTERVAL 1 MONTH"))
    return dim_date_from(spark.range(1).select(F.explode(seq).alias("date_key")), lo, hi)


def dim_date_from(dates: DataFrame, crisis_start: str, crisis_end: str) -> DataFrame:
    d = F.col("date_key")
    return dates.select(
        d,
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.month(d).cast("smallint").alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.coalesce(d.between(F.to_date(F.lit(crisis_start)), F.to_date(F.lit(crisis_end))),
                   F.lit(False)).alias("is_crisis_period"),
    )


def dim_category(spark: SparkSession, rows: Sequence[tuple[str, str, str]] | None = None) -> DataFrame:
    """Static category dimension (an inline VALUES relation)."""
    rows = list(rows if rows is not None else DEFAULT_SPEC.category_rows)
    return spark.createDataFrame(rows, DIM_CATEGORY_SCHEMA)


VIEW_COLUMNS = ["period", "year", "quarter", "month_name", "is_crisis_period", "fuel_type", "fuel_category",
                "price_lkr", "price_usd", "brent_usd_per_barrel", "usd_lkr_rate", "crude_cost_pct",
                "prev_month_price_lkr", "mom_price_change_pct"]


RANGE = "range_no"

# LAG in two steps: inside (category, range of the load), and for a range's first row the last price of the category's
# range before.  Ranges rise with the id, so no window holds a whole category.
VIEW_SQL = """
WITH j AS (
  SELECT f.period, d.year, d.quarter, d.month_name, d.is_crisis_period, f.fuel_type, ft.fuel_category,
         f.price_lkr, f.price_usd, f.brent_usd_per_barrel, f.usd_lkr_rate, f.crude_cost_pct, f.{id} AS n, f.{range} AS r
  FROM {fact} f
  JOIN {dates} d ON f.period = d.date_key
  JOIN {categories} ft ON f.fuel_type = ft.fuel_type_key),
edges AS (SELECT fuel_type, r, MAX_BY(price_lkr, n) AS last_price FROM j GROUP BY fuel_type, r),
carried AS (SELECT fuel_type AS ct, r AS cr, LAG(last_price) OVER (PARTITION BY fuel_type ORDER BY r) AS carry FROM edges),
l AS (SELECT j.*, carry, LAG(STRUCT(price_lkr AS v)) OVER (PARTITION BY fuel_type, r ORDER BY n) AS before
      FROM j JOIN carried ON fuel_type = ct AND r = cr),
p AS (SELECT *, CASE WHEN before IS NULL THEN carry ELSE before.v END AS prev_month_price_lkr FROM l)
SELECT {columns}, prev_month_price_lkr,
       CAST(TRY_CAST((price_lkr - prev_month_price_lkr) / NULLIF(prev_month_price_lkr, 0) * 100 AS DECIMAL(38,2)) AS DOUBLE)
         AS mom_price_change_pct
FROM p"""


def view_sql(fact: str, dates: str, categories: str, id_col: str = "fact_id", range_col: str = RANGE) -> str:
    """The BI view over table or view names: fact INNER JOIN date dim INNER JOIN category dim, the previous row's price of the
    same category (by period, Q7; rows of one period by ``id_col``) and the percent change.

    The fact has ``range_col``: the number of the range of ids that a row lies in (``with_surrogate_key``)."""
    return VIEW_SQL.format(fact=fact, dates=dates, categories=categories, id=id_col, range=range_col, columns=", ".join(VIEW_COLUMNS[:-2]))


def price_vs_benchmark_view(fact: DataFrame, dates: DataFrame, categories: DataFrame, buckets: int | None = None) -> DataFrame:
    """The BI view as a frame.  A loaded fact (``fact_id`` and ``range_no``) is read as it is; any other gets ids in the order of
    (period, fuel_type, its ``fact_id`` or a row hash) and ranges first."""
    if not {"fact_id", RANGE} <= set(fact.columns):
        order = ["period", "fuel_type", *(["fact_id"] if "fact_id" in fact.columns else [])]
        fact = with_surrogate_key(fact, order, name="_n", buckets=buckets, range_name=RANGE).withColumnRenamed("_n", "_id")
        sql = view_sql("{fact}", "{dates}", "{categories}", "_id")
    else:
        sql = view_sql("{fact}", "{dates}", "{categories}")
    return fact.sparkSession.sql(sql, fact=fact, dates=dates, categories=categories)


def register_views(spark: SparkSession, fact: DataFrame, dates: DataFrame, categories: DataFrame,
                   view: str = "vw_price_vs_benchmark") -> DataFrame:
    """Register the star and the BI view over it as temporary views; returns ``spark.table(view)``."""
    if not {"fact_id", RANGE} <= set(fact.columns):
        price_vs_benchmark_view(fact, dates, categories).createOrReplaceTempView(view)
        return spark.table(view)
    for name, df in (("fact", fact), ("dates", dates), ("categories", categories)):
        df.createOrReplaceTempView(f"{view}_{name}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS {view_sql(f'{view}_fact', f'{view}_dates', f'{view}_categories')}")
    return spark.table(view)


def latest_top(view: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` rows of the view (period DESC, fuel_type as tie-break): TakeOrderedAndProject."""
    return view.orderBy(F.col("period").desc(), F.col("fuel_type").asc()).limit(n)


def row_counts(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One row per table: (tbl, rows), as a UNION ALL of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows") for name, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unmatched_keys(fact: DataFrame, categories: DataFrame, key: str = "fuel_type",
                   dim_key: str = "fuel_type_key") -> DataFrame:
    """Fact rows the inner join to the category dimension would drop (left anti, Q8)."""
    dim = categories.select(F.col(dim_key).alias(key)).distinct()
    return fact.join(dim, on=key, how="left_anti").select(*fact.columns)
