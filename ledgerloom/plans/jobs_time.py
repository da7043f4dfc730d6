"""Jobs: YTD/QTD, YoY/MoM, rolling windows, period totals, closing/opening/average balances,
per-day measures and dense month grids — over monthly Net Income and Total Assets series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM
from ..operators import hierarchy, profit, timeintel
from ..sources.dates import month_end_spine
from ..sources.store import stored_model
from .oracle_sql import q
from .registry import job

KEYS = ["scenario_id", "channel_id"]

_SER = """ser AS (
  SELECT scenario_id, channel_id, date_id, year, month, CAST((month - 1) // 3 + 1 AS INTEGER) AS quarter,
         year * 12 + month - 1 AS month_idx, SUM(signed) AS value
  FROM ni_rows GROUP BY scenario_id, channel_id, date_id, year, month
)"""

_ASSETS = """assets AS (
  SELECT f.scenario_id, f.channel_id, f.date_id, f.year, SUM(f.amount_eur) AS value,
         SUM(f.daily_avg_eur) AS daily
  FROM fact f JOIN tree_edges e ON e.leaf_id = f.budget_item_id WHERE e.node_id = 22
  GROUP BY f.scenario_id, f.channel_id, f.date_id, f.year
)"""


def _series(spark, sf_dir):
    m = stored_model(spark, sf_dir)
    s = profit.net_income_by(m.fact, m.items, KEYS + ["date_id"]).withColumnRenamed("net_income", "value")
    return timeintel.with_periods(s)


def _assets(spark, sf_dir):
    m = stored_model(spark, sf_dir)
    leaves22 = (hierarchy.rollup_edges(m.items, with_formulas=False).filter(F.col("node_id") == 22)
                .select(F.col("leaf_id").alias("budget_item_id")))
    a = (m.fact.join(F.broadcast(leaves22), "budget_item_id", "left_semi")
         .groupBy(*KEYS, "date_id", "year")
         .agg(F.sum("amount_eur").cast(MONEY_SUM).alias("value"),
              F.sum("daily_avg_eur").cast(MONEY_SUM).alias("daily")))
    return a


def _run_sql(part: str, name: str) -> str:
    return q(f"""
WITH {_SER}
SELECT scenario_id, channel_id, date_id, CAST(value AS DOUBLE) AS value,
       CAST(SUM(value) OVER (PARTITION BY {part} ORDER BY month_idx
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS {name}
FROM ser
""")


@job("ytd", _run_sql("scenario_id, channel_id, year", "ytd"))
def ytd(spark, sf_dir):
    """Year-to-date Net Income per scenario and channel."""
    s = timeintel.to_date(_series(spark, sf_dir), KEYS, "year")
    return s.select(*KEYS, "date_id", "value", "ytd")


@job("qtd", _run_sql("scenario_id, channel_id, year, quarter", "qtd"))
def qtd(spark, sf_dir):
    """Quarter-to-date Net Income per scenario and channel."""
    s = timeintel.to_date(_series(spark, sf_dir), KEYS, "quarter")
    return s.select(*KEYS, "date_id", "value", "qtd")


def _prior_sql(months: int) -> str:
    return q(f"""
WITH {_SER}
SELECT a.scenario_id, a.channel_id, a.date_id, CAST(a.value AS DOUBLE) AS value, CAST(b.value AS DOUBLE) AS prior,
       CAST(a.value - b.value AS DOUBLE) AS change,
       round(CAST(a.value - b.value AS DOUBLE) / NULLIF(abs(CAST(b.value AS DOUBLE)), 0), 6) AS change_pct
FROM ser a LEFT JOIN ser b ON b.scenario_id = a.scenario_id AND b.channel_id = a.channel_id
  AND b.month_idx = a.month_idx - {months}
""")


@job("yoy", _prior_sql(12))
def yoy(spark, sf_dir):
    """Value, same month last year, change and change % (equi-join on month index - 12)."""
    s = timeintel.change(timeintel.prior(_series(spark, sf_dir), KEYS, 12))
    return s.select(*KEYS, "date_id", "value", "prior", "change", "change_pct")


@job("mom", _prior_sql(1))
def mom(spark, sf_dir):
    """Value, previous month, change and change %."""
    s = timeintel.change(timeintel.prior(_series(spark, sf_dir), KEYS, 1))
    return s.select(*KEYS, "date_id", "value", "prior", "change", "change_pct")


@job("ytd_vs_py_ytd", q(f"""
WITH {_SER},
y AS (SELECT scenario_id, channel_id, date_id, month_idx,
             SUM(value) OVER (PARTITION BY scenario_id, channel_id, year ORDER BY month_idx
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ytd FROM ser)
SELECT a.scenario_id, a.channel_id, a.date_id, CAST(a.ytd AS DOUBLE) AS ytd, CAST(b.ytd AS DOUBLE) AS py_ytd,
       CAST(a.ytd - b.ytd AS DOUBLE) AS change,
       round(CAST(a.ytd - b.ytd AS DOUBLE) / NULLIF(abs(CAST(b.ytd AS DOUBLE)), 0), 6) AS change_pct
FROM y a LEFT JOIN y b ON b.scenario_id = a.scenario_id AND b.channel_id = a.channel_id
  AND b.month_idx = a.month_idx - 12
"""))
def ytd_vs_py_ytd(spark, sf_dir):
    """Year-to-date against prior-year year-to-date at the same month."""
    s = timeintel.to_date(_series(spark, sf_dir), KEYS, "year").select(*KEYS, "date_id", "month_idx", "ytd")
    s = timeintel.change(timeintel.prior(s, KEYS, 12, value="ytd", out="py_ytd"), value="ytd", base="py_ytd")
    return s.select(*KEYS, "date_id", "ytd", "py_ytd", "change", "change_pct")


def _rolling_sql(n: int) -> str:
    return q(f"""
WITH {_SER}
SELECT scenario_id, channel_id, date_id, CAST(value AS DOUBLE) AS value,
       COUNT(*) OVER w AS months_covered,
       CAST(CASE WHEN COUNT(*) OVER w = {n} THEN SUM(value) OVER w END AS DOUBLE) AS rolling_{n}
FROM ser
WINDOW w AS (PARTITION BY scenario_id, channel_id ORDER BY month_idx RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
""")


@job("rolling_12", _rolling_sql(12))
def rolling_12(spark, sf_dir):
    """Trailing 12-month Net Income with months covered (NULL if incomplete)."""
    s = timeintel.rolling(_series(spark, sf_dir), KEYS, 12)
    return s.select(*KEYS, "date_id", "value", "months_covered", "rolling_12")


@job("rolling_3", _rolling_sql(3))
def rolling_3(spark, sf_dir):
    """Trailing 3-month Net Income with months covered (NULL if incomplete)."""
    s = timeintel.rolling(_series(spark, sf_dir), KEYS, 3)
    return s.select(*KEYS, "date_id", "value", "months_covered", "rolling_3")


@job("full_year", q(f"""
WITH {_SER}
SELECT scenario_id, channel_id, year, CAST(SUM(value) AS DOUBLE) AS total, COUNT(*) AS months
FROM ser GROUP BY scenario_id, channel_id, year
"""))
def full_year(spark, sf_dir):
    """Net Income per scenario, channel and year."""
    return timeintel.period_total(_series(spark, sf_dir), KEYS, "year")


@job("quarter_total", q(f"""
WITH {_SER}
SELECT scenario_id, channel_id, year, quarter, CAST(SUM(value) AS DOUBLE) AS total, COUNT(*) AS months
FROM ser GROUP BY scenario_id, channel_id, year, quarter
"""))
def quarter_total(spark, sf_dir):
    """Net Income per scenario, channel, year and quarter."""
    return timeintel.period_total(_series(spark, sf_dir), KEYS, "quarter")


_CLOSING = """cl AS (
  SELECT a.scenario_id, a.channel_id, a.year, c.closing_date_id, a.value AS closing
  FROM assets a
  JOIN (SELECT scenario_id, year, MAX(date_id) AS closing_date_id FROM assets GROUP BY scenario_id, year) c
    ON c.scenario_id = a.scenario_id AND c.year = a.year AND c.closing_date_id = a.date_id
)"""


@job("closing_balance", q(f"""
WITH {_ASSETS}, {_CLOSING}
SELECT scenario_id, channel_id, year, closing_date_id, CAST(closing AS DOUBLE) AS closing FROM cl
"""))
def closing_balance(spark, sf_dir):
    """Total Assets at each scenario-year's closing month-end (one date for all channels)."""
    return timeintel.closing(_assets(spark, sf_dir), KEYS, ["scenario_id"])


@job("opening_balance", q(f"""
WITH {_ASSETS}, {_CLOSING}
SELECT a.scenario_id, a.channel_id, a.year, a.closing_date_id, CAST(a.closing AS DOUBLE) AS closing,
       CAST(b.closing AS DOUBLE) AS opening
FROM cl a LEFT JOIN cl b ON b.scenario_id = a.scenario_id AND b.channel_id = a.channel_id AND b.year = a.year - 1
"""))
def opening_balance(spark, sf_dir):
    """Total Assets opening balance = previous year's closing balance."""
    return timeintel.opening(timeintel.closing(_assets(spark, sf_dir), KEYS, ["scenario_id"]), KEYS)


@job("average_balance", q(f"""
WITH {_ASSETS},
b AS (SELECT scenario_id, year, COUNT(DISTINCT date_id) AS months FROM assets GROUP BY scenario_id, year)
SELECT a.scenario_id, a.channel_id, a.year, b.months,
       round(CAST(SUM(a.value) AS DOUBLE) / b.months, 6) AS avg_value,
       round(CAST(SUM(a.daily) AS DOUBLE) / b.months, 6) AS avg_daily
FROM assets a JOIN b ON b.scenario_id = a.scenario_id AND b.year = a.year GROUP BY a.scenario_id, a.channel_id, a.year, b.months
"""))
def average_balance(spark, sf_dir):
    """Average of month-end Total Assets per year over the scenario's months, on month-end and on daily-average EUR."""
    return timeintel.average(_assets(spark, sf_dir), KEYS, ["value", "daily"], ["scenario_id"])


@job("per_day", q(f"""
WITH {_SER}
SELECT scenario_id, channel_id, date_id, CAST(value AS DOUBLE) AS value,
       CAST(date_id % 100 AS INTEGER) AS days_in_month,
       CASE WHEN year % 400 = 0 OR (year % 4 = 0 AND year % 100 <> 0) THEN 366 ELSE 365 END AS days_in_year,
       round(CAST(value AS DOUBLE) / (date_id % 100), 6) AS per_day,
       round(CAST(value AS DOUBLE) / (date_id % 100)
             * CASE WHEN year % 400 = 0 OR (year % 4 = 0 AND year % 100 <> 0) THEN 366 ELSE 365 END, 6)
         AS annualised
FROM ser
"""))
def per_day(spark, sf_dir):
    """Monthly Net Income per day of the month, and annualised by the days of the year."""
    s = timeintel.per_day(_series(spark, sf_dir))
    return s.select(*KEYS, "date_id", "value", "days_in_month", "days_in_year", "per_day", "annualised")


@job("dense_months", q(f"""
WITH {_SER},
me AS (SELECT date_id FROM calendar WHERE is_month_end),
k AS (SELECT DISTINCT scenario_id, channel_id FROM ser)
SELECT k.scenario_id, k.channel_id, me.date_id, CAST(COALESCE(s.value, 0) AS DOUBLE) AS value,
       s.value IS NULL AS filled
FROM k CROSS JOIN me
LEFT JOIN ser s ON s.scenario_id = k.scenario_id AND s.channel_id = k.channel_id AND s.date_id = me.date_id
"""))
def dense_months(spark, sf_dir):
    """Every (scenario, channel) on every month-end of the ledger calendar, missing months as 0."""
    me = month_end_spine(stored_model(spark, sf_dir).dates)
    return timeintel.densify(_series(spark, sf_dir), KEYS, me)
