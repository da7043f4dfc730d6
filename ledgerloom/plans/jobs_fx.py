"""Jobs: FX rate table, nominal amounts, measure choice, restatement, cross rates, FX effect."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM
from ..operators import fx
from ..sources.store import stored_model
from .oracle_sql import q
from .registry import job


@job("fx_rate_table", q("""
SELECT rate_id, date_id, currency_id, currency_code, currency_name, currency_symbol,
       CAST(eom_rate AS DOUBLE) AS eom_rate, CAST(daily_avg_rate AS DOUBLE) AS daily_avg_rate
FROM rates
"""))
def fx_rate_table(spark, sf_dir):
    """Month-end x currency rates (EUR = 1; USD/GBP seeded within yearly bands) over the ledger span."""
    return stored_model(spark, sf_dir).rates


def _recomputed(m):
    base = m.fact.select("scenario_id", "year", "date_id", "currency_id", "amount_eur", "daily_avg_eur")
    return fx.add_nominal(base, m.rates)


@job("fx_nominal", q("""
SELECT f.scenario_id, f.year, f.currency_id, CAST(SUM(f.amount_eur) AS DOUBLE) AS amount_eur,
       CAST(SUM(CAST(f.amount_eur * r.eom_rate AS DECIMAL(22,2))) AS DOUBLE) AS amount_nominal
FROM fact f JOIN rates r ON r.date_id = f.date_id AND r.currency_id = f.currency_id
GROUP BY f.scenario_id, f.year, f.currency_id
"""))
def fx_nominal(spark, sf_dir):
    """Nominal amounts recomputed per row (eur x month-end rate, rounded per row), summed per currency."""
    r = _recomputed(stored_model(spark, sf_dir))
    return r.groupBy("scenario_id", "year", "currency_id").agg(
        F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur"),
        F.sum("amount_nominal").cast(MONEY_SUM).alias("amount_nominal"))


@job("fx_daily_nominal", q("""
SELECT f.scenario_id, f.year, f.currency_id, CAST(SUM(f.daily_avg_eur) AS DOUBLE) AS daily_avg_eur,
       CAST(SUM(CAST(f.daily_avg_eur * r.daily_avg_rate AS DECIMAL(22,2))) AS DOUBLE) AS daily_avg_nominal
FROM fact f JOIN rates r ON r.date_id = f.date_id AND r.currency_id = f.currency_id
GROUP BY f.scenario_id, f.year, f.currency_id
"""))
def fx_daily_nominal(spark, sf_dir):
    """Daily-average nominal amounts (daily-average eur x daily-average rate, per row)."""
    r = _recomputed(stored_model(spark, sf_dir))
    return r.groupBy("scenario_id", "year", "currency_id").agg(
        F.sum("daily_avg_eur").cast(MONEY_SUM).alias("daily_avg_eur"),
        F.sum("daily_avg_nominal").cast(MONEY_SUM).alias("daily_avg_nominal"))


@job("fx_measure_select", q("""
SELECT scenario_id, year, currency_id, measure, CAST(SUM(amount) AS DOUBLE) AS amount FROM (
  SELECT scenario_id, year, currency_id, 'amount_eur' AS measure, amount_eur AS amount FROM fact
  UNION ALL SELECT scenario_id, year, currency_id, 'amount_nominal', amount_nominal FROM fact
  UNION ALL SELECT scenario_id, year, currency_id, 'daily_avg_eur', daily_avg_eur FROM fact
  UNION ALL SELECT scenario_id, year, currency_id, 'daily_avg_nominal', daily_avg_nominal FROM fact
) u GROUP BY scenario_id, year, currency_id, measure
"""))
def fx_measure_select(spark, sf_dir):
    """The four amounts as one interchangeable (measure, amount) column; nominal kept per currency."""
    m = stored_model(spark, sf_dir)
    return fx.measure_select(m.fact, ["scenario_id", "year", "currency_id"])


@job("fx_report_currency", q("""
SELECT r.currency_id, f.scenario_id, f.date_id, CAST(f.amt AS DOUBLE) AS amount_eur,
       CAST(CAST(CAST(f.amt AS DECIMAL(26,2)) * r.eom_rate AS DECIMAL(22,2)) AS DOUBLE) AS restated_eom,
       CAST(CAST(CAST(f.amt AS DECIMAL(26,2)) * r.daily_avg_rate AS DECIMAL(22,2)) AS DOUBLE) AS restated_avg, r.date_id < f.date_id AS carried
FROM (SELECT scenario_id, date_id, SUM(amount_eur) AS amt FROM fact GROUP BY scenario_id, date_id) f
JOIN rates r ON r.date_id = (SELECT MAX(x.date_id) FROM rates x WHERE x.date_id <= f.date_id AND x.currency_id = r.currency_id) AND r.currency_id IN (2, 3)
"""))
def fx_report_currency(spark, sf_dir):
    """EUR totals restated in USD and GBP at the month-end and the daily-average rate (sum first, convert once, last known rate)."""
    m = stored_model(spark, sf_dir)
    return fx.restate(m.fact, m.rates, [2, 3], ["scenario_id"]).select(
        "currency_id", "scenario_id", "date_id", "amount_eur", "restated_eom", "restated_avg", "carried")


@job("fx_cross_rate", q("""
SELECT a.date_id, a.currency_code AS from_code, b.currency_code AS to_code,
       round(CAST(b.eom_rate AS DOUBLE) / CAST(a.eom_rate AS DOUBLE), 6) AS eom_cross,
       round(CAST(b.daily_avg_rate AS DOUBLE) / CAST(a.daily_avg_rate AS DOUBLE), 6) AS avg_cross
FROM rates a JOIN rates b ON a.date_id = b.date_id AND a.currency_code <> b.currency_code
"""))
def fx_cross_rate(spark, sf_dir):
    """Cross rates A->B = rate_B / rate_A per month-end, both quotes."""
    return fx.cross_rates(stored_model(spark, sf_dir).rates)


@job("fx_eom_vs_avg", q("""
SELECT date_id, currency_id, currency_code, CAST(eom_rate AS DOUBLE) AS eom_rate,
       CAST(daily_avg_rate AS DOUBLE) AS daily_avg_rate, CAST(eom_rate - daily_avg_rate AS DOUBLE) AS spread
FROM rates
"""))
def fx_eom_vs_avg(spark, sf_dir):
    """Month-end minus daily-average rate per currency and month."""
    return fx.eom_vs_avg(stored_model(spark, sf_dir).rates)


@job("fx_effect", q("""
WITH mo AS (
  SELECT budget_item_id, currency_id, date_id, SUM(amount_eur) AS eur FROM fact WHERE scenario_id = 1
  GROUP BY budget_item_id, currency_id, date_id
),
sides AS (
  SELECT budget_item_id, currency_id, date_id, CAST(eur AS DECIMAL(26,2)) AS eur, CAST(0 AS DECIMAL(26,2)) AS eur_py FROM mo
  UNION ALL
  SELECT budget_item_id, currency_id, CAST(strftime(last_day(make_date(date_id // 10000 + 1, date_id // 100 % 100, 1)),
                                    '%Y%m%d') AS INTEGER), CAST(0 AS DECIMAL(26,2)), CAST(eur AS DECIMAL(26,2)) FROM mo
),
cells AS (
  SELECT budget_item_id, currency_id, date_id, CAST(SUM(eur) AS DECIMAL(26,2)) AS eur, CAST(SUM(eur_py) AS DECIMAL(26,2)) AS eur_py
  FROM sides GROUP BY budget_item_id, currency_id, date_id
),
py AS (
  SELECT currency_id, CAST(strftime(last_day(make_date(date_id // 10000 + 1, date_id // 100 % 100, 1)), '%Y%m%d') AS INTEGER) AS date_id,
         eom_rate AS rate_py FROM rates
)
SELECT c.budget_item_id, c.currency_id, c.date_id, CAST(c.eur AS DOUBLE) AS eur, CAST(c.eur_py AS DOUBLE) AS eur_py,
       CAST(r.eom_rate AS DOUBLE) AS eom_rate, CAST(py.rate_py AS DOUBLE) AS rate_py,
       CAST((c.eur - c.eur_py) * py.rate_py AS DOUBLE) AS volume_effect,
       CAST(c.eur * (r.eom_rate - py.rate_py) AS DOUBLE) AS rate_effect,
       CAST(c.eur * r.eom_rate - c.eur_py * py.rate_py AS DOUBLE) AS total_effect
FROM cells c JOIN rates r ON r.date_id = c.date_id AND r.currency_id = c.currency_id
JOIN py ON py.currency_id = c.currency_id AND py.date_id = c.date_id
WHERE c.date_id <= (SELECT MAX(date_id) FROM mo)
"""))
def fx_effect(spark, sf_dir):
    """Actual nominal change vs. the prior-year month by item and currency, split into volume and rate."""
    m = stored_model(spark, sf_dir)
    return fx.fx_effect(m.fact.filter(F.col("scenario_id") == 1), m.rates, ["budget_item_id"])
