"""Jobs: coverage matrix, driver-based scenario amounts, growth plan, rolling forecast, top-down vs bottom-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions.numeric import MONEY_SUM
from ..operators import planning
from ..operators.variance import align
from ..sources import fixed
from ..sources.dates import calendar, month_end_spine
from ..sources.model import default_fill
from ..sources.store import stored_model
from ..sources.tpch import BOTTOMUP_UPLIFT, BUDGET_UPLIFT, FLAGSHIPS, FORECAST_CUTOFF_MONTH, FORECAST_UPLIFT, TOPDOWN_UPLIFT
from .oracle_sql import _values, q
from .registry import job

_COVERAGE_SQL = "\n  UNION ALL\n  ".join(
    f"SELECT ch.channel_id, {seg} AS segment_id, p.product_id, p.currency_id "
    f"FROM (VALUES {', '.join(f'({c})' for c in chs)}) ch(channel_id) "
    f"CROSS JOIN (VALUES {', '.join(f'({a}, {b})' for a, b in pairs)}) p(product_id, currency_id)"
    for chs, seg, pairs in fixed.COVERAGE_RULES)


@job("coverage_matrix", q(f"""
WITH cov AS (
  {_COVERAGE_SQL}
),
n AS (SELECT channel_id, segment_id, product_id, currency_id, COUNT(*) AS n FROM fact WHERE scenario_id = 1
      GROUP BY channel_id, segment_id, product_id, currency_id)
SELECT cov.channel_id, cov.segment_id, cov.product_id, cov.currency_id, COALESCE(n.n, 0) AS fact_rows
FROM cov LEFT JOIN n ON n.channel_id = cov.channel_id AND n.segment_id = cov.segment_id
  AND n.product_id = cov.product_id AND n.currency_id = cov.currency_id
"""))
def coverage_matrix(spark, sf_dir):
    """The rule-based coverage matrix (595 combinations) with the actual rows found on each."""
    m = stored_model(spark, sf_dir)
    keys = ["channel_id", "segment_id", "product_id", "currency_id"]
    cov = planning.coverage_matrix(spark)
    n = m.fact.filter(F.col("scenario_id") == 1).groupBy(*keys).agg(F.count("*").alias("n"))
    return (cov.join(n, keys, "left")
            .select(*keys, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("fact_rows")))


_BLOCKS_SQL = _values([(s, y, b, str(ma), str(mb), c, ss, sa, sd)
                       for s, y, b, ma, mb, c, ss, sa, sd in fixed.PLAN_BLOCKS])


def _noise_sql(slot: int, span: str) -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', '42', scenario_id, date_id, channel_id, segment_id, "
            f"product_id, currency_id, budget_item_id)), {1 + 8 * slot}, 8))::BIGINT % {span} - {span} // 2)")


_DRIVERS_SQL = {
    "base": _values([(sset, cat, v) for sset, pairs in fixed.DRIVER_BASE.items() for cat, v in pairs]),
    "base_other": _values([(sset, v) for sset, v in fixed.BASE_OTHER.items()]),
    "chan": _values([(t, v) for t, v in fixed.DRIVER_CHANNEL]),
    "seg": _values([(k, v) for k, v in fixed.DRIVER_SEGMENT]),
    "season": _values([(sset, qn, v) for sset, pairs in fixed.DRIVER_SEASON.items() for qn, v in pairs]),
    "cur": _values([(k, v) for k, v in fixed.DRIVER_CURRENCY]),
    "adj": _values([(c, v) for c, v in fixed.DRIVER_DAILY_ADJ]),
}


@job("scenario_amounts", q(f"""
WITH combos AS (SELECT DISTINCT channel_id, segment_id, product_id, currency_id FROM fact WHERE scenario_id = 1),
blocks_raw(scenario_id, year, base_set, mult_a, mult_b, cutoff_month, season_set, span_amount, span_daily)
  AS (VALUES {_BLOCKS_SQL}),
blocks AS (SELECT scenario_id, year, base_set, CAST(mult_a AS DECIMAL(5,4)) AS mult_a,
                  CAST(mult_b AS DECIMAL(5,4)) AS mult_b, cutoff_month, season_set, span_amount, span_daily
           FROM blocks_raw),
d_base(base_set, category, v) AS (VALUES {_DRIVERS_SQL["base"]}),
d_base_other(base_set, v) AS (VALUES {_DRIVERS_SQL["base_other"]}),
d_chan(channel_type, v) AS (VALUES {_DRIVERS_SQL["chan"]}),
d_seg(segment_id, v) AS (VALUES {_DRIVERS_SQL["seg"]}),
d_season(season_set, quarter, v) AS (VALUES {_DRIVERS_SQL["season"]}),
d_cur(currency_id, v) AS (VALUES {_DRIVERS_SQL["cur"]}),
d_adj(category, v) AS (VALUES {_DRIVERS_SQL["adj"]}),
pme AS (SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_id,
               CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
               CAST(quarter(d) AS INTEGER) AS quarter
        FROM (SELECT last_day(CAST(unnest(generate_series(DATE '2022-01-01', DATE '2026-12-01',
                                                          INTERVAL 1 MONTH)) AS DATE)) AS d) x),
sp AS (
  SELECT b.scenario_id, pme.date_id, c.channel_id, c.segment_id, c.product_id, c.currency_id,
         i.budget_item_id, pme.year, b.span_amount, b.span_daily,
         CAST(COALESCE(db.v, dbo.v) AS DECIMAL(38,0))
         * CAST(CASE WHEN ch.channel_name LIKE '{fixed.FLAGSHIP_PATTERN}' AND ch.channel_type = 'Branch'
                     THEN {fixed.DRIVER_CHANNEL_FLAGSHIP} ELSE COALESCE(dc.v, 1.0) END AS DECIMAL(3,2))
         * CAST(COALESCE(dsg.v, 1.0) AS DECIMAL(3,2))
         * (CASE WHEN pme.month <= b.cutoff_month THEN b.mult_a ELSE b.mult_b END)
         * CAST(COALESCE(dse.v, 1.0) AS DECIMAL(3,2))
         * CAST(COALESCE(dcu.v, 1.0) AS DECIMAL(3,2)) AS prod,
         CAST(COALESCE(da.v, 1.00) AS DECIMAL(3,2)) AS adj
  FROM combos c JOIN channels ch ON ch.channel_id = c.channel_id
  CROSS JOIN pme JOIN blocks b ON b.year = pme.year
  CROSS JOIN (SELECT budget_item_id, category FROM items WHERE NOT is_subtotal) i
  LEFT JOIN d_base db ON db.base_set = b.base_set AND db.category = i.category
  LEFT JOIN d_base_other dbo ON dbo.base_set = b.base_set
  LEFT JOIN d_chan dc ON dc.channel_type = ch.channel_type
  LEFT JOIN d_seg dsg ON dsg.segment_id = c.segment_id
  LEFT JOIN d_season dse ON dse.season_set = b.season_set AND dse.quarter = pme.quarter
  LEFT JOIN d_cur dcu ON dcu.currency_id = c.currency_id
  LEFT JOIN d_adj da ON da.category = i.category
),
r AS (
  SELECT scenario_id, year, budget_item_id,
         CAST(abs(prod + {_noise_sql(0, 'span_amount')}) AS DECIMAL(22,2)) AS amount_eur,
         CAST(abs(prod * adj + {_noise_sql(1, 'span_daily')}) AS DECIMAL(22,2)) AS daily_avg_eur
  FROM sp
)
SELECT scenario_id, year, budget_item_id, CAST(SUM(amount_eur) AS DOUBLE) AS amount_eur,
       CAST(SUM(daily_avg_eur) AS DOUBLE) AS daily_avg_eur, COUNT(*) AS row_count
FROM r GROUP BY scenario_id, year, budget_item_id
"""))
def scenario_amounts(spark, sf_dir):
    """The eleven plan blocks applied to the coverage spine observed in the actuals (seeded noise)."""
    m = stored_model(spark, sf_dir)
    combos = (m.fact.filter(F.col("scenario_id") == 1)
              .select("channel_id", "segment_id", "product_id", "currency_id").distinct())
    me = month_end_spine(calendar(spark, fixed.MODEL_START, fixed.MODEL_END))
    rows = planning.scenario_amounts(combos, m.channels, me, m.items,
                                     planning.plan_blocks(spark), seed=42)
    return (rows.withColumn("year", fd.year_of("date_id"))
            .groupBy("scenario_id", "year", "budget_item_id")
            .agg(F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur"),
                 F.sum("daily_avg_eur").cast(MONEY_SUM).alias("daily_avg_eur"),
                 F.count("*").alias("row_count")))


_SEASON = next(iter(fixed.DRIVER_SEASON))


@job("driven_plan", q(f"""
WITH d_chan(channel_type, v) AS (VALUES {_DRIVERS_SQL["chan"]}),
d_seg(segment_id, v) AS (VALUES {_DRIVERS_SQL["seg"]}),
d_season(season_set, quarter, v) AS (VALUES {_DRIVERS_SQL["season"]}),
d_cur(currency_id, v) AS (VALUES {_DRIVERS_SQL["cur"]}),
d_adj(category, v) AS (VALUES {_DRIVERS_SQL["adj"]}),
moved AS (SELECT f.*, CAST(f.date_id // 10000 + 1 AS INTEGER) AS plan_year, CAST((f.date_id // 100 % 100 + 2) // 3 AS INTEGER) AS plan_quarter
          FROM fact f WHERE f.scenario_id = 1),
p AS (
  SELECT m.plan_year, m.budget_item_id,
         m.amount_eur * CAST(CAST(CASE WHEN ch.channel_name LIKE '{FLAGSHIPS}' AND ch.channel_type = 'Branch'
             THEN {fixed.DRIVER_CHANNEL_FLAGSHIP} ELSE COALESCE(dc.v, 1.0) END AS DECIMAL(3,2))
           * CAST(COALESCE(ds.v, 1.0) AS DECIMAL(3,2)) * CAST(COALESCE(dn.v, 1.0) AS DECIMAL(3,2)) * CAST(COALESCE(du.v, 1.0) AS DECIMAL(3,2)) AS DECIMAL(12,8)) AS amount,
         CAST(COALESCE(da.v, 1.00) AS DECIMAL(3,2)) AS adj
  FROM moved m JOIN channels ch ON ch.channel_id = m.channel_id
  JOIN items i ON i.budget_item_id = m.budget_item_id
  LEFT JOIN d_chan dc ON dc.channel_type = ch.channel_type
  LEFT JOIN d_seg ds ON ds.segment_id = m.segment_id
  LEFT JOIN d_season dn ON dn.season_set = '{_SEASON}' AND dn.quarter = m.plan_quarter
  LEFT JOIN d_cur du ON du.currency_id = m.currency_id
  LEFT JOIN d_adj da ON da.category = i.category
)
SELECT plan_year AS year, budget_item_id, CAST(SUM(CAST(amount AS DECIMAL(22,2))) AS DOUBLE) AS amount_eur,
       CAST(SUM(CAST(amount * adj AS DECIMAL(22,2))) AS DOUBLE) AS daily_avg_eur, COUNT(*) AS row_count
FROM p GROUP BY plan_year, budget_item_id
"""))
def driven_plan(spark, sf_dir):
    """Next year's plan: the planning drivers applied to the actual amounts, by year and account."""
    m = stored_model(spark, sf_dir)
    rows = planning.driven_plan(m.fact.filter(F.col("scenario_id") == 1), m.channels, m.items, _SEASON, flagships=FLAGSHIPS)
    return rows.groupBy(fd.year_of("date_id").alias("year"), "budget_item_id").agg(
        F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur"), F.sum("daily_avg_eur").cast(MONEY_SUM).alias("daily_avg_eur"),
        F.count("*").alias("row_count"))


@job("driver_base", q(f"""
WITH d_base(base_set, category, v) AS (VALUES {_DRIVERS_SQL["base"]}),
c AS (SELECT i.category, COUNT(*) AS cells, SUM(f.amount_eur) AS total FROM fact f JOIN items i ON i.budget_item_id = f.budget_item_id
      WHERE f.scenario_id = 1 AND NOT i.is_subtotal GROUP BY i.category)
SELECT 'A' AS base_set, c.category, CAST(b.v AS DOUBLE) AS base, c.cells, round(CAST(c.total AS DOUBLE) / c.cells, 2) AS mean,
       round(CAST(c.total AS DOUBLE) / CAST(c.cells * b.v AS DOUBLE), 6) AS index
FROM c LEFT JOIN d_base b ON b.base_set = 'A' AND b.category = c.category
"""))
def driver_base(spark, sf_dir):
    """Actual amounts of a cell against the planning base of their category."""
    m = stored_model(spark, sf_dir)
    return planning.base_index(m.fact.filter(F.col("scenario_id") == 1), m.items, "A")


@job("default_fill", q("""
WITH k AS (SELECT year, channel_id, segment_id, product_id, currency_id, bool_or(scenario_id = 1) AS booked, bool_or(scenario_id = 2) AS planned
           FROM fact WHERE scenario_id IN (1, 2) GROUP BY ALL)
SELECT 2 AS scenario_id, year, channel_id, segment_id, product_id, currency_id, CAST(0 AS DOUBLE) AS amount_eur, CAST(0 AS DOUBLE) AS amount_nominal
FROM k WHERE booked AND NOT planned
"""))
def default_fill_job(spark, sf_dir):
    """Budget rows for combinations that are booked but not planned: their amounts are omitted, so the column defaults fill them."""
    m = stored_model(spark, sf_dir)
    keys = ["year", "channel_id", "segment_id", "product_id", "currency_id"]
    sid = F.col("scenario_id")
    both = m.fact.filter(sid.isin(1, 2)).groupBy(*keys).agg(F.bool_or(sid == 1).alias("booked"), F.bool_or(sid == 2).alias("planned"))
    rows = both.where("booked AND NOT planned").select(F.lit(2).alias("scenario_id"), *keys)
    return default_fill(rows, {c: F.lit(0).cast("decimal(22,2)") for c in ("amount_eur", "amount_nominal")})


#: Growth of plan scenarios over the actuals of the year before.
_GROWTH = [(2, BUDGET_UPLIFT), (5, TOPDOWN_UPLIFT), (6, BOTTOMUP_UPLIFT)]


def _growth_factors(spark, years):
    rows = [(s, v) for s, v in _GROWTH]
    return years.select("year").distinct().crossJoin(F.broadcast(spark.createDataFrame(rows, "scenario_id int, v string"))).select(
        "scenario_id", "year", F.col("v").cast("decimal(5,4)").alias("factor"))


_GROWTH_SQL = f"growth(scenario_id, factor) AS (VALUES {', '.join(f'({s}, CAST({v} AS DECIMAL(5,4)))' for s, v in _GROWTH)})"
_PLAN_KEYS = ["channel_id", "segment_id", "product_id", "currency_id", "budget_item_id"]


@job("growth_plan", q(f"""
WITH {_GROWTH_SQL},
p AS (SELECT g.scenario_id, f.year + 1 AS year, f.budget_item_id, CAST(f.amount_eur * g.factor AS DECIMAL(22,2)) AS amount
      FROM fact f, growth g WHERE f.scenario_id = 1)
SELECT scenario_id, year, budget_item_id, CAST(SUM(amount) AS DOUBLE) AS amount_eur, COUNT(*) AS row_count
FROM p GROUP BY scenario_id, year, budget_item_id
"""))
def growth_plan(spark, sf_dir):
    """Plans by scenario and year = prior-year actual of the same month x their growth factor, rounded per row."""
    m = stored_model(spark, sf_dir)
    plan = planning.growth_plan(m.fact.filter(F.col("scenario_id") == 1), _growth_factors(spark, m.dates), _PLAN_KEYS)
    return plan.groupBy("scenario_id", "year", "budget_item_id").agg(F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur"),
                                                                     F.count("*").alias("row_count"))


@job("apportioned_plan", q(f"""
WITH {_GROWTH_SQL},
t AS (SELECT g.scenario_id, f.year, CAST(SUM(f.amount_eur) * g.factor AS DECIMAL(38,2)) AS target
      FROM fact f, growth g WHERE f.scenario_id = 1 AND g.scenario_id IN (5, 6) GROUP BY g.scenario_id, f.year, g.factor),
x AS (SELECT g.scenario_id, f.*, floor(f.amount_eur * g.factor * 100) AS cents, f.amount_eur * g.factor * 100 - floor(f.amount_eur * g.factor * 100) AS rest
      FROM (SELECT year, date_id, channel_id, segment_id, product_id, currency_id, budget_item_id, amount_eur FROM fact WHERE scenario_id = 1) f, growth g WHERE g.scenario_id IN (5, 6)),
r AS (SELECT *, row_number() OVER (PARTITION BY scenario_id, year ORDER BY rest DESC, md5(concat_ws('|', date_id, channel_id, segment_id, product_id, currency_id, budget_item_id)),
             date_id, channel_id, segment_id, product_id, currency_id, budget_item_id) AS k, SUM(cents) OVER (PARTITION BY scenario_id, year) AS floors FROM x)
SELECT r.scenario_id, CAST(r.year + 1 AS INTEGER) AS year, r.budget_item_id,
       CAST(SUM(CAST((cents + CASE WHEN k <= t.target * 100 - floors THEN 1 ELSE 0 END) / 100 AS DECIMAL(38,2))) AS DOUBLE) AS amount_eur, COUNT(*) AS row_count
FROM r JOIN t ON t.scenario_id = r.scenario_id AND t.year = r.year GROUP BY r.scenario_id, r.year, r.budget_item_id
"""))
def apportioned_plan(spark, sf_dir):
    """Top-down and bottom-up plans whose rows add up to the cent: total of the year before x growth, dealt by largest remainders."""
    m = stored_model(spark, sf_dir)
    actual = m.fact.filter(F.col("scenario_id") == 1)
    factors = _growth_factors(spark, m.dates).where(F.col("scenario_id").isin(5, 6)).withColumn("year", F.col("year").cast("int"))
    target = (actual.groupBy("year").agg(F.sum("amount_eur").alias("t")).join(F.broadcast(factors), "year")
              .select("scenario_id", "year", (F.col("t").cast("decimal(26,2)") * F.col("factor")).cast("decimal(26,2)").alias("target")))
    shares = actual.select("year", "date_id", *_PLAN_KEYS, "amount_eur").join(F.broadcast(factors), "year").select(
        "scenario_id", "year", "date_id", *_PLAN_KEYS, (F.col("amount_eur") * F.col("factor")).alias("share"))
    out = planning.apportion(shares, ["scenario_id", "year"], ["date_id", *_PLAN_KEYS], "share", target)
    return out.groupBy("scenario_id", (F.col("year") + 1).alias("year"), "budget_item_id").agg(
        F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur"), F.count("*").alias("row_count"))


@job("rolling_forecast", q("""
SELECT year, month, CAST(SUM(amount_eur) AS DOUBLE) AS amount_eur, COUNT(*) AS row_count
FROM fact WHERE scenario_id = 7 GROUP BY year, month
"""))
def rolling_forecast(spark, sf_dir):
    """Forecast = actuals through September, then budget x 1.04 (per row), by month."""
    m = stored_model(spark, sf_dir)
    cols = ["date_id", "year", "month", "amount_eur"]
    fc = planning.rolling_forecast(m.fact.filter(F.col("scenario_id") == 1).select(*cols),
                                   m.fact.filter(F.col("scenario_id") == 2).select(*cols),
                                   FORECAST_CUTOFF_MONTH, FORECAST_UPLIFT)
    return fc.groupBy("year", "month").agg(F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur"),
                                           F.count("*").alias("row_count"))


@job("topdown_vs_bottomup", q("""
SELECT f.year, ch.channel_type,
       CAST(SUM(CASE WHEN f.scenario_id = 5 THEN f.amount_eur END) AS DOUBLE) AS topdown,
       CAST(SUM(CASE WHEN f.scenario_id = 6 THEN f.amount_eur END) AS DOUBLE) AS bottomup,
       CAST(SUM(CASE WHEN f.scenario_id = 5 THEN f.amount_eur END)
            - SUM(CASE WHEN f.scenario_id = 6 THEN f.amount_eur END) AS DOUBLE) AS difference
FROM fact f JOIN channels ch ON ch.channel_id = f.channel_id
WHERE f.scenario_id IN (5, 6)
GROUP BY f.year, ch.channel_type
"""))
def topdown_vs_bottomup(spark, sf_dir):
    """Top-down against bottom-up budget by year and channel type."""
    m = stored_model(spark, sf_dir)
    per = (m.fact.filter(F.col("scenario_id").isin(5, 6)).groupBy("scenario_id", "year", "channel_id")
           .agg(F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur")))
    a = align(per.join(m.channels.select("channel_id", "channel_type"), "channel_id"), ["year", "channel_type"], {"topdown": 5, "bottomup": 6})
    return a.withColumn("difference", (F.col("topdown") - F.col("bottomup")).cast(MONEY_SUM))
