"""Jobs: actual vs budget, forecast vs budget, forecast accuracy, scenario pivot, waterfalls."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM
from ..operators import statements, variance
from ..operators.profit import signed_pl
from ..sources import fixed
from ..sources.store import stored_model
from ..sources.tpch import ADAPTER_SCENARIOS
from .oracle_sql import q
from .registry import job

#: Versions of scenarios by fiscal year, and the pairs of them that share months.
VERSIONS_SQL = """versions AS (
  SELECT f.scenario_id, s.scenario_name, s.scenario_type, CASE WHEN s.scenario_type <> 'Actual' THEN f.year END AS fiscal_year,
         MIN(f.date_id) AS first_month, MAX(f.date_id) AS last_month, COUNT(DISTINCT f.date_id) AS months, COUNT(*) AS row_count
  FROM fact f JOIN scenarios s ON s.scenario_id = f.scenario_id GROUP BY 1, 2, 3, 4
)"""


def _fiscal_sql(left: str, right: str, columns: str) -> str:
    return q(f"""
WITH {VERSIONS_SQL},
pairs AS (
  SELECT l.scenario_id AS left_id, r.scenario_id AS right_id, COALESCE(r.fiscal_year, l.fiscal_year) AS fiscal_year,
         GREATEST(l.first_month, r.first_month) AS lo, LEAST(l.last_month, r.last_month) AS hi
  FROM versions l, versions r
  WHERE l.{left} AND r.{right} AND l.first_month <= r.last_month AND r.first_month <= l.last_month
    AND (l.fiscal_year IS NULL OR r.fiscal_year IS NULL OR l.fiscal_year = r.fiscal_year)
),
sides AS (
  SELECT left_id, right_id, fiscal_year, left_id AS scenario_id, TRUE AS is_left, lo, hi FROM pairs
  UNION ALL SELECT left_id, right_id, fiscal_year, right_id, FALSE, lo, hi FROM pairs
),
v AS (
  SELECT p.left_id, p.right_id, p.fiscal_year, n.budget_item_id, n.item_name, n.sort_order, n.sign_convention,
         SUM(CASE WHEN p.is_left THEN CASE WHEN e.leaf_sign < 0 THEN -f.amount_eur ELSE f.amount_eur END END) AS ls,
         SUM(CASE WHEN NOT p.is_left THEN CASE WHEN e.leaf_sign < 0 THEN -f.amount_eur ELSE f.amount_eur END END) AS rs
  FROM sides p JOIN fact f ON f.scenario_id = p.scenario_id AND f.date_id BETWEEN p.lo AND p.hi
  JOIN edges e ON e.leaf_id = f.budget_item_id JOIN items n ON n.budget_item_id = e.node_id
  WHERE n.statement_type = 'PL'
  GROUP BY p.left_id, p.right_id, p.fiscal_year, n.budget_item_id, n.item_name, n.sort_order, n.sign_convention
),
d AS (SELECT *, CASE WHEN sign_convention < 0 THEN -ls ELSE ls END AS l, CASE WHEN sign_convention < 0 THEN -rs ELSE rs END AS r FROM v)
SELECT {columns}, budget_item_id, item_name, sort_order, CAST(l AS DOUBLE) AS {{L}}, CAST(r AS DOUBLE) AS {{R}},
       CAST(l - r AS DOUBLE) AS variance, round(CAST(l - r AS DOUBLE) / NULLIF(abs(CAST(r AS DOUBLE)), 0), 6) AS variance_pct,
       CASE WHEN ls IS NULL OR rs IS NULL THEN 'n/a' WHEN ls - rs > 0 THEN 'favourable'
            WHEN ls - rs < 0 THEN 'adverse' ELSE 'on plan' END AS status
FROM d
""")


def _fiscal(spark, sf_dir, left, right):
    m = stored_model(spark, sf_dir)
    pairs = variance.version_pairs(m.versions, F.expr(left), F.expr(right))
    return variance.fiscal_variance(m.fact, m.items, pairs)


@job("actual_vs_budget", _fiscal_sql("scenario_id = 1", "scenario_id = 2", "fiscal_year").replace("{L}", "actual").replace("{R}", "budget"))
def actual_vs_budget(spark, sf_dir):
    """P&L lines by fiscal year of the budget: actual, budget, variance, variance % and favourability, over the months both have."""
    v = _fiscal(spark, sf_dir, "scenario_id = 1", "scenario_id = 2")
    return v.drop("left_id", "right_id").withColumnsRenamed({"left_amount": "actual", "right_amount": "budget"})


@job("forecast_vs_budget", _fiscal_sql("scenario_id = 7", "scenario_id = 2", "fiscal_year").replace("{L}", "forecast").replace("{R}", "budget"))
def forecast_vs_budget(spark, sf_dir):
    """P&L lines: each fiscal year's rolling forecast against its budget."""
    v = _fiscal(spark, sf_dir, "scenario_id = 7", "scenario_id = 2")
    return v.drop("left_id", "right_id").withColumnsRenamed({"left_amount": "forecast", "right_amount": "budget"})


@job("actual_vs_yearly_budget", _fiscal_sql("scenario_type = 'Actual'", "scenario_type = 'Budget'", "left_id, right_id, fiscal_year")
     .replace("{L}", "left_amount").replace("{R}", "right_amount"))
def actual_vs_yearly_budget(spark, sf_dir):
    """P&L lines: the actuals against every budget of a fiscal year, in one report."""
    return _fiscal(spark, sf_dir, "scenario_type = 'Actual'", "scenario_type = 'Budget'")


@job("forecast_vs_each_budget", _fiscal_sql("scenario_type = 'Forecast'", "scenario_type = 'Budget'", "left_id, right_id, fiscal_year")
     .replace("{L}", "left_amount").replace("{R}", "right_amount"))
def forecast_vs_each_budget(spark, sf_dir):
    """P&L lines: every forecast against each budget of its fiscal year (original, top-down, bottom-up)."""
    return _fiscal(spark, sf_dir, "scenario_type = 'Forecast'", "scenario_type = 'Budget'")


@job("scenario_versions", q(f"WITH {VERSIONS_SQL} SELECT * REPLACE (CAST(fiscal_year AS DOUBLE) AS fiscal_year) FROM versions"))
def scenario_versions(spark, sf_dir):
    """Validity table: every scenario's versions by fiscal year, the months they hold and their rows."""
    m = stored_model(spark, sf_dir)
    return variance.validity(m.fact, m.scenarios).withColumn("fiscal_year", F.col("fiscal_year").cast("double"))


@job("forecast_accuracy", q("""
WITH s AS (
  SELECT year, month, SUM(CASE WHEN scenario_id = 1 THEN signed END) AS actual,
         SUM(CASE WHEN scenario_id = 7 THEN signed END) AS forecast
  FROM ni_rows WHERE scenario_id IN (1, 7) GROUP BY year, month
),
e AS (
  SELECT year, month, actual, forecast, forecast - actual AS error,
         abs(CAST(forecast - actual AS DOUBLE)) / NULLIF(abs(CAST(actual AS DOUBLE)), 0) AS ape
  FROM s WHERE actual IS NOT NULL AND forecast IS NOT NULL
)
SELECT year, month, CAST(actual AS DOUBLE) AS actual, CAST(forecast AS DOUBLE) AS forecast,
       CAST(error AS DOUBLE) AS error, round(ape, 6) AS ape, round(avg(ape) OVER (PARTITION BY year), 6) AS mape
FROM e
"""))
def forecast_accuracy(spark, sf_dir):
    """Monthly Net Income: forecast vs actual error, absolute % error and MAPE per year."""
    m = stored_model(spark, sf_dir)
    s = signed_pl(m.fact.filter(F.col("scenario_id").isin(1, 7)), m.items)
    series = variance.align(s, ["year", "month"], {"actual": 1, "forecast": 7}, measure="signed")
    return variance.forecast_accuracy(series, ["year", "month"], ["year"])


@job("scenario_pivot", q(f"""
SELECT year,
       {", ".join(f"CAST(SUM(CASE WHEN scenario_id = {i} THEN signed END) AS DOUBLE) AS scenario_{i}" for i, *_ in ADAPTER_SCENARIOS)}
FROM pl_lines WHERE budget_item_id = 21 GROUP BY year
"""))
def scenario_pivot(spark, sf_dir):
    """Net Income by year with one column per scenario of the scenario table."""
    m = stored_model(spark, sf_dir)
    lines = statements.statement(m.fact, m.items, "PL", ["scenario_id", "year"])
    ids = sorted(r.scenario_id for r in m.scenarios.select("scenario_id").collect())  # a dimension
    p = (lines.filter(F.col("budget_item_id") == 21).groupBy("year")
         .pivot("scenario_id", ids).agg(F.sum("signed").cast(MONEY_SUM)))
    return p.select("year", *[F.col(str(i)).alias(f"scenario_{i}") for i in ids])


#: P&L lines without a parent; the formula subtotals among them are totals, the others steps.
_FORMULAS = [n for n, _ in fixed.FORMULA_NODES]
_ROOTS_SQL = "SELECT budget_item_id FROM items WHERE parent_item_id IS NULL AND statement_type = 'PL'"
_STEPS_SQL = f"{_ROOTS_SQL} AND budget_item_id NOT IN ({', '.join(map(str, _FORMULAS))})"
_LAST_SQL = "(SELECT MAX(sort_order) + 1 FROM items WHERE statement_type = 'PL')"


def _roots(items):
    return items.filter(F.col("parent_item_id").isNull() & (F.col("statement_type") == "PL")).select("budget_item_id")


@job("variance_waterfall", q(f"""
WITH ni AS (
  SELECT year, SUM(CASE WHEN scenario_id = 1 THEN signed END) AS act,
         SUM(CASE WHEN scenario_id = 2 THEN signed END) AS bud
  FROM pl_lines WHERE budget_item_id = 21 AND scenario_id IN (1, 2) GROUP BY year
),
yrs AS (SELECT year FROM ni WHERE act IS NOT NULL AND bud IS NOT NULL),
steps AS (
  SELECT year, 0 AS step, 'Budget Net Income' AS label, bud AS amount, TRUE AS is_total FROM ni
  WHERE year IN (SELECT year FROM yrs)
  UNION ALL
  SELECT p.year, CAST(p.sort_order AS INTEGER), p.item_name,
         SUM(CASE WHEN p.scenario_id = 1 THEN p.signed END) - SUM(CASE WHEN p.scenario_id = 2 THEN p.signed END),
         FALSE
  FROM pl_lines p WHERE p.budget_item_id IN ({_STEPS_SQL}) AND p.scenario_id IN (1, 2)
    AND p.year IN (SELECT year FROM yrs)
  GROUP BY p.year, p.sort_order, p.item_name
  UNION ALL
  SELECT year, {_LAST_SQL}, 'Actual Net Income', act, TRUE FROM ni WHERE year IN (SELECT year FROM yrs)
),
w AS (
  SELECT *, SUM(CASE WHEN step = {_LAST_SQL} THEN 0 ELSE amount END)
              OVER (PARTITION BY year ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM steps
)
SELECT year, step, label, CAST(amount AS DOUBLE) AS amount, is_total,
       CAST(CASE WHEN step IN (0, {_LAST_SQL}) THEN 0 ELSE run - amount END AS DOUBLE) AS bar_start,
       CAST(CASE WHEN step IN (0, {_LAST_SQL}) THEN amount ELSE run END AS DOUBLE) AS bar_end
FROM w
"""))
def variance_waterfall(spark, sf_dir):
    """Budget Net Income -> signed variance of each top-level P&L line -> Actual Net Income.

    One aggregate per (year, line) feeds every bar: Net Income rows expand into the
    opening and closing totals, the other lines into their variance steps (a
    generator, not three branches over the ledger).
    """
    m = stored_model(spark, sf_dir)
    lines = statements.statement(m.fact.filter(F.col("scenario_id").isin(1, 2)), m.items, "PL",
                                 ["scenario_id", "year"])
    shown = _roots(m.items).filter((F.col("budget_item_id") == 21) | ~F.col("budget_item_id").isin(*_FORMULAS))
    last = m.items.filter(F.col("statement_type") == "PL").agg((F.max("sort_order") + 1).alias("last"))  # one row: after every line
    g = variance.align(lines.join(F.broadcast(shown), "budget_item_id", "left_semi"),
                       ["year", "budget_item_id", "sort_order", "item_name"], {"a": 1, "b": 2}, measure="signed").crossJoin(F.broadcast(last))
    ni = F.col("budget_item_id") == 21

    def bar(step, label, amount, total):
        return F.struct(step.alias("step"), label.alias("label"), amount.cast(MONEY_SUM).alias("amount"),
                        F.lit(total).alias("is_total"))

    rows = F.array(F.when(ni, bar(F.lit(0), F.lit("Budget Net Income"), F.col("b"), True)),
                   F.when(~ni, bar(F.col("sort_order"), F.col("item_name"), F.col("a") - F.col("b"), False)),
                   F.when(ni, bar(F.col("last"), F.lit("Actual Net Income"), F.col("a"), True)))
    both = F.max(F.when(ni & F.col("a").isNotNull() & F.col("b").isNotNull(), F.lit(1))).over(
        Window.partitionBy("year"))
    steps = (g.withColumn("_both", both).filter(F.col("_both") == 1)
             .select("year", "last", F.explode(rows).alias("s")).filter(F.col("s").isNotNull())
             .select("year", "last", "s.step", "s.label", "s.amount", "s.is_total"))
    # the opening total carries the running sum: a step for the window, a total for display
    w = variance.waterfall(steps.withColumn("is_total", F.col("step") == F.col("last")), ["year"])
    return w.select("year", "step", "label", "amount", ((F.col("step") == 0) | (F.col("step") == F.col("last"))).alias("is_total"),
                    F.when(F.col("step") == 0, F.lit(0).cast(MONEY_SUM)).otherwise(F.col("bar_start"))
                    .alias("bar_start"), "bar_end")


@job("pl_waterfall", q(f"""
WITH steps AS (
  SELECT scenario_id, year, sort_order AS step, item_name AS label, signed AS amount,
         budget_item_id IN ({', '.join(map(str, _FORMULAS))}) AS is_total
  FROM pl_lines WHERE budget_item_id IN ({_ROOTS_SQL})
),
w AS (
  SELECT *, SUM(CASE WHEN is_total THEN 0 ELSE amount END)
              OVER (PARTITION BY scenario_id, year ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS run
  FROM steps
)
SELECT scenario_id, year, step, label, CAST(amount AS DOUBLE) AS amount, is_total,
       CAST(CASE WHEN is_total THEN 0 ELSE run - amount END AS DOUBLE) AS bar_start,
       CAST(CASE WHEN is_total THEN amount ELSE run END AS DOUBLE) AS bar_end
FROM w
"""))
def pl_waterfall(spark, sf_dir):
    """NII -> +non-interest -> -opex -> -provision -> PBT -> -tax -> Net Income (totals stand on zero)."""
    m = stored_model(spark, sf_dir)
    lines = statements.statement(m.fact, m.items, "PL", ["scenario_id", "year"])
    steps = (lines.join(F.broadcast(_roots(m.items)), "budget_item_id", "left_semi")
             .select("scenario_id", "year", F.col("sort_order").alias("step"), F.col("item_name").alias("label"),
                     F.col("signed").alias("amount"), F.col("budget_item_id").isin(*_FORMULAS).alias("is_total")))
    return variance.waterfall(steps, ["scenario_id", "year"])
