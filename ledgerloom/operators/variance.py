"""Scenario alignment, variance, forecast accuracy, pivot and waterfalls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions.numeric import MONEY_SUM, safe_ratio
from . import statements


def align(fact: DataFrame, keys: list[str], sides: dict[str, int], measure: str = "amount_eur") -> DataFrame:
    """Pair scenarios on common keys by conditional aggregation (a one-pass full outer alignment).

    ``sides`` maps output column -> scenario_id; a side with no rows stays NULL.
    The scenario filter is a partition filter on the stored ledger.
    """
    f = fact.filter(F.col("scenario_id").isin(list(sides.values())))
    aggs = [F.sum(F.when(F.col("scenario_id") == sid, F.col(measure))).cast(MONEY_SUM).alias(name)
            for name, sid in sides.items()]
    return f.groupBy(*keys).agg(*aggs)


def _status(left, right):
    diff = left - right
    return (F.when(left.isNull() | right.isNull(), F.lit("n/a")).when(diff > 0, F.lit("favourable"))
            .when(diff < 0, F.lit("adverse")).otherwise(F.lit("on plan")))


def variance(lines: DataFrame, keys: list[str], left: int, right: int,
             left_name: str = "actual", right_name: str = "budget") -> DataFrame:
    """Per key: left/right display amounts, variance, variance %, favourable status.

    ``lines`` carries scenario_id, keys, signed and display (statement lines).
    variance = display difference; % = variance / |right| (NULL when right is 0
    or missing); favourability compares *signed* amounts (income up or cost
    down is favourable).  A missing side stays NULL.
    """
    f = lines.filter(F.col("scenario_id").isin(left, right))

    def side(sid, col):
        return F.sum(F.when(F.col("scenario_id") == sid, F.col(col))).cast(MONEY_SUM)

    g = f.groupBy(*keys).agg(side(left, "display").alias(left_name), side(right, "display").alias(right_name),
                             side(left, "signed").alias("_ls"), side(right, "signed").alias("_rs"))
    var = (F.col(left_name) - F.col(right_name)).cast(MONEY_SUM)
    return g.select(*keys, left_name, right_name, var.alias("variance"),
                    safe_ratio(var, F.abs(F.col(right_name))).alias("variance_pct"),
                    _status(F.col("_ls"), F.col("_rs")).alias("status"))


def validity(fact: DataFrame, scenarios: DataFrame) -> DataFrame:
    """scenario_id, scenario_name, scenario_type, fiscal_year, first_month, last_month, months, row_count: versions of scenarios.

    A plan is one version for each fiscal year it has amounts for; actuals are one version without a fiscal year.
    Months are the month-ends with rows.  One aggregation of the ledger's keys, to (scenario, month).
    """
    months = fact.groupBy("scenario_id", "date_id").agg(F.count(F.lit(1)).alias("n"))
    named = months.join(F.broadcast(scenarios.select("scenario_id", "scenario_name", "scenario_type")), "scenario_id")
    fiscal = F.when(F.col("scenario_type") != "Actual", fd.year_of("date_id"))
    return named.groupBy("scenario_id", "scenario_name", "scenario_type", fiscal.alias("fiscal_year")).agg(
        F.min("date_id").alias("first_month"), F.max("date_id").alias("last_month"), F.count(F.lit(1)).alias("months"), F.sum("n").alias("row_count"))


def version_pairs(versions: DataFrame, left: Column, right: Column) -> DataFrame:
    """left_id, right_id, fiscal_year, first_month, last_month: versions that can be compared, and over which months.

    Interval join: the two share months, and if both have a fiscal year it is the same.  ``left`` and ``right``
    choose the versions of either side.
    """
    l, r = (versions.where(w).select(F.col("scenario_id").alias(f"{s}_id"), F.col("fiscal_year").alias(f"{s}_fy"),
                                     F.col("first_month").alias(f"{s}_first"), F.col("last_month").alias(f"{s}_last"))
            for s, w in (("left", left), ("right", right)))
    same = F.col("left_fy").isNull() | F.col("right_fy").isNull() | (F.col("left_fy") == F.col("right_fy"))
    j = l.join(r, (F.col("left_first") <= F.col("right_last")) & (F.col("right_first") <= F.col("left_last")) & same)
    return j.select("left_id", "right_id", F.coalesce("right_fy", "left_fy").alias("fiscal_year"),
                    F.greatest("left_first", "right_first").alias("first_month"), F.least("left_last", "right_last").alias("last_month"))


def fiscal_variance(fact: DataFrame, items: DataFrame, pairs: DataFrame, statement_type: str = "PL") -> DataFrame:
    """Statement lines of every pair of versions over the months both have: like is held against like.

    The ledger is summed to (scenario, month, account) once; months go to the sides of the pairs by scenario and
    interval (``pairs`` is bounded by scenarios and years).  A line that one side doesn't have stays NULL there.
    """
    monthly = fact.groupBy("scenario_id", "date_id", "budget_item_id").agg(F.sum("amount_eur").cast(MONEY_SUM).alias("amount_eur"))
    sides = F.explode(F.array(F.struct(F.lit(True).alias("is_left"), F.col("left_id").alias("scenario_id")),
                              F.struct(F.lit(False).alias("is_left"), F.col("right_id").alias("scenario_id"))))
    by = ["left_id", "right_id", "fiscal_year", "is_left"]
    wanted = pairs.withColumn("side", sides).select(*by[:3], "side.*", "first_month", "last_month")
    mine = monthly.join(F.broadcast(wanted), "scenario_id").where("date_id BETWEEN first_month AND last_month")
    lines = statements.statement(mine, items, statement_type, by)

    def side(is_left, col):
        return F.sum(F.when(F.col("is_left") == is_left, F.col(col))).cast(MONEY_SUM)

    keys = ["left_id", "right_id", "fiscal_year", "budget_item_id", "item_name", "sort_order"]
    g = lines.groupBy(*keys).agg(side(True, "display").alias("left_amount"), side(False, "display").alias("right_amount"),
                                 side(True, "signed").alias("_ls"), side(False, "signed").alias("_rs"))
    var = (F.col("left_amount") - F.col("right_amount")).cast(MONEY_SUM)
    return g.select(*keys, "left_amount", "right_amount", var.alias("variance"),
                    safe_ratio(var, F.abs(F.col("right_amount"))).alias("variance_pct"),
                    _status(F.col("_ls"), F.col("_rs")).alias("status"))


def waterfall(steps: DataFrame, partition: list[str], order: str = "step") -> DataFrame:
    """Bars of a waterfall: totals stand on zero, steps float on the running sum.

    ``steps`` has partition keys, ``step`` order, ``amount`` and ``is_total``.
    The running sum is a window per partition (never global).
    """
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.when(F.col("is_total"), F.lit(0)).otherwise(F.col("amount"))).over(w).cast(MONEY_SUM)
    end = F.when(F.col("is_total"), F.col("amount")).otherwise(run)
    start = F.when(F.col("is_total"), F.lit(0).cast(MONEY_SUM)).otherwise(run - F.col("amount"))
    return steps.select("*", start.cast(MONEY_SUM).alias("bar_start"), end.cast(MONEY_SUM).alias("bar_end"))


def forecast_accuracy(series: DataFrame, keys: list[str], period_keys: list[str]) -> DataFrame:
    """Error by period where forecast and actual both exist; MAPE per ``period_keys``."""
    both = series.filter(F.col("actual").isNotNull() & F.col("forecast").isNotNull())
    err = (F.col("forecast") - F.col("actual")).cast(MONEY_SUM)
    ape = F.abs(err.cast("double")) / F.nullif(F.abs(F.col("actual").cast("double")), F.lit(0.0))
    out = both.select(*keys, "actual", "forecast", err.alias("error"), ape.alias("_ape"))
    w = Window.partitionBy(*period_keys)
    return out.select(*keys, "actual", "forecast", "error", F.round("_ape", 6).alias("ape"),
                      F.round(F.avg("_ape").over(w), 6).alias("mape"))
