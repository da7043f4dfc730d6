"""The bank planning model itself: 595 coverage combinations x 31 leaves x 12 months x 11 blocks.

Used by tests: row counts, closed-form totals with the noise off.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerloom.operators import fx, planning
from ledgerloom.sources import fixed
from ledgerloom.sources import model as md
from ledgerloom.sources.dates import calendar, month_end_spine


def reference_model(spark: SparkSession, seed: int | None = 42, blocks=None, rate_seed: int = 42) -> md.Model:
    items = md.budget_items(spark)
    cal = calendar(spark, fixed.MODEL_START, fixed.MODEL_END)
    me = month_end_spine(cal)
    ch = md.channels(spark)
    bl = planning.plan_blocks(spark, blocks or fixed.PLAN_BLOCKS)
    base = planning.scenario_amounts(planning.coverage_matrix(spark), ch, me, items, bl, seed=seed)
    rates = fx.rate_table(me, fx.bands(spark), rate_seed)
    fact = fx.add_nominal(base, rates).select(*md.FACT_COLUMNS)
    return md.Model(fact=fact, dates=cal, channels=ch, segments=md.segments(spark),
                    products=md.products(spark), rates=rates, scenarios=md.scenarios(spark), items=items)
