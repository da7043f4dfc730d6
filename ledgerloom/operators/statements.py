"""Financial statements: roll-up over the account tree with sign conventions.

Two sign views:
* ``signed``  = amount x sign_convention(leaf), summed up the tree (arithmetic view)
* ``display`` = sign_convention(node) x signed (presentation view: costs positive)

Plan: filter the fact to the statement's leaves (broadcast semi join), sum to
(by, leaf) — partial aggregation before the shuffle — then broadcast-join the
bounded edge list and sum again (a tiny second shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM, safe_ratio
from . import hierarchy
from .counts import check_additive


def leaf_totals(fact: DataFrame, items: DataFrame, by: list[str], measure: str = "amount_eur",
                statement_type: str | None = None) -> DataFrame:
    """Sum ``measure`` to (by, budget_item_id) over the statement's posting leaves."""
    check_additive(by, [measure])
    lv = items.filter(~F.col("is_subtotal"))
    if statement_type:
        lv = lv.filter(F.col("statement_type") == statement_type)
    f = fact.join(F.broadcast(lv.select("budget_item_id")), "budget_item_id", "left_semi")
    return f.groupBy(*by, "budget_item_id").agg(F.sum(measure).cast(MONEY_SUM).alias("amount"))


def rollup(leaf: DataFrame, items: DataFrame, by: list[str], with_formulas: bool = True) -> DataFrame:
    """(by, node_id, signed) from leaf totals (by, budget_item_id, amount)."""
    edges = F.broadcast(hierarchy.cached_edges(items, with_formulas))
    j = leaf.join(edges, leaf.budget_item_id == edges.leaf_id)
    return (j.groupBy(*by, "node_id")
            .agg(F.sum(hierarchy.signed(F.col("amount"), F.col("leaf_sign"))).cast(MONEY_SUM).alias("signed")))


def statement(fact: DataFrame, items: DataFrame, statement_type: str | None, by: list[str],
              measure: str = "amount_eur", with_formulas: bool = True) -> DataFrame:
    """Statement lines (by, node) with names, order, signed and display amounts."""
    leaf = leaf_totals(fact, items, by, measure, statement_type)
    r = rollup(leaf, items, by, with_formulas)
    nodes = items if statement_type is None else items.filter(F.col("statement_type") == statement_type)
    it = F.broadcast(nodes.select(
        F.col("budget_item_id").alias("node_id"), "item_name", "sort_order", "sign_convention",
        "is_subtotal"))
    return (r.join(it, "node_id")
            .select(*by, F.col("node_id").alias("budget_item_id"), "item_name", "sort_order",
                    "is_subtotal", "signed",
                    hierarchy.signed(F.col("signed"), F.col("sign_convention")).alias("display")))


def closing_lines(lines: DataFrame, period_keys: list[str], other_keys: list[str],
                  value_cols: list[str], date_col: str = "date_id") -> DataFrame:
    """Semi-additive pick: every line at the period's one closing month-end.

    The closing month is that of the whole statement, so a sheet never mixes dates; a line
    without postings in that month has no row there.
    """
    w = Window.partitionBy(*period_keys)
    at_close = (lines.withColumn("closing_date_id", F.max(date_col).over(w))
                .filter(F.col(date_col) == F.col("closing_date_id")))
    return at_close.select(*period_keys, *other_keys, "closing_date_id", *value_cols)


def balance_check(bs_lines: DataFrame, by: list[str], assets: int = 22, liabilities: int = 31,
                  equity: int = 39) -> DataFrame:
    """Assets - Liabilities - Equity in display signs (a report, not an assertion)."""
    def pick(node):
        return F.sum(F.when(F.col("budget_item_id") == node, F.col("display"))).cast(MONEY_SUM)

    g = bs_lines.groupBy(*by).agg(pick(assets).alias("assets"), pick(liabilities).alias("liabilities"),
                                  pick(equity).alias("equity"))
    return g.withColumn("difference",
                        (F.col("assets") - F.col("liabilities") - F.col("equity")).cast(MONEY_SUM))


def ratios_of(fact: DataFrame, items: DataFrame, by: list[str]) -> DataFrame:
    """Loan-to-deposit (24/32), equity-to-assets (39/22), cost-to-income (14/(1+9)),
    net interest margin (1 / average of 22 on daily-average EUR); ratios as doubles.

    Everything comes from one aggregate of the fact to (by, month-end, item); flows are then
    summed over the months, balances taken at the period's closing month-end.
    """
    leaf = fact.groupBy(*by, "date_id", "budget_item_id").agg(
        F.sum("amount_eur").cast(MONEY_SUM).alias("amount"), F.sum("daily_avg_eur").cast(MONEY_SUM).alias("daily"))
    edges = F.broadcast(hierarchy.cached_edges(items, True))
    nodes = F.broadcast(items.select(F.col("budget_item_id").alias("node_id"), "sign_convention",
                                     (F.col("statement_type") == "BS").alias("bs")))
    j = leaf.join(edges, leaf.budget_item_id == edges.leaf_id).join(nodes, "node_id")
    shown = hierarchy.signed(hierarchy.signed(F.col("amount"), F.col("leaf_sign")), F.col("sign_convention"))

    def pick(node, value=shown):
        return F.sum(F.when(F.col("node_id") == node, value)).cast(MONEY_SUM)

    monthly = j.groupBy(*by, "date_id").agg(
        pick(14).alias("opex"), pick(1).alias("nii"), pick(9).alias("nonii"), pick(24).alias("loans"),
        pick(32).alias("deposits"), pick(39).alias("equity"), pick(22).alias("assets"),
        pick(22, F.col("daily")).alias("avg"), F.max("bs").alias("bs"))
    close = F.max(F.when(F.col("bs"), F.col("date_id"))).over(Window.partitionBy(*by))
    w = monthly.withColumn("closing", close)

    def at_close(c):
        return F.sum(F.when(F.col("date_id") == F.col("closing"), F.col(c))).alias(c)

    g = w.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("opex", "nii", "nonii")],
                           *[at_close(c) for c in ("loans", "deposits", "equity", "assets")],
                           (F.sum("avg").cast("double") / F.count("avg")).alias("avg_assets"))
    return g.select(*by, safe_ratio("loans", "deposits").alias("loan_to_deposit"),
                    safe_ratio("equity", "assets").alias("equity_to_assets"),
                    safe_ratio(F.col("opex"), F.col("nii") + F.col("nonii")).alias("cost_to_income"),
                    safe_ratio("nii", "avg_assets").alias("net_interest_margin"))
