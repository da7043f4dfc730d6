"""Profitability drill-downs: signed P&L by dimension, rollup/cube/grouping sets, shares, top-N.

Plan rule: the fact is reduced to the (small) dimension keys with a partial
aggregate *before* any dimension attribute is joined, so the grouping-set
expansion (rollup/cube multiplies rows) runs on a few thousand rows, not on
the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM, safe_ratio
from . import hierarchy


def signed_pl(fact: DataFrame, items: DataFrame, measure: str = "amount_eur") -> DataFrame:
    """Fact rows on P&L leaves with ``signed`` = amount x sign (Net Income contribution)."""
    pl = F.broadcast(items.filter((F.col("statement_type") == "PL") & ~F.col("is_subtotal"))
                     .select("budget_item_id", "sign_convention"))
    return (fact.join(pl, "budget_item_id")
            .withColumn("signed", hierarchy.signed(F.col(measure), F.col("sign_convention"))))


def net_income_by(fact: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    return signed_pl(fact, items).groupBy(*keys).agg(F.sum("signed").cast(MONEY_SUM).alias("net_income"))


def grouping_sets(df: DataFrame, sets: list[list[str]], cols: list[str], value: str = "net_income") -> DataFrame:
    """SUM(value) over explicit grouping sets with ``grouping_id`` over ``cols``."""
    g = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
    return g.agg(F.sum(value).cast(MONEY_SUM).alias(value), F.grouping_id(*cols).alias("gid"))


def rollup(df: DataFrame, cols: list[str], value: str = "net_income") -> DataFrame:
    return df.rollup(*cols).agg(F.sum(value).cast(MONEY_SUM).alias(value), F.grouping_id(*cols).alias("gid"))


def cube(df: DataFrame, cols: list[str], value: str = "net_income") -> DataFrame:
    return df.cube(*cols).agg(F.sum(value).cast(MONEY_SUM).alias(value), F.grouping_id(*cols).alias("gid"))


def shares(df: DataFrame, member: list[str], parent: list[str], value: str = "net_income") -> DataFrame:
    """Share of each member in its parent and in the total.

    ``df`` is a report: one row per member, already aggregated.  Sums per parent, and of those the sum of all, are
    joined back to the members; no group is gathered into a row.
    """
    parents = df.groupBy(*[F.col(p).alias(f"_of_{p}") for p in parent]).agg(F.sum(value).alias("_parent"))
    total = df.agg(F.sum(value).alias("_total"))  # one row
    same = [F.col(p).eqNullSafe(F.col(f"_of_{p}")) for p in parent]
    rows = df.join(parents, same).join(F.broadcast(total))
    return rows.select(
        *parent, *member, value,
        safe_ratio(F.col(value), F.col("_parent")).alias("share_of_parent"),
        safe_ratio(F.col(value), F.col("_total")).alias("share_of_total"))


def top_n(df: DataFrame, partition: list[str], order_desc: str, tie: str, n: int) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(F.col(order_desc).desc(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
