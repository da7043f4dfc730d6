"""The constraints of the eight tables as data, checked in one aggregation per table.

A constraint is a condition on a row, in SQL; a row for which it isn't TRUE violates it.  All constraints of a table and
its primary key become one aggregation: the ledger is scanned once however many there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import fixed
from ..sources import model as md
from ..sources.dates import CALENDAR_SCHEMA
from . import fx


@dataclass(frozen=True)
class Constraint:
    """``holds`` must be TRUE for every row of ``table`` (of the fact: with its rate and its account, see ``fact_view``)."""

    table: str
    name: str
    kind: str
    holds: str


SCHEMAS = {"dim_date": CALENDAR_SCHEMA, "dim_channel": md.CHANNEL_SCHEMA, "dim_segment": md.SEGMENT_SCHEMA, "dim_product": md.PRODUCT_SCHEMA,
           "dim_currency": fx.RATES_SCHEMA, "dim_scenario": md.SCENARIO_SCHEMA, "dim_budget_items": md.ITEMS_SCHEMA, "fact_financial_data": md.FACT_SCHEMA}
KEYS = {"dim_date": ["date_id"], "dim_channel": ["channel_id"], "dim_segment": ["segment_id"], "dim_product": ["product_id"], "dim_currency": ["rate_id"],
        "dim_scenario": ["scenario_id"], "dim_budget_items": ["budget_item_id"], "fact_financial_data": md.GRAIN}

_MONTH_END = "date_id % 100 = day(last_day(make_date(CAST(floor(date_id / 10000) AS INT), CAST(floor(date_id / 100) AS INT) % 100, 1)))"
_ROWS = [
    ("dim_currency", "rate_id", "rate_id = concat(date_id, currency_id)"),
    ("dim_currency", "month_end", _MONTH_END),
    ("dim_currency", "currency_code", "length(currency_code) = 3"),
    ("dim_currency", "base_rate", "currency_id <> 1 OR (eom_rate = 1 AND daily_avg_rate = 1)"),
    ("dim_budget_items", "statement_type", "statement_type IN ('PL', 'BS')"),
    ("dim_budget_items", "sign_convention", "sign_convention IN (1, -1)"),
    ("fact_financial_data", "rate_id", "rate_id = concat(date_id, currency_id)"),
    ("fact_financial_data", "month_end", _MONTH_END),
    ("fact_financial_data", "eur_identity", "currency_id <> 1 OR (amount_eur = amount_nominal AND daily_avg_eur = daily_avg_nominal AND eom_rate = 1 AND daily_avg_rate = 1)"),
    ("fact_financial_data", "nominal_recon", "currency_id = 1 OR (amount_nominal = CAST(amount_eur * eom_rate AS DECIMAL(22,2))"
                                             " AND daily_avg_nominal = CAST(daily_avg_eur * daily_avg_rate AS DECIMAL(22,2)))"),
    ("fact_financial_data", "posting_account", "NOT is_subtotal"),
    *[("fact_financial_data", f"{c}_not_negative", f"{c} IS NULL OR {c} >= 0") for c in md.MEASURES],
]
CONSTRAINTS = (
    [Constraint(t, f.name, "not_null", f"{f.name} IS NOT NULL") for t, schema in SCHEMAS.items() for f in schema.fields if not f.nullable]
    + [Constraint(t, c, "length", f"{c} IS NULL OR length({c}) <= {n}") for t, c, n in fixed.VARCHAR_LENGTHS]
    + [Constraint(t, name, "row", holds) for t, name, holds in _ROWS])


def fact_view(m: md.Model) -> DataFrame:
    """Every fact row with the rates of its rate_id and its account's ``is_subtotal`` (nulls where there is none).

    Both are bounded dimensions; doubled keys in them are reduced to one row, so no fact row is counted twice.
    """
    rates = m.rates.groupBy("rate_id").agg(F.min("eom_rate").alias("eom_rate"), F.min("daily_avg_rate").alias("daily_avg_rate"))
    items = m.items.groupBy("budget_item_id").agg(F.max("is_subtotal").alias("is_subtotal"))
    return m.fact.join(F.broadcast(rates), "rate_id", "left").join(F.broadcast(items), "budget_item_id", "left")


def table_checks(name: str, rows: DataFrame, constraints: list[Constraint], key: list[str] | None) -> DataFrame:
    """table_name, check_name, kind, rows_checked, violations: all of a table's constraints and its key, one scan.

    With a key, rows are first counted by it (a row whose key is NULL in part, or shared, violates it), and violations by
    their constraint alone, in the same aggregation: a key carries one count, not one a constraint.  Without, the
    counts are partial sums of the scan and no row is shuffled.
    """
    holds = [F.coalesce(F.expr(c.holds), F.lit(False)) for c in constraints]
    named = [(c.name, c.kind, F.col(f"c{i}")) for i, c in enumerate(constraints)]
    if key:
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        broken = F.array_compact(F.array(*[F.when(~h, F.lit(i)) for i, h in enumerate(holds)]).cast("array<int>"))
        of, is_key = F.col("of"), F.col("of") < 0  # -1: the row's key, else the constraint that it violates
        clean = reduce(lambda a, b: a & b, holds, F.lit(True))
        counted = rows.select(*key, F.explode(F.when(clean, F.array(F.lit(-1))).otherwise(F.concat(F.array(F.lit(-1)), broken))).alias("of"))
        groups = counted.select(*[F.when(is_key, F.col(k)).alias(k) for k in key], "of").groupBy(*key, "of").agg(F.count(F.lit(1)).alias("n"))
        one = groups.agg(F.sum(F.when(is_key, F.col("n"))).alias("n"), F.sum(F.when(is_key & (null | (F.col("n") > 1)), F.col("n"))).alias("key"),
                         *[F.sum(F.when(of == i, F.col("n"))).alias(f"c{i}") for i in range(len(constraints))])
        named.append((",".join(key), "key", F.col("key")))
    else:
        one = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.when(h, 0).otherwise(1)).alias(f"c{i}") for i, h in enumerate(holds)])
    zero = F.lit(0)
    stacked = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(k).alias("kind"), F.coalesce(F.col("n"), zero).cast("long").alias("rows_checked"),
                                 F.coalesce(v, zero).cast("long").alias("violations")) for n, k, v in named])
    return one.select(F.explode(stacked).alias("s")).select(F.lit(name).alias("table_name"), "s.*")


def check_all(m: md.Model, constraints: list[Constraint] = CONSTRAINTS, kinds: tuple[str, ...] = ("not_null", "length", "row", "key")) -> DataFrame:
    """Violations of every constraint of the given kinds, of all eight tables."""
    parts = []
    for name, rows in m.tables().items():
        mine = [c for c in constraints if c.table == name and c.kind in kinds]
        key = KEYS[name] if "key" in kinds else None
        if name == "fact_financial_data" and any(c.kind == "row" for c in mine):
            rows = fact_view(m)
        if mine or key:
            parts.append(table_checks(name, rows, mine, key))
    return reduce(DataFrame.unionByName, parts)
