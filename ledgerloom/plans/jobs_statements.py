"""Jobs: account hierarchy and financial statements (P&L, balance sheet, ratios)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hierarchy, statements
from ..sources.store import stored_model
from .oracle_sql import q
from .registry import job


@job("pl_statement", q("""
SELECT f.scenario_id, f.year, e.node_id AS budget_item_id, n.item_name, n.sort_order,
       CAST(SUM(CASE WHEN e.leaf_sign < 0 THEN -f.amt ELSE f.amt END) AS DOUBLE) AS signed,
       CAST(CASE WHEN n.sign_convention < 0 THEN -SUM(CASE WHEN e.leaf_sign < 0 THEN -f.amt ELSE f.amt END)
                 ELSE SUM(CASE WHEN e.leaf_sign < 0 THEN -f.amt ELSE f.amt END) END AS DOUBLE) AS display
FROM (SELECT scenario_id, year, budget_item_id, SUM(amount_eur) AS amt FROM fact
      GROUP BY scenario_id, year, budget_item_id) f
JOIN edges e ON e.leaf_id = f.budget_item_id
JOIN items n ON n.budget_item_id = e.node_id
WHERE n.statement_type = 'PL'
GROUP BY f.scenario_id, f.year, e.node_id, n.item_name, n.sort_order, n.sign_convention
"""))
def pl_statement(spark, sf_dir):
    """P&L lines (tree roll-up plus formula subtotals) by scenario and year."""
    m = stored_model(spark, sf_dir)
    lines = statements.statement(m.fact, m.items, "PL", ["scenario_id", "year"])
    return lines.select("scenario_id", "year", "budget_item_id", "item_name", "sort_order",
                        "signed", "display")


def _signed_sql(x="f.amt"):
    return f"SUM(CASE WHEN e.leaf_sign < 0 THEN -{x} ELSE {x} END)"


def _tree(m):
    return hierarchy.tree_closure(m.items, "budget_item_id", "parent_item_id")


@job("account_closure", q("""
SELECT w.ancestor_id, w.descendant_id, w.distance, COALESCE(r.n, 0) AS fact_rows
FROM walk w
LEFT JOIN (SELECT budget_item_id, COUNT(*) AS n FROM fact WHERE scenario_id = 1 GROUP BY budget_item_id) r
  ON r.budget_item_id = w.descendant_id
"""))
def account_closure(spark, sf_dir):
    """Ancestor-or-self pairs of the account tree with the actual rows posted under each pair."""
    m = stored_model(spark, sf_dir)
    c = _tree(m)
    rows = m.fact.filter(F.col("scenario_id") == 1).groupBy("budget_item_id").agg(F.count("*").alias("n"))
    return (c.join(rows, c.descendant_id == rows.budget_item_id, "left")
            .select("ancestor_id", "descendant_id", "distance",
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("fact_rows")))


_ORG_SQL = """org(node, parent) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT)
  UNION ALL SELECT 1 + r_regionkey, 0 FROM region
  UNION ALL SELECT 1000 + n_nationkey, 1 + n_regionkey FROM nation
  UNION ALL SELECT 1000000 + s_suppkey, 1000 + s_nationkey FROM supplier),
up(ancestor_id, descendant_id, distance) AS (
  SELECT node, node, 0 FROM org
  UNION ALL SELECT o.parent, u.descendant_id, u.distance + 1 FROM up u JOIN org o ON o.node = u.ancestor_id WHERE o.parent IS NOT NULL)"""


@job("org_closure", f"WITH RECURSIVE {_ORG_SQL} SELECT CAST(ancestor_id AS BIGINT) AS ancestor_id, CAST(descendant_id AS BIGINT) AS descendant_id, distance FROM up")
def org_closure(spark, sf_dir):
    """Ancestor-or-self pairs of the organisation: bank, regions, nations, suppliers, as the tables give it."""
    def nodes(table, node, parent):
        return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(f"CAST({node} AS BIGINT) AS node", f"CAST({parent} AS BIGINT) AS parent")

    tree = (spark.range(1).selectExpr("id AS node", "CAST(NULL AS BIGINT) AS parent").union(nodes("region", "1 + r_regionkey", "0"))
            .union(nodes("nation", "1000 + n_nationkey", "1 + n_regionkey")).union(nodes("supplier", "1000000 + s_suppkey", "1000 + s_nationkey")))
    return hierarchy.tree_closure(tree)


#: Levels that the flattened account tree shows.
_LEVELS = 3


@job("account_flatten", q(f"""
WITH dep AS (SELECT descendant_id, MAX(distance) AS depth0 FROM walk GROUP BY descendant_id),
fl AS (
  SELECT w.descendant_id AS budget_item_id, d.depth0, list(i.item_name ORDER BY d.depth0 - w.distance) AS names
  FROM walk w JOIN dep d ON d.descendant_id = w.descendant_id
  JOIN items i ON i.budget_item_id = w.ancestor_id
  GROUP BY w.descendant_id, d.depth0
)
SELECT fl.budget_item_id, CAST(depth0 + 1 AS INTEGER) AS depth,
       {", ".join(f"names[least({i}, len(names))] AS level{i}" for i in range(1, _LEVELS + 1))},
       array_to_string(names, ' > ') AS path, CAST(a.amt AS DOUBLE) AS amount_eur
FROM fl LEFT JOIN (SELECT w.ancestor_id, SUM(f.amount_eur) AS amt FROM fact f JOIN walk w ON w.descendant_id = f.budget_item_id WHERE f.scenario_id = 1
                   GROUP BY w.ancestor_id) a ON a.ancestor_id = fl.budget_item_id
"""))
def account_flatten(spark, sf_dir):
    """Ragged tree as fixed levels with path and depth, with the actual total of each node's leaves."""
    m = stored_model(spark, sf_dir)
    c = _tree(m)
    flat = hierarchy.flatten(m.items, c, _LEVELS)
    leaf = (m.fact.filter(F.col("scenario_id") == 1).groupBy(F.col("budget_item_id").alias("descendant_id"))
            .agg(F.sum("amount_eur").alias("amount")))
    tot = (leaf.join(F.broadcast(c), "descendant_id").groupBy(F.col("ancestor_id").alias("budget_item_id"))
           .agg(F.sum("amount").cast("decimal(38,2)").alias("amount_eur")))
    return flat.join(tot, "budget_item_id", "left")


@job("statement_rollup", q(f"""
SELECT f.scenario_id, f.date_id, e.node_id AS budget_item_id,
       CAST({_signed_sql()} AS DOUBLE) AS signed,
       CAST(CASE WHEN n.sign_convention < 0 THEN -{_signed_sql()} ELSE {_signed_sql()} END AS DOUBLE) AS display
FROM (SELECT scenario_id, date_id, budget_item_id, SUM(amount_eur) AS amt FROM fact
      GROUP BY scenario_id, date_id, budget_item_id) f
JOIN tree_edges e ON e.leaf_id = f.budget_item_id
JOIN items n ON n.budget_item_id = e.node_id
GROUP BY f.scenario_id, f.date_id, e.node_id, n.sign_convention
"""))
def statement_rollup(spark, sf_dir):
    """Tree roll-up of every node (both statements) by scenario and month-end, both sign views."""
    m = stored_model(spark, sf_dir)
    lines = statements.statement(m.fact, m.items, None, ["scenario_id", "date_id"], with_formulas=False)
    return lines.select("scenario_id", "date_id", "budget_item_id", "signed", "display")


@job("formula_subtotals", q(f"""
SELECT f.scenario_id, f.year, e.node_id AS budget_item_id, n.item_name,
       CAST({_signed_sql()} AS DOUBLE) AS amount
FROM (SELECT scenario_id, year, budget_item_id, SUM(amount_eur) AS amt FROM fact
      GROUP BY scenario_id, year, budget_item_id) f
JOIN edges e ON e.leaf_id = f.budget_item_id
JOIN items n ON n.budget_item_id = e.node_id
WHERE e.node_id IN (19, 21)
GROUP BY f.scenario_id, f.year, e.node_id, n.item_name
"""))
def formula_subtotals(spark, sf_dir):
    """Profit Before Tax and Net Income (formula nodes without children) by scenario and year."""
    m = stored_model(spark, sf_dir)
    lines = statements.statement(m.fact, m.items, "PL", ["scenario_id", "year"])
    return (lines.filter(F.col("budget_item_id").isin(19, 21))
            .select("scenario_id", "year", "budget_item_id", "item_name", F.col("signed").alias("amount")))


_BS_MONTHLY = f"""bs_monthly AS (
  SELECT f.scenario_id, f.year, f.date_id, e.node_id AS budget_item_id, n.item_name, n.sort_order,
         {_signed_sql()} AS signed,
         CASE WHEN n.sign_convention < 0 THEN -{_signed_sql()} ELSE {_signed_sql()} END AS display
  FROM (SELECT scenario_id, year, date_id, budget_item_id, SUM(amount_eur) AS amt FROM fact
        GROUP BY scenario_id, year, date_id, budget_item_id) f
  JOIN edges e ON e.leaf_id = f.budget_item_id
  JOIN items n ON n.budget_item_id = e.node_id
  WHERE n.statement_type = 'BS'
  GROUP BY f.scenario_id, f.year, f.date_id, e.node_id, n.item_name, n.sort_order, n.sign_convention
),
bs_closing AS (
  SELECT b.scenario_id, b.year, b.budget_item_id, b.item_name, b.sort_order, c.closing_date_id, b.signed, b.display
  FROM bs_monthly b
  JOIN (SELECT scenario_id, year, MAX(date_id) AS closing_date_id FROM bs_monthly GROUP BY scenario_id, year) c
    ON c.scenario_id = b.scenario_id AND c.year = b.year AND c.closing_date_id = b.date_id
)"""


def _bs_closing(m):
    monthly = statements.statement(m.fact, m.items, "BS", ["scenario_id", "year", "date_id"])
    return statements.closing_lines(monthly, ["scenario_id", "year"],
                                    ["budget_item_id", "item_name", "sort_order"], ["signed", "display"])


@job("bs_statement", q(f"""
WITH {_BS_MONTHLY}
SELECT scenario_id, year, budget_item_id, item_name, sort_order, closing_date_id,
       CAST(signed AS DOUBLE) AS signed, CAST(display AS DOUBLE) AS display
FROM bs_closing
"""))
def bs_statement(spark, sf_dir):
    """Balance-sheet lines at the closing month-end of each year (semi-additive)."""
    return _bs_closing(stored_model(spark, sf_dir))


@job("bs_balance_check", q(f"""
WITH {_BS_MONTHLY}
SELECT scenario_id, year,
       CAST(SUM(CASE WHEN budget_item_id = 22 THEN display END) AS DOUBLE) AS assets,
       CAST(SUM(CASE WHEN budget_item_id = 31 THEN display END) AS DOUBLE) AS liabilities,
       CAST(SUM(CASE WHEN budget_item_id = 39 THEN display END) AS DOUBLE) AS equity,
       CAST(SUM(CASE WHEN budget_item_id = 22 THEN display END)
            - SUM(CASE WHEN budget_item_id = 31 THEN display END)
            - SUM(CASE WHEN budget_item_id = 39 THEN display END) AS DOUBLE) AS difference
FROM bs_closing GROUP BY scenario_id, year
"""))
def bs_balance_check(spark, sf_dir):
    """Assets - Liabilities - Equity at each closing month-end (reported, not asserted)."""
    return statements.balance_check(_bs_closing(stored_model(spark, sf_dir)), ["scenario_id", "year"])


@job("bs_ratios", q(f"""
WITH {_BS_MONTHLY},
pl AS (
  SELECT f.scenario_id, f.year, e.node_id AS budget_item_id,
         CASE WHEN n.sign_convention < 0 THEN -{_signed_sql()} ELSE {_signed_sql()} END AS display
  FROM (SELECT scenario_id, year, budget_item_id, SUM(amount_eur) AS amt FROM fact
        GROUP BY scenario_id, year, budget_item_id) f
  JOIN edges e ON e.leaf_id = f.budget_item_id
  JOIN items n ON n.budget_item_id = e.node_id
  WHERE n.statement_type = 'PL'
  GROUP BY f.scenario_id, f.year, e.node_id, n.sign_convention
),
p AS (SELECT scenario_id, year, SUM(CASE WHEN budget_item_id = 14 THEN display END) AS opex,
             SUM(CASE WHEN budget_item_id = 1 THEN display END) AS nii,
             SUM(CASE WHEN budget_item_id = 9 THEN display END) AS nonii
      FROM pl GROUP BY scenario_id, year),
b AS (SELECT scenario_id, year, SUM(CASE WHEN budget_item_id = 24 THEN display END) AS loans,
             SUM(CASE WHEN budget_item_id = 32 THEN display END) AS deposits,
             SUM(CASE WHEN budget_item_id = 39 THEN display END) AS equity,
             SUM(CASE WHEN budget_item_id = 22 THEN display END) AS assets
      FROM bs_closing GROUP BY scenario_id, year),
am AS (SELECT f.scenario_id, f.year, f.date_id, SUM(f.daily_avg_eur) AS v
       FROM fact f JOIN tree_edges e ON e.leaf_id = f.budget_item_id WHERE e.node_id = 22
       GROUP BY f.scenario_id, f.year, f.date_id),
av AS (SELECT scenario_id, year, CAST(SUM(v) AS DOUBLE) / COUNT(*) AS avg_assets
       FROM am GROUP BY scenario_id, year)
SELECT COALESCE(p.scenario_id, b.scenario_id) AS scenario_id, COALESCE(p.year, b.year) AS year,
       round(CAST(b.loans AS DOUBLE) / NULLIF(CAST(b.deposits AS DOUBLE), 0), 6) AS loan_to_deposit,
       round(CAST(b.equity AS DOUBLE) / NULLIF(CAST(b.assets AS DOUBLE), 0), 6) AS equity_to_assets,
       round(CAST(p.opex AS DOUBLE) / NULLIF(CAST(p.nii + p.nonii AS DOUBLE), 0), 6) AS cost_to_income,
       round(CAST(p.nii AS DOUBLE) / NULLIF(av.avg_assets, 0), 6) AS net_interest_margin
FROM p FULL JOIN b ON p.scenario_id = b.scenario_id AND p.year = b.year
LEFT JOIN av ON av.scenario_id = COALESCE(p.scenario_id, b.scenario_id) AND av.year = COALESCE(p.year, b.year)
"""))
def bs_ratios(spark, sf_dir):
    """Loan-to-deposit, equity-to-assets, cost-to-income and net interest margin per scenario-year.

    One scan of the ledger: both measures summed to (scenario, year, month-end, item) feed the
    P&L totals, the closing balance sheet and the average of total assets.
    """
    m = stored_model(spark, sf_dir)
    return statements.ratios_of(m.fact, m.items, ["scenario_id", "year"])
