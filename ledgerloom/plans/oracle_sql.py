"""Independent SQL (DuckDB dialect) of the ledger adapter and its reports.

Each registered job has an oracle query written directly in SQL over the raw
order tables; the shared prelude rebuilds the ledger star from scratch with
CTEs, so the oracle never calls into the Spark code.  Money is exact DECIMAL
throughout and cast to DOUBLE only in the final projection.
"""

from __future__ import annotations

from ..sources import fixed
from ..sources.tpch import ADAPTER_SCENARIOS


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows) -> str:
    return ",\n    ".join("(" + ", ".join(_lit(x) for x in r) + ")" for r in rows)


ITEMS_CTE = f"""items_raw(budget_item_id, item_name, statement_type, category, subcategory, parent_item_id,
          sort_order, is_subtotal, sign_convention) AS (VALUES
    {_values(fixed.BUDGET_ITEMS)}
),
items AS (
  SELECT CAST(budget_item_id AS INTEGER) AS budget_item_id, item_name, statement_type, category,
         subcategory, CAST(parent_item_id AS INTEGER) AS parent_item_id,
         CAST(sort_order AS INTEGER) AS sort_order, is_subtotal,
         CAST(sign_convention AS INTEGER) AS sign_convention
  FROM items_raw
)"""

_USD_GBP_BANDS = _values([(c, y, str(centre), m, str(m // 2)) for c, y, centre, m in fixed.FX_BANDS])

PRELUDE = f"""WITH RECURSIVE
{ITEMS_CTE},
slots AS (
  SELECT CAST(row_number() OVER (ORDER BY sort_order, budget_item_id) - 1 AS INTEGER) AS slot,
         budget_item_id, category
  FROM items WHERE NOT is_subtotal
),
segmap AS (
  SELECT c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS segment_id
  FROM (SELECT DISTINCT c_mktsegment FROM customer) s
),
channels AS (
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS channel_id, n_name AS channel_name,
         CASE n_nationkey % 4 WHEN 0 THEN 'Branch' WHEN 1 THEN 'Digital' WHEN 2 THEN 'Remote'
              ELSE 'Business Unit' END AS channel_type,
         n_name AS country, r_name AS region,
         CAST(n_regionkey % 3 + 1 AS INTEGER) AS currency_id
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
products AS (
  SELECT product_id, p_brand AS product_name,
         CASE (product_id - 1) % 4 WHEN 0 THEN 'Loan' WHEN 1 THEN 'Card' WHEN 2 THEN 'Deposit'
              ELSE 'Service' END AS product_category,
         CASE WHEN product_id % 5 = 0 THEN NULL
              ELSE 'Tier ' || CAST((product_id - 1) % 3 + 1 AS VARCHAR) END AS product_subcategory
  FROM (SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) AS INTEGER) AS product_id
        FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL) d) b
),
lines AS (
  SELECT CAST(year(last_day(CAST(l.l_shipdate AS DATE))) * 10000
              + month(last_day(CAST(l.l_shipdate AS DATE))) * 100
              + day(last_day(CAST(l.l_shipdate AS DATE))) AS INTEGER) AS date_id,
         ch.channel_id, sm.segment_id,
         b.product_id,
         ch.currency_id, sl.budget_item_id,
         CAST(CAST(l.l_extendedprice AS DECIMAL(22,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              AS DECIMAL(22,2)) AS amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN segmap sm ON c.c_mktsegment = sm.c_mktsegment
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN products b ON b.product_name = p.p_brand
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN channels ch ON ch.channel_id = s.s_nationkey + 1
  JOIN slots sl ON sl.slot = (l.l_partkey + l.l_linenumber) % (SELECT COUNT(*) FROM slots)
),
actual AS (
  SELECT date_id, channel_id, segment_id, product_id, currency_id, budget_item_id,
         CAST(SUM(amount) AS DECIMAL(22,2)) AS amount_eur
  FROM lines GROUP BY date_id, channel_id, segment_id, product_id, currency_id, budget_item_id
),
shifted AS (
  SELECT *, CAST(year(nd) * 10000 + month(nd) * 100 + day(nd) AS INTEGER) AS next_me,
         CAST(amount_eur * 1.12 AS DECIMAL(22,2)) AS b
  FROM (SELECT *, last_day(make_date(CAST(date_id // 10000 AS INTEGER) + 1,
                                     CAST(date_id // 100 % 100 AS INTEGER), 1)) AS nd
        FROM actual) a
),
scen AS (
  SELECT date_id, channel_id, segment_id, product_id, currency_id, 1 AS scenario_id, budget_item_id,
         amount_eur FROM actual
  UNION ALL
  SELECT next_me, channel_id, segment_id, product_id, currency_id, 2, budget_item_id, b FROM shifted
  UNION ALL
  SELECT next_me, channel_id, segment_id, product_id, currency_id, 5, budget_item_id,
         CAST(b * 1.15 AS DECIMAL(22,2)) FROM shifted
  UNION ALL
  SELECT next_me, channel_id, segment_id, product_id, currency_id, 6, budget_item_id,
         CAST(b * 1.08 AS DECIMAL(22,2)) FROM shifted
  UNION ALL
  SELECT date_id, channel_id, segment_id, product_id, currency_id, 7, budget_item_id, amount_eur
  FROM actual WHERE date_id // 100 % 100 <= 9
  UNION ALL
  SELECT next_me, channel_id, segment_id, product_id, currency_id, 7, budget_item_id,
         CAST(b * 1.04 AS DECIMAL(22,2)) FROM shifted WHERE date_id // 100 % 100 > 9
),
bounds AS (
  SELECT make_date(year(min(CAST(l_shipdate AS DATE))), 1, 1) AS lo,
         make_date(year(max(CAST(l_shipdate AS DATE) + INTERVAL 12 MONTH)), 12, 1) AS hi
  FROM lineitem
),
month_ends AS (
  SELECT CAST(year(me) * 10000 + month(me) * 100 + day(me) AS INTEGER) AS date_id,
         CAST(year(me) AS INTEGER) AS year
  FROM (SELECT last_day(CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE)) AS me
        FROM bounds) m
),
calendar AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_id,
         strftime(d, '%Y-%m-%d') AS full_date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
         CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
         left(strftime(d, '%B'), 3) AS month_name_short, CAST(day(d) AS INTEGER) AS day,
         d = last_day(d) AS is_month_end, CAST(day(last_day(d)) AS INTEGER) AS days_in_month,
         CASE WHEN year(d) % 400 = 0 OR (year(d) % 4 = 0 AND year(d) % 100 <> 0) THEN 366 ELSE 365 END
           AS days_in_year
  FROM (SELECT CAST(unnest(generate_series(lo, make_date(year(hi), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
        FROM bounds) x
),
scenarios(scenario_id, scenario_name, scenario_type) AS (VALUES
    {_values(ADAPTER_SCENARIOS)}
),
currencies(currency_id, currency_code, currency_name, currency_symbol) AS (VALUES
    {_values(fixed.CURRENCIES)}
),
bands_raw(currency_id, band_year, centre, modulus, half_steps) AS (VALUES
    {_USD_GBP_BANDS}
),
bands AS (
  SELECT currency_id, band_year, CAST(centre AS DECIMAL(5,4)) AS centre, modulus,
         CAST(half_steps AS DECIMAL(10,0)) * 0.0001 AS half
  FROM bands_raw
),
rates AS (
  SELECT CAST(m.date_id AS VARCHAR) || CAST(c.currency_id AS VARCHAR) AS rate_id,
         m.date_id, CAST(c.currency_id AS INTEGER) AS currency_id, c.currency_code, c.currency_name,
         c.currency_symbol,
         CAST(CASE WHEN c.currency_id = 1 THEN 1 ELSE
              b.centre + CAST(('0x' || substr(md5(concat_ws('|', '42', 'eom', CAST(m.date_id AS VARCHAR),
                  CAST(c.currency_id AS VARCHAR))), 1, 8))::BIGINT % b.modulus AS DECIMAL(10,0)) * 0.0001
              - b.half END AS DECIMAL(10,6)) AS eom_rate,
         CAST(CASE WHEN c.currency_id = 1 THEN 1 ELSE
              b.centre + CAST(('0x' || substr(md5(concat_ws('|', '42', 'avg', CAST(m.date_id AS VARCHAR),
                  CAST(c.currency_id AS VARCHAR))), 1, 8))::BIGINT % b.modulus AS DECIMAL(10,0)) * 0.0001
              - b.half END AS DECIMAL(10,6)) AS daily_avg_rate
  FROM month_ends m CROSS JOIN currencies c
  LEFT JOIN bands b ON b.currency_id = c.currency_id
       AND b.band_year = 2022 + ((m.year - 2022) % 5 + 5) % 5
),
fact AS (
  SELECT s.date_id, s.channel_id, s.segment_id, s.product_id, s.currency_id, s.scenario_id,
         s.budget_item_id, CAST(s.date_id AS VARCHAR) || CAST(s.currency_id AS VARCHAR) AS rate_id,
         s.amount_eur, CAST(s.amount_eur * r.eom_rate AS DECIMAL(22,2)) AS amount_nominal,
         s.daily_avg_eur, CAST(s.daily_avg_eur * r.daily_avg_rate AS DECIMAL(22,2)) AS daily_avg_nominal,
         CAST(s.date_id // 10000 AS INTEGER) AS year, CAST(s.date_id // 100 % 100 AS INTEGER) AS month
  FROM (SELECT sc.*, CAST(sc.amount_eur * CASE i.category WHEN 'Asset' THEN 0.94
                                                          WHEN 'Liability' THEN 1.03 ELSE 1.00 END
                          AS DECIMAL(22,2)) AS daily_avg_eur
        FROM scen sc JOIN items i ON i.budget_item_id = sc.budget_item_id) s
  JOIN rates r ON r.date_id = s.date_id AND r.currency_id = s.currency_id
),
walk(ancestor_id, descendant_id, distance) AS (
  SELECT budget_item_id, budget_item_id, 0 FROM items
  UNION ALL
  SELECT i.parent_item_id, w.descendant_id, w.distance + 1
  FROM walk w JOIN items i ON i.budget_item_id = w.ancestor_id
  WHERE i.parent_item_id IS NOT NULL
),
tree_edges AS (
  SELECT w.ancestor_id AS node_id, w.descendant_id AS leaf_id, i.sign_convention AS leaf_sign
  FROM walk w JOIN items i ON i.budget_item_id = w.descendant_id WHERE NOT i.is_subtotal
),
edges AS (
  SELECT * FROM tree_edges
  UNION ALL
  SELECT f.node_id, i.budget_item_id, i.sign_convention
  FROM (VALUES {_values(fixed.FORMULA_NODES)}) f(node_id, bound)
  JOIN items i ON i.statement_type = 'PL' AND NOT i.is_subtotal AND i.sort_order < f.bound
),
pl_lines AS (
  SELECT f.scenario_id, f.year, e.node_id AS budget_item_id, n.item_name, n.sort_order,
         SUM(CASE WHEN e.leaf_sign < 0 THEN -f.amt ELSE f.amt END) AS signed,
         CASE WHEN n.sign_convention < 0 THEN -SUM(CASE WHEN e.leaf_sign < 0 THEN -f.amt ELSE f.amt END)
              ELSE SUM(CASE WHEN e.leaf_sign < 0 THEN -f.amt ELSE f.amt END) END AS display
  FROM (SELECT scenario_id, year, budget_item_id, SUM(amount_eur) AS amt FROM fact
        GROUP BY scenario_id, year, budget_item_id) f
  JOIN edges e ON e.leaf_id = f.budget_item_id
  JOIN items n ON n.budget_item_id = e.node_id
  WHERE n.statement_type = 'PL'
  GROUP BY f.scenario_id, f.year, e.node_id, n.item_name, n.sort_order, n.sign_convention
),
ni_rows AS (
  SELECT f.*, CASE WHEN i.sign_convention < 0 THEN -f.amount_eur ELSE f.amount_eur END AS signed
  FROM fact f JOIN items i ON i.budget_item_id = f.budget_item_id
  WHERE i.statement_type = 'PL' AND NOT i.is_subtotal
)"""


def q(body: str) -> str:
    """An oracle query: the shared prelude followed by the report body (which may add CTEs)."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return PRELUDE + ",\n" + body[5:]
    return PRELUDE + "\n" + body
