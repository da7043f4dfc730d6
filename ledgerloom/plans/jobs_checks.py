"""Jobs: data checks (keys, orphans, grain, NOT NULL, EUR identity, nominal reconciliation,
subtotal rows, coverage, rate ranges, rate keys, scenario years, non-negative amounts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, constraints, variance
from ..sources import fixed
from ..sources.model import MEASURES
from ..sources.store import load_outcomes, stored_model
from ..sources.tpch import COVERAGE, REASONS, coverage_rules, source_total
from .jobs_variance import VERSIONS_SQL
from .oracle_sql import _values, q
from .registry import job


def _pk(name, table, key):
    return (f"SELECT '{name}' AS check_name, CAST(COALESCE(SUM(CASE WHEN k IS NULL OR n > 1 THEN n END), 0) "
            f"AS BIGINT) AS violations FROM (SELECT {key} AS k, COUNT(*) AS n FROM {table} GROUP BY {key}) g")


@job("q1_pk_unique", q("\nUNION ALL\n".join([
    _pk("dim_date", "calendar", "date_id"), _pk("dim_channel", "channels", "channel_id"),
    _pk("dim_segment", "segmap", "segment_id"), _pk("dim_product", "products", "product_id"),
    _pk("dim_currency", "rates", "rate_id"), _pk("dim_scenario", "scenarios", "scenario_id"),
    _pk("dim_budget_items", "items", "budget_item_id")])))
def q1_pk_unique(spark, sf_dir):
    """Primary keys unique and not NULL, per dimension table."""
    return checks.pk_unique(stored_model(spark, sf_dir))


def _fk(name, child, ck, parent, pk, where=""):
    cond = f" AND {where}" if where else ""
    return (f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM {child} c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{ck}){cond}")


@job("q2_fk_orphans", q("\nUNION ALL\n".join([
    _fk("fact.date_id", "fact", "date_id", "calendar", "date_id"),
    _fk("fact.channel_id", "fact", "channel_id", "channels", "channel_id"),
    _fk("fact.segment_id", "fact", "segment_id", "segmap", "segment_id"),
    _fk("fact.product_id", "fact", "product_id", "products", "product_id"),
    _fk("fact.scenario_id", "fact", "scenario_id", "scenarios", "scenario_id"),
    _fk("fact.budget_item_id", "fact", "budget_item_id", "items", "budget_item_id"),
    _fk("fact.rate_id", "fact", "rate_id", "rates", "rate_id"),
    _fk("rates.date_id", "rates", "date_id", "calendar", "date_id"),
    _fk("items.parent_item_id", "items", "parent_item_id", "items", "budget_item_id",
        "c.parent_item_id IS NOT NULL")])))
def q2_fk_orphans(spark, sf_dir):
    """Foreign keys of the fact, the rate table and the account tree that point nowhere."""
    return checks.fk_orphans(stored_model(spark, sf_dir))


@job("q3_grain_unique", q("""
SELECT 'grain' AS check_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS violations FROM (
  SELECT COUNT(*) AS n FROM fact
  GROUP BY date_id, channel_id, segment_id, product_id, currency_id, scenario_id, budget_item_id
  HAVING COUNT(*) > 1) d
"""))
def q3_grain_unique(spark, sf_dir):
    """The seven grain columns identify a fact row."""
    return checks.grain_unique(stored_model(spark, sf_dir).fact)


#: The eight tables in SQL, with the columns that their constraints name.
_TABLES_SQL = {
    "dim_date": "SELECT *, CAST(full_date AS DATE) AS d FROM calendar", "dim_channel": "SELECT *, TRUE AS is_active FROM channels",
    "dim_segment": "SELECT segment_id, c_mktsegment AS segment_name FROM segmap", "dim_product": "SELECT *, TRUE AS is_active FROM products",
    "dim_currency": "SELECT * FROM rates", "dim_scenario": "SELECT * FROM scenarios", "dim_budget_items": "SELECT * FROM items",
    "fact_financial_data": "SELECT f.*, r.eom_rate, r.daily_avg_rate, i.is_subtotal FROM fact f LEFT JOIN rates r ON r.rate_id = f.rate_id "
                           "LEFT JOIN items i ON i.budget_item_id = f.budget_item_id",
}


def _checks_sql(kinds: tuple[str, ...]) -> str:
    parts = []
    for table, rows in _TABLES_SQL.items():
        mine = [c for c in constraints.CONSTRAINTS if c.table == table and c.kind in kinds]
        parts += [f"SELECT '{table}' AS table_name, '{c.name}' AS check_name, '{c.kind}' AS kind, COUNT(*) AS rows_checked, "
                  f"COUNT(*) FILTER (WHERE ({c.holds}) IS NOT TRUE) AS violations FROM ({rows}) t" for c in mine]
        key = constraints.KEYS[table]
        if "key" in kinds:
            null = " OR ".join(f"{k} IS NULL" for k in key)
            parts.append(f"SELECT '{table}', '{','.join(key)}', 'key', CAST(COALESCE(SUM(n), 0) AS BIGINT), CAST(COALESCE(SUM(CASE WHEN n > 1 OR {null} THEN n END), 0) AS BIGINT) "
                         f"FROM (SELECT {', '.join(key)}, COUNT(*) AS n FROM ({rows}) t GROUP BY {', '.join(key)}) g")
    return q("\nUNION ALL\n".join(parts))


@job("q4_not_null", _checks_sql(("not_null",)))
def q4_not_null(spark, sf_dir):
    """NULLs in the NOT NULL columns of all eight tables, one pass over each."""
    return constraints.check_all(stored_model(spark, sf_dir), kinds=("not_null",))


@job("ledger_checks", _checks_sql(("not_null", "length", "row", "key")))
def ledger_checks(spark, sf_dir):
    """Every constraint of the eight tables: keys, NULLs, lengths and row conditions; one scan of the ledger."""
    return constraints.check_all(stored_model(spark, sf_dir))


@job("q5_eur_identity", q("""
SELECT 'eur_identity' AS check_name, COUNT(*) AS rows_checked,
       CAST(COALESCE(SUM(CASE WHEN f.amount_eur = f.amount_nominal AND f.daily_avg_eur = f.daily_avg_nominal
                             AND r.eom_rate = 1 AND r.daily_avg_rate = 1 THEN 0 ELSE 1 END), 0) AS BIGINT)
         AS violations
FROM fact f LEFT JOIN rates r ON r.rate_id = f.rate_id WHERE f.currency_id = 1
"""))
def q5_eur_identity(spark, sf_dir):
    """Every EUR row: nominal = EUR and both rates = 1 (full scan instead of five random rows)."""
    m = stored_model(spark, sf_dir)
    return checks.eur_identity(m.fact, m.rates)


@job("q6_nominal_recon", q("""
SELECT 'nominal_recon' AS check_name, COUNT(*) AS rows_checked,
       CAST(COALESCE(SUM(CASE WHEN f.amount_nominal = CAST(f.amount_eur * r.eom_rate AS DECIMAL(22,2))
                               AND f.daily_avg_nominal = CAST(f.daily_avg_eur * r.daily_avg_rate AS DECIMAL(22,2))
                             THEN 0 ELSE 1 END), 0) AS BIGINT) AS violations
FROM fact f LEFT JOIN rates r ON r.rate_id = f.rate_id WHERE f.currency_id IS DISTINCT FROM 1
"""))
def q6_nominal_recon(spark, sf_dir):
    """Every foreign-currency row: stored nominal = recomputed nominal, both measures."""
    m = stored_model(spark, sf_dir)
    return checks.nominal_recon(m.fact, m.rates)


@job("q7_no_subtotal_rows", q("""
SELECT 'rows_on_subtotals' AS check_name, COUNT(*) AS violations
FROM fact f WHERE f.budget_item_id IN (SELECT budget_item_id FROM items WHERE is_subtotal)
"""))
def q7_no_subtotal_rows(spark, sf_dir):
    """No fact row on a subtotal (calculated) account."""
    m = stored_model(spark, sf_dir)
    return checks.no_subtotal_rows(m.fact, m.items)


_RULES_SQL = f"""rule_text(channel_type, segments, categories) AS (VALUES
    {", ".join(f"('{t}', {'NULL' if seg is None else seg}::INTEGER[], {'NULL' if cat is None else cat}::VARCHAR[])" for t, seg, cat in COVERAGE)}),
allowed AS (
  SELECT r.channel_type, s.segment_id, p.product_id, c.currency_id
  FROM rule_text r JOIN segmap s ON r.segments IS NULL OR list_contains(r.segments, s.segment_id)
  JOIN products p ON r.categories IS NULL OR list_contains(r.categories, p.product_category), (SELECT DISTINCT currency_id FROM rates) c),
booked AS (
  SELECT ch.channel_type, f.segment_id, f.product_id, f.currency_id, COUNT(*) AS n
  FROM fact f JOIN channels ch ON ch.channel_id = f.channel_id WHERE f.scenario_id = 1 GROUP BY ALL)"""


@job("q8_coverage", q(f"""
WITH {_RULES_SQL}
SELECT COALESCE(a.channel_type, b.channel_type) AS channel_type, COALESCE(a.segment_id, b.segment_id) AS segment_id,
       COUNT(a.product_id) AS allowed, COUNT(CASE WHEN a.product_id IS NOT NULL THEN b.product_id END) AS booked,
       COUNT(CASE WHEN b.product_id IS NULL THEN a.product_id END) AS missing, COUNT(CASE WHEN a.product_id IS NULL THEN b.product_id END) AS outside,
       CAST(COALESCE(SUM(CASE WHEN a.product_id IS NULL THEN b.n END), 0) AS BIGINT) AS outside_rows
FROM allowed a FULL JOIN booked b ON a.channel_type = b.channel_type AND a.segment_id = b.segment_id AND a.product_id = b.product_id AND a.currency_id = b.currency_id
GROUP BY 1, 2
"""))
def q8_coverage(spark, sf_dir):
    """Actual bookings against the coverage rules, both ways, by channel type and segment."""
    m = stored_model(spark, sf_dir)
    return checks.rule_coverage(m.fact.filter(F.col("scenario_id") == 1), m.channels, coverage_rules(m))


@job("coverage_breaches", q(f"""
WITH {_RULES_SQL}
SELECT CASE WHEN a.product_id IS NULL THEN 'outside' ELSE 'missing' END AS breach, COALESCE(a.channel_type, b.channel_type) AS channel_type,
       COALESCE(a.segment_id, b.segment_id) AS segment_id, COALESCE(a.product_id, b.product_id) AS product_id,
       COALESCE(a.currency_id, b.currency_id) AS currency_id, COALESCE(b.n, 0) AS fact_rows
FROM allowed a FULL JOIN booked b ON a.channel_type = b.channel_type AND a.segment_id = b.segment_id AND a.product_id = b.product_id AND a.currency_id = b.currency_id
WHERE a.product_id IS NULL OR b.product_id IS NULL
"""))
def coverage_breaches(spark, sf_dir):
    """The combinations booked outside the coverage rules, and the allowed ones never booked."""
    m = stored_model(spark, sf_dir)
    return checks.rule_breaches(m.fact.filter(F.col("scenario_id") == 1), m.channels, coverage_rules(m))


@job("q8_plan_coverage", q("""
WITH g AS (SELECT year, channel_id, segment_id, product_id, currency_id, budget_item_id,
                  MAX(CASE WHEN scenario_id = 1 THEN 1 ELSE 0 END) AS b, MAX(CASE WHEN scenario_id = 2 THEN 1 ELSE 0 END) AS a
           FROM fact WHERE scenario_id IN (1, 2)
           GROUP BY year, channel_id, segment_id, product_id, currency_id, budget_item_id),
c AS (SELECT g.* FROM g JOIN (SELECT year FROM g GROUP BY year HAVING MAX(a) = 1 AND MAX(b) = 1) y ON y.year = g.year)
SELECT 'outside_matrix' AS check_name, COUNT(*) AS violations FROM c WHERE b = 1 AND a = 0
UNION ALL
SELECT 'allowed_missing', COUNT(*) FROM c WHERE a = 1 AND b = 0
"""))
def q8_plan_coverage(spark, sf_dir):
    """Actual combinations (channel, segment, product, currency, account) against the year's budget, both ways."""
    m = stored_model(spark, sf_dir)
    return checks.plan_coverage(m.fact, ["channel_id", "segment_id", "product_id", "currency_id", "budget_item_id"])


_RANGES = _values([(c, y, str(lo), str(hi)) for c, y, lo, hi in fixed.FX_DOCUMENTED_RANGES])


@job("q9_rate_range", q(f"""
WITH rng(currency_id, band_year, lo, hi) AS (VALUES {_RANGES})
SELECT 'rate_outside_range' AS check_name, COUNT(*) AS violations
FROM rates r LEFT JOIN rng ON rng.currency_id = r.currency_id
  AND rng.band_year = 2022 + ((r.date_id // 10000 - 2022) % 5 + 5) % 5
WHERE (rng.lo IS NULL AND r.currency_id <> 1) OR r.eom_rate < CAST(rng.lo AS DECIMAL(10,4)) OR r.eom_rate > CAST(rng.hi AS DECIMAL(10,4))
   OR r.daily_avg_rate < CAST(rng.lo AS DECIMAL(10,4)) OR r.daily_avg_rate > CAST(rng.hi AS DECIMAL(10,4))
UNION ALL
SELECT 'currency_code_length', COUNT(*) FROM rates WHERE length(currency_code) <> 3
"""))
def q9_rate_range(spark, sf_dir):
    """Rates inside the documented yearly ranges (the band formula can leave them) and 3-letter codes."""
    return checks.rate_range(stored_model(spark, sf_dir).rates, spark)


@job("q10_rate_key", q("""
SELECT 'fact_rate_id' AS check_name, COUNT(*) AS violations FROM fact
WHERE rate_id IS DISTINCT FROM CAST(date_id AS VARCHAR) || CAST(currency_id AS VARCHAR)
UNION ALL
SELECT 'rates_rate_id', COUNT(*) FROM rates WHERE rate_id IS DISTINCT FROM CAST(date_id AS VARCHAR) || CAST(currency_id AS VARCHAR)
UNION ALL
SELECT 'rates_not_month_end', COUNT(*) FROM rates
WHERE make_date(date_id // 10000, date_id // 100 % 100, date_id % 100)
      IS DISTINCT FROM last_day(make_date(date_id // 10000, date_id // 100 % 100, date_id % 100))
"""))
def q10_rate_key(spark, sf_dir):
    """rate_id = CONCAT(date_id, currency_id) everywhere; rate dates are month-ends."""
    m = stored_model(spark, sf_dir)
    return checks.rate_key(m.fact, m.rates)


@job("q11_scenario_years", q(f"""
WITH {VERSIONS_SQL}
SELECT scenario_id, CAST(fiscal_year AS DOUBLE) AS fiscal_year, first_month, last_month, months, fiscal_year IS NOT NULL AND months = 12 AS complete,
       (scenario_type = 'Actual') = (fiscal_year IS NULL) AS year_set,
       COALESCE(first_month // 10000 = fiscal_year AND last_month // 10000 = fiscal_year, scenario_type = 'Actual') AS in_year
FROM versions
"""))
def q11_scenario_years(spark, sf_dir):
    """Scenario versions: months held, whole fiscal years, fiscal year set for plans only, months inside it."""
    m = stored_model(spark, sf_dir)
    out = checks.scenario_months(variance.validity(m.fact, m.scenarios))
    return out.withColumn("fiscal_year", F.col("fiscal_year").cast("double"))


@job("q12_nonneg", q("\nUNION ALL\n".join(
    f"SELECT '{c}' AS check_name, COUNT(*) AS violations FROM fact WHERE {c} < 0" for c in MEASURES)))
def q12_nonneg(spark, sf_dir):
    """Stored amounts below zero, per measure."""
    return checks.nonneg(stored_model(spark, sf_dir).fact, MEASURES)


@job("load_reconciliation", q("""
SELECT s.source_lines, CAST(s.amt AS DOUBLE) AS source_amount, CAST(l.amt AS DOUBLE) AS ledger_amount,
       CAST(s.amt - l.amt AS DOUBLE) AS difference, s.amt = l.amt AS reconciled
FROM (SELECT COUNT(*) AS source_lines, COALESCE(SUM(CAST(CAST(l_extendedprice AS DECIMAL(22,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                                              AS DECIMAL(22,2))), 0) AS amt FROM lineitem) s,
     (SELECT COALESCE(SUM(amount_eur), 0) AS amt FROM fact WHERE scenario_id = 1) l
"""))
def load_reconciliation(spark, sf_dir):
    """Order lines in, actuals out: the load lost no line (also asserted before a load is committed)."""
    return checks.reconciliation(source_total(spark, sf_dir), stored_model(spark, sf_dir).fact)


_OUTCOMES = ["accepted", *REASONS, "no_rate"]


@job("load_by_reason", q(f"""
WITH j AS (
  SELECT l.*, o.o_orderkey, sm.segment_id, p.p_partkey, b.product_id, s.s_suppkey, ch.channel_id, ch.currency_id,
         CAST(CAST(l.l_extendedprice AS DECIMAL(22,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(22,2)) AS amount
  FROM lineitem l
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN segmap sm ON sm.c_mktsegment = c.c_mktsegment LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN products b ON b.product_name = p.p_brand LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
  LEFT JOIN channels ch ON ch.channel_id = s.s_nationkey + 1
),
c AS (
  SELECT amount, CASE WHEN l_shipdate IS NULL THEN 'no_date' WHEN amount IS NULL THEN 'no_amount' WHEN o_orderkey IS NULL THEN 'no_order'
         WHEN segment_id IS NULL THEN 'no_customer' WHEN p_partkey IS NULL THEN 'no_part' WHEN product_id IS NULL THEN 'no_brand'
         WHEN s_suppkey IS NULL THEN 'no_supplier' WHEN channel_id IS NULL THEN 'no_channel'
         WHEN r.rate_id IS NULL THEN 'no_rate' ELSE 'accepted' END AS outcome
  FROM j LEFT JOIN rates r ON r.currency_id = j.currency_id AND r.date_id // 100 = year(l_shipdate) * 100 + month(l_shipdate)
)
SELECT n.outcome, COUNT(c.outcome) AS lines, CAST(COALESCE(SUM(c.amount), 0) AS DOUBLE) AS amount
FROM (VALUES {", ".join(f"('{x}')" for x in _OUTCOMES)}) n(outcome) LEFT JOIN c ON c.outcome = n.outcome GROUP BY n.outcome
"""))
def load_by_reason(spark, sf_dir):
    """What became of every order line in the load: accepted, or rejected for which reason (zero if none)."""
    got = load_outcomes(spark, sf_dir)
    names = spark.createDataFrame([(x,) for x in _OUTCOMES], "outcome string")
    return names.join(got, "outcome", "left").select("outcome", F.coalesce("lines", F.lit(0)).cast("long").alias("lines"),
                                                     F.coalesce("amount", F.lit(0)).cast("decimal(38,2)").alias("amount"))
