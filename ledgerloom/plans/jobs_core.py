"""Jobs: calendar, stored ledger, star join, scenario alignment, counts and drill-down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import money
from ..operators import counts, star, variance
from ..operators.variance import align
from .jobs_variance import VERSIONS_SQL
from ..sources import aggregates
from ..sources.dates import month_end_spine
from ..sources.model import FACT_COLUMNS, GRAIN
from ..sources.store import stored_model
from .oracle_sql import q
from .registry import job


@job("calendar", q("SELECT * FROM calendar"))
def calendar(spark, sf_dir):
    """Day calendar over whole years spanned by the ledger (shipments + one plan year)."""
    return stored_model(spark, sf_dir).dates


@job("month_end_spine", q("""
SELECT date_id, year, quarter, month, days_in_month FROM calendar WHERE is_month_end
"""))
def month_end_spine_job(spark, sf_dir):
    """Month-end rows of the calendar."""
    return month_end_spine(stored_model(spark, sf_dir).dates).select(
        "date_id", "year", "quarter", "month", "days_in_month")


@job("append_fact", q("""
SELECT date_id, channel_id, segment_id, product_id, currency_id, scenario_id, budget_item_id, rate_id,
       CAST(amount_eur AS DOUBLE) AS amount_eur, CAST(amount_nominal AS DOUBLE) AS amount_nominal,
       CAST(daily_avg_eur AS DOUBLE) AS daily_avg_eur, CAST(daily_avg_nominal AS DOUBLE) AS daily_avg_nominal,
       year
FROM fact
"""))
def append_fact(spark, sf_dir):
    """The loaded ledger (written once, partitioned by scenario and year) read back."""
    return stored_model(spark, sf_dir).fact.select(*FACT_COLUMNS, "year")


@job("star_join", q("""
SELECT f.date_id, 'Q' || CAST(quarter(make_date(f.year, f.month, 1)) AS VARCHAR) AS quarter_name,
       strftime(make_date(f.year, f.month, 1), '%B') AS month_name,
       ch.channel_name, ch.channel_type, ch.region, sm.c_mktsegment AS segment_name,
       p.product_name, p.product_category, r.currency_code, s.scenario_name, i.item_name, i.statement_type,
       CAST(f.amount_eur AS DOUBLE) AS amount_eur, CAST(f.amount_nominal AS DOUBLE) AS amount_nominal
FROM fact f
JOIN channels ch ON ch.channel_id = f.channel_id
JOIN segmap sm ON sm.segment_id = f.segment_id
JOIN products p ON p.product_id = f.product_id
JOIN scenarios s ON s.scenario_id = f.scenario_id
JOIN items i ON i.budget_item_id = f.budget_item_id
JOIN rates r ON r.rate_id = f.rate_id
"""))
def star_join(spark, sf_dir):
    """Fact joined with all seven dimensions (dates through fact.date_id)."""
    m = stored_model(spark, sf_dir)
    return star.star_join(m, ["date_id", "quarter_name", "month_name", "channel_name", "channel_type",
                              "region", "segment_name", "product_name", "product_category", "currency_code",
                              "scenario_name", "item_name", "statement_type", "amount_eur",
                              "amount_nominal"])


@job("scenario_align", q("""
SELECT date_id, channel_id, segment_id, product_id, currency_id, budget_item_id,
       CAST(SUM(CASE WHEN scenario_id = 1 THEN amount_eur END) AS DOUBLE) AS actual_eur,
       CAST(SUM(CASE WHEN scenario_id = 2 THEN amount_eur END) AS DOUBLE) AS budget_eur
FROM fact WHERE scenario_id IN (1, 2)
GROUP BY date_id, channel_id, segment_id, product_id, currency_id, budget_item_id
"""))
def scenario_align(spark, sf_dir):
    """Actual and budget on the same grain; a missing side stays NULL (no inner join)."""
    m = stored_model(spark, sf_dir)
    keys = [k for k in GRAIN if k != "scenario_id"]
    return align(m.fact, keys, {"actual_eur": 1, "budget_eur": 2})


@job("table_counts", q("""
SELECT 'dim_date' AS tbl, COUNT(*) AS row_count FROM calendar UNION ALL
SELECT 'dim_channel', COUNT(*) FROM channels UNION ALL
SELECT 'dim_segment', COUNT(*) FROM segmap UNION ALL
SELECT 'dim_product', COUNT(*) FROM products UNION ALL
SELECT 'dim_currency', COUNT(*) FROM rates UNION ALL
SELECT 'dim_scenario', COUNT(*) FROM scenarios UNION ALL
SELECT 'dim_budget_items', COUNT(*) FROM items UNION ALL
SELECT 'fact_financial_data', COUNT(*) FROM fact
"""))
def table_counts(spark, sf_dir):
    """Row count of the eight star tables (UNION ALL of counts)."""
    return counts.table_counts(stored_model(spark, sf_dir).tables())


@job("scenario_counts", q(f"""
WITH {VERSIONS_SQL}
SELECT row_number() OVER (ORDER BY fiscal_year NULLS FIRST, scenario_type, scenario_name) AS position,
       scenario_name, scenario_type, CAST(fiscal_year AS DOUBLE) AS fiscal_year, CAST(row_count AS BIGINT) AS row_count
FROM versions
"""))
def scenario_counts(spark, sf_dir):
    """Rows per scenario and fiscal year, in the order fiscal year (scenarios without one first), type, name.

    ``position`` states that order in the result.
    """
    m = stored_model(spark, sf_dir)
    v = variance.validity(m.fact, m.scenarios)  # one row a scenario and year: the numbering sees no more
    order = Window.orderBy(F.col("fiscal_year").asc_nulls_first(), "scenario_type", "scenario_name")
    return v.select(F.row_number().over(order).cast("long").alias("position"), "scenario_name", "scenario_type",
                    F.col("fiscal_year").cast("double").alias("fiscal_year"), "row_count")


_SAMPLE_SQL = """
SELECT * FROM (
  SELECT CASE WHEN f.currency_id = 1 THEN 'EUR' ELSE 'foreign' END AS stratum,
         row_number() OVER (PARTITION BY f.currency_id = 1 ORDER BY md5(concat_ws('|', f.date_id, f.channel_id, f.segment_id,
           f.product_id, f.currency_id, f.scenario_id, f.budget_item_id)), f.date_id, f.channel_id, f.segment_id, f.product_id,
           f.currency_id, f.scenario_id, f.budget_item_id) AS position,
         f.currency_id, CAST(r.eom_rate AS DOUBLE) AS eom_rate, CAST(f.amount_eur AS DOUBLE) AS amount_eur,
         CAST(f.amount_nominal AS DOUBLE) AS amount_nominal, CAST(CAST(f.amount_eur * r.eom_rate AS DECIMAL(22,2)) AS DOUBLE) AS expected_nominal,
         CAST(r.daily_avg_rate AS DOUBLE) AS daily_avg_rate, CAST(f.daily_avg_eur AS DOUBLE) AS daily_avg_eur,
         CAST(f.daily_avg_nominal AS DOUBLE) AS daily_avg_nominal,
         CAST(CAST(f.daily_avg_eur * r.daily_avg_rate AS DECIMAL(22,2)) AS DOUBLE) AS expected_daily_nominal,
         CAST(abs(f.amount_eur - f.amount_nominal) AS DOUBLE) AS diff
  FROM fact f LEFT JOIN rates r ON r.rate_id = f.rate_id) s
WHERE position <= 5
"""


@job("sample_topn", q(_SAMPLE_SQL))
def sample_topn(spark, sf_dir):
    """Repeatable samples of five EUR rows and five foreign ones, with their rates, recomputed amounts and EUR difference.

    Both strata come from one scan; every task keeps five rows a stratum (window group limit) before the shuffle.
    """
    m = stored_model(spark, sf_dir)
    stratum = F.when(F.col("currency_id") == 1, F.lit("EUR")).otherwise(F.lit("foreign"))
    s = counts.sample_strata(m.fact.withColumn("stratum", stratum), "stratum", GRAIN, 5)
    j = s.join(F.broadcast(m.rates.select("rate_id", "eom_rate", "daily_avg_rate")), "rate_id", "left")
    return j.select("stratum", "position", "currency_id", "eom_rate", "amount_eur", "amount_nominal",
                    money(F.col("amount_eur") * F.col("eom_rate")).alias("expected_nominal"), "daily_avg_rate", "daily_avg_eur", "daily_avg_nominal",
                    money(F.col("daily_avg_eur") * F.col("daily_avg_rate")).alias("expected_daily_nominal"),
                    F.abs(F.col("amount_eur") - F.col("amount_nominal")).alias("diff"))


@job("sum_by_dims", q("""
SELECT f.scenario_id, f.year, ch.channel_type, sm.c_mktsegment AS segment_name, p.product_category,
       CAST(SUM(f.amount_eur) AS DOUBLE) AS amount_eur, CAST(SUM(f.daily_avg_eur) AS DOUBLE) AS daily_avg_eur
FROM fact f
JOIN channels ch ON ch.channel_id = f.channel_id
JOIN segmap sm ON sm.segment_id = f.segment_id
JOIN products p ON p.product_id = f.product_id
GROUP BY f.scenario_id, f.year, ch.channel_type, sm.c_mktsegment, p.product_category
"""))
def sum_by_dims(spark, sf_dir):
    """Additive EUR sums by scenario, year, channel type, segment and product category, from the stored aggregates."""
    return aggregates.current_sums(spark, sf_dir, ["scenario_id", "year", "channel_type", "segment_name", "product_category"])


#: Drill-downs of the reports: name and what they are summed by.
_DRILLS = [("by region", ["scenario_name", "year", "region"]), ("by channel", ["scenario_name", "year", "channel_name"]),
           ("by segment", ["scenario_name", "year", "segment_name"]), ("by product", ["scenario_name", "year", "product_name"]),
           ("by account", ["scenario_name", "year", "item_name"]), ("by month", ["scenario_name", "year", "month"])]
_ATTRIBUTE_SQL = {"region": "ch.region", "channel_name": "ch.channel_name", "segment_name": "sm.c_mktsegment", "product_name": "p.product_name",
                  "item_name": "i.item_name", "month": "CAST(f.month AS VARCHAR)"}


@job("drill_downs", q("\nUNION ALL\n".join(
    f"SELECT '{name}' AS report, s.scenario_name, f.year, {_ATTRIBUTE_SQL[by[2]]} AS member, CAST(SUM(f.amount_eur) AS DOUBLE) AS amount_eur, "
    f"CAST(SUM(f.daily_avg_eur) AS DOUBLE) AS daily_avg_eur FROM fact f JOIN scenarios s ON s.scenario_id = f.scenario_id "
    f"JOIN channels ch ON ch.channel_id = f.channel_id JOIN segmap sm ON sm.segment_id = f.segment_id JOIN products p ON p.product_id = f.product_id "
    f"JOIN items i ON i.budget_item_id = f.budget_item_id GROUP BY ALL" for name, by in _DRILLS)))
def drill_downs(spark, sf_dir):
    """Sums by scenario and year down to regions, channels, segments, products, accounts and months; no scan of the ledger."""
    parts = [aggregates.current_sums(spark, sf_dir, by).select(F.lit(name).alias("report"), "scenario_name", "year", F.col(by[2]).cast("string").alias("member"),
                                                               "amount_eur", "daily_avg_eur") for name, by in _DRILLS]
    return reduce(DataFrame.unionByName, parts)
