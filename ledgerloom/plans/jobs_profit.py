"""Jobs: profitability by channel, segment and product; cube; contribution shares; top channels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profit
from ..sources.store import stored_model
from .oracle_sql import q
from .registry import job


def _actual(m):
    return m.fact.filter(F.col("scenario_id") == 1)


@job("profit_by_channel", q("""
SELECT ch.region, ch.country, ch.channel_name, ch.channel_type,
       CAST(SUM(n.signed) AS DOUBLE) AS net_income,
       GROUPING(ch.region, ch.country, ch.channel_name, ch.channel_type) AS gid
FROM ni_rows n JOIN channels ch ON ch.channel_id = n.channel_id
WHERE n.scenario_id = 1
GROUP BY GROUPING SETS ((ch.region, ch.country, ch.channel_name), (ch.region, ch.country), (ch.region),
                        (ch.channel_type), ())
"""))
def profit_by_channel(spark, sf_dir):
    """Actual Net Income by region > country > channel, by channel type, and in total."""
    m = stored_model(spark, sf_dir)
    per_channel = profit.net_income_by(_actual(m), m.items, ["channel_id"])
    d = per_channel.join(m.channels.select("channel_id", "region", "country", "channel_name", "channel_type"),
                         "channel_id")
    cols = ["region", "country", "channel_name", "channel_type"]
    sets = [["region", "country", "channel_name"], ["region", "country"], ["region"], ["channel_type"], []]
    return profit.grouping_sets(d, sets, cols)


@job("profit_by_segment", q("""
SELECT n.year, sm.c_mktsegment AS segment_name, CAST(SUM(n.signed) AS DOUBLE) AS net_income
FROM ni_rows n JOIN segmap sm ON sm.segment_id = n.segment_id
WHERE n.scenario_id = 1 GROUP BY n.year, sm.c_mktsegment
"""))
def profit_by_segment(spark, sf_dir):
    """Actual Net Income by year and customer segment."""
    m = stored_model(spark, sf_dir)
    per = profit.net_income_by(_actual(m), m.items, ["year", "segment_id"])
    return (per.join(m.segments.select("segment_id", "segment_name"), "segment_id")
            .select("year", "segment_name", "net_income"))


@job("profit_by_product", q("""
SELECT p.product_category, p.product_subcategory, p.product_name, CAST(SUM(n.signed) AS DOUBLE) AS net_income,
       GROUPING(p.product_category, p.product_subcategory, p.product_name) AS gid
FROM ni_rows n JOIN products p ON p.product_id = n.product_id
WHERE n.scenario_id = 1
GROUP BY ROLLUP (p.product_category, p.product_subcategory, p.product_name)
"""))
def profit_by_product(spark, sf_dir):
    """Actual Net Income rolled up category > subcategory > product (grouping_id marks totals)."""
    m = stored_model(spark, sf_dir)
    per = profit.net_income_by(_actual(m), m.items, ["product_id"])
    d = per.join(m.products.select("product_id", "product_category", "product_subcategory", "product_name"),
                 "product_id")
    return profit.rollup(d, ["product_category", "product_subcategory", "product_name"])


@job("profit_cube", q("""
SELECT ch.channel_type, sm.c_mktsegment AS segment_name, p.product_category,
       CAST(SUM(n.signed) AS DOUBLE) AS net_income,
       GROUPING(ch.channel_type, sm.c_mktsegment, p.product_category) AS gid
FROM ni_rows n JOIN channels ch ON ch.channel_id = n.channel_id
JOIN segmap sm ON sm.segment_id = n.segment_id JOIN products p ON p.product_id = n.product_id
WHERE n.scenario_id = 1
GROUP BY CUBE (ch.channel_type, sm.c_mktsegment, p.product_category)
"""))
def profit_cube(spark, sf_dir):
    """Actual Net Income over channel type x segment x product category with all subtotals."""
    m = stored_model(spark, sf_dir)
    per = profit.net_income_by(_actual(m), m.items, ["channel_id", "segment_id", "product_id"])
    d = (per.join(m.channels.select("channel_id", "channel_type"), "channel_id")
         .join(m.segments.select("segment_id", "segment_name"), "segment_id")
         .join(m.products.select("product_id", "product_category"), "product_id"))
    return profit.cube(d, ["channel_type", "segment_name", "product_category"])


@job("contribution_share", q("""
WITH c AS (
  SELECT ch.region, ch.channel_name, SUM(n.signed) AS net_income
  FROM ni_rows n JOIN channels ch ON ch.channel_id = n.channel_id
  WHERE n.scenario_id = 1 GROUP BY ch.region, ch.channel_name
)
SELECT region, channel_name, CAST(net_income AS DOUBLE) AS net_income,
       round(CAST(net_income AS DOUBLE) / NULLIF(CAST(SUM(net_income) OVER (PARTITION BY region) AS DOUBLE), 0), 6)
         AS share_of_parent,
       round(CAST(net_income AS DOUBLE) / NULLIF(CAST(SUM(net_income) OVER () AS DOUBLE), 0), 6) AS share_of_total
FROM c
"""))
def contribution_share(spark, sf_dir):
    """Each channel's share of its region's and of the bank's actual Net Income."""
    m = stored_model(spark, sf_dir)
    per = profit.net_income_by(_actual(m), m.items, ["channel_id"])
    d = per.join(m.channels.select("channel_id", "region", "channel_name"), "channel_id")
    return profit.shares(d, ["channel_name"], ["region"])


@job("top_channels", q("""
WITH c AS (
  SELECT n.year, n.channel_id, ch.channel_name, SUM(n.signed) AS net_income
  FROM ni_rows n JOIN channels ch ON ch.channel_id = n.channel_id
  WHERE n.scenario_id = 1 GROUP BY n.year, n.channel_id, ch.channel_name
),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY net_income DESC, channel_id) AS rank FROM c)
SELECT year, channel_id, channel_name, CAST(net_income AS DOUBLE) AS net_income, CAST(rank AS INTEGER) AS rank
FROM r WHERE rank <= 3
"""))
def top_channels(spark, sf_dir):
    """Top 3 channels by actual Net Income per year (ties broken by channel id)."""
    m = stored_model(spark, sf_dir)
    per = profit.net_income_by(_actual(m), m.items, ["year", "channel_id"])
    d = per.join(m.channels.select("channel_id", "channel_name"), "channel_id")
    return profit.top_n(d, ["year"], "net_income", "channel_id", 3)
