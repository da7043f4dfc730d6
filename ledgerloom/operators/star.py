"""Star join of the fact with its seven dimensions.

Dimension tables are keyed by small integer spaces (calendar days, nations,
segments, brands, chart of accounts, month-end rates), so every join is a
broadcast hash join once AQE has measured the dimension at runtime; the
fixed-size ones are hinted explicitly.  Dates join through ``fact.date_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.model import Model


def star_join(m: Model, columns: list[str] | None = None) -> DataFrame:
    f = m.fact
    j = (f.join(m.dates.select("date_id", "quarter_name", "month_name"), "date_id")
         .join(m.channels.select("channel_id", "channel_name", "channel_type", "region"), "channel_id")
         .join(m.segments.select("segment_id", "segment_name"), "segment_id")
         .join(m.products.select("product_id", "product_name", "product_category"), "product_id")
         .join(F.broadcast(m.scenarios.select("scenario_id", "scenario_name")), "scenario_id")
         .join(F.broadcast(m.items.select("budget_item_id", "item_name", "statement_type")),
               "budget_item_id")
         .join(F.broadcast(m.rates.select("rate_id", "currency_code")), "rate_id"))
    return j.select(*columns) if columns else j
