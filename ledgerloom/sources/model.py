"""Dimension tables of the ledger star schema, with explicit schemas.

``Model`` bundles one fact DataFrame with its seven dimensions; every
operator takes DataFrames, whichever source (the reference planning model or
the TPC-H adapter) produced them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed

ITEMS_SCHEMA = T.StructType([
    T.StructField("budget_item_id", T.IntegerType(), False),
    T.StructField("item_name", T.StringType(), False),
    T.StructField("statement_type", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("subcategory", T.StringType(), True),
    T.StructField("parent_item_id", T.IntegerType(), True),
    T.StructField("sort_order", T.IntegerType(), False),
    T.StructField("is_subtotal", T.BooleanType(), False),
    T.StructField("sign_convention", T.IntegerType(), False),
])

CHANNEL_SCHEMA = T.StructType([
    T.StructField("channel_id", T.IntegerType(), False),
    T.StructField("channel_name", T.StringType(), False),
    T.StructField("channel_type", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("opened_date", T.DateType(), True),
    T.StructField("is_active", T.BooleanType(), False),
])

SEGMENT_SCHEMA = T.StructType([
    T.StructField("segment_id", T.IntegerType(), False),
    T.StructField("segment_name", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("product_category", T.StringType(), False),
    T.StructField("product_subcategory", T.StringType(), True),
    T.StructField("is_active", T.BooleanType(), False),
])

SCENARIO_SCHEMA = T.StructType([
    T.StructField("scenario_id", T.IntegerType(), False),
    T.StructField("scenario_name", T.StringType(), False),
    T.StructField("scenario_type", T.StringType(), False),
    T.StructField("fiscal_year", T.IntegerType(), True),
    T.StructField("description", T.StringType(), True),
])

FACT_SCHEMA = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("channel_id", T.IntegerType(), False),
    T.StructField("segment_id", T.IntegerType(), False),
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("currency_id", T.IntegerType(), False),
    T.StructField("scenario_id", T.IntegerType(), False),
    T.StructField("budget_item_id", T.IntegerType(), False),
    T.StructField("rate_id", T.StringType(), False),
    T.StructField("amount_eur", T.DecimalType(22, 2), False),
    T.StructField("amount_nominal", T.DecimalType(22, 2), False),
    T.StructField("daily_avg_eur", T.DecimalType(22, 2), True),
    T.StructField("daily_avg_nominal", T.DecimalType(22, 2), True),
])

FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]
GRAIN = ["date_id", "channel_id", "segment_id", "product_id", "currency_id", "scenario_id",
         "budget_item_id"]
MEASURES = ["amount_eur", "amount_nominal", "daily_avg_eur", "daily_avg_nominal"]


@dataclass(frozen=True)
class Model:
    """A fact table and its dimensions (all lazy DataFrames)."""

    fact: DataFrame
    dates: DataFrame
    channels: DataFrame
    segments: DataFrame
    products: DataFrame
    rates: DataFrame
    scenarios: DataFrame
    items: DataFrame
    versions: DataFrame | None = None  # of a stored ledger: its scenarios by fiscal year

    def with_fact(self, fact: DataFrame) -> "Model":
        return replace(self, fact=fact)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dates, "dim_channel": self.channels, "dim_segment": self.segments,
            "dim_product": self.products, "dim_currency": self.rates,
            "dim_scenario": self.scenarios, "dim_budget_items": self.items,
            "fact_financial_data": self.fact,
        }


_ITEMS: dict = {}


def budget_items(spark: SparkSession) -> DataFrame:
    """The fixed chart of accounts; one DataFrame per session so derived tables can be reused."""
    hit = _ITEMS.get(id(spark))
    if hit is None or hit[0] is not spark:
        hit = (spark, spark.createDataFrame(fixed.BUDGET_ITEMS, ITEMS_SCHEMA))
        _ITEMS[id(spark)] = hit
    return hit[1]


def channels(spark: SparkSession) -> DataFrame:
    rows = [r[:5] + (_dt.date.fromisoformat(r[5]),) + r[6:] for r in fixed.CHANNELS]
    return spark.createDataFrame(rows, CHANNEL_SCHEMA)


def segments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.SEGMENTS, SEGMENT_SCHEMA)


def products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.PRODUCTS, PRODUCT_SCHEMA)


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.SCENARIOS, SCENARIO_SCHEMA)


def leaves(items: DataFrame) -> DataFrame:
    """Posting accounts: the only items that may carry fact rows."""
    return items.filter(~F.col("is_subtotal"))


def leaf_slots(items: DataFrame) -> DataFrame:
    """(slot, budget_item_id, category): leaves numbered 0.. in sort_order.

    Items are a bounded chart of accounts, so a global ordering over them is
    a tiny single-partition step.
    """
    from pyspark.sql import Window

    w = Window.orderBy("sort_order", "budget_item_id")
    return (leaves(items)
            .select((F.row_number().over(w) - 1).cast("int").alias("slot"),
                    "budget_item_id", "category"))


def default_fill(df: DataFrame, defaults: dict) -> DataFrame:
    """Column DEFAULTs on insert: ``{column: literal}`` for columns that ``df`` doesn't have.

    A DEFAULT stands in for an omitted column only; an explicit NULL stays for the
    NOT NULL check to find.
    """
    return df.withColumns({c: v if isinstance(v, Column) else F.lit(v) for c, v in defaults.items() if c not in df.columns})
