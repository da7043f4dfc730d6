"""Ledger adapter: turns the TPC-H-like order tables into the bank ledger star.

Mapping (ours; the ledger semantics are the source model's):

* ``date_id``        month-end of ``l_shipdate``
* ``channel_id``     supplier nation (+1); country = nation, region = region
* ``currency_id``    ``n_regionkey % 3 + 1`` of the supplier nation
* ``segment_id``     customer market segment, ranked alphabetically from 1
* ``product_id``     brands, ranked alphabetically from 1
* ``budget_item_id`` k-th posting leaf in sort order, k = (l_partkey + l_linenumber) % 31
* ``amount_eur``     extended price net of discount, exact cents, summed to grain

Scenarios derived from the actuals (factors ours): 2 = budget of year y =
actual of y-1 same month x 1.12; 5 = top-down = budget x 1.15; 6 = bottom-up =
budget x 1.08; 7 = rolling forecast = actual up to September, then budget x 1.04.

Plan shape: every dimension side is first reduced to (key, small ints) so the
big joins move narrow rows; the line-level rows are aggregated to the ledger
grain (partial aggregation map-side) before anything else touches them.
Catalyst/AQE choose broadcast vs. shuffle for the order-side joins from
runtime sizes; only fixed-size tables (chart of accounts, currencies) carry
an explicit broadcast hint.
"""

from __future__ import annotations

from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions.numeric import dec, money
from ..operators import fx
from . import fixed
from .dates import calendar_for_bounds, month_end_spine
from .model import Model, budget_items, leaf_slots, leaves

FX_SEED = 42
CHANNEL_TYPES = ["Branch", "Digital", "Remote", "Business Unit"]
PRODUCT_CATEGORIES = ["Loan", "Card", "Deposit", "Service"]

# Scenario ids of the adapter ledger: (scenario_id, name, type)
ADAPTER_SCENARIOS = [
    (1, "Actual", "Actual"),
    (2, "Budget", "Budget"),
    (5, "Budget_TopDown", "Budget"),
    (6, "Budget_BottomUp", "Budget"),
    (7, "Forecast_Q3", "Forecast"),
]
BUDGET_UPLIFT = "1.12"
TOPDOWN_UPLIFT = "1.15"
BOTTOMUP_UPLIFT = "1.08"
FORECAST_UPLIFT = "1.04"
FORECAST_CUTOFF_MONTH = 9
#: Names of the flagship channels (a branch among them plans with a driver of its own).
FLAGSHIPS = "UNITED%"


# Read schemas of the order tables (only the columns the ledger uses).  Declaring them
# skips Parquet schema inference, which otherwise launches a footer-reading job per read.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


#: Rows up to which a dimension is broadcast; the count is checked before the hint is given.
BROADCAST_ROWS = 100_000


def small(dim: DataFrame) -> DataFrame:
    """``dim`` with a broadcast hint if it is counted to be small, else as it is (a shuffle join)."""
    return F.broadcast(dim) if dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else dim


def channel_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    ctype = F.element_at(F.array(*[F.lit(t) for t in CHANNEL_TYPES]),
                         (F.pmod(F.col("n_nationkey"), F.lit(4)) + 1).cast("int"))
    return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
            .select((F.col("n_nationkey") + 1).cast("int").alias("channel_id"),
                    F.col("n_name").alias("channel_name"),
                    ctype.alias("channel_type"),
                    F.col("n_name").alias("country"),
                    F.col("r_name").alias("region"),
                    F.lit(None).cast("date").alias("opened_date"),
                    F.lit(True).alias("is_active"),
                    (F.pmod(F.col("n_regionkey"), F.lit(3)) + 1).cast("int").alias("currency_id")))


def segment_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_mktsegment, segment_id): distinct segments ranked alphabetically.

    The distinct is a distributed aggregate; only the handful of distinct
    values reaches the (single-partition) ranking window.
    """
    segs = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    return segs.select("c_mktsegment",
                       F.dense_rank().over(Window.orderBy("c_mktsegment")).cast("int").alias("segment_id"))


def segment_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_map(spark, sf_dir).select(
        "segment_id", F.col("c_mktsegment").alias("segment_name"),
        F.lit(None).cast("string").alias("description"))


def product_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_brand, product_id): distinct brands ranked alphabetically; parts without a brand have no product."""
    brands = table(spark, sf_dir, "part").select("p_brand").where("p_brand IS NOT NULL").distinct()
    return brands.select("p_brand", F.dense_rank().over(Window.orderBy("p_brand")).cast("int").alias("product_id"))


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    pid = F.col("product_id")
    cat = F.element_at(F.array(*[F.lit(c) for c in PRODUCT_CATEGORIES]),
                       (F.pmod(pid - 1, F.lit(4)) + 1).cast("int"))
    sub = F.when(F.pmod(pid, F.lit(5)) == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Tier "), (F.pmod(pid - 1, F.lit(3)) + 1).cast("string")))
    return product_map(spark, sf_dir).select(pid, F.col("p_brand").alias("product_name"),
                                             cat.alias("product_category"), sub.alias("product_subcategory"),
                                             F.lit(True).alias("is_active"))


#: What may be sold where: channel type, segments and product categories (None: all); ours, after the model's rules.
COVERAGE = [
    ("Branch", None, None),
    ("Digital", [1, 2, 4], None),
    ("Remote", [1, 2], ["Card", "Deposit"]),
    ("Business Unit", [3, 5], None),
]


def coverage_rules(m: Model, coverage=COVERAGE) -> DataFrame:
    """channel_type, segment_id, pairs: COVERAGE over the dimensions, products in every currency with rates.

    Bounded: a row for each channel type and segment, an array of products x currencies.
    """
    spark = m.segments.sparkSession
    rules = spark.createDataFrame(coverage, "channel_type string, segments array<int>, categories array<string>")
    currencies = m.rates.select("currency_id").distinct()
    pairs = m.products.select("product_id", "product_category").join(F.broadcast(currencies))
    j = (rules.join(F.broadcast(m.segments.select("segment_id")), F.col("segments").isNull() | F.array_contains("segments", F.col("segment_id")))
         .join(F.broadcast(pairs), F.col("categories").isNull() | F.array_contains("categories", F.col("product_category"))))
    return j.groupBy("channel_type", "segment_id").agg(F.array_sort(F.collect_set(F.struct("product_id", "currency_id"))).alias("pairs"))


def scenario_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, n, t, None, None) for i, n, t in ADAPTER_SCENARIOS]
    from .model import SCENARIO_SCHEMA
    return spark.createDataFrame(rows, SCENARIO_SCHEMA)


def line_amount():
    """A line's amount: extended price net of discount, exact cents."""
    return money(F.col("l_extendedprice").cast("decimal(22,2)")
                 * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))


def source_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: lines and their total amount as they stand in the order tables."""
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("source_lines"),
                                                F.sum(line_amount()).cast("decimal(38,2)").alias("source_amount"))


#: Why a line can't be posted; the first reason that holds counts.
REASONS = ["no_date", "no_amount", "no_order", "no_customer", "no_part", "no_brand", "no_supplier", "no_channel"]
LEDGER_KEYS = ["date_id", "channel_id", "segment_id", "product_id", "currency_id", "budget_item_id"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def order_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines, and orders with their customer's market segment (``has_customer`` false if there is none)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    return table(spark, sf_dir, "lineitem"), orders.select("o_orderkey", "o_custkey", F.col("c_custkey").isNotNull().alias("has_customer"), "c_mktsegment")


#: Parts and suppliers up to which their ids (two whole numbers a row) are broadcast to the lines instead of shuffling these.
LOOKUP_ROWS = 2_000_000


def looked_up(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether table ``name``, counted, is broadcast to the lines; not in a session that has turned broadcasts off."""
    off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return not off and table(spark, sf_dir, name).count() <= LOOKUP_ROWS


def key_bounds(dims: Model) -> dict[str, tuple[int, int]]:
    """Least and largest id of each bounded ledger key, from the dimensions (one small job)."""
    ids = [(dims.channels, "channel_id"), (dims.segments, "segment_id"), (dims.products, "product_id"), (leaves(dims.items), "budget_item_id")]
    parts = [d.select(F.lit(k).alias("key"), F.col(k).alias("id")) for d, k in ids]
    rows = reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()  # a row a key
    return {k: (0, 0) for _, k in ids} | {"currency_id": (1, 3)} | {r["key"]: (r.lo, r.hi) for r in rows if r.lo is not None}


def packed(keys: dict[str, tuple[int, int]]) -> Column:
    """Columns as one whole number of mixed radix, so that rows to be shuffled are narrow; a struct where that doesn't fit.

    The first column may hold any whole number, but not NULL; the others NULL or a value from 0 to their upper bound.
    """
    if not _packs(keys):
        return F.struct(*keys)
    code = None
    for name, (_, hi) in keys.items():
        code = F.col(name).cast("long") if code is None else code * F.lit(hi + 2) + F.coalesce(F.col(name), F.lit(hi + 1))
    return code


def unpacked(code: Column, keys: dict[str, tuple[int, int]]) -> dict[str, Column]:
    """The columns that ``packed`` made ``code`` of, as ints."""
    if not _packs(keys):
        return {name: code.getField(name) for name in keys}
    out, below = {}, 1
    for name, (_, hi) in reversed(list(keys.items())):
        rest = F.call_function("div", code - F.pmod(code, F.lit(below).cast("long")), F.lit(below).cast("long"))
        first = name == next(iter(keys))
        out[name] = (rest if first else F.nullif(F.pmod(rest, F.lit(hi + 2).cast("long")), F.lit(hi + 1).cast("long"))).cast("int")
        below *= hi + 2
    return out


def _packs(keys: dict[str, tuple[int, int]]) -> bool:
    rest = list(keys.values())[1:]
    return all(lo >= 0 for lo, _ in rest) and prod(hi + 2 for _, hi in rest) <= 2**40


def narrow(amount: Column) -> tuple[Column, Column]:
    """An amount in two columns: one of eight bytes that holds all below a million, one for the others."""
    short = amount.try_cast("decimal(8,2)")
    return short.alias("short"), F.when(short.isNull(), amount).alias("wide")


def classified_lines(spark: SparkSession, sf_dir: str, dims: Model, years: tuple[int, int] | None = None, seen: Observation | None = None,
                     sources: tuple[DataFrame, DataFrame] | None = None, bounds: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Every order line with its ledger keys, its amount and, if it can't be posted, a reason (see REASONS).

    ``dims`` holds the channels, segments and products (names and ids).  All joins keep the line: a line that finds
    no partner gets a reason instead.  ``years`` (first, last) restricts the lines by shipment date, down to the scan.  ``seen``
    observes what the scan has read: lines, first and last shipment date.  ``sources`` are lines and orders in
    another layout (``buckets``), as ``order_lines`` gives them.  ``bounds`` are ``key_bounds`` of ``dims``, if known.

    Parts and suppliers are looked up first where they fit a broadcast, and last, by shuffles, where they don't.  A line
    is shuffled as its order key, one number for what is known of its ledger keys, and its amount.
    """
    items = dims.items
    lineitem, orders = sources or order_lines(spark, sf_dir)
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount",
        "l_shipdate")
    if years:
        li = li.where((F.col("l_shipdate") >= F.lit(f"{years[0]}-01-01").cast("timestamp_ntz"))
                      & (F.col("l_shipdate") < F.lit(f"{years[1] + 1}-01-01").cast("timestamp_ntz")))
    if seen is not None:
        day = F.col("l_shipdate").cast("date")
        li = li.observe(seen, F.count(F.lit(1)).alias("lines"), F.min(day).alias("first"), F.max(day).alias("last"))
    # market segments, brands and nations are looked up in bounded maps: no shuffle on a key of few values
    seg = small(dims.segments.select(F.col("segment_name").alias("c_mktsegment"), "segment_id"))
    order_seg = orders.join(seg, "c_mktsegment", "left").select("o_orderkey", "segment_id")
    brand = small(dims.products.select(F.col("product_name").alias("p_brand"), "product_id"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand").join(brand, "p_brand", "left").select("p_partkey", "product_id")
    channel = small(channel_dim(spark, sf_dir).select("channel_id", "currency_id"))
    supp = (table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
            .join(channel.select("channel_id"), F.col("s_nationkey") + 1 == F.col("channel_id"), "left").select("s_suppkey", "channel_id"))
    slots = F.broadcast(leaf_slots(items).select("slot", "budget_item_id"))
    n_leaves = leaves(items).count()  # one number of the chart of accounts
    bounds = bounds or key_bounds(dims)

    def fault(**missing):
        """Number of the first reason that holds."""
        codes = [F.when(F.col(c).isNull(), F.lit(REASONS.index(r))) for r, c in missing.items()]
        return F.least(F.col("fault"), F.coalesce(*codes))

    day, number = F.col("l_shipdate").cast("date"), F.col("l_linenumber")
    usual = number.between(0, 62)
    rows = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.coalesce(F.year(day) * 12 + F.month(day) - 1, F.lit(0)).alias("month"),
        F.when(usual, number).alias("number"), F.when(~usual, number).alias("odd_number"),
        F.pmod(F.col("l_partkey") + number, F.lit(n_leaves)).cast("int").alias("slot"), *narrow(line_amount()),
        F.when(day.isNull(), F.lit(REASONS.index("no_date"))).when(line_amount().isNull(), F.lit(REASONS.index("no_amount"))).alias("fault"))
    known = {"month": (0, 0), "number": (0, 62), "slot": (0, n_leaves - 1)}
    lookups = [("part", part, "l_partkey", "p_partkey", "product_id", {"no_part": "p_partkey", "no_brand": "product_id"}),
               ("supplier", supp, "l_suppkey", "s_suppkey", "channel_id", {"no_supplier": "s_suppkey", "no_channel": "channel_id"})]
    near = [x for x in lookups if looked_up(spark, sf_dir, x[0])]
    far = [x for x in lookups if x not in near]
    for _, dim, key, dim_key, found, missing in near:
        rows = rows.join(F.broadcast(dim), F.col(key) == F.col(dim_key), "left").withColumn("fault", fault(**missing)).drop(key, dim_key)
        known[found] = bounds[found]
    by_order = (order_seg, "l_orderkey", "o_orderkey", "segment_id", {"no_order": "o_orderkey", "no_customer": "segment_id"})
    for dim, key, dim_key, found, missing in [by_order, *[x[1:] for x in far]]:
        keys = [c for c in rows.columns if c.startswith("l_")]
        sent = rows.select(*keys, packed(known).alias("code"), "short", "wide", "odd_number", "fault")
        j = sent.join(dim, F.col(key) == F.col(dim_key), "left").withColumn("fault", fault(**missing))
        rows = j.select(*[c for c in keys if c == "l_orderkey" or c != key], *[v.alias(c) for c, v in unpacked(F.col("code"), known).items()],
                        found, "short", "wide", "odd_number", "fault")
        known[found] = bounds[found]
    joined = rows.join(slots, "slot", "left").join(channel, "channel_id", "left")
    year = F.floor(F.col("month") / 12).cast("int")
    date_id = F.when(~F.col("fault").eqNullSafe(F.lit(REASONS.index("no_date"))), fd.month_end_key(year, F.pmod(F.col("month"), F.lit(12)) + 1))
    return joined.select(
        date_id.alias("date_id"), *LEDGER_KEYS[1:], F.coalesce("wide", F.col("short").cast("decimal(22,2)")).alias("amount"),
        "l_orderkey", F.coalesce("number", "odd_number").alias("l_linenumber"),
        F.coalesce(*[F.when(F.col("fault") == i, F.lit(r)) for i, r in enumerate(REASONS)]).alias("reason"))


def staged_ledger(lines: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """Classified lines in one aggregation: accepted ones summed to the ledger grain (reason null), rejected ones by themselves.

    Columns: the ledger keys, the line's keys (null if accepted), reason, amount_eur, lines.  The grain is shuffled as one
    number (``packed``), sums of amounts below a million in eight bytes.
    """
    keys = {"date_id": (0, 0)} | {k: bounds[k] for k in LEDGER_KEYS[1:]}
    bad = F.col("reason").isNotNull()
    rows = lines.withColumn("date_id", fd.month_index("date_id")).select(
        F.when(~bad, packed(keys)).alias("grain"), *[F.when(bad, F.col(k)).alias(k) for k in LINE_KEYS], "reason", *narrow(F.col("amount")))
    sums = rows.groupBy("grain", *LINE_KEYS, "reason").agg(F.sum("short").alias("short"), F.sum("wide").alias("wide"), F.count(F.lit(1)).alias("lines"))
    wide = F.col("wide").cast("decimal(32,2)")
    amount = F.coalesce(F.col("short") + wide, F.col("short").cast("decimal(32,2)"), wide)
    of = unpacked(F.col("grain"), keys)
    month = of.pop("date_id")
    date_id = fd.month_end_key(F.floor(month / 12).cast("int"), F.pmod(month, F.lit(12)) + 1)
    return sums.select(date_id.alias("date_id"), *[v.alias(k) for k, v in of.items()], *LINE_KEYS, "reason", money(amount).alias("amount_eur"), "lines")


def with_plan_scenarios(actual: DataFrame) -> DataFrame:
    """Add budget/top-down/bottom-up/forecast rows in one pass over the actuals.

    Each actual row fans out to at most six scenario rows through a generator
    (no join, no shuffle, no re-read of the actuals): the rows of a scenario
    are pure functions of one actual row.
    """
    a = F.col("amount_eur")
    budget = money(a * dec(BUDGET_UPLIFT, 3, 2))
    next_me = fd.shift_month_end("date_id", 12)
    month = fd.month_of("date_id")
    cutoff = FORECAST_CUTOFF_MONTH

    def entry(sid, date_col, amount, keep):
        return F.when(keep, F.struct(F.lit(sid).alias("scenario_id"), date_col.alias("date_id"),
                                     amount.alias("amount_eur")))

    b = F.col("b")
    rows = F.array(
        entry(1, F.col("date_id"), a, F.lit(True)),
        entry(2, F.col("next_me"), b, F.lit(True)),
        entry(5, F.col("next_me"), money(b * dec(TOPDOWN_UPLIFT, 3, 2)), F.lit(True)),
        entry(6, F.col("next_me"), money(b * dec(BOTTOMUP_UPLIFT, 3, 2)), F.lit(True)),
        entry(7, F.col("date_id"), a, month <= cutoff),
        entry(7, F.col("next_me"), money(b * dec(FORECAST_UPLIFT, 3, 2)), month > cutoff),
    )
    keys = ["channel_id", "segment_id", "product_id", "currency_id", "budget_item_id"]
    return (actual.withColumn("b", budget).withColumn("next_me", next_me)
            .select(*keys, F.explode(rows).alias("r"))
            .filter(F.col("r").isNotNull())
            .select(F.col("r.date_id").cast("int").alias("date_id"), *keys,
                    F.col("r.scenario_id").cast("int").alias("scenario_id"),
                    F.col("r.amount_eur").alias("amount_eur")))


def daily_adjust(items: DataFrame) -> DataFrame:
    """(budget_item_id, adj): daily-average factor by account category (bounded, broadcast)."""
    cat = F.col("category")
    expr = None
    for c, v in fixed.DRIVER_DAILY_ADJ:
        expr = F.when(cat == c, dec(v, 3, 2)) if expr is None else expr.when(cat == c, dec(v, 3, 2))
    return items.select("budget_item_id", expr.otherwise(dec("1.00", 3, 2)).alias("adj"))


def ledger_calendar(spark: SparkSession, first, last) -> DataFrame:
    """Whole years from the first shipment through the year after the last (plans reach +12 months)."""
    bounds = spark.createDataFrame([(first, last)], "lo date, last date")
    return calendar_for_bounds(bounds.select("lo", F.add_months("last", 12).alias("hi")))


def source_dims(spark: SparkSession, sf_dir: str) -> Model:
    """Channels, segments and products of the order tables, and the fixed dimensions; no calendar, rates or fact."""
    return Model(fact=None, dates=None, channels=channel_dim(spark, sf_dir).drop("currency_id"), segments=segment_dim(spark, sf_dir),
                 products=product_dim(spark, sf_dir), rates=None, scenarios=scenario_dim(spark), items=budget_items(spark))


def posted(actual: DataFrame, dims: Model) -> DataFrame:
    """Fact rows from actual amounts at the grain: plan scenarios, daily averages and nominal amounts.

    Nominal amounts use the month's rate or, without one, the last known before it; a row whose currency has no
    rate yet has NULL nominal amounts.
    """
    from decimal import Decimal

    from .model import FACT_COLUMNS, default_fill

    base = with_plan_scenarios(actual)
    base = (base.join(F.broadcast(daily_adjust(dims.items)), "budget_item_id")
            .withColumn("daily_avg_eur", money(F.col("amount_eur") * F.col("adj"))).drop("adj"))
    rates = fx.rates_asof(month_end_spine(dims.dates), dims.rates)
    # column DEFAULTs of the fact (omitted amounts are 0.00 on insert)
    return default_fill(fx.add_nominal(base, rates),
                        {"amount_eur": Decimal("0.00"), "amount_nominal": Decimal("0.00")}).select(*FACT_COLUMNS)
