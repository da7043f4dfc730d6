"""Driver-based planning: coverage spine x driver lookups x scenario parameters.

One parameter table replaces the source model's eleven copy-pasted load
blocks.  The spine is generated by crossing the coverage combinations (the
only side that grows) with two bounded, broadcast sides: block x month-end
rows and the posting leaves.  All driver lookups are pure expressions built
from the fixed tables, so a scenario row is computed in one codegen stage
without any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions.numeric import MONEY_SUM, dec, draw_from, money, safe_ratio, seeded_digest
from ..sources import fixed
from ..sources.model import leaves

BLOCK_SCHEMA = ("scenario_id int, year int, base_set string, mult_a decimal(5,4), mult_b decimal(5,4), "
                "cutoff_month int, season_set string, span_amount int, span_daily int")


def coverage_matrix(spark: SparkSession, rules=fixed.COVERAGE_RULES) -> DataFrame:
    """Allowed (channel, segment, product, currency) combinations, exploded from the rule table."""
    rows = [(i, list(chs), seg, [{"product_id": p, "currency_id": c} for p, c in pairs])
            for i, (chs, seg, pairs) in enumerate(rules)]
    r = spark.createDataFrame(rows, "rule int, channels array<int>, segment_id int, "
                                    "pairs array<struct<product_id:int,currency_id:int>>")
    return (r.select(F.explode("channels").alias("channel_id"), "segment_id", F.explode("pairs").alias("p"))
            .select("channel_id", "segment_id", F.col("p.product_id").alias("product_id"),
                    F.col("p.currency_id").alias("currency_id")))


def _parallelism(spark: SparkSession) -> int:
    """Cluster cores (default parallelism), or the shuffle partition count if not exposed."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def plan_blocks(spark: SparkSession, blocks=fixed.PLAN_BLOCKS) -> DataFrame:
    return spark.createDataFrame(blocks, BLOCK_SCHEMA)


def _case(key: Column, pairs, default, p: int, s: int) -> Column:
    e = None
    for k, v in pairs:
        e = F.when(key == k, dec(v, p, s)) if e is None else e.when(key == k, dec(v, p, s))
    return e.otherwise(dec(default, p, s))


def channel_driver(channel_type: Column, channel_name: Column, flagships: str = fixed.FLAGSHIP_PATTERN) -> Column:
    """Flagship branch 3.0 (name LIKE ``flagships``), other branch 2.0, digital 1.5, remote 0.8, unit 2.5."""
    flagship = F.when(channel_name.like(flagships), dec(fixed.DRIVER_CHANNEL_FLAGSHIP, 3, 2))
    e = None
    for t, v in fixed.DRIVER_CHANNEL:
        val = flagship.otherwise(dec(v, 3, 2)) if t == "Branch" else dec(v, 3, 2)
        e = F.when(channel_type == t, val) if e is None else e.when(channel_type == t, val)
    return e.otherwise(dec("1.0", 3, 2))


def base_driver(base_set: Column, category: Column) -> Column:
    e = None
    for sset, pairs in fixed.DRIVER_BASE.items():
        for cat, v in pairs:
            cond = (base_set == sset) & (category == cat)
            e = F.when(cond, dec(v, 7, 0)) if e is None else e.when(cond, dec(v, 7, 0))
    for sset, v in fixed.BASE_OTHER.items():
        e = e.when(base_set == sset, dec(v, 7, 0))
    return e


def season_driver(season_set: Column, quarter: Column) -> Column:
    e = None
    for sset, pairs in fixed.DRIVER_SEASON.items():
        for qn, v in pairs:
            cond = (season_set == sset) & (quarter == qn)
            e = F.when(cond, dec(v, 3, 2)) if e is None else e.when(cond, dec(v, 3, 2))
    return e.otherwise(dec("1.00", 3, 2))


def scenario_amounts(combos: DataFrame, channels: DataFrame, month_ends: DataFrame, items: DataFrame,
                     blocks: DataFrame, seed: int | None = 42) -> DataFrame:
    """Scenario rows: ABS(base*channel*segment*multiplier*season*currency + noise), cast to cents.

    ``combos`` (channel_id, segment_id, product_id, currency_id) is the only
    input that grows; ``month_ends`` needs ``date_id``; ``seed=None`` turns the
    noise off (closed-form totals).  Returns the fact columns without rates.

    The exact product is regrouped by what each factor depends on:
    channel x segment x currency per combination, multiplier x season per
    (block, month), base (and base x daily factor) per (block, leaf).  Decimal
    multiplication is exact, so the value is the same; the big stream then
    does one wide multiply per measure.  Both noise draws come from one md5.
    """
    me = month_ends.select("date_id", fd.year_of("date_id").alias("year"),
                           fd.month_of("date_id").alias("month"), fd.quarter_of("date_id").alias("quarter"))
    bm = me.join(F.broadcast(blocks), "year")
    mult = F.when(F.col("month") <= F.col("cutoff_month"), F.col("mult_a")).otherwise(F.col("mult_b"))
    periods = bm.select("scenario_id", "year", "date_id", "span_amount", "span_daily",
                        (mult * season_driver(F.col("season_set"), F.col("quarter"))).alias("t"))
    lv = leaves(items).select("budget_item_id", "category")
    cats = lv.select("category").distinct()
    bases = (blocks.select("scenario_id", "year", "base_set").crossJoin(cats)
             .select("scenario_id", "year", "category",
                     base_driver(F.col("base_set"), F.col("category")).alias("base"),
                     (base_driver(F.col("base_set"), F.col("category"))
                      * _case(F.col("category"), fixed.DRIVER_DAILY_ADJ, "1.00", 3, 2)).alias("base_daily")))
    ch = channels.select("channel_id", "channel_name", "channel_type")
    k = (combos.join(F.broadcast(ch), "channel_id")
         .select("channel_id", "segment_id", "product_id", "currency_id",
                 (channel_driver(F.col("channel_type"), F.col("channel_name"))
                  * _case(F.col("segment_id"), fixed.DRIVER_SEGMENT, "1.0", 3, 2)
                  * _case(F.col("currency_id"), fixed.DRIVER_CURRENCY, "1.0", 3, 2)).alias("k")))
    # Only the combinations grow; periods (blocks x 12), category bases (blocks x 5) and
    # leaves are bounded and broadcast.  The exact product depends on the account only
    # through its category, so it is formed on (combination, month, category) rows and the
    # 31 leaves fan out afterwards: the widest stream only adds noise, takes ABS and rounds.
    # The combinations come out of a small (AQE-coalesced) shuffle; spread them over the
    # cluster before the ~4,000x fan-out so the generated rows are not built by one task.
    par = _parallelism(k.sparkSession)
    kp = k.repartition(par).crossJoin(F.broadcast(periods)).withColumn("tk", F.col("t") * F.col("k"))
    kpc = (kp.join(F.broadcast(bases), ["scenario_id", "year"])
           .select("scenario_id", "date_id", "channel_id", "segment_id", "product_id", "currency_id",
                   "category", "span_amount", "span_daily",
                   (F.col("base") * F.col("tk")).alias("p"), (F.col("base_daily") * F.col("tk")).alias("pd")))
    spine = kpc.join(F.broadcast(lv), "category")
    keys = ["scenario_id", "date_id", "channel_id", "segment_id", "product_id", "currency_id",
            "budget_item_id"]
    if seed is None:
        n_amt = n_daily = F.lit(0)
    else:
        # one digest column per row, referenced by both draws (not inlined twice)
        spine = spine.withColumn("_d", seeded_digest(seed, *keys))
        n_amt = draw_from(F.col("_d"), 0, F.col("span_amount"))
        n_daily = draw_from(F.col("_d"), 1, F.col("span_daily"))
    return spine.select(
        "date_id", "channel_id", "segment_id", "product_id", "currency_id", "scenario_id", "budget_item_id",
        money(F.abs(F.col("p") + n_amt)).alias("amount_eur"),
        money(F.abs(F.col("pd") + n_daily)).alias("daily_avg_eur"))


def base_index(amounts: DataFrame, items: DataFrame, base_set: str) -> DataFrame:
    """base_set, category, base, cells, mean, index: given amounts against the base driver of their category.

    A cell is a row of ``amounts`` on a posting account; index = mean amount of a cell / base.
    """
    cats = leaves(items).select("budget_item_id", "category")
    j = amounts.join(F.broadcast(cats), "budget_item_id").groupBy("category").agg(F.count(F.lit(1)).alias("cells"), F.sum("amount_eur").cast(MONEY_SUM).alias("total"))
    base = base_driver(F.lit(base_set), F.col("category"))
    return j.select(F.lit(base_set).alias("base_set"), "category", base.alias("base"), "cells", safe_ratio(F.col("total"), F.col("cells"), 2).alias("mean"),
                    safe_ratio(F.col("total"), F.col("cells") * base).alias("index"))


def driven_plan(base: DataFrame, channels: DataFrame, items: DataFrame, season_set: str,
                measure: str = "amount_eur", flagships: str = fixed.FLAGSHIP_PATTERN) -> DataFrame:
    """Drivers applied to given amounts: plan = amount x channel x segment x season x currency driver.

    ``base`` holds ledger rows (ids, date_id, ``measure``); returns them a year later with the
    planned amount and its daily average (x the category's factor), each rounded once per row.
    Rows whose channel or account is unknown keep a driver of 1.  Dimensions are joined, the
    rows are not multiplied.
    """
    ch = channels.select("channel_id", channel_driver(F.col("channel_type"), F.col("channel_name"), flagships).alias("by_channel"))
    adj = items.select("budget_item_id", _case(F.col("category"), fixed.DRIVER_DAILY_ADJ, "1.00", 3, 2).alias("by_day"))
    one = dec("1.00", 3, 2)
    moved = base.withColumn("date_id", fd.shift_month_end("date_id", 12))
    k = (F.coalesce("by_channel", one) * _case(F.col("segment_id"), fixed.DRIVER_SEGMENT, "1.0", 3, 2)
         * season_driver(F.lit(season_set), fd.quarter_of("date_id")) * _case(F.col("currency_id"), fixed.DRIVER_CURRENCY, "1.0", 3, 2))
    j = moved.join(ch, "channel_id", "left").join(adj, "budget_item_id", "left").withColumn("k", k.cast("decimal(12,8)"))
    amount = F.col(measure) * F.col("k")
    return j.select("date_id", "channel_id", "segment_id", "product_id", "currency_id", "budget_item_id",
                    money(amount).alias("amount_eur"), money(amount * F.coalesce("by_day", one)).alias("daily_avg_eur"))


def growth_plan(base: DataFrame, factors: DataFrame, keys: list[str], measure: str = "amount_eur",
                shift_years: int = 1) -> DataFrame:
    """Plans of year y = base of year y - shift at the same month x factor, rounded per row.

    ``factors`` is (scenario_id, year, factor), bounded by scenarios and plan years and broadcast: a year may have
    several plans, each its own factor, and a scenario another factor each year.
    """
    shifted = base.select(*keys, fd.shift_month_end("date_id", 12 * shift_years).alias("date_id"),
                          F.col(measure).alias("_base"))
    shifted = shifted.withColumn("year", fd.year_of("date_id"))
    j = shifted.join(F.broadcast(factors), "year")
    return j.select("scenario_id", *keys, "date_id", "year", money(F.col("_base") * F.col("factor")).alias(measure))


#: Parts that rows of equal remainder are dealt into before any of them is ranked.
TIE_PARTS = 4096


def apportion(rows: DataFrame, group: list[str], keys: list[str], exact: str, target: DataFrame, name: str = "amount_eur") -> DataFrame:
    """Whole cents for every row so that each group adds up to its target (largest remainders).

    ``exact`` is a row's share, a decimal of any scale and at least zero; ``target`` is (*group, target), bounded by the groups.
    Every row gets its share rounded down to cents, and the cents that are left go one each to the rows with the
    largest remainders (ties by md5 of ``keys``, then the keys).  ``keys`` identify a row within its group.  Groups
    without a target are left out; a target that shares can't reach this way (less than the floors, or a cent a row more)
    raises an error.

    No group is ranked whole: counts by remainder (a bounded number of values) say which remainders get a cent, counts of hash
    parts narrow the last remainder down, and only rows of one part of that remainder are sorted.
    """
    floors = F.floor(F.col(exact) * 100, 0).cast("decimal(38,0)")
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    part = F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int")
    cut = rows.withColumn("_floor", floors).withColumn("_rest", F.col(exact) * 100 - F.col("_floor"))
    same = [*group]
    totals = cut.groupBy(*same).agg(F.sum("_floor").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    left = (F.col("target") * 100 - F.col("_sum")).cast("long")
    # targets are bounded by the groups, and so is everything below by groups x remainders (or x parts)
    need = totals.join(F.broadcast(target), same).withColumn("_left", left)
    need = need.withColumn("_left", F.when((F.col("_left") < 0) | (F.col("_left") > F.col("_n")), F.raise_error(F.lit("target out of reach of the shares")).cast("long")).otherwise(F.col("_left")))
    by_rest = cut.groupBy(*same, "_rest").agg(F.count(F.lit(1)).alias("_k"))
    before = F.coalesce(F.sum("_k").over(Window.partitionBy(*same).orderBy(F.desc("_rest")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = (by_rest.withColumn("_before", before).join(need.select(*same, "_left"), same)
            .where((F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("_k")))
            .select(*same, F.col("_rest").alias("_edge"), (F.col("_left") - F.col("_before")).alias("_ties")))
    tied = cut.join(F.broadcast(edge), same).where("_rest = _edge").withColumn("_digest", digest).withColumn("_part", part)
    parts = tied.groupBy(*same, "_ties", "_part").agg(F.count(F.lit(1)).alias("_k"))
    ahead = F.coalesce(F.sum("_k").over(Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (parts.withColumn("_ahead", ahead).where((F.col("_ahead") <= F.col("_ties")) & (F.col("_ties") < F.col("_ahead") + F.col("_k")))
            .select(*same, F.col("_part").alias("_last"), (F.col("_ties") - F.col("_ahead")).alias("_take")))
    # one row a group: the remainder from which on rows get a cent, the part up to which, and how many rows of that part
    rule = need.select(*same, "_left").join(edge, same, "left").join(last, same, "left")
    at_edge, in_last = F.col("_rest") == F.col("_edge"), F.col("_part") == F.col("_last")
    # only rows of the last remainder need a digest
    judged = cut.join(F.broadcast(rule), same).withColumn("_digest", F.when(at_edge, digest)).withColumn("_part", part)
    rank = F.row_number().over(Window.partitionBy(*same, "_part").orderBy("_digest", *keys))
    sure = judged.where(~F.coalesce(at_edge & in_last, F.lit(False))).withColumn(
        "_cent", F.when(F.col("_edge").isNull(), F.col("_left") > 0).when(at_edge, F.coalesce(F.col("_part") < F.col("_last"), F.col("_ties") > 0))
        .otherwise(F.col("_rest") > F.col("_edge")))
    ranked = judged.where(at_edge & in_last).withColumn("_cent", rank <= F.col("_take"))
    amount = ((F.col("_floor") + F.col("_cent").cast("int")) / 100).cast("decimal(22,2)")
    return sure.unionByName(ranked).select(*rows.columns, amount.alias(name))


def rolling_forecast(actual: DataFrame, plan: DataFrame, cutoff_month: int, uplift: str,
                     measure: str = "amount_eur") -> DataFrame:
    """Actuals through the cutoff month, then the plan x uplift (rounded per row) — a union, no join."""
    m_a = fd.month_of("date_id")
    a = actual.filter(m_a <= cutoff_month)
    p = plan.filter(m_a > cutoff_month).withColumn(measure, money(F.col(measure) * dec(uplift, 3, 2)))
    return a.unionByName(p)
