"""Data checks derived from the source model's constraints and validation queries.

Every check is a distributed aggregate over the full tables (no sampling) and
returns (check, violations) rows or the offending groups; nothing is
collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as fd
from ..sources import fixed
from ..sources.model import GRAIN, Model
from . import fx


def _one(name: str, df: DataFrame, cond=None) -> DataFrame:
    d = df if cond is None else df.filter(cond)
    return d.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


def pk_unique(m: Model) -> DataFrame:
    """Rows whose primary key is NULL or shared with another row, per table."""
    keys = {"dim_date": "date_id", "dim_channel": "channel_id", "dim_segment": "segment_id",
            "dim_product": "product_id", "dim_currency": "rate_id", "dim_scenario": "scenario_id",
            "dim_budget_items": "budget_item_id"}
    parts = []
    for t, k in keys.items():
        df = m.tables()[t]
        dup = (df.groupBy(k).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.coalesce(F.sum(F.when(F.col(k).isNull() | (F.col("n") > 1), F.col("n"))), F.lit(0))
                    .cast("bigint").alias("violations")))
        parts.append(dup.select(F.lit(t).alias("check_name"), "violations"))
    return _union(parts)


def fk_orphans(m: Model) -> DataFrame:
    """Fact (and rate / parent) keys with no matching dimension row; one scan of the fact."""
    # the fact is reduced once to its distinct key tuples with row counts (map-side partial
    # aggregate, so a key holding a third of the rows is no hot partition), and each small
    # key list only adds a flag to that result
    keys = {"date_id": m.dates, "channel_id": m.channels, "segment_id": m.segments, "product_id": m.products,
            "scenario_id": m.scenarios, "budget_item_id": m.items, "rate_id": m.rates}
    rows = m.fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    for k, dim in keys.items():
        rows = rows.join(dim.select(k).distinct().withColumn(f"has_{k}", F.lit(True)), k, "left")
    missed = rows.agg(*[F.coalesce(F.sum(F.when(F.col(f"has_{k}").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias(k)
                        for k in keys])
    fact = missed.select(F.explode(F.array(*[F.struct(F.lit(f"fact.{k}").alias("check_name"), F.col(k).alias("violations"))
                                             for k in keys])).alias("s")).select("s.*")
    rates = _one("rates.date_id", m.rates.join(m.dates.select("date_id"), "date_id", "left_anti"))
    parents = m.items.select(F.col("parent_item_id").alias("budget_item_id")).where("budget_item_id IS NOT NULL")
    items = _one("items.parent_item_id", parents.join(m.items.select("budget_item_id"), "budget_item_id", "left_anti"))
    return _union([fact, rates, items])


def grain_unique(fact: DataFrame) -> DataFrame:
    """Fact rows sharing a grain with another row."""
    g = fact.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit("grain").alias("check_name"), "violations")


def not_null(fact: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count per NOT NULL column, one pass."""
    agg = fact.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in columns])
    stacked = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"),
                                                      F.coalesce(F.col(c), F.lit(0)).cast("bigint")
                                                      .alias("violations")) for c in columns])).alias("s"))
    return stacked.select("s.check_name", "s.violations")


def _checked(name: str, rows: DataFrame, bad) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows_checked"),
                    F.sum(F.coalesce(bad, F.lit(True)).cast("bigint")).alias("violations")).select(
        F.lit(name).alias("check_name"), "rows_checked",
        F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations"))


def eur_identity(fact: DataFrame, rates: DataFrame) -> DataFrame:
    """EUR rows: nominal equals EUR for both measures and both rates are 1 (full scan).

    A NULL on either side and a rate_id without a rate are violations.
    """
    j = fact.filter(F.col("currency_id") == 1).join(
        rates.select("rate_id", "eom_rate", "daily_avg_rate"), "rate_id", "left")
    good = (F.col("amount_eur").isNotNull() & F.col("daily_avg_eur").isNotNull()
            & F.col("amount_eur").eqNullSafe(F.col("amount_nominal"))
            & F.col("daily_avg_eur").eqNullSafe(F.col("daily_avg_nominal"))
            & F.col("eom_rate").eqNullSafe(F.lit(1)) & F.col("daily_avg_rate").eqNullSafe(F.lit(1)))
    return _checked("eur_identity", j, ~good)


def nominal_recon(fact: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows of every foreign currency: stored nominal equals CAST(eur x rate AS DECIMAL(22,2)) for
    both measures.  A NULL on either side and a rate_id without a rate are violations."""
    r = rates.select("rate_id", "eom_rate", "daily_avg_rate")
    j = fact.filter(~F.col("currency_id").eqNullSafe(F.lit(1))).join(r, "rate_id", "left")
    exp = (F.col("amount_eur") * F.col("eom_rate")).cast("decimal(22,2)")
    exp_d = (F.col("daily_avg_eur") * F.col("daily_avg_rate")).cast("decimal(22,2)")
    return _checked("nominal_recon", j, ~((F.col("amount_nominal") == exp) & (F.col("daily_avg_nominal") == exp_d)))


def no_subtotal_rows(fact: DataFrame, items: DataFrame) -> DataFrame:
    sub = F.broadcast(items.filter(F.col("is_subtotal")).select("budget_item_id"))
    return _one("rows_on_subtotals", fact.join(sub, "budget_item_id", "left_semi"))


def coverage(fact: DataFrame, matrix: DataFrame) -> DataFrame:
    """Fact combinations outside the matrix, and allowed combinations with no fact row."""
    keys = ["channel_id", "segment_id", "product_id", "currency_id"]
    combos = fact.select(*keys).distinct()
    return _union([_one("outside_matrix", combos.join(matrix.select(*keys), keys, "left_anti")),
                   _one("allowed_missing", matrix.select(*keys).join(combos, keys, "left_anti"))])


def rule_coverage(fact: DataFrame, channels: DataFrame, rules: DataFrame) -> DataFrame:
    """Bookings against a table of rules, both ways, by channel type and segment.

    ``rules``: channel_type, segment_id, pairs (array of distinct (product_id, currency_id)), one row each.  A booked
    combination is allowed if its pair is in its rule's array; rules are not unfolded.  Returns allowed (pairs of the
    rule), booked (allowed ones that are booked), missing (allowed, not booked), outside (booked, not allowed) and
    outside_rows.  Bookings of a channel type and segment without a rule are outside, rules without bookings missing.
    """
    group, pair = ["channel_type", "segment_id"], F.struct("product_id", "currency_id")
    combos = fact.groupBy("channel_id", "segment_id", "product_id", "currency_id").agg(F.count(F.lit(1)).alias("n"))
    types = channels.select("channel_id", "channel_type")
    booked = combos.join(types, "channel_id", "left").groupBy(*group, "product_id", "currency_id").agg(F.sum("n").alias("n"))
    # rules are bounded by channel types x segments
    j = booked.join(F.broadcast(rules.select(*group, "pairs")), group, "left")
    inside = F.coalesce(F.array_contains("pairs", pair), F.lit(False))
    seen = j.groupBy(*group).agg(F.count_if(inside).alias("booked"), F.count_if(~inside).alias("outside"), F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outside_rows"))
    zero = F.lit(0).cast("long")
    both = rules.select(*group, F.size("pairs").cast("long").alias("allowed")).join(seen, group, "full")
    counts_ = {c: F.coalesce(c, zero) for c in ("allowed", "booked", "outside", "outside_rows")}
    return both.withColumns(counts_).select(*group, "allowed", "booked", (F.col("allowed") - F.col("booked")).alias("missing"), "outside", "outside_rows")


def rule_breaches(fact: DataFrame, channels: DataFrame, rules: DataFrame) -> DataFrame:
    """breach (outside or missing), channel_type, segment_id, product_id, currency_id, fact_rows: the combinations themselves.

    A rule's missing pairs are its array less the set of its booked pairs, which is no longer than the array.
    """
    group, pair = ["channel_type", "segment_id"], F.struct("product_id", "currency_id")
    combos = fact.groupBy("channel_id", "segment_id", "product_id", "currency_id").agg(F.count(F.lit(1)).alias("n"))
    booked = combos.join(channels.select("channel_id", "channel_type"), "channel_id", "left").groupBy(*group, "product_id", "currency_id").agg(F.sum("n").alias("n"))
    r = F.broadcast(rules.select(*group, "pairs"))
    j = booked.join(r, group, "left").withColumn("inside", F.coalesce(F.array_contains("pairs", pair), F.lit(False)))
    outside = j.where("NOT inside").select(F.lit("outside").alias("breach"), *group, "product_id", "currency_id", F.col("n").alias("fact_rows"))
    found = j.where("inside").groupBy(*group).agg(F.collect_set(pair).alias("found"))
    left = rules.join(found, group, "left").select(*group, F.explode(F.when(F.col("found").isNull(), F.col("pairs")).otherwise(F.array_except("pairs", "found"))).alias("p"))
    return outside.unionByName(left.select(F.lit("missing").alias("breach"), *group, "p.product_id", "p.currency_id", F.lit(0).cast("long").alias("fact_rows")))


def plan_coverage(fact: DataFrame, keys: list[str], booked: int = 1, allowed: int = 2) -> DataFrame:
    """Booked combinations that the plan of the year doesn't hold, and planned ones without a booking.

    The plan scenario is the coverage rule: a combination of ``keys`` is allowed in a year if
    it is planned there.  Years without either side are not compared.  One aggregate of the
    fact gives both sides.
    """
    sid = F.col("scenario_id")
    g = fact.filter(sid.isin(booked, allowed)).groupBy("year", *keys).agg(
        F.max((sid == booked).cast("int")).alias("b"), F.max((sid == allowed).cast("int")).alias("a"))
    per_year = g.groupBy("year").agg(F.sum(F.when((F.col("b") == 1) & (F.col("a") == 0), 1).otherwise(0)).alias("outside"),
                                     F.sum(F.when((F.col("a") == 1) & (F.col("b") == 0), 1).otherwise(0)).alias("missing"),
                                     F.max("b").alias("b"), F.max("a").alias("a")).filter("a = 1 AND b = 1")
    total = per_year.agg(F.coalesce(F.sum("outside"), F.lit(0)).cast("bigint").alias("outside_matrix"),
                         F.coalesce(F.sum("missing"), F.lit(0)).cast("bigint").alias("allowed_missing"))
    return total.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("violations"))
                                            for c in ("outside_matrix", "allowed_missing")])).alias("s")).select("s.*")


def rate_range(rates: DataFrame, spark) -> DataFrame:
    """Rates outside the documented yearly ranges; currency codes not 3 characters."""
    rng = spark.createDataFrame(fixed.FX_DOCUMENTED_RANGES,
                                "r_currency_id int, band_year int, lo decimal(10,4), hi decimal(10,4)")
    r = rates.withColumn("band_year", fx.band_year(fd.year_of("date_id")))
    rng = rng.withColumnRenamed("band_year", "r_band_year")
    j = r.join(F.broadcast(rng), (F.col("currency_id") == F.col("r_currency_id"))
               & (F.col("band_year") == F.col("r_band_year")), "left")
    inside = F.col("eom_rate").between(F.col("lo"), F.col("hi")) & F.col("daily_avg_rate").between(F.col("lo"), F.col("hi"))
    # a foreign currency without a documented range counts as outside: nothing is skipped
    listed = F.col("lo").isNotNull() | (F.col("currency_id") == 1)
    out = ~listed | (F.col("lo").isNotNull() & ~F.coalesce(inside, F.lit(False)))
    return _union([_one("rate_outside_range", j, out),
                   _one("currency_code_length", rates, ~F.coalesce(F.length("currency_code") == 3, F.lit(False)))])


def rate_key(fact: DataFrame, rates: DataFrame) -> DataFrame:
    """rate_id = CONCAT(date_id, currency_id) on fact and rates; rate dates are month-ends."""
    me = fd.date_key(F.last_day(fd.key_to_date("date_id")))
    return _union([
        _one("fact_rate_id", fact, ~F.coalesce(F.col("rate_id") == fx.rate_id(), F.lit(False))),
        _one("rates_rate_id", rates, ~F.coalesce(F.col("rate_id") == fx.rate_id(), F.lit(False))),
        _one("rates_not_month_end", rates, ~F.coalesce(F.col("date_id") == me, F.lit(False))),
    ])


def scenario_months(versions: DataFrame) -> DataFrame:
    """Versions of scenarios (``variance.validity``) and whether they are whole: ``complete`` if a plan holds the twelve
    months of its fiscal year, ``year_set`` if a plan, and only a plan, has a fiscal year, ``in_year`` if its months lie in it."""
    actual, fy = F.col("scenario_type") == "Actual", F.col("fiscal_year")
    return versions.select(
        "scenario_id", "fiscal_year", "first_month", "last_month", "months", (fy.isNotNull() & (F.col("months") == 12)).alias("complete"),
        (actual == fy.isNull()).alias("year_set"),
        F.coalesce((fd.year_of("first_month") == fy) & (fd.year_of("last_month") == fy), actual).alias("in_year"))


def reconciliation(source: DataFrame, fact: DataFrame) -> DataFrame:
    """Amount of the source lines against the actuals of the ledger, to the cent (one row each, no join of rows)."""
    ledger = fact.filter(F.col("scenario_id") == 1).agg(F.coalesce(F.sum("amount_eur"), F.lit(0)).cast("decimal(38,2)").alias("ledger_amount"))
    both = source.withColumn("source_amount", F.coalesce("source_amount", F.lit(0)).cast("decimal(38,2)")).crossJoin(F.broadcast(ledger))
    return both.withColumn("difference", (F.col("source_amount") - F.col("ledger_amount")).cast("decimal(38,2)")).withColumn(
        "reconciled", F.col("difference") == 0)


def nonneg(fact: DataFrame, measures: list[str]) -> DataFrame:
    """Stored amounts below zero, per measure (amounts are stored unsigned)."""
    agg = fact.agg(*[F.sum((F.col(c) < 0).cast("bigint")).alias(c) for c in measures])
    stacked = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"),
                                                      F.coalesce(F.col(c), F.lit(0)).cast("bigint")
                                                      .alias("violations")) for c in measures])).alias("s"))
    return stacked.select("s.check_name", "s.violations")
