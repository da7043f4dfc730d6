from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks, constraints, profit
from ledgerloom.plans import all_jobs, jobs_checks
from ledgerloom.sources.store import stored_model
from ledgerloom.sources.tpch import coverage_rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    m = stored_model(spark, SF)
    return replace(m, fact=m.fact.where("scenario_id = 1 AND year = 1996").limit(400).drop("month"))


def found(m, **kw):
    return {(r.table_name, r.check_name, r.kind): r.violations for r in constraints.check_all(m, **kw).collect() if r.violations}


def test_a_clean_ledger_violates_nothing(spark, small):
    assert found(small) == {}
    rows = constraints.check_all(small).collect()
    assert {r.table_name for r in rows} == set(constraints.KEYS) and all(r.rows_checked > 0 for r in rows)
    assert {r.kind for r in rows} == {"not_null", "length", "row", "key"}
    assert found(small.with_fact(small.fact.limit(0))) == {}


def test_planted_faults_in_every_table(spark, small):
    def twice(df):
        return df.union(df.limit(1))

    def spoiled(df, column, value):
        first = df.columns[0]
        key = df.agg(F.min(first)).first()[0]
        cast = df.schema[column].dataType
        return df.withColumn(column, F.when(F.col(first) == key, F.lit(value).cast(cast)).otherwise(F.col(column)))

    assert found(replace(small, dates=twice(small.dates))) == {("dim_date", "date_id", "key"): 2}
    assert found(replace(small, channels=spoiled(small.channels, "region", None))) == {("dim_channel", "region", "not_null"): 1}
    assert found(replace(small, channels=spoiled(small.channels, "channel_type", "x" * 31))) == {("dim_channel", "channel_type", "length"): 1}
    assert found(replace(small, segments=spoiled(small.segments, "segment_name", "é" * 31))) == {("dim_segment", "segment_name", "length"): 1}
    assert found(replace(small, products=twice(small.products))) == {("dim_product", "product_id", "key"): 2}
    assert ("dim_currency", "currency_code", "row") in found(replace(small, rates=spoiled(small.rates, "currency_code", "EURO")))
    assert found(replace(small, scenarios=spoiled(small.scenarios, "scenario_type", None))) == {("dim_scenario", "scenario_type", "not_null"): 1}
    assert found(replace(small, items=spoiled(small.items, "sign_convention", 2))) == {("dim_budget_items", "sign_convention", "row"): 1}


def test_planted_faults_in_the_fact(spark, small):
    one = small.fact.where("currency_id = 2").limit(1)
    fact = "fact_financial_data"

    def with_row(**columns):
        row = one.withColumn("channel_id", F.lit(77))  # a grain of its own
        return found(small.with_fact(small.fact.unionByName(row.withColumns({k: F.lit(v).cast(small.fact.schema[k].dataType) for k, v in columns.items()}))))

    assert with_row() == {}
    assert found(small.with_fact(small.fact.unionByName(one))) == {(fact, ",".join(constraints.KEYS[fact]), "key"): 2}
    assert with_row(product_id=None) == {(fact, "product_id", "not_null"): 1, (fact, ",".join(constraints.KEYS[fact]), "key"): 1}
    assert with_row(amount_eur=-1)[fact, "amount_eur_not_negative", "row"] == 1
    assert with_row(rate_id="x" * 21) == {(fact, "rate_id", "length"): 1, (fact, "rate_id", "row"): 1, (fact, "nominal_recon", "row"): 1}
    assert with_row(amount_nominal=0) == {(fact, "nominal_recon", "row"): 1}
    assert with_row(budget_item_id=1) == {(fact, "posting_account", "row"): 1}
    eur = with_row(currency_id=1)
    assert eur[fact, "eur_identity", "row"] == 1 and eur[fact, "rate_id", "row"] == 1


def test_all_checks_scan_the_ledger_once(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # else paths are cut in plans
    try:
        plan = all_jobs()["ledger_checks"].build(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert sum("/fact/load=" in scan for scan in plan.split("FileScan parquet")[1:]) == 1


def test_a_key_carries_one_count(spark, small):
    rows = spark.createDataFrame([(1, "a"), (1, None), (2, None), (3, "c"), (None, None), (None, "d"), (4, "eee")], "k int, v string")
    checks = [constraints.Constraint("t", "v", "not_null", "v IS NOT NULL"), constraints.Constraint("t", "v", "length", "v IS NULL OR length(v) <= 2")]
    got = constraints.table_checks("t", rows, checks, ["k"])
    assert {(r.check_name, r.kind): (r.rows_checked, r.violations) for r in got.collect()} == {("v", "not_null"): (7, 3), ("v", "length"): (7, 1), ("k", "key"): (7, 4)}
    # one counter a key and row kind, however many constraints: sums for each of them filled the memory at the ledger's grain
    plan = constraints.check_all(small)._jdf.queryExecution().executedPlan().toString()
    keyed = [line for line in plan.splitlines() if "HashAggregate(keys=[date_id" in line and "budget_item_id" in line]
    assert keyed and all("sum(" not in line for line in keyed)


def test_rules_are_checked_both_ways(spark, monkeypatch):
    m = stored_model(spark, SF)
    rules = coverage_rules(m)
    before = {(r.channel_type, r.segment_id): r for r in jobs_checks.q8_coverage(spark, SF).collect()}
    busy = next(k for k, r in sorted(before.items()) if r.allowed and r.booked)
    pair = checks.rule_breaches(m.fact.where("scenario_id = 1"), m.channels, rules.withColumn("pairs", F.array().cast(rules.schema["pairs"].dataType))).where(
        (F.col("channel_type") == busy[0]) & (F.col("segment_id") == busy[1])).first()
    mine = (F.col("channel_type") == busy[0]) & (F.col("segment_id") == busy[1])
    forbidden = F.filter("pairs", lambda p: ~((p["product_id"] == pair.product_id) & (p["currency_id"] == pair.currency_id)))
    never = F.array(F.struct(F.lit(999).alias("product_id"), F.lit(1).alias("currency_id")))
    planted = rules.withColumn("pairs", F.when(mine, F.concat(forbidden, never)).otherwise(F.col("pairs")))
    monkeypatch.setattr(jobs_checks, "coverage_rules", lambda m: planted)
    after = {(r.channel_type, r.segment_id): r for r in jobs_checks.q8_coverage(spark, SF).collect()}
    assert {k for k in before if before[k] != after[k]} == {busy}
    assert after[busy].missing == before[busy].missing + 1 and after[busy].outside == before[busy].outside + 1
    assert after[busy].outside_rows == before[busy].outside_rows + pair.fact_rows
    listed = {(r.breach, r.product_id, r.currency_id) for r in jobs_checks.coverage_breaches(spark, SF).where(mine).collect()}
    assert {("missing", 999, 1), ("outside", pair.product_id, pair.currency_id)} <= listed
    # rules without a booking, bookings without a rule
    monkeypatch.setattr(jobs_checks, "coverage_rules", lambda m: rules.withColumn("channel_type", F.lit("None such")).dropDuplicates(["segment_id"]))
    rows = jobs_checks.q8_coverage(spark, SF).collect()
    assert all((r.missing == r.allowed > 0 and r.outside == 0) if r.channel_type == "None such" else (r.allowed == 0 and r.outside > 0) for r in rows)


def test_shares_of_null_parents_and_single_members(spark):
    rows = spark.createDataFrame([("a", "n", 1.0), ("b", "n", 3.0), ("c", None, 4.0), (None, "o", 0.0)], "member string, parent string, net_income double")
    got = {r.member: (r.share_of_parent, r.share_of_total) for r in profit.shares(rows, ["member"], ["parent"]).collect()}
    assert got == {"a": (0.25, 0.125), "b": (0.75, 0.375), "c": (1.0, 0.5), None: (None, 0.0)}
