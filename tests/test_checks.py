from dataclasses import replace
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from ledgerloom.operators import checks, counts, variance
from ledgerloom.sources import fixed
from reference_model import reference_model


def _clean(spark):
    m = reference_model(spark, seed=3, blocks=[fixed.PLAN_BLOCKS[0]])
    small = m.fact.filter((F.col("channel_id") == 1) & (F.col("date_id") <= 20220331))
    return m.with_fact(small.withColumn("year", F.lit(2022)))


def _v(df):
    return {r.check_name: r.violations for r in df.collect()}


def test_clean_ledger_passes(spark):
    m = _clean(spark)
    assert set(_v(checks.fk_orphans(m)).values()) == {0}
    assert _v(checks.grain_unique(m.fact)) == {"grain": 0}
    assert _v(checks.no_subtotal_rows(m.fact, m.items)) == {"rows_on_subtotals": 0}
    assert _v(checks.nominal_recon(m.fact, m.rates)) == {"nominal_recon": 0}
    assert _v(checks.eur_identity(m.fact, m.rates)) == {"eur_identity": 0}
    assert set(_v(checks.rate_key(m.fact, m.rates)).values()) == {0}
    assert set(_v(checks.nonneg(m.fact, ["amount_eur", "amount_nominal"])).values()) == {0}


def test_planted_faults_are_found(spark):
    m = _clean(spark)
    one = m.fact.limit(1)
    dup = one
    orphan = one.withColumn("channel_id", F.lit(99))
    subtotal = one.withColumn("budget_item_id", F.lit(1))
    bad_rate = one.withColumn("rate_id", F.lit("x")).withColumn("date_id", F.lit(20220131))
    usd = m.fact.filter(F.col("currency_id") == 2).limit(1)
    off = usd.withColumn("amount_nominal", (F.col("amount_nominal") + F.lit(Decimal("0.01"))).cast("decimal(22,2)"))
    neg = one.withColumn("amount_eur", F.lit(Decimal("-1.00")).cast("decimal(22,2)"))
    bad = m.with_fact(m.fact.unionByName(dup).unionByName(orphan).unionByName(subtotal)
                      .unionByName(bad_rate).unionByName(off).unionByName(neg))
    assert _v(checks.grain_unique(bad.fact))["grain"] >= 2
    assert _v(checks.fk_orphans(bad))["fact.channel_id"] == 1
    assert _v(checks.no_subtotal_rows(bad.fact, bad.items))["rows_on_subtotals"] == 1
    assert _v(checks.rate_key(bad.fact, bad.rates))["fact_rate_id"] == 1
    assert _v(checks.nominal_recon(bad.fact, bad.rates))["nominal_recon"] >= 1
    assert _v(checks.nonneg(bad.fact, ["amount_eur"]))["amount_eur"] == 1
    actuals = checks.scenario_months(variance.validity(m.fact, m.scenarios)).first()
    assert actuals.months == 3 and actuals.year_set and actuals.fiscal_year is None
    plan = variance.validity(m.fact.withColumn("scenario_id", F.lit(2)), m.scenarios)
    assert not checks.scenario_months(plan).first().complete
    stray = checks.scenario_months(plan.withColumns({"last_month": F.lit(20230131), "fiscal_year": F.lit(2022)})).first()
    assert stray.year_set and not stray.in_year
    assert not checks.scenario_months(plan.withColumn("fiscal_year", F.lit(None).cast("int"))).first().year_set


def test_rate_range_flags_band_overshoot(spark):
    m = reference_model(spark, seed=None, blocks=[fixed.PLAN_BLOCKS[0]])
    v = _v(checks.rate_range(m.rates, spark))
    assert v["currency_code_length"] == 0
    known = v["rate_outside_range"]
    off = m.rates.limit(1).withColumns({"currency_id": F.lit(9), "currency_code": F.lit("ABCD")})
    v = _v(checks.rate_range(m.rates.unionByName(off), spark))
    assert v == {"rate_outside_range": known + 1, "currency_code_length": 1}


def test_key_null_and_nominal_faults_are_found(spark):
    m = _clean(spark)
    assert set(_v(checks.pk_unique(m)).values()) == {0}
    assert _v(checks.pk_unique(replace(m, channels=m.channels.union(m.channels.limit(1)))))["dim_channel"] == 2
    eur = m.fact.filter(F.col("currency_id") == 1).limit(1)
    null = eur.withColumn("daily_avg_nominal", F.lit(None).cast("decimal(22,2)"))
    stray = eur.withColumn("rate_id", F.lit("none"))
    foreign = eur.withColumn("currency_id", F.lit(7)).withColumn("rate_id", F.lit("none"))
    assert _v(checks.eur_identity(m.fact.unionByName(null).unionByName(stray), m.rates)) == {"eur_identity": 2}
    assert _v(checks.nominal_recon(m.fact.unionByName(foreign), m.rates)) == {"nominal_recon": 1}
    assert _v(checks.not_null(m.fact.unionByName(null), ["daily_avg_nominal"])) == {"daily_avg_nominal": 1}
    assert _v(checks.rate_key(m.fact.unionByName(eur.withColumn("rate_id", F.lit(None).cast("string"))), m.rates))["fact_rate_id"] == 1


def test_coverage_finds_both_faults(spark):
    keys = "channel_id int, segment_id int, product_id int, currency_id int"
    fact = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 2, 1)], keys)
    allowed = spark.createDataFrame([(1, 1, 1, 1), (2, 1, 1, 1)], keys)
    assert _v(checks.coverage(fact, allowed)) == {"outside_matrix": 1, "allowed_missing": 1}


def test_plan_coverage_is_by_year(spark):
    rows = [(1, 2023, 1), (2, 2023, 1), (1, 2023, 2), (2, 2024, 3), (1, 2024, 1), (1, 2022, 9)]
    fact = spark.createDataFrame(rows, "scenario_id int, year int, channel_id int")
    assert _v(checks.plan_coverage(fact, ["channel_id"])) == {"outside_matrix": 2, "allowed_missing": 1}


def test_lost_lines_and_nominal_sums_are_refused(spark):
    source = spark.createDataFrame([(2, Decimal("30.00"))], "source_lines long, source_amount decimal(38,2)")
    fact = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("20.00"))], "scenario_id int, amount_eur decimal(22,2)")
    row = checks.reconciliation(source, fact).first()
    assert row.difference == Decimal("20.00") and not row.reconciled
    with pytest.raises(ValueError, match="currencies"):
        counts.sum_by(fact, ["scenario_id"], ["amount_nominal"])
