from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators import fx, variance
from ledgerloom.sources.dates import calendar, month_end_spine
from ledgerloom.sources.model import budget_items


def test_rate_table_bands(spark):
    me = month_end_spine(calendar(spark, "2022-01-01", "2026-12-31"))
    r = fx.rate_table(me, fx.bands(spark), 42)
    assert r.count() == 180
    eur = r.filter(F.col("currency_id") == 1)
    assert eur.filter((F.col("eom_rate") != 1) | (F.col("daily_avg_rate") != 1)).count() == 0
    usd22 = r.filter((F.col("currency_id") == 2) & (F.col("date_id") < 20230101))
    lo, hi = usd22.agg(F.min("eom_rate"), F.max("eom_rate")).collect()[0]
    assert Decimal("0.9680") <= lo and hi <= Decimal("1.1379")
    assert r.filter(F.col("rate_id") != F.concat(F.col("date_id").cast("string"),
                                                  F.col("currency_id").cast("string"))).count() == 0


def test_fx_effect_volume_plus_rate_is_total(spark):
    rates = spark.createDataFrame([(20230131, 2, Decimal("1.100000")), (20240131, 2, Decimal("1.050000"))],
                                  "date_id int, currency_id int, eom_rate decimal(10,6)")
    fact = spark.createDataFrame([(20230131, 2, Decimal("100.00")), (20240131, 2, Decimal("130.00"))],
                                 "date_id int, currency_id int, amount_eur decimal(22,2)")
    e = fx.fx_effect(fact, rates, []).collect()[0]
    assert e.volume_effect + e.rate_effect == e.total_effect
    assert e.volume_effect == Decimal("33.00000000")


def test_variance_keeps_missing_side_null(spark):
    lines = spark.createDataFrame(
        [(1, 2023, 1, Decimal("10.00"), Decimal("10.00")), (2, 2023, 1, Decimal("8.00"), Decimal("8.00")),
         (1, 2022, 1, Decimal("5.00"), Decimal("5.00"))],
        "scenario_id int, year int, budget_item_id int, signed decimal(38,2), display decimal(38,2)")
    v = {r.year: r for r in variance.variance(lines, ["year", "budget_item_id"], 1, 2).collect()}
    assert v[2023].variance == Decimal("2.00") and v[2023].status == "favourable"
    assert v[2022].budget is None and v[2022].variance is None and v[2022].status == "n/a"


def test_waterfall_ends_on_total(spark):
    steps = spark.createDataFrame(
        [(1, 0, Decimal("100.00"), False), (1, 1, Decimal("-30.00"), False), (1, 2, Decimal("70.00"), True)],
        "p int, step int, amount decimal(38,2), is_total boolean")
    w = {r.step: r for r in variance.waterfall(steps, ["p"]).collect()}
    assert w[1].bar_start == Decimal("100.00") and w[1].bar_end == Decimal("70.00")
    assert w[2].bar_start == 0 and w[2].bar_end == Decimal("70.00")


def test_fx_effect_keeps_new_and_ended_cells(spark):
    rates = spark.createDataFrame([(d, 2, Decimal("1.000000")) for d in (20230131, 20240131)],
                                  "date_id int, currency_id int, eom_rate decimal(10,6)")
    fact = spark.createDataFrame([(1, 20230131, 2, Decimal("100.00")), (1, 20240131, 2, Decimal("130.00")),
                                  (2, 20230131, 2, Decimal("70.00")), (3, 20240131, 2, Decimal("10.00"))],
                                 "budget_item_id int, date_id int, currency_id int, amount_eur decimal(22,2)")
    e = {r.budget_item_id: r.total_effect for r in fx.fx_effect(fact, rates, ["budget_item_id"]).collect()}
    assert e == {1: Decimal("30.00000000"), 2: Decimal("-70.00000000"), 3: Decimal("10.00000000")}


def test_restatement_carries_rates_and_drops_no_month(spark):
    rates = spark.createDataFrame([(20230131, 2, Decimal("1.100000"), Decimal("1.200000")), (20230331, 2, Decimal("1.300000"), Decimal("1.400000"))],
                                  "date_id int, currency_id int, eom_rate decimal(10,6), daily_avg_rate decimal(10,6)")
    fact = spark.createDataFrame([(d, Decimal("100.00")) for d in (20221231, 20230131, 20230228, 20230331, 20230430)], "date_id int, amount_eur decimal(22,2)")
    got = {(r.currency_id, r.date_id): r for r in fx.restate(fact, rates, [2, 3], []).collect()}
    assert len(got) == 10
    assert got[2, 20221231].restated_eom is None and got[3, 20230430].restated_eom is None
    assert [(got[2, d].restated_eom, got[2, d].carried, got[2, d].rate_date) for d in (20230131, 20230228, 20230331, 20230430)] == [
        (Decimal("110.00"), False, 20230131), (Decimal("110.00"), True, 20230131), (Decimal("130.00"), False, 20230331), (Decimal("130.00"), True, 20230331)]


def test_a_row_without_a_rate_is_kept(spark):
    base = spark.createDataFrame([(20230131, 2, Decimal("1.00"), Decimal("2.00"))], "date_id int, currency_id int, amount_eur decimal(22,2), daily_avg_eur decimal(22,2)")
    none = spark.createDataFrame([], "date_id int, currency_id int, eom_rate decimal(10,6), daily_avg_rate decimal(10,6)")
    row = fx.add_nominal(base, none).first()
    assert row.amount_nominal is None and row.amount_eur == Decimal("1.00") and row.rate_id == "202301312"


def test_versions_pair_up_by_shared_months(spark):
    scenarios = spark.createDataFrame([(1, "Actual", "Actual"), (2, "Budget", "Budget"), (7, "Forecast", "Forecast")], "scenario_id int, scenario_name string, scenario_type string")
    rows = [(1, d) for d in (20221231, 20230131, 20230228)] + [(2, d) for d in (20230131, 20230228, 20230331, 20240131)] + [(7, 20230331), (7, 20240131)]
    fact = spark.createDataFrame([(s, d, 1, Decimal(100 + k)) for k, (s, d) in enumerate(rows)], "scenario_id int, date_id int, budget_item_id int, amount_eur decimal(22,2)")
    versions = variance.validity(fact, scenarios)
    assert {(r.scenario_id, r.fiscal_year): (r.first_month, r.last_month, r.months, r.row_count) for r in versions.collect()} == {
        (1, None): (20221231, 20230228, 3, 3), (2, 2023): (20230131, 20230331, 3, 3), (2, 2024): (20240131, 20240131, 1, 1),
        (7, 2023): (20230331, 20230331, 1, 1), (7, 2024): (20240131, 20240131, 1, 1)}
    pairs = variance.version_pairs(versions, F.col("scenario_id") == 1, F.col("scenario_type") == "Budget")
    assert [tuple(r) for r in pairs.collect()] == [(1, 2, 2023, 20230131, 20230228)]  # 2024 has no actuals
    both = variance.version_pairs(versions, F.col("scenario_id") == 7, F.col("scenario_id") == 2)
    assert {tuple(r) for r in both.collect()} == {(7, 2, 2023, 20230331, 20230331), (7, 2, 2024, 20240131, 20240131)}
    items = budget_items(spark).where("parent_item_id IS NULL AND statement_type = 'PL'").limit(1).withColumns({"budget_item_id": F.lit(1), "is_subtotal": F.lit(False), "sign_convention": F.lit(1)})
    v = variance.fiscal_variance(fact, items, pairs).where("budget_item_id = 1").first()
    # the months both have: January and February, not December or March
    assert (v.fiscal_year, v.left_amount, v.right_amount) == (2023, Decimal("203.00"), Decimal("207.00"))
