import hashlib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as fd
from ledgerloom.operators import planning, statements
from ledgerloom.sources import fixed
from reference_model import reference_model


def test_coverage_matrix_counts(spark):
    cov = planning.coverage_matrix(spark)
    assert cov.count() == 595
    assert cov.distinct().count() == 595
    by_cur = {r.currency_id: r["count"] for r in cov.groupBy("currency_id").count().collect()}
    assert by_cur == {1: 333, 2: 209, 3: 53}


# golden values (SURVEY §5, noise off, rows cast to DECIMAL(22,2)): (scenario, year) -> (PBT, NI)
GOLDEN = {
    (1, 2024): (Decimal("5068211445.42"), Decimal("4173821190.21")),
    (4, 2025): (Decimal("6252108187.71"), Decimal("5389748437.71")),
    (7, 2025): (Decimal("5534717271.42"), Decimal("4558002458.73")),
}


def test_closed_form_profit(spark):
    blocks = [b for b in fixed.PLAN_BLOCKS if (b[0], b[1]) in GOLDEN]
    m = reference_model(spark, seed=None, blocks=blocks)
    fact = m.fact.withColumn("year", fd.year_of("date_id"))
    assert fact.count() == 221340 * len(blocks)
    lines = statements.statement(fact, m.items, "PL", ["scenario_id", "year"])
    got = {(r.scenario_id, r.year, r.budget_item_id): r.signed
           for r in lines.filter(F.col("budget_item_id").isin(19, 21)).collect()}
    for (s, y), (pbt, ni) in GOLDEN.items():
        assert got[(s, y, 19)] == pbt
        assert got[(s, y, 21)] == ni


def test_noise_is_repeatable_and_nominal_exact(spark):
    blocks = [fixed.PLAN_BLOCKS[0]]
    a = reference_model(spark, seed=7, blocks=blocks).fact
    b = reference_model(spark, seed=7, blocks=blocks).fact
    keys = ["date_id", "channel_id", "segment_id", "product_id", "currency_id", "budget_item_id"]
    assert a.exceptAll(b).count() == 0
    assert a.filter(F.col("amount_eur") < 0).count() == 0
    eur = a.filter(F.col("currency_id") == 1)
    assert eur.filter(F.col("amount_eur") != F.col("amount_nominal")).count() == 0
    assert a.select(*keys).distinct().count() == 221340


GOLDEN_ALL = {
    (1, 2022): ("4188604500.00", "3449439000.00"),
    (1, 2023): ("4607464950.03", "3794382900.00"),
    (1, 2024): ("5068211445.42", "4173821190.21"),
    (1, 2025): ("5570843985.42", "4587753870.21"),
    (2, 2023): ("5001686550.00", "4311798750.00"),
    (3, 2024): ("5601888935.91", "4829214600.00"),
    (4, 2025): ("6252108187.71", "5389748437.71"),
    (5, 2026): ("6902327439.09", "5950282275.00"),
    (6, 2026): ("6402158784.09", "5519102400.00"),
    (7, 2025): ("5534717271.42", "4558002458.73"),
    (8, 2026): ("6602226246.21", "5691574350.21"),
}


def test_full_model_counts_and_golden_totals(spark):
    m = reference_model(spark, seed=None)
    fact = m.fact.withColumn("year", fd.year_of("date_id"))
    by_scenario = {r.scenario_id: r["count"] for r in fact.groupBy("scenario_id").count().collect()}
    assert sum(by_scenario.values()) == 2434740
    assert by_scenario[1] == 885360 and all(by_scenario[s] == 221340 for s in range(2, 9))
    by_cur = {r.currency_id: r["count"] for r in fact.groupBy("currency_id").count().collect()}
    assert by_cur == {1: 1362636, 2: 855228, 3: 216876}
    lines = statements.statement(fact, m.items, "PL", ["scenario_id", "year"])
    got = {(r.scenario_id, r.year, r.budget_item_id): r.signed
           for r in lines.filter(F.col("budget_item_id").isin(19, 21)).collect()}
    for (s, y), (pbt, ni) in GOLDEN_ALL.items():
        assert got[(s, y, 19)] == Decimal(pbt), (s, y)
        assert got[(s, y, 21)] == Decimal(ni), (s, y)


def test_reference_validation_queries(spark):
    from ledgerloom.operators import checks, counts

    m = reference_model(spark, seed=11)
    got = {r.tbl: r.row_count for r in counts.table_counts(m.tables()).collect()}
    assert got == {"dim_date": 1826, "dim_channel": 14, "dim_segment": 5, "dim_product": 17,
                   "dim_currency": 180, "dim_scenario": 8, "dim_budget_items": 43,
                   "fact_financial_data": 2434740}
    eur = checks.eur_identity(m.fact, m.rates).collect()[0]
    assert eur.rows_checked == 1362636 and eur.violations == 0
    nom = checks.nominal_recon(m.fact, m.rates).collect()[0]
    assert nom.rows_checked == 855228 + 216876 and nom.violations == 0
    assert m.fact.filter(F.col("amount_eur") < 0).count() == 0


def test_drivers_apply_to_given_amounts(spark):
    base = spark.createDataFrame([(20230331, 1, 3, 1, 2, 2, Decimal("100.00")), (20230331, 2, 1, 1, 1, 2, Decimal("100.00"))],
                                 "date_id int, channel_id int, segment_id int, product_id int, currency_id int, budget_item_id int, amount_eur decimal(22,2)")
    channels = spark.createDataFrame([(1, "City Flagship", "Branch"), (2, "Side Street", "Branch")], "channel_id int, channel_name string, channel_type string")
    items = spark.createDataFrame([(2, "Asset")], "budget_item_id int, category string")
    got = {r.channel_id: r for r in planning.driven_plan(base, channels, items, "none").collect()}
    assert got[1].date_id == 20240331
    assert got[1].amount_eur == Decimal("480.00")  # 100 x 3.0 (flagship) x 4.0 x 0.40
    assert got[2].amount_eur == Decimal("200.00")  # 100 x 2.0 (other branch) x 1.0 x 1.00
    assert got[1].daily_avg_eur == Decimal("451.20")


def _plain_apportion(shares, target):
    """Cents by largest remainder, ties by md5 of the key and the key."""
    cents = {k: int(v * 100) for k, v in shares.items()}
    left = int(target * 100) - sum(cents.values())
    order = sorted(shares, key=lambda k: (-(shares[k] * 100 - cents[k]), hashlib.md5(str(k).encode()).hexdigest(), k))
    return {k: Decimal(cents[k] + (k in order[:left])) / 100 for k in shares}


def test_apportioned_rows_add_up_to_the_target(spark):
    r = random.Random(3)
    groups = {1: {k: Decimal(r.randrange(0, 10**7)) / 10**4 for k in range(700)},
              2: {k: Decimal("0.005") for k in range(300)},  # all tied
              3: {k: Decimal(r.randrange(0, 3)) / 3 for k in range(50)} | {99: Decimal("0.00")},
              4: {k: Decimal(k) for k in range(5)}}  # no cent left
    groups = {g: {k: v.quantize(Decimal("0.0001")) for k, v in rows.items()} for g, rows in groups.items()}
    target = {g: sum(rows.values()).quantize(Decimal("0.01")) for g, rows in groups.items()}
    target[2] += Decimal("0.37")
    rows = spark.createDataFrame([(g, k, v) for g, rows in groups.items() for k, v in rows.items()] + [(9, 1, Decimal(1))], "g int, k int, share decimal(20,4)")
    targets = spark.createDataFrame(list(target.items()), "g int, target decimal(20,2)")
    got = {(x.g, x.k): x.amount_eur for x in planning.apportion(rows.repartition(5), ["g"], ["k"], "share", targets).collect()}
    assert got == {(g, k): v for g in groups for k, v in _plain_apportion(groups[g], target[g]).items()}
    assert all(sum(v for (h, _), v in got.items() if h == g) == target[g] for g in groups)


def test_targets_out_of_reach_are_refused(spark):
    rows = spark.createDataFrame([(1, 1, Decimal("0.5"))], "g int, k int, share decimal(20,4)")
    for t in ("0.52", "0.49"):
        with pytest.raises(Exception, match="out of reach"):
            planning.apportion(rows, ["g"], ["k"], "share", spark.createDataFrame([(1, Decimal(t))], "g int, target decimal(20,2)")).collect()
    assert planning.apportion(rows.limit(0), ["g"], ["k"], "share", spark.createDataFrame([(1, Decimal("0.5"))], "g int, target decimal(20,2)")).count() == 0


def test_growth_differs_by_scenario_and_year(spark):
    base = spark.createDataFrame([(20221231, 1, Decimal("100.00")), (20231231, 1, Decimal("100.00"))], "date_id int, k int, amount_eur decimal(22,2)")
    factors = spark.createDataFrame([(5, 2023, Decimal("1.10")), (5, 2024, Decimal("1.20")), (6, 2024, Decimal("0.90"))], "scenario_id int, year int, factor decimal(5,4)")
    got = {(r.scenario_id, r.year): r.amount_eur for r in planning.growth_plan(base, factors, ["k"]).collect()}
    assert got == {(5, 2023): Decimal("110.00"), (5, 2024): Decimal("120.00"), (6, 2024): Decimal("90.00")}
