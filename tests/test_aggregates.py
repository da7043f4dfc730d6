import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import aggregates, store

SF = "/root/testdata/sf0.001"


def test_requests_go_to_the_smallest_aggregate():
    a = [aggregates.Aggregate(("x", "y", "z"), 100, "xyz"), aggregates.Aggregate(("x", "y"), 20, "xy"), aggregates.Aggregate(("y",), 3, "y")]
    assert aggregates.route(a, {"y"}).path == "y" and aggregates.route(a, {"x"}).path == "xy"
    assert aggregates.route(a, {"z"}).path == "xyz" and aggregates.route(a, set()).path == "y" and aggregates.route(a, {"w"}) is None


@pytest.mark.parametrize("by", [["scenario_id"], ["year", "channel_type"], ["region", "segment_name", "product_category"], ["month", "currency_id"],
                                ["category", "year"], ["channel_id", "budget_item_id"], ["channel_type", "channel_name"]])
def test_sums_equal_those_of_the_ledger(spark, by):
    m = store.stored_model(spark, SF)
    got = aggregates.current_sums(spark, SF, by)
    wide = m.fact
    for dim, key in ((m.channels.drop("country"), "channel_id"), (m.segments, "segment_id"), (m.products, "product_id"), (m.items, "budget_item_id")):
        wide = wide.join(dim, key)
    want = wide.groupBy(*by).agg(F.sum("amount_eur").alias("amount_eur"), F.sum("daily_avg_eur").alias("daily_avg_eur"))
    key = lambda r: [str(v) for v in r]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_stale_aggregates_are_refused(spark):
    aggregates.current_sums(spark, SF, ["year"])
    before = aggregates.sums(spark, SF, ["year"]).collect()
    store.reload(spark, SF, [(1, 1996)])
    with pytest.raises(aggregates.StaleAggregates):
        aggregates.sums(spark, SF, ["year"])
    assert sorted(aggregates.current_sums(spark, SF, ["year"]).collect()) == sorted(before)
    store.vacuum(spark, store.ledger_path(spark, SF))
    assert sorted(aggregates.sums(spark, SF, ["year"]).collect()) == sorted(before)


def test_a_build_that_dies_publishes_nothing(spark, monkeypatch):
    store.reload(spark, SF, [(1, 1996)])
    monkeypatch.setattr(aggregates, "_summed", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        aggregates.build(spark, SF)
    with pytest.raises(aggregates.StaleAggregates):
        aggregates.lattice(spark, SF)


def test_nominal_needs_its_currency_and_names_must_be_known(spark):
    with pytest.raises(ValueError, match="currencies"):
        aggregates.current_sums(spark, SF, ["year"], ["amount_nominal"])
    with pytest.raises(ValueError, match="unknown"):
        aggregates.current_sums(spark, SF, ["colour"])
    m = store.stored_model(spark, SF)
    got = {r.currency_id: r.amount_nominal for r in aggregates.current_sums(spark, SF, ["currency_id"], ["amount_nominal"]).collect()}
    assert got == {r.currency_id: r.s for r in m.fact.groupBy("currency_id").agg(F.sum("amount_nominal").alias("s")).collect()}
