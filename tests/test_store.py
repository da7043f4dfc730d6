import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import fx, statements, variance
from ledgerloom.sources import store
from ledgerloom.sources.dates import month_end_spine

SF = "/root/testdata/sf0.001"


def test_stored_model_is_memoized_and_rebuild_is_idempotent(spark):
    m1 = store.stored_model(spark, SF)
    assert store.stored_model(spark, SF) is m1
    n1 = m1.fact.count()
    sums1 = m1.fact.agg(F.sum("amount_eur"), F.sum("amount_nominal")).collect()[0]
    m2 = store.stored_model(spark, SF, rebuild=True)
    assert m2 is not m1
    assert m2.fact.count() == n1
    assert m2.fact.agg(F.sum("amount_eur"), F.sum("amount_nominal")).collect()[0] == sums1


def test_dimensions_are_stored_with_the_ledger(spark):
    m = store.stored_model(spark, SF)
    path = store.ledger_path(spark, SF)
    assert store.current(spark, path) is not None
    assert path.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    counts = {k: getattr(m, k).count() for k in ["dates", "channels", "segments", "products", "rates"]}
    month_ends = m.dates.filter(F.col("is_month_end")).count()
    assert counts["channels"] == 25 and counts["segments"] == 5
    assert counts["rates"] == 3 * month_ends and counts["dates"] >= 365
    # every fact month has a rate for its currency
    missing = m.fact.join(m.rates.select("rate_id"), "rate_id", "left_anti").count()
    assert missing == 0


def test_a_load_that_dies_leaves_the_committed_version(spark, monkeypatch):
    store.stored_model(spark, SF)
    path = store.ledger_path(spark, SF)
    before = store.current(spark, path)
    monkeypatch.setattr(store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.stored_model(spark, SF, rebuild=True)
    with pytest.raises(RuntimeError, match="lost"):
        store.reload(spark, SF, [(1, 1995)])
    assert store.current(spark, path) == before


def test_two_writers_commit_complete_versions(spark):
    path = store.ledger_path(spark, SF)
    first, second = store.load(spark, SF, path), store.load(spark, SF, path)
    assert store.current(spark, path) == second != first
    for at in (first, second):
        assert store.read_fact(spark, path, at).count() == store.stored_model(spark, SF).fact.count()


def test_a_taken_commit_number_is_refused(spark):
    path = store.ledger_path(spark, SF)
    store.stored_model(spark, SF)
    now = store.current(spark, path)
    with pytest.raises(store.ConcurrentCommit):
        store.commit(spark, path, now)
    assert store.current(spark, path) == now


def test_two_processes_that_load_at_once_agree(spark, tmp_path, monkeypatch):
    sf = copied(tmp_path)
    path, plain = store.ledger_path(spark, sf), store.commit

    def slower(spark_, path_, manifest):  # the other process commits first
        monkeypatch.setattr(store, "commit", plain)
        store.load(spark, sf)
        plain(spark_, path_, manifest)

    monkeypatch.setattr(store, "commit", slower)
    model = store.stored_model(spark, sf)
    now = store.current(spark, path)
    assert now.number == 0 and model.fact.count() == sum(p["rows"] for p in now.partitions.values())


def cents(manifest):
    return {k: (p["rows"], p["amount"]) for k, p in manifest.partitions.items()}


def copied(tmp_path, **changes):
    """The order tables of SF in a folder of their own, some of them changed by pandas functions."""
    for t in store.SOURCE_TABLES:
        rows = pd.read_parquet(f"{SF}/{t}.parquet")
        rows = changes[t](rows) if t in changes else rows
        pq.write_table(pa.Table.from_pandas(rows, schema=pq.read_schema(f"{SF}/{t}.parquet"), preserve_index=False), f"{tmp_path}/{t}.parquet")
    return str(tmp_path)


def test_reload_rewrites_one_scenario_year_and_twice_is_the_same(spark, tmp_path):
    sf = copied(tmp_path)
    path = store.ledger_path(spark, sf)
    before = store.load(spark, sf)
    once = store.reload(spark, sf, [(1, 1995)])
    again = store.reload(spark, sf, [(1, 1995)])
    for m in (once, again):
        changed = {k for k in m.partitions if m.partitions[k]["load"] != before.partitions[k]["load"]}
        assert changed == {"scenario_id=1/year=1995"} and cents(m) == cents(before)
    assert again.number == before.number + 2 and store.current(spark, path) == again
    # the older states are still whole until they are vacuumed
    assert store.read_fact(spark, path, before).count() == store.read_fact(spark, path, again).count()
    store.vacuum(spark, path)
    rows = store.stored_model(spark, sf).fact
    assert rows.count() == sum(p["rows"] for p in again.partitions.values())


def test_reload_takes_late_lines_and_what_depends_on_them(spark, tmp_path):
    sf = copied(tmp_path)
    before = store.load(spark, sf)
    late = pd.read_parquet(f"{sf}/lineitem.parquet")
    some = late[late.l_shipdate.dt.year == 1995].head(50).assign(l_linenumber=99)
    copied(tmp_path, lineitem=lambda x: pd.concat([x, some]))
    after = store.reload(spark, sf, [(1, 1995)], cascade=True)
    changed = {k for k in after.partitions if after.partitions[k]["load"] != before.partitions[k]["load"]}
    assert changed == {store._partition(s, y) for s, y in [(1, 1995), *store.dependents(1995)]}
    assert cents(after) == cents(store.load(spark, sf))  # the same as loading it all
    assert cents(after) != cents(before)


def test_reload_refuses_new_dimension_members_and_unknown_years(spark, tmp_path):
    sf = copied(tmp_path)
    with pytest.raises(RuntimeError, match="load it first"):
        store.reload(spark, sf, [(1, 1995)])
    store.load(spark, sf)
    with pytest.raises(RuntimeError, match="dimensions"):
        store.reload(spark, sf, [(1, 2050)])
    copied(tmp_path, part=lambda x: x.assign(p_brand=x.p_brand.where(x.index > 0, "A new brand")))
    with pytest.raises(RuntimeError, match="dimensions"):
        store.reload(spark, sf, [(1, 1995)])


def test_rejected_lines_have_their_reason(spark, tmp_path):
    plant = {"no_order": ("l_orderkey", 10**12), "no_part": ("l_partkey", 10**12), "no_supplier": ("l_suppkey", 10**12),
             "no_date": ("l_shipdate", pd.NaT), "no_amount": ("l_discount", None)}

    def lines(x):
        for k, (column, value) in enumerate(plant.values()):
            x.loc[x.index[k * 10:k * 10 + k + 1], column] = value
        return x

    part, order = pd.read_parquet(f"{SF}/lineitem.parquet")[["l_partkey", "l_orderkey"]].iloc[100]
    sf = copied(
        tmp_path, lineitem=lines, part=lambda x: x.assign(p_brand=[None if k == part else "NoNumber" if k % 7 == 0 else b for k, b in zip(x.p_partkey, x.p_brand)]),
        orders=lambda x: x.assign(o_custkey=x.o_custkey.where(x.o_orderkey != order, 10**12)))
    m = store.load(spark, sf)
    out = m.lines["outcomes"]
    assert m.lines["read"] == sum(out.values()) == len(pd.read_parquet(f"{sf}/lineitem.parquet"))
    assert {k: out[k] for k in plant} == {"no_order": 1, "no_part": 2, "no_supplier": 3, "no_date": 4, "no_amount": 5}
    assert out["no_brand"] > 0 and out["no_customer"] > 0
    staged = store.read_staged(spark, store.ledger_path(spark, sf), m.staged)
    kept = staged.where("rejected AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
    assert kept.agg(F.sum("lines")).first()[0] == sum(n for k, n in out.items() if k != "accepted")
    model = store.stored_model(spark, sf)
    assert model.fact.where("product_id IS NULL").count() == 0
    assert model.products.where("product_name = 'NoNumber'").count() == 1
    assert model.products.select("product_id").distinct().count() == model.products.count()


def test_versions_of_the_manifest_are_those_of_the_rows(spark):
    m = store.stored_model(spark, SF)
    key = lambda r: (r.scenario_id, r.fiscal_year or 0)
    assert sorted(m.versions.collect(), key=key) == sorted(variance.validity(m.fact, m.scenarios).collect(), key=key)


def test_doubled_keys_stop_the_load(spark, tmp_path):
    sf = copied(tmp_path, supplier=lambda x: pd.concat([x, x.head(1)]))
    with pytest.raises(RuntimeError, match="doubled keys"):
        store.load(spark, sf)
    assert store.current(spark, store.ledger_path(spark, sf)) is None


def test_missing_rates_are_carried_or_rejected(spark, tmp_path):
    sf = copied(tmp_path)
    full = store.stored_model(spark, SF).rates
    first = full.agg(F.min("date_id")).first()[0]
    gap = full.where(f"NOT (currency_id = 2 AND date_id BETWEEN 19960101 AND 19960831) AND NOT (currency_id = 3 AND date_id < {first + 10_000})")
    m = store.load(spark, sf, rates=gap.select(*full.columns))
    assert m.lines["outcomes"]["no_rate"] > 0 and sum(m.lines["outcomes"].values()) == m.lines["read"]
    model = store.stored_model(spark, sf)
    usd = model.fact.where("scenario_id = 1 AND currency_id = 2 AND year = 1996 AND month = 5")
    rate = full.where("currency_id = 2 AND date_id = 19951231").first().eom_rate
    assert usd.count() > 0 and usd.where(F.col("amount_nominal") != (F.col("amount_eur") * F.lit(rate)).cast("decimal(22,2)")).count() == 0
    asof = fx.rates_asof(month_end_spine(model.dates), model.rates)
    assert asof.where("currency_id = 2 AND rate_date <> date_id").count() == 8
    assert asof.where("currency_id = 2 AND date_id = 19960531").first().rate_date == 19951231


def test_a_rewrite_of_the_same_size_is_a_new_source(spark, tmp_path):
    for t in store.SOURCE_TABLES:
        (tmp_path / f"{t}.parquet").mkdir()
        (tmp_path / f"{t}.parquet" / "part-0").write_bytes(b"abc")
    a = store.source_key(spark, str(tmp_path))
    part = tmp_path / "part.parquet" / "part-0"
    part.write_bytes(b"xyz")
    os.utime(part, (1, 1))
    assert store.source_key(spark, str(tmp_path)) != a


def test_a_ledger_of_no_lines(spark, tmp_path):
    sf = copied(tmp_path, lineitem=lambda x: x.head(0))
    m = store.load(spark, sf)
    assert m.lines == {"read": 0, "outcomes": {}} and m.partitions == {}
    model = store.stored_model(spark, sf)
    assert model.fact.count() == 0 and model.versions.count() == 0 and model.dates.count() == 0
    assert statements.statement(model.fact, model.items, "PL", ["scenario_id"]).count() == 0
