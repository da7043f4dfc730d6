"""What the load moves: lines as narrow rows, actuals before they fan out; the ledger stays the same to the cent."""

import re

import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_store import SF, cents, copied

from ledgerloom.sources import store, tpch

KEYS = {"month": (0, 0), "a": (0, 5), "b": (1, 30)}


@pytest.mark.parametrize("keys", [KEYS, KEYS | {"b": (-3, 30)}, KEYS | {"b": (0, 2**40)}])
def test_packed_keys_come_back(spark, keys):
    rows = spark.createDataFrame([(m, a, b) for m in (-5, 0, 23_988, 119_999) for a in (None, 0, 5) for b in (None, 0, 1, 30)], "month int, a int, b int")
    code = rows.select("*", tpch.packed(keys).alias("code"))
    assert (dict(code.dtypes)["code"] == "bigint") == (keys == KEYS)
    back = code.select("month", "a", "b", *[v.alias(f"{k}_") for k, v in tpch.unpacked(F.col("code"), keys).items()]).collect()
    assert len(back) == 48 and all((r.month, r.a, r.b) == (r.month_, r.a_, r.b_) for r in back)


def odd(x):
    """Line numbers and amounts that don't fit the narrow columns, some on lines that are rejected."""
    for k, number in enumerate([0, 62, 63, 64, -1, 2**31 - 1, 1_000]):
        x.loc[x.index[k], "l_linenumber"] = number
    for k, price in enumerate([999_999.99, 1_000_000, 25_000_000_000.01, -1_000_000, -5.5]):
        x.loc[x.index[k:20:5], "l_extendedprice"] = price
    x.loc[x.index[:20], "l_discount"] = 0.0
    x.loc[x.index[1:20:3], "l_suppkey"] = 10**12
    return x


def test_odd_lines_are_the_same_by_lookups_and_by_shuffles(spark, tmp_path, monkeypatch):
    sf = copied(tmp_path, lineitem=odd)
    by_lookup = store.load(spark, sf)
    monkeypatch.setattr(tpch, "LOOKUP_ROWS", 0)
    by_shuffle = store.load(spark, sf)
    monkeypatch.setattr(tpch, "_packs", lambda keys: False)
    apart = store.load(spark, sf)
    assert cents(by_lookup) == cents(by_shuffle) == cents(apart) and by_lookup.lines == by_shuffle.lines == apart.lines
    lines = pd.read_parquet(f"{sf}/lineitem.parquet")
    gone = lines[lines.l_suppkey == 10**12]
    for m in (by_lookup, by_shuffle, apart):
        staged = store.read_staged(spark, store.ledger_path(spark, sf), m.staged)
        kept = staged.where("rejected").select("l_orderkey", "l_linenumber", F.col("amount_eur").cast("double")).collect()
        want = gone.groupby(["l_orderkey", "l_linenumber"]).l_extendedprice.sum()
        assert sorted(map(tuple, kept)) == [(*k, pytest.approx(v)) for k, v in want.items()]
        total = staged.agg(F.sum("amount_eur")).first()[0]
        assert float(total) == pytest.approx((lines.l_extendedprice * (1 - lines.l_discount)).sum(), abs=300)  # cents are rounded a line


def test_actuals_are_dealt_out_before_they_fan_out(spark, monkeypatch):
    plans, write = {}, DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        plans[path] = self._df._jdf.queryExecution().executedPlan().toString()
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    store.load(spark, SF)
    fact = next(p for path, p in plans.items() if "/fact/load=" in path)
    assert "Generate" in fact and fact.index("Generate") < re.search(r"(?<!Broadcast)Exchange ", fact).start()
    # the aggregation's grain is one number
    staged = next(p for path, p in plans.items() if "/staged/" in path)
    assert "Exchange hashpartitioning(grain#" in staged
