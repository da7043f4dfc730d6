import re

import pytest
from pyspark.sql import functions as F
from test_store import SF, cents, copied

from ledgerloom.sources import buckets, store, tpch


@pytest.fixture
def shuffled(spark):
    """Joins as at scale: nothing is small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(lines):
    plan = lines._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_buckets_save_the_shuffles_of_lines_and_orders(spark, tmp_path, shuffled):
    sf = copied(tmp_path)
    dims = tpch.source_dims(spark, sf)
    plain = exchanges(tpch.classified_lines(spark, sf, dims))
    assert buckets.layout(spark, sf) is None
    found = buckets.prepare(spark, sf, 5)
    bucketed = tpch.classified_lines(spark, sf, dims, sources=found.read(spark))
    assert {"l_orderkey", "o_orderkey", "o_custkey", "c_custkey"} <= set(plain)
    # what is left: lines by part and by supplier, with these (and nations with regions)
    left = exchanges(bucketed)
    assert not {"l_orderkey", "o_orderkey", "o_custkey", "c_custkey"} & set(left)
    assert sorted(k for k in left if k.startswith("l_")) == ["l_partkey", "l_suppkey"]


def test_a_load_from_buckets_is_the_same_ledger(spark, tmp_path, shuffled):
    sf = copied(tmp_path)
    plain = store.load(spark, sf)
    found = buckets.prepare(spark, sf, 5)
    assert found.read(spark)[0].count() == plain.lines["read"]
    loaded = store.load(spark, sf)
    assert cents(loaded) == cents(plain) and loaded.lines == plain.lines
    assert cents(store.reload(spark, sf, [(1, 1995)], cascade=True)) == cents(plain)


def test_a_stale_layout_is_not_used(spark, tmp_path):
    sf = copied(tmp_path)
    buckets.prepare(spark, sf, 3)
    copied(tmp_path, lineitem=lambda x: x.head(1000))
    assert buckets.layout(spark, sf) is None
    assert store.load(spark, sf).lines["read"] == 1000


def test_missing_partners_have_the_same_reasons(spark, tmp_path, shuffled):
    sf = copied(tmp_path, orders=lambda x: x.assign(o_custkey=x.o_custkey.where(x.index % 50 > 0, 10**12)).iloc[5:])
    want = store.load(spark, sf).lines
    buckets.prepare(spark, sf, 4)
    assert store.load(spark, sf).lines == want
    assert want["outcomes"]["no_order"] > 0 and want["outcomes"]["no_customer"] > 0
    kept = buckets.layout(spark, sf).read(spark)[1]
    assert kept.where(~F.col("has_customer")).count() > 0
