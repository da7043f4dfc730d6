import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from plans import summarize  # noqa: E402

from ledgerloom.plans import all_jobs  # noqa: E402

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    return all_jobs()[key].build(spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_reports_never_rescan_the_order_tables(spark):
    for key in all_jobs():
        tables = set(re.findall(r"testdata/sf0\.001/(\w+)\.parquet", _plan(spark, key)))
        allowed = {"load_reconciliation": {"lineitem"}}.get(key, set())
        assert tables <= allowed, (key, tables)


def test_statement_plan_shape(spark):
    s = summarize(_plan(spark, "pl_statement"))
    assert s["ledger_scans"] == 1 and s["cols"] == "budget_item_id amount_eur"
    assert s["shuffle"] == 2 and s["smj"] == 0


def test_prior_period_is_single_pass(spark):
    for key in ["yoy", "mom", "opening_balance", "variance_waterfall"]:
        s = summarize(_plan(spark, key))
        assert s["ledger_scans"] == 1 and s["smj"] == 0, (key, s)


def test_samples_keep_a_few_rows_a_task(spark):
    plan = _plan(spark, "sample_topn")
    assert "WindowGroupLimit" in plan and summarize(plan)["ledger_scans"] <= 2  # the ledger and the rates


def test_measures_are_summed_before_they_are_unpivoted(spark):
    plan = _plan(spark, "fx_measure_select")
    assert plan.index("Expand") < plan.index("HashAggregate") and plan.count("Exchange") == 1
