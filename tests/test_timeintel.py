from decimal import Decimal

from ledgerloom.operators import timeintel


def _series(spark, months):
    rows = [(1, d, Decimal(v)) for d, v in months]
    return timeintel.with_periods(spark.createDataFrame(rows, "k int, date_id int, value decimal(38,2)"))


def test_ytd_december_equals_full_year(spark):
    months = [(20230131 + 0, "1.00")] + [(d, "2.00") for d in (20230228, 20230331, 20231231)]
    s = _series(spark, months)
    ytd = {r.date_id: r.ytd for r in timeintel.to_date(s, ["k"]).collect()}
    total = timeintel.period_total(s, ["k"]).collect()[0].total
    assert ytd[20231231] == total == Decimal("7.00")


def test_rolling_requires_complete_window_and_prior_handles_gaps(spark):
    s = _series(spark, [(20230131, "1.00"), (20230228, "1.00"), (20230430, "1.00"), (20240430, "5.00")])
    r = {x.date_id: x for x in timeintel.rolling(s, ["k"], 3).collect()}
    assert r[20230430].months_covered == 2 and r[20230430].rolling_3 is None
    p = {x.date_id: x.prior for x in timeintel.prior(s, ["k"], 12).collect()}
    assert p[20240430] == Decimal("1.00") and p[20230228] is None


def test_densify_fills_missing_months(spark):
    s = _series(spark, [(20230131, "1.00"), (20230331, "3.00")])
    me = spark.createDataFrame([(20230131,), (20230228,), (20230331,)], "date_id int")
    d = {r.date_id: r for r in timeintel.densify(s, ["k"], me).collect()}
    assert d[20230228].value == Decimal("0.00") and d[20230228].filled
    assert not d[20230131].filled


def test_opening_balance_is_prior_year_closing_and_null_after_a_gap(spark):
    rows = [(1, 20210630, Decimal("5.00")), (1, 20211231, Decimal("7.00")),
            (1, 20220331, Decimal("9.00")), (1, 20240131, Decimal("4.00"))]
    s = timeintel.with_periods(spark.createDataFrame(rows, "k int, date_id int, value decimal(38,2)"))
    o = {r.year: r for r in timeintel.opening(timeintel.closing(s, ["k"], ["k"]), ["k"]).collect()}
    assert o[2021].closing == Decimal("7.00") and o[2021].opening is None
    assert o[2022].opening == Decimal("7.00") and o[2022].closing_date_id == 20220331
    assert o[2024].opening is None  # 2023 absent: no carried-over balance from 2022


def test_a_book_closes_on_one_date(spark):
    rows = [(1, 1, 20231130, Decimal("40.00")), (1, 1, 20231231, Decimal("50.00")), (1, 2, 20231130, Decimal("7.00"))]
    s = timeintel.with_periods(spark.createDataFrame(rows, "scenario_id int, channel_id int, date_id int, value decimal(38,2)"))
    got = {(r.channel_id, r.closing_date_id): r.closing for r in timeintel.closing(s, ["scenario_id", "channel_id"], ["scenario_id"]).collect()}
    assert got == {(1, 20231231): Decimal("50.00")}  # channel 2 had nothing left at the year's close


def test_averages_count_missing_months_of_the_book_as_zero(spark):
    rows = [(1, 1, 20230131, Decimal("10.00")), (1, 1, 20230228, Decimal("20.00")), (1, 2, 20230228, Decimal("6.00")), (2, 1, 20230228, Decimal("8.00"))]
    s = timeintel.with_periods(spark.createDataFrame(rows, "scenario_id int, channel_id int, date_id int, value decimal(38,2)"))
    got = {(r.scenario_id, r.channel_id): (r.months, r.avg_value) for r in timeintel.average(s, ["scenario_id", "channel_id"], ["value"], ["scenario_id"]).collect()}
    assert got == {(1, 1): (2, 15.0), (1, 2): (2, 3.0), (2, 1): (1, 8.0)}
