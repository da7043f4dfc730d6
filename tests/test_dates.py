import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as fd
from ledgerloom.sources.dates import calendar, month_end_spine


def test_date_functions_on_fixture_dates(spark):
    days = [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2023, 2, 28), dt.date(2022, 12, 31),
            dt.date(1900, 3, 1), dt.date(2000, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    r = {x.d: x for x in df.select(
        "d", fd.date_key("d").alias("key"), fd.is_month_end("d").alias("me"),
        fd.days_in_month("d").alias("dim"), fd.days_in_year("d").alias("diy"),
        fd.quarter_name("d").alias("qn"), fd.month_name("d").alias("mn"),
        fd.month_name_short("d").alias("ms"),
        fd.shift_month_end(fd.date_key("d"), -12).alias("py")).collect()}
    assert r[dt.date(2024, 2, 29)].key == 20240229 and r[dt.date(2024, 2, 29)].me
    assert not r[dt.date(2024, 2, 28)].me and r[dt.date(2023, 2, 28)].me
    assert r[dt.date(2024, 2, 28)].dim == 29 and r[dt.date(2023, 2, 28)].dim == 28
    assert r[dt.date(1900, 3, 1)].diy == 365 and r[dt.date(2000, 3, 1)].diy == 366
    assert r[dt.date(2024, 2, 29)].diy == 366 and r[dt.date(2023, 2, 28)].diy == 365
    assert r[dt.date(2022, 12, 31)].qn == "Q4" and r[dt.date(2022, 12, 31)].mn == "December"
    assert r[dt.date(2022, 12, 31)].ms == "Dec"
    assert r[dt.date(2024, 2, 29)].py == 20230228  # 2024-02-29 -> 2023-02-28


def test_reference_calendar_shape(spark):
    cal = calendar(spark, "2022-01-01", "2026-12-31")
    assert cal.count() == 1826
    me = month_end_spine(cal)
    assert me.count() == 60
    assert cal.filter(F.col("year") == 2024).count() == 366
    assert cal.select(F.min("date_id"), F.max("date_id")).collect()[0] == (20220101, 20261231)


def test_calendar_spans_are_bounded(spark):
    assert calendar(spark, "2023-12-30", "2025-01-02").count() == 2 + 366 + 2
    assert calendar(spark, "2024-05-05", "2024-05-05").count() == 1
    with pytest.raises(Exception, match="500 years"):
        calendar(spark, "1600-01-01", "2099-12-31").count()
