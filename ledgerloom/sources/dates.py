"""Calendar (``dim_date``) and month-end spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as fd


CALENDAR_SCHEMA = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("quarter_name", T.StringType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("month_name_short", T.StringType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("is_month_end", T.BooleanType(), False),
    T.StructField("days_in_month", T.IntegerType(), False),
    T.StructField("days_in_year", T.IntegerType(), False),
])


#: Years that a calendar may span; a wider one is refused (a wrong date among the sources, most likely).
MAX_YEARS = 400


def _calendar_from_bounds(bounds: DataFrame, start: Column, end: Column, max_years: int = MAX_YEARS) -> DataFrame:
    """Days from ``start`` to ``end``: first the years, dealt over tasks, then each year's days."""
    span = F.year(end) - F.year(start) + 1
    checked = F.when(span > max_years, F.raise_error(F.concat(F.lit("calendar of "), span.cast("string"), F.lit(f" years, {max_years} allowed"))).cast("int")).otherwise(F.year(end))
    years = bounds.select(start.alias("lo"), end.alias("hi"), F.explode(F.sequence(F.year(start), checked)).alias("y")).repartition("y")
    first = F.greatest("lo", F.make_date("y", F.lit(1), F.lit(1)))
    last = F.least("hi", F.make_date("y", F.lit(12), F.lit(31)))
    days = years.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("d"))
    return days.select(
        fd.date_key("d").alias("date_id"),
        F.col("d").alias("full_date"),
        F.year("d").alias("year"),
        F.quarter("d").alias("quarter"),
        fd.quarter_name("d").alias("quarter_name"),
        F.month("d").alias("month"),
        fd.month_name("d").alias("month_name"),
        fd.month_name_short("d").alias("month_name_short"),
        F.dayofmonth("d").alias("day"),
        fd.is_month_end("d").alias("is_month_end"),
        fd.days_in_month("d").alias("days_in_month"),
        fd.days_in_year("d").alias("days_in_year"),
    )


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both bounds inclusive."""
    one = spark.range(1)
    return _calendar_from_bounds(one, F.to_date(F.lit(start)), F.to_date(F.lit(end)))


def calendar_for_bounds(bounds: DataFrame) -> DataFrame:
    """Whole calendar years from year(lo) to year(hi) of a one-row (lo, hi) DataFrame."""
    return _calendar_from_bounds(bounds, F.trunc("lo", "year"),
                                 F.make_date(F.year("hi"), F.lit(12), F.lit(31)))


def month_end_spine(cal: DataFrame) -> DataFrame:
    return cal.filter(F.col("is_month_end"))
