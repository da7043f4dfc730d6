"""Time intelligence over monthly series keyed by (keys..., date_id).

Months are addressed by a month index (year*12 + month - 1), so prior-period
lookups are equi-joins on a shifted index (robust to gaps) and trailing
windows are RANGE frames on the index.  Every window is partitioned by the
report keys; none is global.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions.numeric import MONEY_SUM, safe_ratio


def with_periods(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": fd.year_of("date_id"), "quarter": fd.quarter_of("date_id"),
                           "month": fd.month_of("date_id"), "month_idx": fd.month_index("date_id")})


def to_date(df: DataFrame, keys: list[str], grain: str = "year", value: str = "value",
            out: str | None = None) -> DataFrame:
    """Running total from the first month of the year (grain='year') or quarter ('quarter')."""
    part = keys + (["year"] if grain == "year" else ["year", "quarter"])
    w = Window.partitionBy(*part).orderBy("month_idx").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out or ("ytd" if grain == "year" else "qtd"), F.sum(value).over(w).cast(MONEY_SUM))


def prior(df: DataFrame, keys: list[str], months: int, value: str = "value", out: str = "prior") -> DataFrame:
    """Attach the value exactly ``months`` earlier (NULL if that month is absent).

    A RANGE frame fixed at [-months, -months] on the month index selects that one
    row inside the same window pass — no self-join, no second scan, and gaps in
    the series give NULL rather than a wrong neighbour.
    """
    w = Window.partitionBy(*keys).orderBy("month_idx").rangeBetween(-months, -months)
    return df.withColumn(out, F.first(value).over(w))


def change(df: DataFrame, value: str = "value", base: str = "prior") -> DataFrame:
    d = (F.col(value) - F.col(base)).cast(MONEY_SUM)
    return df.withColumn("change", d).withColumn("change_pct", safe_ratio(d, F.abs(F.col(base))))


def rolling(df: DataFrame, keys: list[str], n: int, value: str = "value") -> DataFrame:
    """Trailing n-month sum on the month index; NULL unless all n months are present."""
    w = Window.partitionBy(*keys).orderBy("month_idx").rangeBetween(-(n - 1), 0)
    cnt = F.count(F.lit(1)).over(w)
    return (df.withColumn("months_covered", cnt)
            .withColumn(f"rolling_{n}", F.when(cnt == n, F.sum(value).over(w)).cast(MONEY_SUM)))


def period_total(df: DataFrame, keys: list[str], grain: str = "year", value: str = "value") -> DataFrame:
    part = keys + (["year"] if grain == "year" else ["year", "quarter"])
    return df.groupBy(*part).agg(F.sum(value).cast(MONEY_SUM).alias("total"),
                                 F.count(F.lit(1)).alias("months"))


def closing(df: DataFrame, keys: list[str], book_keys: list[str], value: str = "value") -> DataFrame:
    """Semi-additive: every key's value at the closing month-end of its book and year.

    ``book_keys`` (a subset of ``keys``, e.g. the scenario) name the book that closes on one
    date: its last month-end with data.  A key without a value in that month has no row, so
    the closing values of a book add up to its balance on that date.
    """
    w = Window.partitionBy(*book_keys, "year")
    return (df.withColumn("closing_date_id", F.max("date_id").over(w))
            .filter(F.col("date_id") == F.col("closing_date_id"))
            .select(*keys, "year", "closing_date_id", F.col(value).alias("closing")))


def opening(closing_df: DataFrame, keys: list[str]) -> DataFrame:
    """Opening balance = closing balance of the previous year (NULL if that year is absent).

    The previous row of the per-key year series is taken with ``lag`` and kept
    only when it is exactly the prior year, so a gap yields NULL.
    """
    w = Window.partitionBy(*keys).orderBy("year")
    prev_year = F.lag("year").over(w)
    return closing_df.withColumn("opening", F.when(prev_year == F.col("year") - 1, F.lag("closing").over(w)))


def average(df: DataFrame, keys: list[str], cols: list[str], book_keys: list[str]) -> DataFrame:
    """Mean of month-end values per year, over the months that the whole book (``book_keys``) has in the year.

    ``df`` has a row for each key and month with a value; a month of the book in which a key has none counts as
    zero, so averages of the keys add up to the average of the book.
    """
    months = df.groupBy(*book_keys, "year").agg(F.count_distinct("date_id").alias("months"))
    sums = df.groupBy(*keys, "year").agg(*[F.sum(c).cast("double").alias(f"_{c}") for c in cols])
    return sums.join(months, [*book_keys, "year"]).select(*keys, "year", "months", *[F.round(F.col(f"_{c}") / F.col("months"), 6).alias(f"avg_{c}") for c in cols])


def per_day(df: DataFrame, value: str = "value") -> DataFrame:
    """Flow per day of the month and annualised by the days of the year."""
    dim = (F.col("date_id") % 100).cast("int")  # month-end day = days in month
    y = F.col("year")
    diy = F.when((y % 400 == 0) | ((y % 4 == 0) & (y % 100 != 0)), F.lit(366)).otherwise(F.lit(365))
    pd_ = F.col(value).cast("double") / dim
    return df.select("*", dim.alias("days_in_month"), diy.alias("days_in_year"),
                     F.round(pd_, 6).alias("per_day"), F.round(pd_ * diy, 6).alias("annualised"))


def densify(df: DataFrame, keys: list[str], month_ends: DataFrame, value: str = "value") -> DataFrame:
    """Fill missing (keys, month) cells with 0, reading ``df`` (one row per key and month) once.

    The months and values of a key become one map (at most one entry per calendar month), and
    each key is then unfolded over the month spine, so no second aggregate and no join back is needed.
    """
    have = df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("date_id", value))).alias("have"))
    spine = month_ends.agg(F.array_sort(F.collect_list("date_id")).alias("spine"))  # one row
    full = have.crossJoin(F.broadcast(spine)).select(*keys, "have", F.explode("spine").alias("date_id"))
    found = F.try_element_at(F.col("have"), F.col("date_id"))
    return full.select(*keys, "date_id", F.coalesce(found, F.lit(0).cast(MONEY_SUM)).cast(MONEY_SUM).alias(value),
                       found.isNull().alias("filled"))
