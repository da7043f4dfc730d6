"""FX: rate table, nominal amounts, restatement, cross rates and FX effect.

Quote convention: a rate is foreign units per 1 EUR; EUR rows carry 1.000000.
The rate table has (month-end x currency) grain: its size is bounded by the
calendar span times the number of currencies, never by the fact, so it is
always broadcast.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as fd
from ..functions.numeric import MONEY_SUM, MONEY_WIDE, RATE, dec, money, seeded_draw
from ..sources import fixed
from .counts import check_additive

RATES_SCHEMA = T.StructType([
    T.StructField("rate_id", T.StringType(), False),
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("currency_id", T.IntegerType(), False),
    T.StructField("currency_code", T.StringType(), False),
    T.StructField("currency_name", T.StringType(), False),
    T.StructField("currency_symbol", T.StringType(), False),
    T.StructField("eom_rate", T.DecimalType(10, 6), False),
    T.StructField("daily_avg_rate", T.DecimalType(10, 6), False),
])


def currencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.CURRENCIES, "currency_id int, currency_code string, "
                                                   "currency_name string, currency_symbol string")


def bands(spark: SparkSession) -> DataFrame:
    """(currency_id, band_year, centre, modulus, half) — half = modulus / 20000."""
    rows = [(c, y, centre, m, Decimal(m // 2) / Decimal(10000)) for c, y, centre, m in fixed.FX_BANDS]
    return spark.createDataFrame(rows, "currency_id int, band_year int, centre decimal(5,4), "
                                       "modulus int, half decimal(5,4)")


def band_year(year_col):
    """Year of the band table used for a calendar year: the five band years repeat."""
    return (F.lit(fixed.FX_FIRST_BAND_YEAR)
            + F.pmod(year_col - F.lit(fixed.FX_FIRST_BAND_YEAR), F.lit(fixed.FX_BAND_YEARS))).cast("int")


def rate_id(date_id="date_id", currency_id="currency_id"):
    """``CONCAT(date_id, currency_id)`` — the computed key of the rate table."""
    c = (lambda x: F.col(x) if isinstance(x, str) else x)
    return F.concat(c(date_id).cast("string"), c(currency_id).cast("string"))


def rate_table(month_ends: DataFrame, band_df: DataFrame, seed: int) -> DataFrame:
    """Rates per (month-end, currency): EUR at 1, USD/GBP = centre + draw/10000 - half.

    ``month_ends`` needs a ``date_id`` column.  The eom and daily-average draws
    are independent (different seed tags), as in the source model.
    """
    spark = month_ends.sparkSession
    cur = F.broadcast(currencies(spark))
    me = month_ends.select("date_id").distinct()
    grid = me.crossJoin(cur)  # months x 3 currencies, both sides bounded

    def draw(tag):
        return seeded_draw(seed, F.lit(tag), "date_id", "currency_id", modulus=F.col("modulus"))

    b = F.broadcast(band_df.withColumnRenamed("currency_id", "band_currency_id"))
    grid = grid.withColumn("band_year_key", band_year(fd.year_of("date_id")))
    with_band = grid.join(b, (F.col("currency_id") == F.col("band_currency_id"))
                          & (F.col("band_year_key") == F.col("band_year")), "left")

    def rate(tag):
        v = (F.col("centre") + draw(tag).cast("decimal(10,0)") * dec("0.0001", 5, 4) - F.col("half"))
        return F.when(F.col("currency_id") == 1, dec("1.000000", 10, 6)).otherwise(v).cast(RATE)

    return with_band.select(
        rate_id("date_id", "currency_id").alias("rate_id"),
        F.col("date_id").cast("int").alias("date_id"),
        F.col("currency_id").cast("int").alias("currency_id"),
        "currency_code", "currency_name", "currency_symbol",
        rate("eom").alias("eom_rate"),
        rate("avg").alias("daily_avg_rate"),
    )


def rates_asof(dates: DataFrame, rates: DataFrame) -> DataFrame:
    """date_id, currency_id, eom_rate, daily_avg_rate, rate_date: each currency's last known rate at each of ``dates``.

    Rates and dates are laid over one another in date order and the last rate is carried forward; ``rate_date``
    tells where it comes from (a date of its own: not carried).  Dates before a currency's first rate are missing.
    Both tables are bounded by the calendar.
    """
    listed = rates.select("currency_id").distinct()
    known = rates.select("currency_id", "date_id", F.lit(False).alias("wanted"), F.struct("eom_rate", "daily_avg_rate", F.col("date_id").alias("rate_date")).alias("rate"))
    wanted = dates.select("date_id").distinct().crossJoin(F.broadcast(listed)).select(
        "currency_id", "date_id", F.lit(True).alias("wanted"), F.lit(None).cast(known.schema["rate"].dataType).alias("rate"))
    upto = Window.partitionBy("currency_id").orderBy("date_id", "wanted").rowsBetween(Window.unboundedPreceding, 0)
    filled = known.unionByName(wanted).withColumn("rate", F.last("rate", ignorenulls=True).over(upto))
    return filled.where("wanted AND rate IS NOT NULL").select("date_id", "currency_id", "rate.*")


def add_nominal(base: DataFrame, rates: DataFrame) -> DataFrame:
    """Per-row nominal amounts: ``CAST(eur * rate AS DECIMAL(22,2))`` for both measures.

    ``base`` has date_id, currency_id, amount_eur, daily_avg_eur.  Joined on the (date_id, currency_id) pair, which
    is what ``rate_id`` encodes.  No row is lost: without a rate the nominal amounts are NULL (see ``rates_asof``
    for months that take an earlier one).
    """
    r = F.broadcast(rates.select("date_id", "currency_id", "eom_rate", "daily_avg_rate"))
    j = base.join(r, ["date_id", "currency_id"], "left")
    return (j.withColumn("rate_id", rate_id())
             .withColumn("amount_nominal", money(F.col("amount_eur") * F.col("eom_rate")))
             .withColumn("daily_avg_nominal", money(F.col("daily_avg_eur") * F.col("daily_avg_rate")))
             .drop("eom_rate", "daily_avg_rate"))


def measure_select(fact: DataFrame, keys: list[str], measures: list[str] | None = None) -> DataFrame:
    """Sums of the four amounts by ``keys`` as (measure, amount): one report, interchangeable measures.

    The amounts are summed first; only the sums are unpivoted.
    """
    from ..sources.model import MEASURES

    ms = measures or MEASURES
    check_additive(keys, ms)
    sums = fact.groupBy(*keys).agg(*[F.sum(m).cast(MONEY_SUM).alias(m) for m in ms])
    return sums.unpivot(keys, ms, "measure", "amount")


def restate(fact: DataFrame, rates: DataFrame, currency_ids: list[int], by: list[str], measure: str = "amount_eur") -> DataFrame:
    """EUR amounts restated in each of ``currency_ids`` at both rates: sum to (by, month) once, multiply once, cast once.

    A month without a rate takes the last known one; ``rate_date`` tells of which month, ``carried`` if that is an
    earlier one.  Before a currency's first rate the restated amounts are NULL; no month is dropped.
    """
    keys = list(dict.fromkeys(["date_id"] + by))
    monthly = fact.groupBy(*keys).agg(F.sum(measure).cast(MONEY_WIDE).alias("amount_eur"))
    wanted = fact.sparkSession.createDataFrame([(c,) for c in currency_ids], "currency_id int")
    r = rates_asof(monthly.select("date_id"), rates.join(F.broadcast(wanted), "currency_id", "left_semi"))
    j = monthly.crossJoin(F.broadcast(wanted)).join(F.broadcast(r), ["date_id", "currency_id"], "left")
    return j.select(
        "currency_id", *keys, "amount_eur",
        *[money(F.col("amount_eur") * F.col(c)).cast("decimal(38,2)").alias(o)
          for c, o in (("eom_rate", "restated_eom"), ("daily_avg_rate", "restated_avg"))],
        "rate_date", (F.col("rate_date") < F.col("date_id")).alias("carried"))


def cross_rates(rates: DataFrame) -> DataFrame:
    """rate(A->B) = rate_B / rate_A per month-end, both quotes; self join of a bounded table."""
    a = rates.select("date_id", F.col("currency_code").alias("from_code"),
                     F.col("eom_rate").alias("eom_a"), F.col("daily_avg_rate").alias("avg_a"))
    b = rates.select("date_id", F.col("currency_code").alias("to_code"),
                     F.col("eom_rate").alias("eom_b"), F.col("daily_avg_rate").alias("avg_b"))
    j = a.join(b, "date_id").filter(F.col("from_code") != F.col("to_code"))
    return j.select("date_id", "from_code", "to_code",
                    F.round(F.col("eom_b").cast("double") / F.col("eom_a").cast("double"), 6).alias("eom_cross"),
                    F.round(F.col("avg_b").cast("double") / F.col("avg_a").cast("double"), 6).alias("avg_cross"))


def eom_vs_avg(rates: DataFrame) -> DataFrame:
    """Spread between month-end and daily-average rate per currency and month."""
    return rates.select("date_id", "currency_id", "currency_code", "eom_rate", "daily_avg_rate",
                        (F.col("eom_rate") - F.col("daily_avg_rate")).alias("spread"))


def fx_effect(fact: DataFrame, rates: DataFrame, by: list[str]) -> DataFrame:
    """Nominal change vs. the same month a year earlier, split exactly into volume and rate.

    Sum EUR to (by, currency, month) first; every monthly amount then counts once as this
    year's and once, a year later, as the prior year's, so a cell that is new or has ended
    has a zero on its other side.  volume = (E1 - E0) * r0, rate = E1 * (r1 - r0),
    total = E1*r1 - E0*r0.  Months reach to the last one with data; a month whose own or
    prior-year rate is not in the rate table has no comparison.
    """
    keys = list(dict.fromkeys(by + ["currency_id"]))
    monthly = fact.groupBy(*keys, "date_id").agg(F.sum("amount_eur").cast(MONEY_WIDE).alias("eur"))
    zero = F.lit(0).cast(MONEY_WIDE)
    sides = F.array(F.struct("date_id", F.col("eur").alias("eur"), zero.alias("eur_py")),
                    F.struct(fd.shift_month_end("date_id", 12).alias("date_id"), zero.alias("eur"), F.col("eur").alias("eur_py")))
    cells = (monthly.select(*keys, F.explode(sides).alias("s")).groupBy(*keys, "s.date_id")
             .agg(F.sum("s.eur").cast(MONEY_WIDE).alias("eur"), F.sum("s.eur_py").cast(MONEY_WIDE).alias("eur_py")))
    last = fact.agg(F.max("date_id").alias("last"))  # one row
    r = rates.select("date_id", "currency_id", "eom_rate")
    py = rates.select(fd.shift_month_end("date_id", 12).alias("date_id"), "currency_id", F.col("eom_rate").alias("rate_py"))
    j = (cells.join(F.broadcast(last), F.col("date_id") <= F.col("last"))
         .join(r, ["date_id", "currency_id"]).join(py, ["date_id", "currency_id"]))
    vol = (F.col("eur") - F.col("eur_py")) * F.col("rate_py")
    rt = F.col("eur") * (F.col("eom_rate") - F.col("rate_py"))
    tot = F.col("eur") * F.col("eom_rate") - F.col("eur_py") * F.col("rate_py")
    return j.select(*keys, "date_id", "eur", "eur_py", "eom_rate", "rate_py",
                    vol.cast("decimal(38,8)").alias("volume_effect"),
                    rt.cast("decimal(38,8)").alias("rate_effect"),
                    tot.cast("decimal(38,8)").alias("total_effect"))
