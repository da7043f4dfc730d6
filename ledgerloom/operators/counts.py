"""Counting, sampling and additive drill-down operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, row_count) per table: one distributed count each, glued with UNION ALL."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def group_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``COUNT(*)`` per key combination (partial + final hash aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def sample_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """A repeatable pseudo-random sample of ``n`` rows: order by md5 of the key, then the key.

    Replaces ``TOP n ... ORDER BY NEWID()``; runs as a per-partition top-n
    followed by a merge of n rows per partition (no global sort).
    """
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


def sample_strata(df: DataFrame, stratum: str, keys: list[str], n: int) -> DataFrame:
    """``sample_rows`` for every value of ``stratum`` at once; ``position`` numbers a stratum's rows from 1.

    The bound on the row number becomes a window group limit: a task passes on ``n`` rows a stratum.
    """
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    w = Window.partitionBy(stratum).orderBy("_h", *keys)
    return df.withColumn("_h", h).withColumn("position", F.row_number().over(w).cast("long")).where(F.col("position") <= n).drop("_h")


def check_additive(by: list[str], measures: list[str]) -> None:
    nominal = [m for m in measures if m.endswith("_nominal")]
    if nominal and not {"currency_id", "rate_id", "currency_code"} & set(by):
        raise ValueError(f"{', '.join(nominal)} can't be added over currencies; group by currency_id")


def sum_by(df: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Additive sum of measures over any subset of dimensions (drill-down).

    Nominal amounts are in each row's own currency: summing them without the currency
    among ``by`` is refused.
    """
    check_additive(by, measures)
    return df.groupBy(*by).agg(*[F.sum(m).cast(MONEY_SUM).alias(m) for m in measures])
