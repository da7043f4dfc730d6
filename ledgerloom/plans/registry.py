"""Registry of report jobs: key -> (Spark builder, oracle SQL).

A job takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the ledger
built from the tables in ``sf_dir``.  ``present`` is applied at the edge:
exact decimals become doubles and dates become ISO strings, so that the
result compares cell-for-cell with an independent SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Job:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


JOBS: dict[str, Job] = {}


def job(key: str, oracle: str | None):
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))
        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        JOBS[key] = Job(key, build, oracle)
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)
