"""Order tables laid out for the load: lines and orders in buckets of the order key.

The load joins every line with its order.  Where the tables are prepared once, that join reads matching buckets and
neither lines nor orders are shuffled for it; loads and reloads of the same sources share the layout.  A layout
belongs to one state of the source files and is found by their digest, so a stale one is never used.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .tpch import SOURCE_SCHEMAS, table

ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, has_customer boolean, c_mktsegment string"


@dataclass(frozen=True)
class Layout:
    """Names of the registered tables: lines, and orders with their customer's market segment."""

    lines: str
    orders: str
    buckets: int

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.table(self.lines), spark.table(self.orders)


def _folder(spark: SparkSession, sf_dir: str) -> str:
    root = store.ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/ledgerloom/buckets-{store.source_key(spark, sf_dir)}"


def _register(spark: SparkSession, name: str, schema: str, key: str, buckets: int, path: str) -> str:
    """The files at ``path`` as a table of this session (the catalog may not outlive it, the files do)."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def prepare(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> Layout:
    """Write lines and orders in buckets of the order key (one shuffle of each) and publish the layout.

    ``buckets`` defaults to the session's shuffle partitions, so that each is about the size of a shuffle partition.
    A write that dies publishes nothing.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, run = _folder(spark, sf_dir), uuid.uuid4().hex[:12]
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "o_custkey", F.col("c_custkey").isNotNull().alias("has_customer"), "c_mktsegment")
    for name, rows, key in (("lines", table(spark, sf_dir, "lineitem"), "l_orderkey"), ("orders", orders, "o_orderkey")):
        written = f"bucketed_{name}_{run}"
        (rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{run}/{name}").saveAsTable(written))
    fs, aside = store._fs(spark, f"{folder}/{run}/layout.json")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps({"run": run, "buckets": buckets}).encode()))
    out.close()
    _, target = store._fs(spark, f"{folder}/layout.json")
    fs.delete(target, False)
    fs.rename(aside, target)
    return layout(spark, sf_dir)


def layout(spark: SparkSession, sf_dir: str) -> Layout | None:
    """The layout of the sources as they are now, or None."""
    folder = _folder(spark, sf_dir)
    fs, p = store._fs(spark, f"{folder}/layout.json")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    run, buckets = found["run"], found["buckets"]
    return Layout(_register(spark, f"bucketed_lines_{run}", SOURCE_SCHEMAS["lineitem"], "l_orderkey", buckets, f"{folder}/{run}/lines"),
                  _register(spark, f"bucketed_orders_{run}", ORDERS_SCHEMA, "o_orderkey", buckets, f"{folder}/{run}/orders"), buckets)
