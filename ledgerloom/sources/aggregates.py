"""A lattice of stored aggregates of the ledger, and a router that answers sums from the smallest one that can.

Each aggregate holds the additive measures by a set of keys, and is made from the smallest one that has these keys, so
the ledger is read only for the sets that no other contains.  A lattice belongs to one commit of the ledger: after a reload it is
stale, and requests are refused until it is built anew.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM
from ..operators.counts import check_additive
from . import store

KEYS = ["scenario_id", "year", "month", "channel_id", "segment_id", "product_id", "currency_id", "budget_item_id"]
MEASURES = ["amount_eur", "daily_avg_eur"]
NOMINAL = ["amount_nominal", "daily_avg_nominal"]
#: Key sets that are stored; the drill-downs of the reports are contained in one of them.
KEY_SETS = [
    ["scenario_id", "year", "channel_id", "segment_id", "product_id", "currency_id"],
    ["scenario_id", "year", "month", "channel_id", "currency_id"],
    ["scenario_id", "year", "month", "budget_item_id", "currency_id"],
    ["scenario_id", "year", "channel_id", "segment_id", "product_id"],
    ["scenario_id", "year", "channel_id"],
    ["scenario_id", "year", "month"],
    ["scenario_id", "year"],
]
#: Attributes of dimensions that can be asked for: name -> (key, dimension).
ATTRIBUTES = {"channel_type": ("channel_id", "channels"), "channel_name": ("channel_id", "channels"), "region": ("channel_id", "channels"),
              "segment_name": ("segment_id", "segments"), "product_name": ("product_id", "products"), "product_category": ("product_id", "products"),
              "item_name": ("budget_item_id", "items"), "category": ("budget_item_id", "items"), "scenario_name": ("scenario_id", "scenarios")}


class StaleAggregates(RuntimeError):
    """The ledger has been committed anew since the aggregates were built."""


@dataclass(frozen=True)
class Aggregate:
    keys: tuple[str, ...]
    rows: int
    path: str


def _registry(path: str, number: int) -> str:
    return f"{path}/aggregates/{number:012d}"


def lattice(spark: SparkSession, sf_dir: str) -> list[Aggregate]:
    """The stored aggregates of the ledger's present commit; StaleAggregates if there are only older ones or none."""
    path = store.ledger_path(spark, sf_dir)
    manifest = store.current(spark, path)
    if manifest is None:
        raise StaleAggregates("there is no ledger")
    fs, p = store._fs(spark, f"{_registry(path, manifest.number)}/lattice.json")
    if not fs.exists(p):
        raise StaleAggregates(f"no aggregates of commit {manifest.number}; build them")
    stream = fs.open(p)
    try:
        rows = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return [Aggregate(tuple(r["keys"]), r["rows"], r["path"]) for r in rows]


def route(aggregates: list[Aggregate], keys: set[str]) -> Aggregate | None:
    """The aggregate of fewest rows that has all ``keys``, or None."""
    fit = [a for a in aggregates if keys <= set(a.keys)]
    return min(fit, key=lambda a: (a.rows, a.keys)) if fit else None


def _measures(keys) -> list[str]:
    return MEASURES + (NOMINAL if "currency_id" in keys else [])


def _summed(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(m).cast(MONEY_SUM).alias(m) for m in measures])


def build(spark: SparkSession, sf_dir: str, key_sets=KEY_SETS) -> list[Aggregate]:
    """Store the aggregates of the ledger's present commit and publish them together.

    Nominal amounts are kept where the currency is a key.  A build that dies publishes nothing.
    """
    model = store.stored_model(spark, sf_dir)
    path = store.ledger_path(spark, sf_dir)
    number = store.current(spark, path).number
    run = f"{_registry(path, number)}/{uuid.uuid4().hex[:12]}"
    built: list[Aggregate] = []
    for keys in sorted(key_sets, key=lambda k: (-len(k), k)):
        base = route(built, set(keys))
        source = model.fact if base is None else spark.read.parquet(base.path)
        at = f"{run}/{'-'.join(keys)}"
        _summed(source, keys, _measures(keys)).write.parquet(at)
        built.append(Aggregate(tuple(keys), spark.read.parquet(at).count(), at))
    aside = f"{run}.json"
    fs, p = store._fs(spark, aside)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps([{"keys": a.keys, "rows": a.rows, "path": a.path} for a in built]).encode()))
    out.close()
    _, target = store._fs(spark, f"{_registry(path, number)}/lattice.json")
    fs.rename(p, target)  # whichever of two builds of a commit comes last: both hold the same sums
    return lattice(spark, sf_dir)


def sums(spark: SparkSession, sf_dir: str, by: list[str], measures: list[str] = MEASURES) -> DataFrame:
    """Sums of ``measures`` by any keys and attributes, from the smallest stored aggregate that has them, else from the ledger.

    Raises StaleAggregates if the ledger has changed since the aggregates were built, ValueError for unknown names and
    for nominal amounts without the currency.
    """
    unknown = [c for c in by if c not in KEYS and c not in ATTRIBUTES]
    if unknown:
        raise ValueError(f"unknown keys: {unknown}")
    check_additive(by, measures)
    keys = list(dict.fromkeys(ATTRIBUTES[c][0] if c in ATTRIBUTES else c for c in by))
    found = route(lattice(spark, sf_dir), set(keys))
    model = store.stored_model(spark, sf_dir)
    rows = _summed(model.fact if found is None else spark.read.parquet(found.path), keys, measures)
    for key in dict.fromkeys(ATTRIBUTES[c][0] for c in by if c in ATTRIBUTES):
        wanted = [c for c in by if c in ATTRIBUTES and ATTRIBUTES[c][0] == key]
        dimension = getattr(model, ATTRIBUTES[wanted[0]][1])
        rows = rows.join(dimension.select(key, *wanted), key)
    return _summed(rows, by, measures)


def current_sums(spark: SparkSession, sf_dir: str, by: list[str], measures: list[str] = MEASURES) -> DataFrame:
    """``sums``, after building the aggregates if there are none of the present commit."""
    store.stored_model(spark, sf_dir)
    try:
        lattice(spark, sf_dir)
    except StaleAggregates:
        build(spark, sf_dir)
    return sums(spark, sf_dir, by, measures)
