"""Stored ledger: the fact is written in partitions (scenario_id, year), and manifests say which files make it up.

The load (``append_fact``) writes the adapter ledger as Parquet under the shared folder the cluster names in
``spark.checkpoint.dir``; reports read it back, which cuts the lineage of the order-table joins and lets every
report prune on the partition columns.  A ledger's folder is keyed by the source folder and by the code that builds it.

Files are never changed.  Each load writes into folders of its own and then commits a manifest: for every partition
the load that wrote it, its rows, amount and months, besides the digest of the source files and the counts of lines
read, accepted and rejected.  Commits are numbered; one that already exists is not replaced, so of two writers that start
from the same state one fails and can try again, and a load that dies part-way is never read.  ``reload`` derives
single scenario-years anew and commits a manifest in which only these differ.
"""

from __future__ import annotations

import functools
import hashlib
import json
import sys
import threading
import time
import uuid
from dataclasses import asdict, dataclass, replace
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as fd
from ..operators import fx
from ..session import ensure_checkpoint_dir
from .dates import CALENDAR_SCHEMA, month_end_spine
from .model import (CHANNEL_SCHEMA, FACT_COLUMNS, FACT_SCHEMA, PRODUCT_SCHEMA, SEGMENT_SCHEMA, Model,
                    budget_items)
from .tpch import (FX_SEED, LEDGER_KEYS, LINE_KEYS, classified_lines, key_bounds, ledger_calendar, posted, scenario_dim,
                   source_dims, staged_ledger)

SOURCE_TABLES = ["lineitem", "orders", "customer", "supplier", "part", "nation", "region"]
PARTITION_COLUMNS = ["scenario_id", "year"]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


@functools.lru_cache(maxsize=1)
def _code_fingerprint() -> str:
    """Digest of the modules that define the ledger (as loaded by this process), so a code
    change gets a new ledger."""
    from ..functions import dates as f_dates, numeric as f_numeric
    from ..operators import fx as o_fx
    from . import dates as s_dates, fixed as s_fixed, model as s_model, tpch as s_tpch

    h = hashlib.sha1()
    for mod in (f_dates, f_numeric, o_fx, s_dates, s_fixed, s_model, s_tpch, sys.modules[__name__]):
        with open(mod.__file__, "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()


def source_key(spark: SparkSession, sf_dir: str) -> str:
    """Digest of every source file's path, size and time (a table may be a folder of files)."""
    h = hashlib.sha1()
    for t in SOURCE_TABLES:
        fs, p = _fs(spark, f"{sf_dir}/{t}.parquet")
        found, files = fs.listFiles(p, True), []
        while found.hasNext():
            st = found.next()
            files.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
        h.update("\n".join([t, *sorted(files)]).encode())
    return h.hexdigest()[:16]


def ledger_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of one ledger: commits, and the files of all its loads."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    key = hashlib.sha1(f"{_code_fingerprint()}|{sf_dir}".encode()).hexdigest()[:16]
    return f"{root}/ledgerloom/ledger-{key}"


@dataclass(frozen=True)
class Manifest:
    """What makes up one state of a ledger.  ``partitions``: "scenario_id=1/year=1995" -> load, rows, amount, months held."""

    number: int
    source: str
    dims: str
    staged: str
    partitions: dict
    lines: dict

    def holds(self, scenario_id: int, year: int) -> bool:
        return _partition(scenario_id, year) in self.partitions


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since this one began; nothing was changed."""


def _partition(scenario_id: int, year: int) -> str:
    return f"scenario_id={scenario_id}/year={year}"


def _commits(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, f"{path}/commits")
    if not fs.exists(p):
        return []
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.endswith(".json"))


def read_manifest(spark: SparkSession, path: str, name: str) -> Manifest:
    fs, p = _fs(spark, f"{path}/commits/{name}")
    stream = fs.open(p)
    try:
        return Manifest(**json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest committed state, or None."""
    names = _commits(spark, path)
    return read_manifest(spark, path, names[-1]) if names else None


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Publish a manifest under its number: written aside whole, then renamed, which fails if the number is taken."""
    jvm = spark.sparkContext._jvm
    fs, aside = _fs(spark, f"{path}/commits/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{manifest.number:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri() if aside.toUri().getScheme() else fs.getUri(),
                                                                  spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, target, none)
    except Exception as e:
        fs.delete(aside, False)
        if fs.exists(target):
            raise ConcurrentCommit(f"{target.toString()} was committed by another writer") from e
        raise


MAX_RECORDS_PER_FILE = 5_000_000
#: Actual amounts from which one task makes and writes fact rows (up to six each).
ACTUALS_PER_TASK = 200_000


def write_posted(actual: DataFrame, dims: Model, path: str, wanted=None) -> None:
    """Fact rows of actual amounts (those ``wanted``), written by scenario-year.

    The actuals are dealt out by ranges of the ledger keys before they fan out to scenarios: they are a fifth of the
    fact's rows and narrower, and a task has few months, so it writes few scenario-years.  A hot month is split.
    """
    tasks = max(1, -(-actual.count() // ACTUALS_PER_TASK))
    ranges = actual.select(*LEDGER_KEYS, "amount_eur").repartitionByRange(tasks, *LEDGER_KEYS).sortWithinPartitions(*LEDGER_KEYS)
    rows = posted(ranges, dims).withColumn("year", fd.year_of("date_id"))
    (rows if wanted is None else rows.where(wanted)).sortWithinPartitions(*PARTITION_COLUMNS).write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option(
        "compression", "zstd").partitionBy(*PARTITION_COLUMNS).parquet(path)


_FACT_WITH_YEAR = T.StructType(FACT_SCHEMA.fields + [T.StructField("year", T.IntegerType(), True)])


def read_fact(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    """The fact that a manifest describes, with the declared schema: no inference job, and filters prune partitions."""
    if not manifest.partitions:
        return spark.createDataFrame([], _FACT_WITH_YEAR)
    folders = [f"{path}/fact/load={p['load']}/{k}" for k, p in sorted(manifest.partitions.items())]
    rows = spark.read.schema(_FACT_WITH_YEAR).option("basePath", f"{path}/fact").parquet(*folders)
    return rows.select(*FACT_COLUMNS, "year")


# Dimensions derived from the order tables, stored next to the fact so that reports never
# scan lineitem, customer or part again.  Each is bounded (calendar days, nations, market
# segments, brands, month-ends x currencies) and written as one file.
STORED_DIMS = {
    "dim_date": ("dates", CALENDAR_SCHEMA),
    "dim_channel": ("channels", CHANNEL_SCHEMA),
    "dim_segment": ("segments", SEGMENT_SCHEMA),
    "dim_product": ("products", PRODUCT_SCHEMA),
    "dim_currency": ("rates", fx.RATES_SCHEMA),
}


def _write_dim(df: DataFrame, path: str, name: str) -> None:
    schema = STORED_DIMS[name][1]
    df.select(*schema.fieldNames()).coalesce(1).write.parquet(f"{path}/{name}")


def _read_dim(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(STORED_DIMS[name][1]).parquet(f"{path}/{name}")


def read_dims(spark: SparkSession, path: str) -> dict:
    return {attr: _read_dim(spark, path, name) for name, (attr, _) in STORED_DIMS.items()}


STAGED_SCHEMA = T.StructType(
    [T.StructField(k, T.IntegerType()) for k in LEDGER_KEYS] + [T.StructField(k, t) for k, t in zip(LINE_KEYS, (T.LongType(), T.IntegerType()), strict=True)]
    + [T.StructField("reason", T.StringType()), T.StructField("amount_eur", T.DecimalType(22, 2)), T.StructField("lines", T.LongType()),
       T.StructField("rejected", T.BooleanType())])


def read_staged(spark: SparkSession, path: str, run: str) -> DataFrame:
    """What one pass over the order lines has left: accepted amounts at the grain, and each rejected line with its reason."""
    return spark.read.schema(STAGED_SCHEMA).parquet(f"{path}/staged/{run}")


def _stage(spark: SparkSession, sf_dir: str, path: str, run: str, dims: Model, years: tuple[int, int] | None = None):
    """Pass over the order lines once: write the staged ledger; returns lines read, first and last shipment date.

    Where the order tables are laid out in buckets (``buckets.prepare``), lines and orders are read from there.
    """
    from . import buckets

    seen, found, bounds = Observation(), buckets.layout(spark, sf_dir), key_bounds(dims)
    lines = classified_lines(spark, sf_dir, dims, years, seen, found.read(spark) if found else None, bounds)
    staged = staged_ledger(lines, bounds).select(*[F.col(f.name).cast(f.dataType) for f in STAGED_SCHEMA.fields[:-1]], F.col("reason").isNotNull().alias("rejected"))
    staged.write.option("compression", "zstd").partitionBy("rejected").parquet(f"{path}/staged/{run}")
    if read_staged(spark, path, run).isEmpty():  # no lines: a scan without tasks observes nothing
        return 0, None, None
    got = seen.get
    return got["lines"], got["first"], got["last"]


def _unrated(actual: DataFrame, dims: Model) -> DataFrame:
    """Accepted amounts of months in which their currency has no rate yet."""
    rates = fx.rates_asof(month_end_spine(dims.dates), dims.rates).select("date_id", "currency_id")
    return actual.join(F.broadcast(rates), ["date_id", "currency_id"], "left_anti")


def _rated(actual: DataFrame, dims: Model) -> DataFrame:
    rates = fx.rates_asof(month_end_spine(dims.dates), dims.rates).select("date_id", "currency_id")
    return actual.join(F.broadcast(rates), ["date_id", "currency_id"], "left_semi")


def line_counts(staged: DataFrame, dims: Model) -> DataFrame:
    """outcome ("accepted" or a reason), lines, amount: what became of every order line."""
    accepted = staged.where("NOT rejected")
    parts = [_rated(accepted, dims).select(F.lit("accepted").alias("outcome"), "lines", "amount_eur"),
             _unrated(accepted, dims).select(F.lit("no_rate").alias("outcome"), "lines", "amount_eur"),
             staged.where("rejected").select(F.col("reason").alias("outcome"), "lines", "amount_eur")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("outcome").agg(F.sum("lines").alias("lines"), F.coalesce(F.sum("amount_eur"), F.lit(0)).cast("decimal(38,2)").alias("amount"))


def _written(spark: SparkSession, path: str, run: str) -> dict:
    """Manifest entries of the partitions that a run has written."""
    fs, p = _fs(spark, f"{path}/fact/load={run}")
    if not fs.exists(p):
        return {}
    rows = spark.read.schema(_FACT_WITH_YEAR).parquet(f"{path}/fact/load={run}").groupBy(*PARTITION_COLUMNS).agg(
        F.count("*").alias("n"), F.sum("amount_eur").cast("decimal(38,2)").alias("amount"), F.min("date_id").alias("first"),
        F.max("date_id").alias("last"), F.count_distinct("date_id").alias("months")).collect()  # a row a scenario-year
    return {_partition(r.scenario_id, r.year): {"load": run, "rows": r.n, "amount": str(r.amount), "scenario_id": r.scenario_id, "year": r.year,
                                                "first": r["first"], "last": r["last"], "months": r.months} for r in rows}


def versions(spark: SparkSession, manifest: Manifest, scenarios: DataFrame) -> DataFrame:
    """``variance.validity`` of a committed ledger, from its manifest: no scan."""
    schema = "scenario_id int, year int, first_month int, last_month int, months long, n long"
    rows = [(p["scenario_id"], p["year"], p["first"], p["last"], p["months"], p["rows"]) for p in manifest.partitions.values()]
    named = spark.createDataFrame(rows, schema).join(F.broadcast(scenarios.select("scenario_id", "scenario_name", "scenario_type")), "scenario_id")
    fiscal = F.when(F.col("scenario_type") != "Actual", F.col("year"))
    return named.groupBy("scenario_id", "scenario_name", "scenario_type", fiscal.alias("fiscal_year")).agg(
        F.min("first_month").alias("first_month"), F.max("last_month").alias("last_month"), F.sum("months").alias("months"), F.sum("n").alias("row_count"))


def _next(spark: SparkSession, path: str) -> int:
    names = _commits(spark, path)
    return int(names[-1].split(".")[0]) + 1 if names else 0


def _new_run() -> str:
    return f"r{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def load(spark: SparkSession, sf_dir: str, path: str | None = None, rates: DataFrame | None = None) -> Manifest:
    """Build the whole ledger from the order tables and commit it.

    One pass over the lines gives the accepted amounts, the rejected lines with their reasons, the number of lines
    and the calendar's bounds; the rest works on the ledger grain.  ``rates`` replaces the drawn rate table; a month
    without a rate takes the last known one.  The load fails, and commits nothing, unless every line read was
    accepted or rejected once and the actuals add up to the accepted amounts to the cent.
    """
    path = path or ledger_path(spark, sf_dir)
    number, source, run = _next(spark, path), source_key(spark, sf_dir), _new_run()
    at, dims = f"{path}/dims/{run}", source_dims(spark, sf_dir)
    for name, attr in [("dim_channel", "channels"), ("dim_segment", "segments"), ("dim_product", "products")]:
        _write_dim(getattr(dims, attr), at, name)
        dims = replace(dims, **{attr: _read_dim(spark, at, name)})
    read, first, last = _stage(spark, sf_dir, path, run, dims)
    _write_dim(ledger_calendar(spark, first, last), at, "dim_date")
    dates = _read_dim(spark, at, "dim_date")
    drawn = rates if rates is not None else fx.rate_table(month_end_spine(dates), fx.bands(spark), FX_SEED)
    _write_dim(drawn, at, "dim_currency")
    dims = replace(dims, dates=dates, rates=_read_dim(spark, at, "dim_currency"))
    staged = read_staged(spark, path, run)
    counts = {r.outcome: (r.lines, r.amount) for r in line_counts(staged, dims).collect()}
    found = sum(n for n, _ in counts.values())
    if found != read:  # a task that ran twice counts twice in an observation: count exactly before failing
        read = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    if found != read:
        raise RuntimeError(f"ledger not committed: {read} order lines gave {found} accepted and rejected ones (doubled keys?)")
    write_posted(_rated(staged.where("NOT rejected"), dims), dims, f"{path}/fact/load={run}")
    partitions = _written(spark, path, run)
    actuals = sum((Decimal(p["amount"]) for k, p in partitions.items() if k.startswith("scenario_id=1/")), Decimal(0))
    accepted = counts.get("accepted", (0, Decimal(0)))[1]
    if actuals != accepted:
        raise RuntimeError(f"ledger not committed: accepted lines hold {accepted}, actuals {actuals}")
    lines = {"read": read, "outcomes": {k: n for k, (n, _) in sorted(counts.items())}}
    manifest = Manifest(number, source, run, run, partitions, lines)
    commit(spark, path, manifest)
    return manifest


#: Scenarios derived from the actuals of the year before, and of the year before and the same year.
_FROM_YEAR_BEFORE, _FROM_BOTH = (2, 5, 6), (7,)


def dependents(year: int) -> list[tuple[int, int]]:
    """Scenario-years that are derived from the actuals of ``year``."""
    return [(s, year + 1) for s in (*_FROM_YEAR_BEFORE, *_FROM_BOTH)] + [(s, year) for s in _FROM_BOTH]


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> bool:
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def reload(spark: SparkSession, sf_dir: str, partitions: list[tuple[int, int]], cascade: bool = False) -> Manifest:
    """Derive the given (scenario_id, year) partitions anew from the sources as they are now; the others stay as they are.

    Actuals come from the lines shipped in that year, the other scenarios from the ledger's actuals (those reloaded
    with them, if any).  ``cascade`` adds the scenarios that depend on a reloaded year of actuals.  The caller answers for
    the sources having changed in these years only.  Doing it again gives the same ledger; a reload that dies leaves
    the committed one.  New segments, brands or nations, or a year outside the calendar, need a full load and are
    refused.  A partition that has no rows any more leaves the manifest.
    """
    path = ledger_path(spark, sf_dir)
    before = current(spark, path)
    if before is None:
        raise RuntimeError("there is no ledger yet; load it first")
    wanted = set(partitions) | {d for s, y in partitions if cascade and s == 1 for d in dependents(y)}
    dims = Model(fact=None, scenarios=scenario_dim(spark), items=budget_items(spark), **read_dims(spark, f"{path}/dims/{before.dims}"))
    years = {r.year for r in dims.dates.select("year").distinct().collect()}  # of the calendar
    wanted = {(s, y) for s, y in wanted if y in years or (s, y) in partitions}
    now = source_dims(spark, sf_dir)
    if not ({y for _, y in wanted} <= years and _same(now.channels, dims.channels, CHANNEL_SCHEMA.fieldNames())
            and _same(now.segments, dims.segments, ["segment_id", "segment_name"]) and _same(now.products, dims.products, ["product_id", "product_name"])):
        raise RuntimeError("the dimensions have changed; a full load is needed")
    run, source = _new_run(), source_key(spark, sf_dir)
    fresh = sorted(y for s, y in wanted if s == 1)
    kept = {y - d for s, y in wanted if s != 1 for d in ((1, 0) if s in _FROM_BOTH else (1,))} - set(fresh)
    amounts = ["amount_eur"]
    fact = read_fact(spark, path, before)
    actual = fact.where((F.col("scenario_id") == 1) & F.col("year").isin(sorted(kept))).select(*LEDGER_KEYS, *amounts)
    if fresh:
        _stage(spark, sf_dir, path, run, dims, (fresh[0], fresh[-1]))
        staged = read_staged(spark, path, run).where("NOT rejected").where(fd.year_of("date_id").isin(fresh))
        actual = actual.unionByName(_rated(staged, dims).select(*LEDGER_KEYS, *amounts))
    mine = F.struct("scenario_id", fd.year_of("date_id")).isin([F.struct(F.lit(s), F.lit(y)) for s, y in sorted(wanted)])
    write_posted(actual, dims, f"{path}/fact/load={run}", mine)
    written = _written(spark, path, run)
    rest = {k: p for k, p in before.partitions.items() if k not in {_partition(s, y) for s, y in wanted}}
    manifest = replace(before, number=before.number + 1, source=source, partitions=rest | written)
    commit(spark, path, manifest)
    return manifest


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete what the last ``keep`` commits don't use: older commits, and the files of loads that are in none of them.

    Only to be run while no other writer is at work (a load's files are unused until it commits).  Returns the loads deleted.
    """
    names = _commits(spark, path)
    manifests = [read_manifest(spark, path, n) for n in names[-keep:]]
    used = {m.dims for m in manifests} | {m.staged for m in manifests} | {p["load"] for m in manifests for p in m.partitions.values()}
    gone = set()
    for folder, prefix in (("fact", "load="), ("dims", ""), ("staged", "")):
        fs, p = _fs(spark, f"{path}/{folder}")
        for st in fs.listStatus(p) if fs.exists(p) else []:
            run = st.getPath().getName().removeprefix(prefix)
            if run not in used:
                fs.delete(st.getPath(), True)
                gone.add(run)
    numbers = {f"{m.number:012d}" for m in manifests}
    fs, p = _fs(spark, f"{path}/aggregates")
    for st in fs.listStatus(p) if fs.exists(p) else []:
        if st.getPath().getName() not in numbers:
            fs.delete(st.getPath(), True)
    for n in names[:-keep]:
        fs, p = _fs(spark, f"{path}/commits/{n}")
        fs.delete(p, False)
    return sorted(gone)


_MODELS: dict = {}
_LOCK = threading.Lock()


def stored_model(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Model:
    """The ledger model read from the stored tables: partitioned fact plus stored dimensions.

    The adapter is only planned when there is no committed ledger of the sources as they are (or ``rebuild`` asks for a
    new one); the lazy model is memoized per session and commit (DataFrames are immutable plans).  The fact
    carries ``year`` (a partition column) and ``month`` besides the schema columns.
    """
    path = ledger_path(spark, sf_dir)
    with _LOCK:  # jobs of one process may run in threads; one of them loads the ledger
        for old in [k for k, (s, *_) in _MODELS.items() if s is not spark]:
            del _MODELS[old]  # plans of sessions that have ended
        manifest = None if rebuild else current(spark, path)
        if manifest is None or manifest.source != source_key(spark, sf_dir):
            try:
                manifest = load(spark, sf_dir, path)
            except ConcurrentCommit:  # another process has loaded the same sources meanwhile, or others
                manifest = current(spark, path)
                if manifest.source != source_key(spark, sf_dir):
                    manifest = load(spark, sf_dir, path)
        hit = _MODELS.get(path)
        if hit is not None and hit[1] == manifest.number:
            return hit[2]
        fact = read_fact(spark, path, manifest).withColumn("month", fd.month_of("date_id"))
        scenarios = scenario_dim(spark)
        model = Model(fact=fact, scenarios=scenarios, items=budget_items(spark), versions=versions(spark, manifest, scenarios),
                      **read_dims(spark, f"{path}/dims/{manifest.dims}"))
        _MODELS[path] = (spark, manifest.number, model)
        return model


def load_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_counts`` of the last full load of the ledger that ``stored_model`` reads."""
    dims = stored_model(spark, sf_dir)
    path = ledger_path(spark, sf_dir)
    return line_counts(read_staged(spark, path, current(spark, path).staged), dims)
