"""Prefix sums in an order, and list ranking: building blocks that no single task or group has to hold whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

#: Links of a contracted list that one task ranks at most.
LAST = 10_000


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def scanned(df: DataFrame, order: list[str], group: str | None = None, sums: tuple[str, ...] = (), xors: tuple[str, ...] = ()) -> DataFrame:
    """All columns of ``df`` and ``<c>_upto`` for long columns c: sum (or xor) over the rows of the same ``group`` up to and with this one.

    Rows are range-partitioned and sorted by ``order`` (whose first column is ``group``, a long without nulls, if there is
    one), summed in each task, and get what the tasks before hold of their group.  Sums must fit a long.  A group may span any number of
    tasks; the driver sees two rows a task.  ``df`` is read twice, so it should be stored.
    """
    names = [*sums, *xors]
    spark = df.sparkSession
    longs = [T.StructField(f"{c}_upto", T.LongType()) for c in names]
    schema = T.StructType([*df.schema.fields, *longs, T.StructField("part__", T.IntegerType()), T.StructField("head__", T.BooleanType()),
                           T.StructField("edge__", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, running, last_group, first_group = None, np.zeros(len(names), np.int64), None, None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            g = np.asarray(batch.column(group), np.int64) if group else np.zeros(n, np.int64)
            if first_group is None:
                first_group = last_group = g[0]
            new = np.concatenate(([g[0] != last_group], g[1:] != g[:-1]))
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # of the row's group in this batch; -1: before it
            out = []
            for k, c in enumerate(names):
                v = np.asarray(batch.column(c), np.int64)
                total = np.concatenate(([0], np.cumsum(v) if c in sums else np.bitwise_xor.accumulate(v)))
                before = np.where(start < 0, 0, total[np.maximum(start, 0)])
                carry = np.where(start < 0, running[k], 0)
                out.append(total[1:] - before + carry if c in sums else total[1:] ^ before ^ carry)
                running[k] = out[-1][-1]
            last_group = g[-1]
            edge = np.zeros(n, np.int32)
            edge[0] = held is None
            if held is not None:
                yield held
            held = pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, pa.int64()) for x in out], pa.array(np.full(n, part, np.int32)),
                                               pa.array(g == first_group), pa.array(edge)], names=schema.names)
        if held is not None:
            edge = np.array(held.column("edge__"))
            edge[-1] += 2
            yield held.set_column(len(schema) - 1, "edge__", pa.array(edge, pa.int32()))

    ranged = df.repartitionByRange(_partitions(df), *order).sortWithinPartitions(*order)
    done = stored(ranged.mapInArrow(run, schema), "scan")
    ends = done.where("edge__ > 0").select("part__", "edge__", "head__", *([group] if group else []), *[f"{c}_upto" for c in names]).collect()
    carries, running, last_group = [], [0] * len(names), None
    first = {r.part__: r[group] if group else 0 for r in ends if r.edge__ & 1}
    for r in sorted((r for r in ends if r.edge__ & 2), key=lambda r: r.part__):
        carry = running if last_group == first[r.part__] else [0] * len(names)
        carries.append((r.part__, *carry))
        upto = [r[f"{c}_upto"] for c in names]
        running = [x + y if c in sums else x ^ y for c, x, y in zip(names, carry, upto, strict=True)] if r.head__ else upto
        last_group = r[group] if group else 0
    carry = spark.createDataFrame(carries, T.StructType([T.StructField("part__", T.IntegerType())] + [T.StructField(f"{c}_carry", T.LongType()) for c in names]))
    joined = done.join(F.broadcast(carry), "part__")

    def whole(c):
        mine, before = F.col(f"{c}_upto"), F.when(F.col("head__"), F.col(f"{c}_carry")).otherwise(0)
        return mine + before if c in sums else mine.bitwiseXOR(before)

    return joined.select(*df.columns, *[whole(c).alias(f"{c}_upto") for c in names])


LINK = "id long, next long, w long"


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contract the stretches of a list that lie whole in this task (links id -> next of weight w).

    The first link of a stretch stays (kind 0: id, next after the stretch, weight of the stretch); the others leave
    with the first one's id and their distance from it (kind 1).
    """
    table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
    if table is None:
        return
    order = np.argsort(ids := np.asarray(table["id"]))
    ids, nxt, w = ids[order], np.asarray(table["next"].fill_null(-1))[order], np.asarray(table["w"])[order]
    n = len(ids)
    to = np.minimum(np.searchsorted(ids, nxt), n - 1)
    inner = ids[to] == nxt
    up, off = np.arange(n), np.zeros(n, np.int64)
    up[to[inner]] = np.flatnonzero(inner)
    off[to[inner]] = w[inner]
    while True:
        further = up[up]
        if (further == up).all():
            break
        off, up = off + off[up], further
    tail = np.flatnonzero(~inner)
    heads = up[tail]
    kept = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(len(tail), np.int32)), pa.array(ids[heads]), pa.array(nxt[tail], mask=nxt[tail] < 0), pa.array(off[tail] + w[tail])],
        names=["kind", "id", "ref", "w"])
    gone = np.flatnonzero(up != np.arange(n))
    left = pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(gone), np.int32)), pa.array(ids[gone]), pa.array(ids[up[gone]]), pa.array(off[gone])], names=["kind", "id", "ref", "w"])
    yield from (kept, left)


def _splice(links: DataFrame, round_: int) -> DataFrame:
    """Take out each link whose random number exceeds those of its neighbours (a third of them; no two are neighbours).

    Same result columns as ``_contract``.  A link with a greater successor is written by that successor's row, which
    it meets in the one join.
    """
    mine, after = F.xxhash64(F.lit(round_), "id"), F.xxhash64(F.lit(round_), "next")
    rises = F.col("next").isNotNull() & (after > mine)
    marked = links.withColumn("rises", F.coalesce(rises, F.lit(False)))
    before = marked.where("rises").select(F.col("id").alias("p"), F.col("next").alias("id"), F.col("w").alias("pw"))
    both = marked.join(before, "id", "left")

    def row(kind, id_, ref, w):
        return F.struct(F.lit(kind).alias("kind"), id_.alias("id"), ref.alias("ref"), w.alias("w"))

    p, pw, met, gone = F.col("p"), F.col("pw"), F.col("p").isNotNull(), F.col("p").isNotNull() & ~F.col("rises")
    rows = F.array(
        F.when(gone, row(1, F.col("id"), p, pw)),
        F.when(gone, row(0, p, F.col("next"), pw + F.col("w"))).when(met, row(0, p, F.col("id"), pw)),
        F.when(~met & ~F.col("rises"), row(0, F.col("id"), F.col("next"), F.col("w"))))
    return both.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")


def list_ranks(links: DataFrame, last: int = LAST) -> DataFrame:
    """id, rank: distance of every link of one list (long id >= 0, next; null at the end) from its first link.

    First every task contracts the stretches it holds (ids that are near one another mostly follow one another), then
    rounds of splicing take a third of the links out each, until at most ``last`` are left for one task.  Then the
    removed links get their ranks in reverse order.  All work is on stored tables that shrink geometrically.
    """
    spark = links.sparkSession
    ranged = links.select("id", "next", F.lit(1).cast("long").alias("w")).repartitionByRange(_partitions(links), "id")
    step, levels, round_ = stored(ranged.mapInArrow(_contract, "kind int, id long, ref long, w long"), "contracted"), [], 0
    while True:
        levels.append(step.where("kind = 1"))
        links = step.where("kind = 0").select("id", F.col("ref").alias("next"), "w")
        if links.count() <= last:
            break
        step = stored(_splice(links, round_), "spliced")
        round_ += 1
    final = stored(links.coalesce(1).mapInArrow(_contract, "kind int, id long, ref long, w long"), "contracted")
    ranks = final.select("id", F.when(F.col("kind") == 0, F.lit(0)).otherwise(F.col("w")).cast("long").alias("rank"))
    for level in reversed(levels):
        found = level.join(ranks.select(F.col("id").alias("ref"), "rank"), "ref").select("id", (F.col("rank") + F.col("w")).alias("rank"))
        ranks = stored(ranks.unionByName(found), "ranks")
    return ranks
