"""Operator 8: exact Jaccard self-join of documents' word shingles, as a metric-space join.

Jaccard distance d = 1 - similarity is a metric, and documents link when d <= eps.  Documents with equal
shingle sets are one class (distance 0).  The classes are joined by regions:

1. *First regions.*  Two far documents have distance near 1 to any third one, so document pivots alone would
   replicate every document to every region.  The first pivots are therefore single shingles: a set has
   distance 1 - 1/n to a shingle it holds, 1 otherwise, and a linked pair shares at least SHARED shingles (or
   its whole intersection) among the first n - ceil(t n) + SHARED of each side in one common order, rare
   shingles first, frequent ones last.  Classes that share so many are connected; a connected region holds
   every link of its members.  Regions too large for a task are parted again, as often as that helps: the shingles
   that many of their members have in their prefixes go later in the order.
2. *Voronoi cells.*  A region picks pivots among its members, measures every member's distance to each, and assigns
   each to its nearest pivot.  A linked pair x, y of cells i, j satisfies, by the triangle inequality, d(y, i) <= r + eps
   (r: the cell's radius) and d(y, i) <= d(y, j) + 2 eps; members in that window are copied into cell i.  Members about as
   far from all pivots as can be (1 - eps or more) would widen every cell, so they form a cell of their own, which gets
   other pivots.  Cells recurse; pivots have met every member and leave, so each step ends nearer.
3. Regions within ``REGION_WEIGHT`` shingles (and ``REGION_WORK``) recurse inside one task, larger ones over
   the cluster with ``PIVOTS`` pivots a round (members are dealt to slots, pivots copied to each slot).  Members
   connected with a region's largest group are kept as copies only: their links with each other are not
   needed.  A region whose windows would copy it more than ``COPIES`` times is compared block by block, blocks
   dealt over the cluster, as is what is left after ``MAX_ROUNDS``.

Links are united by connected components.  Shingles are 64-bit hashes, classes 64 bits of a digest of the set.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shingle_sets, small_batches, stored, table, text_bytes
from .components import connected_components

#: Slots of the table that orders shingles, by the first bits of the hash: one byte each, the level of the most frequent
#: shingle there.  Lower levels come first, then lower hashes.  Any order is right; this one keeps regions small.  The table
#: is broadcast; it comes to the driver in pieces.
SLOT_BITS, PIECE_BITS = 24, 16
#: Shingles that a task counts at once for that table; those seen once there don't count, nor do sums below LEAST.
COUNT_BLOCK, LEAST = 4 << 20, 4
#: Passes that part large regions again, and shingles of all large regions from which a pass is worth its jobs.
PASSES, PART_WEIGHT = 4, 1 << 24
#: Shingles that linked documents share at least in their prefixes (fewer for small sets), and the longest run of
#: one shingle's classes whose pairs are counted; a longer run connects all its classes.
SHARED, RUN = 4, 32
#: A region of at most so many shingles, and so many times its inner members, is joined in one task.
REGION_WEIGHT, REGION_WORK = 1 << 18, 1 << 28
#: Members that a task compares directly, and pivots of a larger region in a task.
DIRECT, CELLS = 4, 16
#: Pivots a round of a larger region, rounds after which what is left is compared in blocks, rows of a block, and times
#: that a round may copy a region.
PIVOTS, MAX_ROUNDS, BLOCK_ROWS, COPIES = 64, 5, 512, 3

Pair = tuple[int, int]


def _class_key(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _scan(k: int) -> Callable:
    """Per document (kind 0): its class, set size and text's hash; per task (kind 1): shingles seen often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("text_hash", pa.int64())])
        held: list[np.ndarray] = []
        room = COUNT_BLOCK

        def often() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            values, counts = values[counts > 1], counts[counts > 1]
            none = pa.nulls(len(values), pa.int64())
            return _batch(schema, np.ones(len(values), np.int32), none, counts, values.view(np.int64), none)

        for b in small_batches(batches):
            sets = shingle_sets(*text_bytes(b.column("text")), k)
            yield _batch(schema, np.zeros(len(sets), np.int32), b.column("doc_id"), [len(s) for s in sets],
                         [_class_key(s) if len(s) else None for s in sets], b.column("text_hash"))
            held += sets
            room -= sum(map(len, sets))
            if room < 0:
                yield often()
                held, room = [], COUNT_BLOCK
        if held:
            yield often()

    return run


def _levels(counts: DataFrame) -> np.ndarray:
    """Table of levels, eight to a doubling, of shingles (long ``key``) and their counts (long ``n``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for b in batches:
            slots, levels = np.asarray(b.column("slot")), np.asarray(b.column("level")).astype(np.uint8)
            for p in np.unique(slots >> PIECE_BITS):
                at = slots >> PIECE_BITS == p
                np.maximum.at(pieces.setdefault(int(p), np.zeros(1 << PIECE_BITS, np.uint8)), slots[at] & ((1 << PIECE_BITS) - 1), levels[at])
        for p, piece in pieces.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([zlib.compress(piece.tobytes(), 1)], pa.binary())], ["piece", "levels"])

    slot = F.shiftrightunsigned("key", 64 - SLOT_BITS).cast("int")
    level = F.least(F.floor(8 * F.log2("n")) - 15, F.lit(255)).cast("int")
    slots = counts.where(F.col("n") >= LEAST).select(slot.alias("slot"), level.alias("level"))
    pieces = slots.repartition(F.shiftright("slot", PIECE_BITS)).mapInArrow(run, "piece int, levels binary")
    table = np.zeros(1 << SLOT_BITS, np.uint8)
    for r in pieces.collect():  # at most 2^SLOT_BITS bytes
        at = r.piece << PIECE_BITS
        table[at:at + (1 << PIECE_BITS)] = np.maximum(table[at:at + (1 << PIECE_BITS)], np.frombuffer(zlib.decompress(r.levels), np.uint8))
    return table


def _prefixes(k: int, percent: int, levels) -> Callable:
    """Rows (shingle, class, size) for the prefix of every set; a task gives each class once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shingle", pa.int64()), ("cls", pa.int64()), ("n", pa.int32())])
        table = levels.value
        seen: set[int] = set()
        for b in small_batches(batches):
            parts, owners, sizes = [], [], []
            for s in shingle_sets(*text_bytes(b.column("text")), k):
                if not len(s) or (c := _class_key(s)) in seen:
                    continue
                seen.add(c)
                length = min(len(s), len(s) - -(-percent * len(s) // 100) + SHARED)
                level = table[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                first = s[level == 0]
                if len(first) < length:
                    first = s[np.argsort(level, kind="stable")]
                parts.append(first[:length].view(np.int64))
                owners.append(np.full(length, c))
                sizes.append(np.full(length, len(s), np.int32))
            if parts:
                yield _batch(schema, np.concatenate(parts), np.concatenate(owners), np.concatenate(sizes))

    return run


def _need(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Prefix shingles that a linked pair shares at least."""
    return np.minimum(SHARED, -(-percent * np.maximum(n, m).astype(np.int64) // 100))


def _pairs(percent: int) -> Callable:
    """From rows sorted by (shingle, n, cls): pairs of classes with the number of shingles shared, and needed.

    A run of at most RUN classes gives its pairs that sizes allow.  In a longer run each class is paired with
    the next by size only, as if enough were shared: if two sizes allow a link, so do all sizes between them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int32()), ("need", pa.int32())])

        def rows(s: np.ndarray, c: np.ndarray, n: np.ndarray, long: np.ndarray) -> Iterator[pa.RecordBatch]:
            for d in range(1, RUN):
                same = s[d:] == s[:-d]
                if not same.any():
                    break
                at = np.flatnonzero(same & ((d == 1) | ~long[d:]) & (100 * n[:-d].astype(np.int64) >= percent * n[d:].astype(np.int64)) & (c[d:] != c[:-d]))
                if len(at):
                    x, y = c[at], c[at + d]
                    yield _batch(schema, np.minimum(x, y), np.maximum(x, y), np.where(long[at], SHARED, 1).astype(np.int32),
                                 _need(n[at], n[at + d], percent).astype(np.int32))

        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        cut = False  # the held rows end a longer run, of which only the last row is kept
        for b in batches:
            s, c, n = held = [np.concatenate((h, np.asarray(b.column(x)))) for h, x in zip(held, ("shingle", "cls", "n"), strict=True)]
            if not len(s):
                continue
            starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            lengths = np.diff(np.append(starts, len(s)))
            long = np.repeat(lengths > RUN, lengths)
            long[:lengths[0]] |= cut
            last = starts[-1]
            cut = bool(long[-1])
            done = len(s) if cut else last
            yield from rows(s[:done], c[:done], n[:done], long[:done])
            held = [x[-1:] if cut else x[last:] for x in held]
        s, c, n = held
        if len(s) and not cut:
            yield from rows(s, c, n, np.zeros(len(s), bool))

    return run


# ---- joining a region ---------------------------------------------------------------------------

def overlaps(pivot: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of one sorted set with many, given one after the other."""
    at = np.minimum(np.searchsorted(pivot, flat), len(pivot) - 1)
    return np.add.reduceat((pivot[at] == flat).astype(np.int64), starts)


def join_region(keys: list[int], sets: list[np.ndarray], n_inner: int, percent: int) -> list[Pair]:
    """Links among the first ``n_inner`` members and between them and the others (copies from other cells), as many as
    it takes to connect what links connect: by Voronoi cells, recursively."""
    links: list[Pair] = []
    size, eps, tiny = np.array([len(s) for s in sets]), 1 - percent / 100, 1e-9
    root = np.arange(len(sets))
    todo = [(np.arange(n_inner), np.arange(n_inner, len(sets)))]
    while todo:
        inner, outer = todo.pop()
        members = np.concatenate((inner, outer))
        if not len(inner) or (root[members] == root[members[0]]).all():
            continue
        n_pivots = len(inner) if len(inner) <= DIRECT else min(CELLS, int(len(inner) ** 0.5))
        flat, starts = np.concatenate([sets[i] for i in members]), np.concatenate(([0], np.cumsum(size[members])[:-1]))
        distance = np.empty((n_pivots, len(members)))
        for i, p in enumerate(inner[:n_pivots]):
            both = overlaps(sets[p], flat, starts)
            union = size[members] + size[p] - both
            distance[i] = 1 - both / union
            for x in members[100 * both >= percent * union]:
                if root[x] != root[p]:
                    links.append((keys[p], keys[x]))
                    root[root == root[x]] = root[p]
        # pivots have met everyone and leave
        distance, others, left = distance[:, n_pivots:], members[n_pivots:], len(inner) - n_pivots
        if not left:
            continue
        nearest, least = distance.argmin(axis=0), distance.min(axis=0)
        own = np.arange(len(others)) < left
        near = own & (least < 1 - eps)
        for j in range(n_pivots):
            cell = near & (nearest == j)
            if cell.any():
                window = ~cell & (distance[j] <= least[cell].max() + eps + tiny) & (~near | (distance[j] <= least + 2 * eps + tiny))
                todo.append((others[cell], others[window]))
        far = own & ~near
        if far.any():
            todo.append((others[far], others[~own & (least >= least[far].min() - eps - tiny)]))
    return links


def _grouped(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with equal ``by`` columns from sorted batches, as lists of row values."""
    key, held = None, []
    for b in small_batches(batches):
        for row in b.to_pylist():
            k = tuple(row[c] for c in by)
            if k != key:
                if held:
                    yield key, held
                key, held = k, []
            held.append(row)
    if held:
        yield key, held


def _sets_of(rows: list[dict], k: int) -> dict[int, np.ndarray]:
    """Sets by class; rows whose text isn't of the class (repeated ids) are passed over."""
    col = pa.array([r["text"] for r in rows], pa.string())
    sets = zip(rows, shingle_sets(*text_bytes(col), k), strict=True)
    return {r["cls"]: s for r, s in sets if len(s) and _class_key(s) == r["cls"]}


def _join_regions(k: int, percent: int) -> Callable:
    """From rows sorted by region: links of each region."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for _, rows in _grouped(batches, ["region"]):
            sets = _sets_of(rows, k)
            inner = {r["cls"] for r in rows if r["role"] == 0} & set(sets)
            keys = sorted(inner) + sorted(set(sets) - inner)
            if links := join_region(keys, [sets[c] for c in keys], len(inner), percent):
                yield _batch(schema, *zip(*links, strict=True))

    return run


def _pivot_distances(k: int, percent: int) -> Callable:
    """From rows sorted by (region, part, pivots first): each member's distances to the pivots it shares shingles with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("region", pa.int64()), ("origin", pa.int64()), ("role", pa.int32()), ("cls", pa.int64()), ("n", pa.int64()),
                            ("near", pa.list_(pa.struct([("d", pa.float64()), ("p", pa.int64())])))])
        eps = 1 - percent / 100
        for _, rows in _grouped(batches, ["region", "part"]):
            pivots = _sets_of([r for r in rows if r["pivot"]], k)
            members = [r for r in rows if not r["pivot"]]
            sets = _sets_of(members, k)
            members = list({r["cls"]: r for r in members if r["cls"] in sets}.values())
            if not members:
                continue
            flat = np.concatenate([sets[r["cls"]] for r in members])
            size = np.array([len(sets[r["cls"]]) for r in members])
            starts = np.concatenate(([0], np.cumsum(size)[:-1]))
            near: list[list[dict]] = [[] for _ in members]
            for c, pivot in pivots.items():
                both = overlaps(pivot, flat, starts)
                union = size + len(pivot) - both
                dist = np.where(100 * both >= percent * union, np.minimum(1 - both / union, eps), np.maximum(1 - both / union, eps + 1e-12))
                for i in np.flatnonzero(both):
                    near[i].append({"d": dist[i], "p": c})
            yield _batch(schema, *[[r[c] for r in members] for c in ("region", "origin", "role", "cls", "n")], near)

    return run


def _sized(members: DataFrame) -> DataFrame:
    """Members with their region's rows and weight."""
    stats = members.groupBy("region").agg(F.count("*").alias("rows"), F.sum(1 - F.col("role")).alias("inner"), F.sum("n").alias("weight"))
    return members.join(stats, "region")


def _with_text(members: DataFrame, texts: DataFrame) -> DataFrame:
    return members.join(texts.select("cls", "text"), "cls")


def _local_links(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    rows = _with_text(members.select("region", "role", "cls"), texts).repartition("region").sortWithinPartitions("region")
    return rows.select("region", "role", "cls", "text").mapInArrow(_join_regions(k, percent), "a long, b long")


def _round(members: DataFrame, texts: DataFrame, links: DataFrame | None, anchors: DataFrame | None, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One round of Voronoi cells of large regions: all links so far, the anchors, the cells, and what is too dense for cells.

    An anchor is a member of the largest connected group that the first round finds in a first region.  Members
    connected with their anchor are copies from then on: a pair of which both are needs no link, and a pair of which
    one is not is found where that one is no copy.
    """
    eps, tiny = 1 - percent / 100, 1e-9
    parts = F.ceil(F.greatest(F.col("rows") / 256, F.col("weight") / F.lit(REGION_WEIGHT / 4))).cast("int")
    pivots = members.where("role = 0").groupBy("region", F.pmod("cls", F.lit(PIVOTS)).alias("slot"), parts.alias("parts")).agg(
        F.min("cls").alias("cls"), F.min("origin").alias("origin"))
    copies = pivots.select("region", "origin", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"),
                           "cls", F.lit(0).cast("long").alias("n"), F.lit(True).alias("pivot"))
    dealt = members.select("region", "origin", F.pmod(F.xxhash64("cls"), parts).cast("int").alias("part"), "role", "cls", "n", F.lit(False).alias("pivot"))
    rows = _with_text(dealt.unionByName(copies), texts)
    rows = rows.repartition("region", "part").sortWithinPartitions("region", "part", F.desc("pivot"))
    near = stored(rows.select("region", "origin", "part", "role", "cls", "n", "pivot", "text").mapInArrow(
        _pivot_distances(k, percent), "region long, origin long, role int, cls long, n long, near array<struct<d double, p long>>"), "distances")
    found = near.select("cls", F.explode("near").alias("x")).where((F.col("x.d") <= eps) & (F.col("x.p") != F.col("cls"))).select(F.col("x.p").alias("a"), F.col("cls").alias("b"))
    links = stored(found if links is None else links.unionByName(found), "links")
    label = stored(connected_components(links).toDF("cls", "label"), "labels")
    if anchors is None:
        groups = near.select("origin", "cls").distinct().join(label, "cls").groupBy("origin", "label").agg(F.count("*").alias("size"), F.min("cls").alias("anchor"))
        anchors = stored(groups.groupBy("origin").agg(F.max_by("anchor", F.struct("size", "label")).alias("anchor")), "anchors")
    main = anchors.join(label.withColumnRenamed("cls", "anchor"), "anchor").select("origin", F.col("label").alias("main"))

    left = near.join(pivots.select("region", "cls"), ["region", "cls"], "left_anti").join(label, "cls", "left").join(main, "origin", "left")
    best = F.array_min("near")
    left = left.withColumns({"least": F.coalesce(best["d"], F.lit(1.0)), "cell": best["p"],
                             "own": (F.col("role") == 0) & ~F.coalesce(F.col("label") == F.col("main"), F.lit(False))})
    left = stored(left.withColumn("in_cell", F.col("own") & (F.col("least") < 1 - eps)).drop("label", "main"), "left")
    named = ["origin", "cls", "n"]
    centres = left.where("in_cell").groupBy("region", F.col("cell").alias("p")).agg(F.max("least").alias("radius"))
    inner = left.where("in_cell").select("region", F.xxhash64("region", "cell").alias("to"), F.lit(0).alias("role"), *named)
    reach = left.select("region", *named, "in_cell", "least", "cell", F.explode("near").alias("x")).select("region", *named, "in_cell", "least", "cell", "x.d", "x.p")
    window = (F.col("d") <= F.col("radius") + eps + tiny) & (~F.col("in_cell") | ((F.col("p") != F.col("cell")) & (F.col("d") <= F.col("least") + 2 * eps + tiny)))
    outer = reach.join(centres, ["region", "p"]).where(window).select("region", F.xxhash64("region", "p").alias("to"), F.lit(1).alias("role"), *named)
    far = left.where("own AND NOT in_cell")
    beyond = far.groupBy("region").agg(F.min("least").alias("from"))
    apart = F.xxhash64("region", F.lit("far")).alias("to")
    far_outer = left.where("NOT own").join(beyond, "region").where(F.col("least") >= F.col("from") - eps - tiny).select("region", apart, F.lit(1).alias("role"), *named)
    cells = stored(inner.unionByName(outer).unionByName(far.select("region", apart, F.lit(0).alias("role"), *named)).unionByName(far_outer), "cells")

    many = cells.groupBy("region").agg(F.count("*").alias("copied")).join(left.groupBy("region").agg(F.count("*").alias("had")), "region")
    dense = stored(many.where(F.col("copied") > COPIES * F.col("had")).select("region"), "dense")
    whole = left.join(dense, "region", "left_semi").select("region", F.when(F.col("own"), 0).otherwise(1).alias("role"), *named)
    parted = cells.join(dense, "region", "left_anti").select(F.col("to").alias("region"), "role", *named)
    return links, anchors, stored(_sized(parted), "regions"), stored(_sized(whole), "whole")


def _blocks(members: DataFrame) -> DataFrame:
    """Every pair of blocks of a region as a region of its own."""
    nb = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("weight") / F.lit(REGION_WEIGHT / 2))).cast("int")
    rows = members.withColumn("nb", nb).withColumn("i", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return rows.select(F.xxhash64("region", F.least("i", "j"), F.greatest("i", "j")).alias("region"), "role", "cls", "n")


def _prefix_rows(docs: DataFrame, levels: np.ndarray, k: int, percent: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2^SLOT_BITS bytes
    return docs.select("text").mapInArrow(_prefixes(k, percent, shared), "shingle long, cls long, n int")


def _first_regions(prefixes: DataFrame, percent: int) -> DataFrame:
    """Columns cls, region: classes that share enough of their prefixes are connected, directly or by others."""
    pairs = prefixes.repartition("shingle").sortWithinPartitions("shingle", "n", "cls").mapInArrow(
        _pairs(percent), "a long, b long, shared int, need int")
    near = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("need").alias("need")).where("shared >= need")
    return connected_components(stored(near.select("a", "b"), "near")).toDF("cls", "region")  # read more than once


def _parted(members: DataFrame, texts: DataFrame, levels: np.ndarray, k: int, percent: int) -> DataFrame:
    """``members``, those of large regions in smaller first regions: by orders in which the shingles of longer runs come
    later, as long as that halves the classes in large regions.  A region holds every link of its members in any order."""
    large, before = F.col("weight") > REGION_WEIGHT, None
    for _ in range(PASSES):
        own = members.where(large)
        n, weight = own.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if weight <= PART_WEIGHT or before and 2 * n > before:
            break
        before = n
        own_texts = stored(texts.join(own.select("cls"), "cls", "left_semi").select("text"), "large")
        runs = _prefix_rows(own_texts, levels, k, percent).groupBy(F.col("shingle").alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > RUN)
        levels = np.maximum(levels, _levels(runs))
        region = _first_regions(_prefix_rows(own_texts, levels, k, percent), percent)
        again = own.select("cls", "n").join(region, "cls").select("region", "cls", "n")
        parted = members.where(~large).select("region", "cls", "n").unionByName(again).withColumn("role", F.lit(0))
        members = stored(_sized(parted), "regions")
    return members


def labelled(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, cls, text_hash) of ``docs``, and (cls, doc_id, label): each class's smallest doc_id and component.

    A class is a distinct shingle set (null without words), a component a set of classes that links connect.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    scanned = stored(docs.mapInArrow(_scan(k), "kind int, doc_id long, n long, key long, text_hash long"), "scan")
    docs = docs.drop("text_hash")
    each = scanned.where("kind = 0").select("doc_id", "n", F.col("key").alias("cls"), "text_hash")
    classes = each.where("doc_id IS NOT NULL AND cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))

    levels = _levels(scanned.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")))
    region = _first_regions(_prefix_rows(docs.where("doc_id IS NOT NULL"), levels, k, percent), percent)
    members = classes.join(region, "cls").select("region", F.lit(0).alias("role"), "cls", "n", "doc_id")
    members = stored(_sized(members), "regions")
    texts = stored(docs.join(members.select("doc_id", "cls"), "doc_id").select("cls", "text"), "texts")
    members = _parted(members.drop("doc_id"), texts, levels, k, percent).withColumn("origin", F.col("region"))
    small = F.expr(f"weight <= {REGION_WEIGHT} AND inner * weight <= {REGION_WORK}")

    def local(regions: DataFrame) -> DataFrame:  # each on its own: one plan of all rounds would be large for the driver
        return stored(_local_links(regions, texts, k, percent), "found")

    found, met, anchors = [local(members.where(small))], None, None
    for _ in range(MAX_ROUNDS):
        members = members.where(~small)
        if members.isEmpty():
            break
        met, anchors, members, whole = _round(members, texts, met, anchors, k, percent)
        found += [local(members.where(small)), local(_blocks(whole))]
    else:
        found.append(local(_blocks(members.where(~small))))
    links = found[0]
    for more in [*found[1:], *([met] if met is not None else [])]:
        links = links.union(more)
    label = connected_components(stored(links, "links")).toDF("cls", "label")

    named = stored(classes.select("cls", "doc_id").join(label, "cls", "left").select("cls", "doc_id", F.coalesce("label", "cls").alias("label")), "named")
    return each, named


def jaccard_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Columns doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text; other columns unread).

    Words fold A-Z; a set holds the distinct ``k``-word shingles, or the whole sequence if there are fewer
    words.  Two rows link when 100 * intersection >= percent * union; the component is named by its smallest
    doc_id.  Null, empty and blank texts have no shingles and link with nothing; rows with a null doc_id link
    with nothing and have a null component.  Repeated rows each give a row.  An empty table gives none.
    """
    each, named = labelled(docs, k, percent)
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    component = named.join(smallest, "label").select("cls", "component_id")
    return each.join(component, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def query(spark, sf_dir):
    """4-word shingles, similarity of 0.85 or more, all documents."""
    return jaccard_components(table(spark, sf_dir, "documents"), 4, 85)


def stage(spark, docs, sf_dir):
    """One document of each group of near-duplicates (5-word shingles, 0.8 or more) stays: the smallest doc_id.

    Different texts under one doc_id are documents of their own.  Rows without a doc_id and rows without words stay;
    of rows of one doc_id with the same text one stays.
    """
    each, named = labelled(docs, 5, 80)
    each = each.where("doc_id IS NOT NULL")
    first = each.where("cls IS NOT NULL").join(named.select("cls", "label"), "cls").groupBy("label").agg(F.min(F.struct("doc_id", "cls", "text_hash")).alias("first"))
    keep = first.select("first.doc_id", "first.text_hash").unionByName(each.where("cls IS NULL").select("doc_id", "text_hash"))
    keys = {"doc_id": F.col("row.doc_id").cast("long"), "text_hash": F.xxhash64(F.coalesce("row.text", F.lit("")))}
    rows = docs.where("doc_id IS NOT NULL").select(F.struct("*").alias("row")).withColumns(keys)
    kept = rows.join(keep, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return kept.select("row.*").unionByName(docs.where("doc_id IS NULL"))
