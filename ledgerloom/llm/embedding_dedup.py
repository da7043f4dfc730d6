"""Operator 9: near-duplicate embeddings by a forest of random-projection trees.

A tree splits the vectors again and again by a random direction, where few vectors are near; vectors close to a
split go to both sides (spill).  Vectors are compared within leaves only, in double precision, and links are
united.  A pair that shares several leaves counts in the first: rows carry the numbers of all their leaves.

A split loses some pairs, more in denser nodes.  Each sampled vector carries how likely a vector linked to it by
just the threshold is still with it: a node that no split parts at a fair price, or whose path has lost its
part of pairs, stays a leaf, however large.  Trees are added until, by this estimate, all of them together miss
no more than ``MISSED`` of these pairs in a leaf, but for leaves with a share ``OPEN`` of the vectors; leaves whose pairs are found are left
out of later trees.

Trees are fitted on at most ``SAMPLE`` vectors (the smallest hashed ids), for each length; every vector is routed.  A leaf that
is still large gets a forest of its own, fitted on its own vectors, so leaves stay near ``LEAF`` at any size.  Leaves beyond
``BLOCK`` vectors are compared block by block, so no task holds more than two blocks.  Equal vectors are one class
with a count.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table
from .components import connected_components

SAMPLE, SEED = 20_000, 17
#: Vectors aimed at in a leaf, sampled vectors that it has at least, and vectors in a block of a larger leaf.
LEAF, SAMPLED, BLOCK = 256, 16, 1024
#: Vectors from which on a leaf gets a forest of its own, vectors that is fitted on, and vectors that one task routes.
SPLIT, LEAF_SAMPLE, ROUTED = 8 * LEAF, 2000, 50_000
#: Forests inside forests, at most (a hundredfold each).
LEVELS = 6
#: A split's spill on either side, in standard deviations of the projected difference of two vectors just linked.
SPILL = 0.3
#: Share of just linked pairs that all trees may miss in a leaf, and that one tree keeps on the way to a node.
MISSED, KEPT = 0.005, 0.5
#: Trees are added until at most this share of the sampled vectors lies in leaves that miss more.
OPEN = 0.02
#: A split is made if the log of the pairs it keeps is at most this part of the log of the comparisons it saves.
PRICE = 0.5
#: In place of a leaf whose pairs the trees before have found.
DONE = -(2**31)
THRESHOLD = 0.95


@dataclass
class Tree:
    """Nodes: direction, split, spill, children (negative: leaf ~child, or DONE)."""

    directions: list[np.ndarray] = field(default_factory=list)
    splits: list[float] = field(default_factory=list)
    spills: list[float] = field(default_factory=list)
    children: list[tuple[int, int]] = field(default_factory=list)
    root: int = -1


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def below(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, to 0.0005."""
    return 0.5 + 0.5 * np.tanh(0.7978846 * (z + 0.044715 * z**3))


def grow(sample: np.ndarray, least: float, threshold: float, missed: np.ndarray, rng: np.random.Generator, next_leaf: int) -> tuple[Tree, int, np.ndarray]:
    """A tree over unit vectors, the next leaf's number, and how likely each row shares a leaf with a vector just linked to it.

    ``missed`` is how likely the trees before miss such a vector.
    """
    tree, found = Tree(), np.zeros(len(sample))
    step = np.sqrt(2 - 2 * threshold)

    def cut(rows: np.ndarray, kept: np.ndarray):
        """The best (direction, split, spill, where rows lie, width, what is kept), or None."""
        some = np.arange(0, len(rows), len(rows) // 500 + 1)
        part, had = sample[rows[some]], kept[some, None, None]
        spread = np.sqrt(part.var(axis=0).sum())
        if not spread:
            return None
        directions = unit(rng.standard_normal((4, sample.shape[1])))
        along = part @ directions.T
        # differences of linked vectors lie where the node's vectors differ, at least
        width = step * np.maximum(1 / np.sqrt(sample.shape[1]), along.std(axis=0) / spread)
        spill = SPILL * width
        splits = np.sort(along, axis=0)[(np.array([0.3, 0.4, 0.5, 0.6, 0.7]) * len(some)).astype(int)]
        off = along[:, None] - splits
        keep = np.where(np.abs(off) <= spill, 1.0, below((np.abs(off) + spill) / width))
        larger = np.maximum((off <= spill).mean(axis=0), (off >= -spill).mean(axis=0))
        price, gain = -np.log((had * keep).sum(axis=0) / had.sum()), -np.log(2 * larger**2)
        cost = np.where(gain > 0, price / np.where(gain > 0, gain, 1), np.inf)
        i, j = np.unravel_index(np.argmin(cost), cost.shape)
        if cost[i, j] > PRICE:
            return None
        direction, split, spill, width = directions[j], float(splits[i, j]), float(spill[j]), width[j]
        at = sample[rows] @ direction
        off = np.abs(at - split)
        return direction, split, spill, at, width, kept * np.where(off <= spill, 1.0, below((off + spill) / width))

    def node(rows: np.ndarray, kept: np.ndarray, mass: np.ndarray) -> int:
        nonlocal next_leaf
        if len(rows) and missed[rows].max() <= MISSED:
            return DONE
        best = cut(rows, kept) if len(rows) > least else None
        if best is None or best[-1].mean() < KEPT:
            if len(rows) and missed[rows].mean() <= MISSED:
                return DONE
            found[rows] += mass
            next_leaf += 1
            return ~(next_leaf - 1)
        direction, split, spill, at, width, kept = best
        me = len(tree.splits)
        tree.directions.append(direction)
        tree.splits.append(split)
        tree.spills.append(spill)
        tree.children.append((0, 0))
        children = []
        for sign in (1, -1):
            side = sign * (at - split) <= spill
            off = sign * (split - at[side])
            # a linked vector counts on one side only
            children.append(node(rows[side], kept[side], mass[side] * below((off + np.where(off > spill, spill, 0)) / width)))
        tree.children[me] = children[0], children[1]
        return me

    tree.root = node(np.arange(len(sample)), np.ones(len(sample)), np.ones(len(sample)))
    return tree, next_leaf, found


def plain(tree: Tree) -> tuple:
    """A tree as arrays: a broadcast goes by plain pickle, which needs no class of this package on executors."""
    children = np.array(tree.children, np.int64).reshape(-1, 2)
    return tree.root, np.array(tree.directions), np.array(tree.splits), np.array(tree.spills), children


def route(tree: tuple, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows) for unit vectors, by a tree as ``plain`` gives it."""
    root, directions, splits, spills, children = tree
    out, todo = [], [(root, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        if at == DONE:
            continue
        if at < 0:
            out.append((~at, rows))
        elif len(rows):
            off = x[rows] @ directions[at] - splits[at]
            left, right = children[at].tolist()
            todo += [(left, rows[off <= spills[at]]), (right, rows[off >= -spills[at]])]
    return out


def forest(sample: np.ndarray, n: int, threshold: float, leaves: int = 0) -> tuple[list[Tree], int]:
    """Trees for ``n`` vectors, as many as MISSED asks for; leaves are numbered from ``leaves``, the next is returned."""
    rng, trees = np.random.default_rng(SEED), []
    missed = np.ones(len(sample))
    while True:
        tree, leaves, found = grow(sample, max(LEAF * len(sample) / max(n, 1), SAMPLED), threshold, missed, rng, leaves)
        trees, missed = [*trees, tree], missed * np.clip(1 - found, 0, 1)
        if (found > 0).mean() <= OPEN:
            return trees, leaves


def forests(raw: list[bytes], n: int, threshold: float) -> dict[int, list[tuple]]:
    """A forest (of ``plain`` trees) for each length in bytes, from a sample of ``n`` vectors."""
    by_length: dict[int, list[bytes]] = {}
    for v in raw:
        by_length.setdefault(len(v), []).append(v)
    out, leaves = {}, 0
    for length, vectors in sorted(by_length.items()):
        trees, leaves = forest(_matrix(vectors), n * len(vectors) // len(raw), threshold, leaves)
        out[length] = [plain(t) for t in trees]
    return out


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; null where they are null, zero, empty, or hold null or non-finite components."""
    for b in batches:
        raw = []
        for v in b.column("vec").to_pylist():
            x = np.array(v, float) if v and None not in v else None
            raw.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(raw, pa.binary())], ["vec_id", "raw"])


def _matrix(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), float).reshape(len(raw), -1)
    return unit(x / np.abs(x).max(axis=1, keepdims=True))


def _route(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column("raw").to_pylist()
            lengths = np.array([len(v) for v in raw])
            leaves: list[list[int]] = [[] for _ in raw]
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                if length not in trees:
                    # too rare for the sample: one leaf
                    for r in at.tolist():
                        leaves[r].append(-length)
                    continue
                x = _matrix([raw[r] for r in at])
                for tree in trees[length]:
                    for leaf, rows in route(tree, x):
                        for r in at[rows].tolist():
                            leaves[r].append(leaf)
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("copies"), b.column("raw"), pa.array([sorted(v) for v in leaves], pa.list_(pa.int64()))],
                                             ["cls", "copies", "raw", "leaves"])

    return run


# ---- forests inside large leaves ----------------------------------------------------------------

def _packed(trees: list[tuple]) -> bytes:
    return pickle.dumps([tuple(np.asarray(x) for x in t) for t in trees])


def _leaf_forest(threshold: float) -> Callable:
    """Sampled vectors of one leaf -> its forest; null where the forest doesn't part them."""
    def run(table_: pa.Table) -> pa.Table:
        leaf, n = table_["leaf"][0].as_py(), table_["n"][0].as_py()
        raw = sorted(zip(table_["cls"].to_pylist(), table_["raw"].to_pylist(), strict=True))
        same = len({len(v) for _, v in raw}) == 1  # leaves of rare lengths hold one length too
        trees = [plain(t) for t in forest(_matrix([v for _, v in raw]), n, threshold)[0]] if same else []
        blob = _packed(trees) if any(t[0] >= 0 for t in trees) else None
        return pa.table({"leaf": pa.array([leaf], pa.int64()), "n": pa.array([n], pa.int64()), "trees": pa.array([blob], pa.binary())})

    return run


def _route_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (leaf, part, trees first): each vector's leaves inside its leaf."""
    at, trees = None, []

    def routed(keys: list[int], raw: list[bytes]) -> pa.RecordBatch:
        x = _matrix(raw)
        cls, new = [], []
        for k, tree in enumerate(trees):
            for leaf, rows in route(tree, x):
                # beyond all numbers of the first forests
                name = int.from_bytes(hashlib.blake2b(f"{at}:{k}:{leaf}".encode(), digest_size=8).digest(), "little") >> 2 | 1 << 61
                cls += [keys[i] for i in rows]
                new += [name] * len(rows)
        return pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(new, pa.int64())], ["cls", "leaf"])

    for b in batches:
        keys, raw = [], []
        for leaf, blob, cls, vec in zip(*[b.column(c).to_pylist() for c in ("leaf", "trees", "cls", "raw")], strict=True):
            if blob is not None or leaf != at:
                if keys:
                    yield routed(keys, raw)
                keys, raw = [], []
            if blob is not None:
                at, trees = leaf, pickle.loads(blob)
            else:
                keys.append(cls)
                raw.append(vec)
        if keys:
            yield routed(keys, raw)


def refined(routed: DataFrame, threshold: float) -> DataFrame:
    """``routed`` with leaves of SPLIT vectors or more parted by forests of their own, again and again.

    A leaf's forest is fitted on at most LEAF_SAMPLE of its vectors in one task; a leaf that it doesn't part (a dense group)
    stays.  Its vectors are routed in parts of about ROUTED, so a leaf of any size is spread over tasks.
    """
    done = None
    for _ in range(LEVELS):
        each = routed.select("cls", "raw", F.explode("leaves").alias("leaf"))
        large = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= SPLIT)
        large = stored(large if done is None else large.join(done, "leaf", "left_anti"), "large")
        if large.isEmpty():
            break
        # about four times the sample by a hash, of these the first
        share = F.pmod(F.xxhash64("cls"), F.lit(1 << 20)) / F.lit(float(1 << 20))
        some = each.join(large, "leaf").where(share <= 4 * LEAF_SAMPLE / F.col("n"))
        nth = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("cls"), "cls"))
        sample = some.withColumn("nth", nth).where(F.col("nth") <= LEAF_SAMPLE).select("leaf", "n", "cls", "raw")
        trees = stored(sample.groupBy("leaf").applyInArrow(_leaf_forest(threshold), "leaf long, n long, trees binary"), "leaf-forests")
        whole = trees.where("trees IS NULL").select("leaf")
        done = stored(whole if done is None else done.unionByName(whole), "whole-leaves")
        parted = trees.where("trees IS NOT NULL").withColumn("parts", F.ceil(F.col("n") / ROUTED).cast("int"))
        if parted.isEmpty():
            break
        copies = parted.select("leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "trees", F.lit(None).cast("long").alias("cls"), F.lit(None).cast("binary").alias("raw"))
        dealt = each.join(parted.select("leaf", "parts"), "leaf").select(
            "leaf", F.pmod(F.xxhash64("cls"), "parts").cast("int").alias("part"), F.lit(None).cast("binary").alias("trees"), "cls", "raw")
        rows = copies.unionByName(dealt).withColumn("later", F.col("trees").isNull())
        rows = rows.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "later")
        inner = rows.select("leaf", "trees", "cls", "raw").mapInArrow(_route_leaves, "cls long, leaf long")
        rest = each.select("cls", "leaf").join(parted.select("leaf"), "leaf", "left_anti").select("cls", "leaf")
        lists = rest.unionByName(inner).groupBy("cls").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
        routed = stored(routed.drop("leaves").join(lists, "cls"), "routed")
    return routed


def tile_links(leaf: int, x: np.ndarray, y: np.ndarray, own: list[list[int]], other: list[list[int]], threshold: float, same: bool) -> np.ndarray:
    """Links between two blocks of a leaf, but for pairs that share an earlier leaf."""
    links = x @ y.T >= threshold
    if same:
        np.fill_diagonal(links, False)
    if links.any():
        earlier = {v: i for i, v in enumerate(sorted({v for rows in (own, other) for r in rows for v in r if v < leaf}))}
        if earlier:
            marks = []
            for rows in (own, other):
                m = np.zeros((len(rows), len(earlier)), np.float32)
                for i, r in enumerate(rows):
                    m[i, [earlier[v] for v in r if v < leaf]] = 1
                marks.append(m)
            links &= marks[0] @ marks[1].T < 0.5
    return links


def spanning(links: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) from each row of a symmetric matrix to the smallest key that it reaches."""
    rows = np.flatnonzero(links.any(axis=1))
    part, label = links[np.ix_(rows, rows)], keys[rows].copy()
    while len(rows):
        least = np.minimum(np.where(part, label[None, :], np.iinfo(np.int64).max).min(axis=1), label)
        if (least == label).all():
            break
        label = least
    return keys[rows], label


def _tiles(threshold: float) -> Callable:
    """From rows sorted by tile: links of each class (kind 0) and links that span the tile's components (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

        def rows(key: tuple, held: list[dict]) -> Iterator[pa.RecordBatch]:
            leaf, i, j = key
            sides = [[r for r in held if r["block"] == k] for k in (i, j)]
            if not sides[0] or not sides[1]:
                return
            x, y = (_matrix([r["raw"] for r in s]) for s in sides)
            links = tile_links(leaf, x, y, *([r["leaves"] for r in s] for s in sides), threshold, i == j)
            if not links.any():
                return
            keys, copies = ([np.array([r[c] for r in s], np.int64) for s in sides] for c in ("cls", "copies"))
            count = [(keys[0], links @ copies[1])] + ([(keys[1], links.T @ copies[0])] if i != j else [])
            for k, n in count:
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(k), np.int32)), pa.array(k), pa.array(n.astype(np.int64))], schema=schema)
            if i != j:
                zero = [np.zeros((len(k), len(k)), bool) for k in keys]
                links, keys = np.block([[zero[0], links], [links.T, zero[1]]]), [np.concatenate(keys)]
            a, b = spanning(links, keys[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(a), np.int32)), pa.array(a), pa.array(b)], schema=schema)

        key, held = None, []
        for b in batches:
            for row in b.to_pylist():
                k = (row["leaf"], row["i"], row["j"])
                if k != key:
                    if held:
                        yield from rows(key, held)
                    key, held = k, []
                held.append(row)
        if held:
            yield from rows(key, held)

    return run


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Columns vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding; others unread).

    Vectors that are null, zero, empty, or hold null or non-finite components and rows with a null vec_id link
    with nothing; vectors link with those of their own length only.  Repeated rows are vectors of their own that
    link with each other.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec")).mapInArrow(_raw, "vec_id long, raw binary")
    rows = stored(rows.withColumn("key", F.sha2("raw", 256)), "vectors")
    good = rows.where("vec_id IS NOT NULL AND raw IS NOT NULL")
    classes = stored(good.groupBy("key").agg(F.min("vec_id").alias("cls"), F.count("*").alias("copies"), F.min("raw").alias("raw")), "classes")
    n = classes.count()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    # at most SAMPLE vectors
    sample = classes.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("raw").toPandas()["raw"]
    shared = spark.sparkContext.broadcast(forests([bytes(v) for v in sample], n, threshold))
    routed = stored(classes.select("cls", "copies", "raw").mapInArrow(_route(shared), "cls long, copies long, raw binary, leaves array<long>"), "routed")
    routed = refined(routed, threshold)
    each = routed.select("cls", "copies", "raw", "leaves", F.explode("leaves").alias("leaf"))
    # a row a leaf: vectors x trees / LEAF at most, and unsampled lengths
    sizes = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = each.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
    dealt = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = dealt.select("leaf", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "cls", "copies", "raw", "leaves")
    tiles = tiles.repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")
    found = stored(tiles.mapInArrow(_tiles(threshold), "kind int, a long, b long"), "tiles")
    links = found.where("kind = 0").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("links"))
    label = connected_components(found.where("kind = 1").select("a", "b")).toDF("cls", "label")
    known = classes.select("key", "cls", "copies").join(links, "cls", "left").join(label, "cls", "left").select(
        "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("label", "cls").alias("label"))
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(known, "key", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("label", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"))
