"""Operator 12: the trie of conversation prefixes, by the Euler-tour technique.

A node is a distinct sequence of the first d turns.  It has an enter and an exit arc; each arc's successor follows
from first children, next siblings and parents, so all arcs form one list, the tour.  The list is ranked
(``scan.list_ranks``), and what a node's subtree holds is the difference of two prefix sums at the positions of its
arcs.  So neither depth nor the number of children of a node matters, and no task walks a subtree.

A prefix is known by its depth and two 64-bit hashes, the xor of a hash of (position, turn) over its turns, which
prefix scans give for conversations of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_words, stored, table
from .scan import LAST, list_ranks, scanned

NODE = ["depth", "a", "b"]
EMPTY = hashlib.sha256(b"").hexdigest()
#: Ids that one row of the ends' lists holds at most.
IDS = 4096


def numbered(rows: DataFrame) -> DataFrame:
    """conv_id, i, a, b, words: turns numbered from 0 by ``turn`` (null first; ties by a hash of role and text).

    a and b are hashes of (role, text), null taken as empty; words counts the text's words.  Rows of null conv_id
    belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.where("conv_id IS NOT NULL").select("conv_id", "turn", F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"),
                                                     n_words(text).alias("words"), F.lit(1).cast("long").alias("one"))
    turns = scanned(stored(turns, "turns"), ["conv_id", "turn", "a", "b"], "conv_id", sums=("one",))
    return turns.select("conv_id", (F.col("one_upto") - 1).alias("i"), "a", "b", "words")


def n_shared(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of their block's first: (conv_id, pos, a, b, words, length) and (conv_id, length).

    Conversation c begins with the first h turns of conversation c - c % 20, then goes on with its own after its first h.
    """
    lengths = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "lengths")
    convs = lengths.withColumns({"h": n_shared(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % 20})
    convs = convs.join(lengths.toDF("base", "n_base"), "base", "left").withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv_id", "base", "h", "shared", "length"), "convs")
    own = turns.join(convs, "conv_id").where("i >= h").select("conv_id", (F.col("i") - F.col("h") + F.col("shared")).alias("pos"), "a", "b", "words", "length")
    heads = turns.where("i < 4").withColumnRenamed("conv_id", "base").join(convs, "base").where("i < shared")
    return own.unionByName(heads.select("conv_id", F.col("i").alias("pos"), "a", "b", "words", "length")), convs.select("conv_id", "length")


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they stand, in the form of ``rebuilt``."""
    lengths = stored(turns.groupBy("conv_id").agg(F.count("*").alias("length")), "lengths")
    return turns.withColumnRenamed("i", "pos").join(lengths, "conv_id"), lengths


def _id_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, a, b, conv_id) sorted so -> (depth, a, b, first, ids): ids of a node, comma-joined, up to IDS a row."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        key = [np.asarray(batch.column(c)) for c in NODE]
        new = np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in key])))
        new[::IDS] = True
        starts = np.flatnonzero(new)
        ids = batch.column("conv_id")
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, n).astype(np.int32)), ids.cast(pa.string()))
        yield pa.RecordBatch.from_arrays([*[pa.array(k[starts]) for k in key], ids.take(pa.array(starts)), pc.binary_join(lists, ",")], names=[*NODE, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of ids sorted by node and first id -> SHA-256 of each node's whole list, streamed."""
    node, state = None, None
    for batch in batches:
        out = []
        for depth, a, b, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")], strict=True):
            if (depth, a, b) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, a, b), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digest_rows(out)
    if node is not None:
        yield _digest_rows([(*node, state.hexdigest())])


def _digest_rows(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                      names=[*NODE, "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256 from rows (depth, a, b, conv_id).

    A digest is sequential, so one task takes a node's list; a range sort puts the ids in order first and packs them
    thousands to a row, so that task streams a few rows even where a third of all conversations end.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.repartitionByRange(parts, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    lists = stored(ranged.mapInArrow(_id_lists, "depth long, a long, b long, first long, ids string"), "ends")
    return lists.repartition(parts, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")


def tour(nodes: DataFrame) -> DataFrame:
    """Links (id, next) of the Euler tour of ``nodes`` (id, parent, next_sibling, first_child): arc 2 id enters, 2 id + 1 leaves."""
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    arcs = F.array(F.struct(enter.alias("id"), F.coalesce(F.col("first_child") * 2, leave).alias("next")),
                   F.struct(leave.alias("id"), F.coalesce(F.col("next_sibling") * 2, F.col("parent") * 2 + 1).alias("next")))
    return nodes.select(F.explode(arcs).alias("arc")).select("arc.*")


def trie(turns: DataFrame, convs: DataFrame, last: int = LAST) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: conv_id, pos (0, 1, ... without gaps), a, b, words, length; ``convs``: conv_id, length (0 for turnless ones,
    which are members of the root alone).  Equal conversations share all nodes.  Without conversations there is no node.
    """
    marked = turns.select("conv_id", "pos", "words", (F.col("pos") + 1 == F.col("length")).alias("is_end"), F.xxhash64("pos", "a").alias("a"), F.xxhash64("pos", "b").alias("b"))
    prefixes = scanned(stored(marked, "rebuilt"), ["conv_id", "pos"], "conv_id", xors=("a", "b"))
    prefixes = stored(prefixes.select("conv_id", (F.col("pos") + 1).alias("depth"), "words", "is_end", F.col("a_upto").alias("a"), F.col("b_upto").alias("b"),
                                      F.col("a_upto").bitwiseXOR(F.col("a")).alias("pa"), F.col("b_upto").bitwiseXOR(F.col("b")).alias("pb")), "prefixes")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id", "n_convs", none.alias("pa"), none.alias("pb"), zero.alias("words"))
    inner = prefixes.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
                                        F.min("words").alias("words"))
    nodes = stored(root.unionByName(inner).withColumn("one", F.lit(1).cast("long")), "nodes")
    # numbered by (conv_id, depth): ids of siblings go by their smallest members, and a tour mostly follows the ids
    nodes = stored(scanned(nodes, ["conv_id", "depth"], sums=("one",)).withColumn("id", F.col("one_upto") - 1).drop("one", "one_upto"), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    children = stored(nodes.select("id", "depth", "pa", "pb").join(above, ["depth", "pa", "pb"]).select("id", "parent", "parent_conv_id", F.lit(1).cast("long").alias("one")), "children")
    siblings = stored(scanned(children, ["parent", "id"], "parent", sums=("one",)).withColumnRenamed("one_upto", "k"), "siblings")
    after = siblings.select("parent", (F.col("k") - 1).alias("k"), F.col("id").alias("next_sibling"))
    siblings = siblings.join(after, ["parent", "k"], "left").select("id", "parent", "parent_conv_id", "next_sibling")
    kids = children.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"), F.min("id").alias("first_child"))
    nodes = stored(nodes.join(kids, "id", "left").join(siblings, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "tree")

    ranks = list_ranks(stored(tour(nodes), "tour"), last)
    enters = F.col("arc") % 2 == 0
    values = nodes.select("id", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    arcs = ranks.select("rank", F.col("id").alias("arc"), F.floor(F.col("id") / 2).cast("long").alias("id")).join(values, "id")
    arcs = arcs.select("rank", "arc", "id", *[F.when(enters, F.col(c)).otherwise(0).cast("long").alias(c) for c in ("leaf", "saved")])
    sums = scanned(stored(arcs, "arcs"), ["rank"], sums=("leaf", "saved"))
    within = [F.sum(F.when(enters, F.col(c) - F.col(f"{c}_upto")).otherwise(F.col(f"{c}_upto"))).alias(name) for c, name in (("leaf", "n_leaves"), ("saved", "saved_tokens"))]
    subtrees = sums.groupBy("id").agg(*within)
    ends = prefixes.where("is_end").select(*NODE, "conv_id").unionByName(convs.where("length = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id"))
    out = nodes.join(subtrees, "id").join(ends_digests(stored(ends, "end-rows")), NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def conversation_trie(rows: DataFrame, last: int = LAST) -> DataFrame:
    """The trie of conversations as they stand (conv_id, turn, role, text; further columns aren't read).

    Null roles and texts count as empty, turns go by ``turn`` (null first, ties in a fixed order), repeated rows are
    repeated turns, rows of null conv_id are left out; an empty table has no nodes.
    """
    return trie(*sequences(stored(numbered(rows), "numbered")), last)


def query(spark, sf_dir):
    """The trie of all rebuilt conversations."""
    return trie(*rebuilt(stored(numbered(table(spark, sf_dir, "conversations")), "numbered")))


_CRC = ("xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)), lambda c, x: "
        "list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c, x)), 4294967295), 4294967295)")

ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h, count(*) AS n FROM t GROUP BY conv_id),
s AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS shared FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (
  SELECT s.conv_id, t.i AS pos, t.role, t.text FROM s JOIN t ON t.conv_id = s.base AND t.i < s.shared
  UNION ALL SELECT s.conv_id, t.i - s.h + s.shared, t.role, t.text FROM s JOIN t ON t.conv_id = s.conv_id AND t.i >= s.h),
p AS (
  SELECT s.conv_id, 0 AS depth, 'root' AS node, CAST(NULL AS VARCHAR) AS parent, 0 AS words, NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = s.conv_id) AS is_end FROM s
  UNION ALL
  SELECT conv_id, pos + 1, CAST(pre AS VARCHAR), CASE WHEN pos = 0 THEN 'root' ELSE CAST(pre[:-2] AS VARCHAR) END,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), pos + 1 = n
  FROM (SELECT *, list(sha256(concat(length(role), ':', role, text))) OVER (PARTITION BY conv_id ORDER BY pos) AS pre, count(*) OVER (PARTITION BY conv_id) AS n FROM r)),
nodes AS (
  SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM p GROUP BY node, parent, depth),
kids AS (SELECT n.node, count(k.node) AS n_children FROM nodes n LEFT JOIN nodes k ON k.parent = n.node GROUP BY n.node),
below AS (
  SELECT p.node, sum(CASE WHEN kids.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM nodes n JOIN kids ON kids.node = n.node JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, kids.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN kids ON kids.node = n.node JOIN below ON below.node = n.node LEFT JOIN nodes u ON u.node = n.parent
"""
