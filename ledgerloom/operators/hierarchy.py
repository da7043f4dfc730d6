"""Chart-of-accounts hierarchy: closure, flattening, roll-up edges and signs.

The tree is a bounded dimension (dozens of nodes), so the closure and the
roll-up edge list are tiny and always broadcast; the fact side is aggregated
to leaf level *before* it meets them (Catalyst does not reorder an aggregate
below a many-to-many join on its own, so the plan is written that way).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from ..sources import fixed


_NO_PARENT = -2147483648  # sentinel: no parent (NULLs inside long lambdas are avoided)


def closure(items: DataFrame) -> DataFrame:
    """(ancestor_id, descendant_id, distance) for every ancestor-or-self pair, at any depth.

    The chart of accounts is a bounded dimension: its parent map is gathered
    into one map value, broadcast to every item, and each item's ancestor
    chain is walked with a higher-order ``aggregate`` until no parent is left —
    two small stages, no per-level job.  A chain cannot be longer than the
    number of items; one that still has a parent then is a cycle, which fails.
    """
    none = F.lit(_NO_PARENT)
    pm = items.agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("budget_item_id").cast("int"),
        F.coalesce(F.col("parent_item_id").cast("int"), none)))).alias("pm"))
    it = items.select(F.col("budget_item_id").cast("int").alias("descendant_id")).crossJoin(F.broadcast(pm))

    def step(acc, _):
        last = F.element_at(acc, -1)
        nxt = F.coalesce(F.try_element_at(F.col("pm"), last), none)
        return F.when(last == none, acc).otherwise(F.concat(acc, F.array(nxt)))

    chain = F.aggregate(F.sequence(F.lit(1), F.size("pm")), F.array(F.col("descendant_id")), step)
    guard = F.when(F.element_at(F.col("chain"), -1) != none, F.raise_error(F.lit("account tree has a cycle")))
    return (it.select("descendant_id", chain.alias("chain"))
            .select("descendant_id", F.posexplode("chain").alias("distance", "ancestor_id"),
                    guard.alias("_guard"))
            .filter((F.col("ancestor_id") != none) & F.col("_guard").isNull())
            .select(F.col("ancestor_id").cast("int").alias("ancestor_id"),
                    "descendant_id", F.col("distance").cast("int").alias("distance")))


def tree_closure(tree: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(ancestor_id, descendant_id, distance) for every ancestor-or-self pair of a tree given as a table.

    Pointer doubling: after k rounds every node has its ancestors up to distance 2^k - 1 and a jump of 2^k; one join adds
    the ancestors beyond, one doubles the jumps.  So a tree of any size takes log2(depth) rounds of joins on
    stored tables, and nothing is gathered in one row.  A node that is its own ancestor and a node given twice raise
    ValueError; a parent that is no node ends the chain, like NULL.
    """
    nodes = written(tree.select(F.col(node).alias("node"), F.col(parent).alias("to")), "tree")
    n, distinct = nodes.agg(F.count("node"), F.count_distinct("node")).first()
    if n != distinct:
        raise ValueError("a node is given twice")
    jump = written(nodes.where("to IS NOT NULL").join(nodes.select(F.col("node").alias("to")), "to", "left_semi").select("node", "to"), "jump")
    pairs = nodes.where("node IS NOT NULL").select(F.col("node").alias("descendant_id"), F.col("node").alias("ancestor_id"), F.lit(0).alias("distance"))
    span = 1
    while not jump.isEmpty():
        if span > n:  # a jump of more steps than there are nodes
            raise ValueError("the tree has a cycle")
        steps = jump.toDF("ancestor_id", "to")
        further = pairs.join(steps, "ancestor_id").select("descendant_id", F.col("to").alias("ancestor_id"), (F.col("distance") + span).alias("distance"))
        pairs = written(pairs.unionByName(further), "closure")
        jump = written(jump.join(jump.toDF("to", "next"), "to").select("node", F.col("next").alias("to")), "jump")
        span *= 2
    return pairs.select("ancestor_id", "descendant_id", "distance")


def formula_edges(items: DataFrame, formulas=fixed.FORMULA_NODES) -> DataFrame:
    """(node_id, leaf_id) for formula subtotals: P&L leaves with sort_order below the bound."""
    spark = items.sparkSession
    f = spark.createDataFrame(formulas, "node_id int, bound int")
    leaves = items.filter((F.col("statement_type") == "PL") & ~F.col("is_subtotal"))
    return (leaves.join(F.broadcast(f), F.col("sort_order") < F.col("bound"))
            .select("node_id", F.col("budget_item_id").alias("leaf_id")))


def rollup_edges(items: DataFrame, with_formulas: bool = True) -> DataFrame:
    """(node_id, leaf_id, leaf_sign): every node each posting leaf contributes to.

    Tree edges come from the closure (descendant is a leaf); formula nodes
    without children get their leaves appended, so one aggregate yields every
    statement line.
    """
    leaves = items.filter(~F.col("is_subtotal")).select(
        F.col("budget_item_id").alias("leaf_id"), F.col("sign_convention").alias("leaf_sign"))
    tree = (closure(items).join(leaves, F.col("descendant_id") == F.col("leaf_id"))
            .select(F.col("ancestor_id").alias("node_id"), "leaf_id"))
    edges = tree.unionByName(formula_edges(items)) if with_formulas else tree
    return edges.join(leaves, "leaf_id").select("node_id", "leaf_id", "leaf_sign")


_EDGE_CACHE: dict = {}


def cached_edges(items: DataFrame, with_formulas: bool = True) -> DataFrame:
    """``rollup_edges`` memoized per (items DataFrame, formulas) and cached: the edge list is
    bounded by the chart of accounts and reused by every statement of a session.
    A cached block that is lost is recomputed from its lineage.  Lists of sessions that have ended are let go."""
    for old in [k for k, (kept, _) in _EDGE_CACHE.items() if kept.sparkSession is not items.sparkSession]:
        del _EDGE_CACHE[old]
    key = (id(items), with_formulas)
    hit = _EDGE_CACHE.get(key)
    if hit is None or hit[0] is not items:
        hit = (items, rollup_edges(items, with_formulas).cache())
        _EDGE_CACHE[key] = hit
    return hit[1]


def flatten(items: DataFrame, pairs: DataFrame | None = None, levels: int | None = None) -> DataFrame:
    """Ragged tree to level1..levelN names, path and depth, from its closure ``pairs``.

    Short branches repeat their last name in the deeper levels; deeper branches than ``levels`` keep their whole path.
    Without ``levels`` the depth of the tree is looked up first.
    """
    c = closure(items) if pairs is None else pairs
    if levels is None:
        levels = (c.agg(F.max("distance")).first()[0] or 0) + 1
    names = items.select(F.col("budget_item_id").alias("ancestor_id"), F.col("item_name").alias("anc_name"))
    chain = F.reverse(F.array_sort(F.collect_list(F.struct("distance", "anc_name"))))  # root first
    agg = (c.join(names, "ancestor_id").groupBy("descendant_id").agg(chain.alias("chain"))
           .withColumn("names", F.transform("chain", lambda s: s["anc_name"])))
    return agg.select(
        F.col("descendant_id").alias("budget_item_id"),
        F.size("names").alias("depth"),
        *[F.element_at("names", F.least(F.lit(i), F.size("names"))).alias(f"level{i}") for i in range(1, levels + 1)],
        F.array_join("names", " > ").alias("path"))


def signed(amount: Column, sign: Column) -> Column:
    """``amount * sign_convention`` for a sign of +1/-1 (no decimal widening)."""
    return F.when(sign < 0, -amount).otherwise(amount)
