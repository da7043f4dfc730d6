import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import hierarchy, statements
from ledgerloom.sources.model import ITEMS_SCHEMA, budget_items


def test_closure_sizes(spark):
    items = budget_items(spark)
    c = hierarchy.closure(items)
    assert c.count() == 87
    leaves = items.filter(~F.col("is_subtotal")).select(F.col("budget_item_id").alias("descendant_id"))
    assert c.join(leaves, "descendant_id", "left_semi").count() == 71
    assert hierarchy.rollup_edges(items).count() == 98
    # item 6 (Interest Expense) rolls into 1 at distance 1; 7 into 1 at distance 2
    rows = {(r.ancestor_id, r.descendant_id): r.distance for r in c.collect()}
    assert rows[(1, 6)] == 1 and rows[(1, 7)] == 2 and rows[(7, 7)] == 0


def _chain(spark, n):
    rows = [(i, f"n{i}", "PL", "Income", None, i - 1 if i > 1 else None, i, i < n, 1) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, ITEMS_SCHEMA)


def test_deep_trees_are_walked_to_the_root(spark):
    assert hierarchy.closure(_chain(spark, 40)).count() == 40 * 41 // 2
    flat = {r.budget_item_id: r for r in hierarchy.flatten(_chain(spark, 4)).collect()}
    assert (flat[4].level1, flat[4].level4, flat[4].depth) == ("n1", "n4", 4)
    assert flat[2].level4 == "n2"


def test_a_cycle_fails(spark):
    rows = [(1, "a", "PL", "Income", None, 2, 1, True, 1), (2, "b", "PL", "Income", None, 1, 2, False, 1)]
    with pytest.raises(Exception, match="cycle"):
        hierarchy.closure(spark.createDataFrame(rows, ITEMS_SCHEMA)).collect()


def test_flatten_repeats_last_name(spark):
    flat = {r.budget_item_id: r for r in hierarchy.flatten(budget_items(spark)).collect()}
    assert flat[18].depth == 1 and flat[18].level3 == "Provision for Loan Losses"
    assert flat[7].level1 == "Net Interest Income" and flat[7].level2 == "Interest Expense"
    assert flat[7].path == "Net Interest Income > Interest Expense > Interest Expense on Deposits"


def _mini_tree(spark):
    rows = [
        (1, "Root income", "PL", "Income", None, None, 10, True, 1),
        (2, "Branch", "PL", "Income", None, 1, 11, True, 1),
        (3, "Leaf a", "PL", "Income", None, 2, 12, False, 1),
        (4, "Cost node", "PL", "Expense", None, 1, 13, True, -1),   # sign flip under a + parent
        (5, "Leaf cost", "PL", "Expense", None, 4, 14, False, -1),
        (6, "Root leaf", "PL", "Expense", None, None, 51, False, -1),  # root that is a leaf (like tax)
        (19, "PBT", "PL", "Subtotal", None, None, 50, True, 1),        # formula node, no children
        (21, "Net", "PL", "Subtotal", None, None, 52, True, 1),
    ]
    return spark.createDataFrame(rows, ITEMS_SCHEMA)


def test_statement_signs_and_formulas(spark):
    items = _mini_tree(spark)
    fact = spark.createDataFrame(
        [(3, Decimal("100.00")), (5, Decimal("30.00")), (6, Decimal("5.00"))],
        "budget_item_id int, amount_eur decimal(22,2)").withColumn("k", F.lit(1))
    lines = {r.budget_item_id: r for r in statements.statement(fact, items, "PL", ["k"]).collect()}
    assert lines[1].signed == Decimal("70.00") and lines[1].display == Decimal("70.00")
    assert lines[4].signed == Decimal("-30.00") and lines[4].display == Decimal("30.00")
    assert lines[6].display == Decimal("5.00")
    assert lines[19].signed == Decimal("70.00")  # leaves with sort_order < 50
    assert lines[21].signed == Decimal("65.00")  # leaves with sort_order < 52


def _up(parents, node):
    out = []
    while node is not None:
        out.append(node)
        node = parents[node]
    return out


def test_closure_of_a_large_deep_tree(spark):
    r = random.Random(7)
    n, depth = 100_000, 60
    layer = n // depth
    # layers of a tree; a third of every layer hangs on one node
    parents = {i: None if i < layer else ((i // layer - 1) * layer + (0 if i % 3 == 0 else r.randrange(layer))) for i in range(layer * depth)}
    tree = spark.createDataFrame(list(parents.items()), "node long, parent long")
    got = hierarchy.tree_closure(tree).groupBy("descendant_id").agg(F.count("*"), F.sum("ancestor_id"), F.max("distance")).collect()
    want = {}
    for i in parents:  # parents come before their children
        c, total, d = want[parents[i]] if parents[i] is not None else (0, 0, -1)
        want[i] = (c + 1, total + i, d + 1)
    assert {row[0]: tuple(row[1:]) for row in got} == want
    assert max(d for _, _, d in want.values()) == depth - 1


def test_tree_closure_of_odd_trees(spark):
    def closed(rows):
        pairs = hierarchy.tree_closure(spark.createDataFrame(rows, "node long, parent long")).collect()
        return {(p.ancestor_id, p.descendant_id): p.distance for p in pairs}

    assert closed([]) == {}
    assert closed([(1, None), (2, 1), (3, 99), (None, 1)]) == {(1, 1): 0, (2, 2): 0, (1, 2): 1, (3, 3): 0}  # 99 is no node
    chain = {i: i - 1 if i else None for i in range(130)}
    assert closed(list(chain.items())) == {(a, i): d for i in chain for d, a in enumerate(_up(chain, i))}
    for cycle in ([(1, 1)], [(1, 2), (2, 3), (3, 1), (4, None)]):
        with pytest.raises(ValueError, match="cycle"):
            closed(cycle)
    with pytest.raises(ValueError, match="twice"):
        closed([(1, None), (1, None)])


def test_flatten_with_given_levels(spark):
    items = _chain(spark, 5)
    flat = {r.budget_item_id: r for r in hierarchy.flatten(items, hierarchy.tree_closure(items, "budget_item_id", "parent_item_id"), 3).collect()}
    assert (flat[5].level3, flat[5].path, flat[1].level3) == ("n3", "n1 > n2 > n3 > n4 > n5", "n1")
