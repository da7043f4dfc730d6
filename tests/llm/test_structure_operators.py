"""Operators 11 to 13, prefix scans and list ranking, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import line_dedup, periodic, prefix_trie, scan

SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11: line dedup ------------------------------------------------------------------------------

def plain_lines(rows, min_docs=3, min_chars=20):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(SPACE).translate(lower)
    holders = defaultdict(set)
    order = lambda i: float("-inf") if i is None else i
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)], key=order) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows():
    r = random.Random(3)
    common = [f"This is the Common line number {k} of the corpus" for k in range(6)] + ["é" * 20, "É" * 20, "x" * 19, "Y" * 20 + " \r"]
    rows = [(i, "\n".join(r.choice(common + [f"own line {i} {k}, long enough to count"]) for k in range(r.randint(0, 6)))) for i in range(60)]
    hot = "  A line that a third of all documents hold\t"
    rows += [(100 + i, f"{hot}\nrest {i}\n{hot.strip().upper()}") for i in range(40)]
    rows += [(7, rows[7][1]), (7, "other text\n" + common[0]), (None, common[1]), (None, common[1] + "\n" + common[2]), (200, None), (201, ""), (202, "\n\n"),
             (203, "\n".join(common * 3000)), (-5, common[3]), (300, "twice only, in two documents"), (301, "Twice only, in two documents")]
    return rows


def got_lines(df):
    return sorted(((r.doc_id, r.out.n_lines, r.out.n_dropped, r.out.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("batches", [1, 5, 11])
def test_lines_equal_plain(spark, batches):
    rows = line_rows()
    d = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, lines string, positions int")
    out = line_dedup.deduplicated(d, batches=batches, name="out")
    assert out.columns == ["doc_id", "text", "lines", "positions", "out"]
    assert got_lines(out) == plain_lines(rows)
    replaced = line_dedup.deduplicated(d, min_docs=2, min_chars=5, batches=2)
    assert sorted(replaced.columns) == ["doc_id", "lines", "positions", "text"]
    assert got_lines(replaced.withColumnRenamed("lines", "out")) == plain_lines(rows, 2, 5)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_are_compacted_by_levels(spark):
    store = line_dedup.RunStore(spark, fanout=3)
    for k in range(10):
        store.add(spark.range(k, 50 + k).selectExpr("id h1", "-id h2", "cast(1 as long) n", f"cast({-k} as long) least", f"cast({-k} as long) greatest"))
    assert [len(x) for x in store.levels] == [1, 0, 1]  # ten batches, two runs
    batch = spark.range(0, 100).selectExpr("id h1", "-id h2", "cast(1 as long) n", "cast(-99 as long) least", "cast(-99 as long) greatest")
    got = {r.h1: (r.known_n, r.known_least, r.known_greatest) for r in store.merged(batch).collect()}
    for key in range(100):
        held = [-k for k in range(10) if k <= key < 50 + k]
        assert got[key] == ((len(held), min(held), max(held)) if held else (0, None, None))
    # the runs lie in buckets: the merge moves the batch alone
    names = [n for level in store.levels for n in level]
    plan = spark.table(names[0]).join(spark.table(names[1]).hint("merge"), line_dedup.KEY)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    store.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_common_keys_leave_the_later_batches(spark):
    store = line_dedup.RunStore(spark)
    lines = lambda ids: spark.createDataFrame([(i, 1, 2) for i in ids], "doc long, h1 long, h2 long")
    assert line_dedup.ingest(store, lines([9, 9, 8]), 3).count() == 0
    assert line_dedup.ingest(store, lines([7]), 3).collect()[0].keeper == 9
    assert line_dedup.ingest(store, lines([6, 5]), 3).count() == 0
    assert sum(spark.table(n).agg(F.sum("n")).first()[0] or 0 for level in store.levels for n in level) == 3
    store.close()


# ---- scans and list ranking ----------------------------------------------------------------------

def test_scans_over_tasks(spark):
    r = random.Random(1)
    rows = [(r.choice([1, 1, 1, 2, 5, 9]), i, r.getrandbits(48) - (1 << 47), r.getrandbits(64) - (1 << 63)) for i in range(3000)]
    d = spark.createDataFrame(rows, "g long, i long, v long, x long").repartition(3)
    for group in ("g", None):
        got = scan.scanned(d, ["g", "i"] if group else ["i"], group, sums=("v",), xors=("x",)).collect()
        assert len(got) == len(rows)
        total, xor = defaultdict(int), defaultdict(int)
        for row in sorted(got, key=lambda r: (r.g, r.i) if group else r.i):
            g = row.g if group else 0
            total[g] += row.v
            xor[g] ^= row.x
            assert row.v_upto == total[g] and row.x_upto == xor[g]
    assert scan.scanned(d.limit(0), ["i"], sums=("v",)).count() == 0


@pytest.mark.parametrize("n,last", [(1, 1), (2, 1), (700, 5), (700, 10_000)])
def test_list_ranks(spark, n, last):
    ids = list(range(n))
    random.Random(n).shuffle(ids)
    links = spark.createDataFrame([(a, b) for a, b in zip(ids, [*ids[1:], None], strict=True)], "id long, next long")
    got = {r.id: r.rank for r in scan.list_ranks(links, last).collect()}
    assert got == {x: k for k, x in enumerate(ids)}


# ---- 12: prefix trie -----------------------------------------------------------------------------

def plain_trie(convs):
    """Nodes of {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    out = {}
    for node, ids in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:len(x)] == x and len(y) > len(x) for y in below)]
        saved = sum((len(members[x]) - 1) * len(re.findall(WORD, x[-1][1])) for x in below if x)
        ends = [c for c in ids if len(convs[c]) == len(node)]
        out[ids[0], len(node)] = (members[node[:-1]][0] if node else None, len(ids), len(kids), len(leaves), saved, sha(",".join(map(str, ends))))
    return out


def got_trie(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def conversations():
    r = random.Random(5)
    convs = {}
    for c in [*range(0, 95), 400, 1000, 1001, 1019, 77777]:
        convs[c] = [(r.choice(["user", "assistant"]), r.choice(["a b", "hello  there", "", "x\ty z"])) for _ in range(r.randint(1, 6))]
    for c in range(500, 560):
        convs[c] = [("user", "the same start"), ("assistant", "yes"), ("user", f"{c % 7}")]
    for c in range(600, 640):
        convs[c] = [("user", "the same start")]
    for c in range(2001, 2020):
        convs[c] = [("user", "without the first of its block")]
    convs[701] = [("user", f"turn {k % 3}") for k in range(300)]
    return convs


def conversation_rows(convs):
    return [(c, None if k == 0 and c % 3 == 0 else k, role or None, text or None, "x", c) for c, turns in convs.items() for k, (role, text) in enumerate(turns)]


SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs long"


@pytest.mark.parametrize("last", [1, 40, 10_000])
def test_trie_equals_plain(spark, last):
    convs = conversations()
    rows = conversation_rows(convs)
    rows += [(None, 0, "user", "no conversation", "x", 0)]
    random.Random(2).shuffle(rows)
    assert got_trie(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), last)) == plain_trie(convs)


def plain_rebuilt(convs):
    out = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + convs[c][h:]
    return out


def test_trie_query_on_rebuilt_conversations(spark, tmp_path):
    convs = conversations()
    spark.createDataFrame(conversation_rows(convs), SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    built = plain_rebuilt(convs)
    assert any(not x for x in built.values())  # some lose all their turns
    assert got_trie(prefix_trie.query(spark, str(tmp_path))) == plain_trie(built)


def test_trie_of_nothing_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.conversation_trie(empty).count() == 0
    assert prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(empty))).count() == 0
    twice = spark.createDataFrame([(3, 0, "user", "a b", "", 0)] * 2, SCHEMA)
    assert got_trie(prefix_trie.conversation_trie(twice)) == plain_trie({3: [("user", "a b")] * 2})


def test_ends_digests_stream_long_lists(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = [(1, 2, 3, i * 7 % 1009 - 500) for i in range(1000)] + [(1, 2, 4, 5), (0, 0, 0, -1)]
    got = {(r.depth, r.a, r.b): r.ends_sha256 for r in prefix_trie.ends_digests(spark.createDataFrame(rows, "depth long, a long, b long, conv_id long")).collect()}
    assert got == {(1, 2, 3): sha(",".join(map(str, sorted(r[3] for r in rows[:1000])))), (1, 2, 4): sha("5"), (0, 0, 0): sha("-1")}


# ---- 13: periodic runs ---------------------------------------------------------------------------

def plain_runs(x):
    out = []
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(12, 2 * q):
                w = x[i:i + n]
                if min(p for p in range(1, n + 1) if w[p:] == w[:n - p]) == q:
                    out.append((i, n, q))
            i = j + 1
    return sorted(out)


def repeating(r, n, kinds):
    x = [r.randrange(kinds) for _ in range(n)]
    for _ in range(r.randint(0, 4)):
        a = r.randrange(n)
        p = r.randint(1, max(1, (n - a) // 2))
        for i in range(a, r.randint(a, n)):
            x[i] = x[a + (i - a) % p]
    return [f"w{v}" for v in x]


def plain_collapsed(x, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(x) if i not in gone)


def test_runs_equal_plain():
    r = random.Random(9)
    for _ in range(1500):
        x = repeating(r, r.randint(1, 70), r.choice([1, 2, 3, 5, 30]))
        runs, collapsed = periodic.periodic_runs(" ".join(x))
        assert runs == plain_runs(x) and collapsed == plain_collapsed(x, runs)


def test_long_texts_and_fibonacci_words():
    a, b = ["a"], ["a", "b"]
    for _ in range(8):
        a, b = b, b + a
    assert periodic.periodic_runs(" ".join(b))[0] == plain_runs(b)
    assert periodic.periodic_runs("w " * 200_000) == ([(0, 200_000, 1)], "w")
    block = [f"v{i}" for i in range(700)]
    assert periodic.periodic_runs(" ".join(["start", *block * 30, "end"]))[0] == [(1, 21_000, 700)]
    x = np.random.default_rng(0).integers(0, 2, 3000).tolist()
    assert periodic.periodic_runs(" ".join(map(str, x)))[0] == plain_runs(x)


def test_segments_split_at_rare_words():
    ids = np.array([0, 1] * 10 + [2] + [3, 4, 3, 4, 3, 4] + [5] + [0, 6] * 8)
    assert periodic.split_rare(ids) == [(0, 20), (28, 44)]
    assert periodic.split_rare(np.arange(50)) == [] and periodic.split_rare(np.zeros(0, np.int64)) == []


TEXTS = [None, "", " \t\n", "a b " * 20, "x" + " y z" * 9 + "  q", "é é " * 13, "w\x00 " * 12, "only some words"]


def test_runs_query(spark, tmp_path):
    r = random.Random(4)
    texts = TEXTS + [" ".join(repeating(r, r.randint(1, 60), 6)) for _ in range(80)] + [" ".join(f"u{k}" for k in range(400))] * 30
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "a b " * 20, "z"), (3, texts[3], "z"), (3, "other", "z")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(x) for x in periodic.query(spark, str(tmp_path)).collect()), key=repr)
    want, planted = [], 0
    for i, t, _ in rows:
        x = re.findall(WORD, t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and x:
            n, g = len(x), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = [x[j] if j < a else x[a + (j - a) % p] for j in range(n)]
            planted += 1
        runs = plain_runs(x)
        best = max(runs, key=lambda v: (v[1], -v[0], -v[2]), default=(None, None, None))
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(plain_collapsed(x, runs))))
    assert planted > 5 and got == sorted(want, key=repr)


def test_runs_keep_other_columns(spark):
    d = spark.createDataFrame([(1, "a " * 20, "own", 2)], "doc_id long, text string, periodic string, row int")
    out = periodic.with_runs(d, F.col("text"))
    assert out.columns == ["doc_id", "text", "row", "periodic"]
    got = out.first()
    assert got.row == 2 and got.periodic.collapsed == "a" and [tuple(x) for x in got.periodic.runs] == [(0, 20, 1)]
    assert periodic.with_runs(d.limit(0), F.col("text")).count() == 0
