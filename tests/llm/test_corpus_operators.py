"""Operators 3, 6, 7, 8, 9 and the pipeline on small corpora, against plain Python."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import embedding_dedup, jaccard_join, mixing, packing, pii, token_files, toxicity
from ledgerloom.llm.common import n_words
from ledgerloom.llm.components import connected_components

SF = "/root/testdata/sf0.001"


class Sets(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame([*chain, *star, (-5, -5), (7, None)], "a long, b long")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(50)} | {-5: -5}
    assert connected_components(edges.limit(0)).count() == 0


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def plain_components(rows, k, percent):
    sets, parts = {i: shingles(t, k) for i, t in rows}, Sets()
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            parts.join(a, b)
    return {i: (len(s), parts.find(i)) for i, s in sets.items()}


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        base = list(rng.choice(words, rng.integers(5, 120)))
        for _ in range(rng.integers(1, 7)):
            own = list(base)
            for _ in range(rng.integers(0, 6)):
                own[rng.integers(len(own))] = str(rng.choice(words))
            rows.append(" ".join(own))
    passage = " ".join(rng.choice(words, 60))
    rows += [" ".join(rng.choice(words, 20)) + " " + passage for _ in range(15)]
    rows += ["", None, " \n", "A b", "a B", "a b", "one two three", passage.upper(), passage, "long " * 5000]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("limits", [{}, {"REGION_WEIGHT": 50, "MAX_ROUNDS": 3}, {"REGION_WEIGHT": 80, "MAX_ROUNDS": 1, "RUN": 2, "PIVOTS": 2},
                                    {"REGION_WEIGHT": 60, "RUN": 2, "PIVOTS": 3, "COPIES": 100}, {"REGION_WEIGHT": 60, "RUN": 2, "PIVOTS": 5, "COPIES": 0}])
def test_jaccard_join_is_exact(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(jaccard_join, k, v)
    rounds, plain_round = [], jaccard_join._round
    monkeypatch.setattr(jaccard_join, "_round", lambda *a: rounds.append(1) or plain_round(*a))
    rows = corpus()
    d = spark.createDataFrame([(i, t, "x", 9) for i, t in rows], "doc_id long, text string, cls string, n int")
    for k, percent in ((4, 85), (5, 80))[: 1 if limits else 2]:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(d, k, percent).collect()}
        assert got == plain_components(rows, k, percent)
    assert bool(rounds) == bool(limits)


def test_jaccard_join_parts_regions_that_common_passages_connect(spark, monkeypatch):
    """Documents that share passages only: no task counts a shingle twice, so the first order knows none of the passages."""
    monkeypatch.setattr(jaccard_join, "COUNT_BLOCK", 1)
    monkeypatch.setattr(jaccard_join, "RUN", 2)
    monkeypatch.setattr(jaccard_join, "REGION_WEIGHT", 1000)
    monkeypatch.setattr(jaccard_join, "PART_WEIGHT", 1000)
    rounds, plain_round = [], jaccard_join._round
    monkeypatch.setattr(jaccard_join, "_round", lambda *a: rounds.append(1) or plain_round(*a))
    rng = np.random.default_rng(12)
    passages = [" ".join(f"p{i}w{j}" for j in range(15)) for i in range(6)]
    rows = []
    for i in range(120):
        own = [f"d{i}w{j}" for j in range(40)]
        rows.append((i, " ".join([*own[:20], passages[rng.integers(6)], *own[20:], passages[rng.integers(6)]])))
    rows += [(200 + i, rows[i][1] + " end") for i in range(10)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(d, 4, 85).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_components(rows, 4, 85)
    assert got[200][1] == 0 and len({c for _, c in got.values()}) == 120
    assert not rounds


def test_stage_parts_regions_that_common_passages_connect(spark, monkeypatch):
    for name, value in (("COUNT_BLOCK", 1), ("RUN", 2), ("REGION_WEIGHT", 1000), ("PART_WEIGHT", 1000)):
        monkeypatch.setattr(jaccard_join, name, value)
    monkeypatch.setattr(jaccard_join, "_round", lambda *a: pytest.fail("a large region is left"))
    rows = [(i, " ".join([*[f"d{i}w{j}" for j in range(50)], *[f"p{i % 2}w{j}" for j in range(25)]])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(5)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        got = sorted(r.doc_id for r in jaccard_join.stage(spark, d, SF).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == list(range(60))


def test_jaccard_join_brings_a_table_of_fixed_size_to_the_driver(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i // 2}x{j}" for j in range(60))) for i in range(40)]  # 20 x 57 shingles, all seen twice
    d = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    brought, frame = [], type(d)
    for name in ("collect", "toPandas"):
        monkeypatch.setattr(frame, name, lambda self, plain=getattr(frame, name): (lambda x: brought.append(len(x)) or x)(plain(self)))
    out = jaccard_join.jaccard_components(d, 4, 85)
    monkeypatch.undo()
    assert max(brought, default=0) <= 256
    assert {r.doc_id: r.component_id for r in out.collect()} == {i: i // 2 * 2 for i in range(40)}


def test_levels_of_shingles(spark):
    rng = np.random.default_rng(4)
    keys, counts = rng.integers(-2**63, 2**63, 5000), (1 / (rng.random(5000) + 1e-9)).astype(np.int64) + 1
    keys[:1000] = keys[1000:2000] ^ 1  # the same slots
    want = np.zeros(1 << 24, np.int64)
    np.maximum.at(want, (keys.view(np.uint64) >> np.uint64(40)).astype(np.int64), np.where(counts >= 4, np.minimum(255, np.floor(8 * np.log2(counts) + 1e-9) - 15), 0).astype(np.int64))
    got = jaccard_join._levels(spark.createDataFrame(list(zip(keys.tolist(), counts.tolist(), strict=True)), "key long, n long").repartition(3))
    assert got.dtype == np.uint8 and np.abs(got - want).max() <= 1 and ((got > 0) == (want > 0)).all()


@pytest.mark.parametrize("n_inner", [1, 7, 40])
def test_regions_connect_what_links_connect(n_inner):
    rng = np.random.default_rng(n_inner)
    bases = [rng.choice(3000, 60, replace=False) for _ in range(4)]
    sets = []
    for _ in range(40):
        s = set(bases[rng.integers(4)].tolist()) - set(rng.choice(3000, 150).tolist())
        sets.append(np.array(sorted(s | set(rng.choice(3000, rng.integers(0, 8)).tolist())), np.uint64))
    want, got = Sets(), Sets()
    for i in range(n_inner, 40):
        want.join(n_inner, i)
        got.join(n_inner, i)
    for a, b in itertools.combinations(range(40), 2):
        x, y = set(sets[a].tolist()), set(sets[b].tolist())
        if a < n_inner and 100 * len(x & y) >= 80 * len(x | y):
            want.join(a, b)
    for a, b in jaccard_join.join_region(list(range(40)), sets, n_inner, 80):
        got.join(a, b)
    assert [got.find(i) for i in range(40)] == [want.find(i) for i in range(40)]


def test_jaccard_join_of_odd_rows(spark):
    d = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(d, 4, 85).collect()), key=repr)
    assert got == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (None, 2, None)]
    assert jaccard_join.jaccard_components(d.limit(0), 4, 85).count() == 0
    assert sorted(r.doc_id or 0 for r in jaccard_join.stage(spark, d, SF).collect()) == [0, 1, 2]


def test_embedding_forest_finds_near_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 32))
    for i in range(0, 300):
        x[i + 300] = x[i] + rng.standard_normal(32) * 0.1
    x[600:900] = x[0] + rng.standard_normal((300, 32)) * 0.05  # one dense group
    x[1000] = x[1001]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    parts = Sets()
    for a, b in zip(*np.nonzero(link), strict=True):
        parts.join(int(a), int(b))
    odd = [(5000, None), (5001, []), (5002, [0.0] * 32), (5003, [float("nan")] * 32), (5004, [None] * 32), (5005, [1.0, 2.0]), (None, [1.0] * 32)]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + odd
    d = spark.createDataFrame([(i, v, "l") for i, v in rows], "vec_id long, embedding array<double>, links string")
    got = {r.vec_id: r for r in embedding_dedup.embedding_links(d).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links <= link[i].sum() for i in range(1500))
    assert sum(got[i].n_links for i in range(1500)) >= 0.9 * link.sum()
    assert np.mean([got[i].component_id == parts.find(i) for i in range(1500)]) > 0.95
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in odd if i is not None)
    assert got[None].n_links == 0 and got[1000].n_links >= 1
    assert embedding_dedup.embedding_links(d.limit(0)).count() == 0


@pytest.mark.parametrize("typical", [0.985, 0.955, 0.93])
def test_embedding_recall_in_dense_groups(spark, monkeypatch, typical):
    """A third of the rows in one group; the forest is fitted on a tenth of them, with small leaves."""
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 400)
    monkeypatch.setattr(embedding_dedup, "LEAF", 16)
    rng = np.random.default_rng(11)
    x = embedding_dedup.unit(rng.standard_normal((4000, 64)))
    x[::3] = embedding_dedup.unit(x[1] + np.sqrt(1 / typical - 1) * x[::3])
    link = embedding_dedup.unit(x) @ embedding_dedup.unit(x).T >= 0.95
    np.fill_diagonal(link, False)
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.embedding_links(d).collect()}
    assert all(got[i] <= n for i, n in enumerate(link.sum(axis=1)))
    assert sum(got.values()) >= 0.98 * link.sum() > 0


def test_large_leaves_get_forests_of_their_own(spark, monkeypatch):
    """Comparisons grow about linearly with the vectors, with a forest fitted on few of them; recall stays."""
    for k, v in {"SAMPLE": 320, "LEAF": 32, "SPLIT": 128, "LEAF_SAMPLE": 300, "ROUTED": 500, "MISSED": 0.02}.items():
        monkeypatch.setattr(embedding_dedup, k, v)
    work, recall = [], []
    for n in (2000, 8000):
        rng = np.random.default_rng(n)
        x = rng.standard_normal((n, 24))
        x[n // 2:] = x[:n // 2] + rng.standard_normal((n // 2, 24)) * 0.15
        x[:n // 10] = x[0] + rng.standard_normal((n // 10, 24)) * 0.05  # a dense group, of which all pairs link
        u = embedding_dedup.unit(x)
        link = u @ u.T >= 0.95
        np.fill_diagonal(link, False)
        d = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        compared, plain_refined = [], embedding_dedup.refined
        monkeypatch.setattr(embedding_dedup, "refined", lambda *a: compared.append(plain_refined(*a)) or compared[-1])
        got = {r.vec_id: r.n_links for r in embedding_dedup.embedding_links(d).collect()}
        monkeypatch.setattr(embedding_dedup, "refined", plain_refined)
        sizes = [r["count"] for r in compared[0].select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()]
        assert all(got[i] <= k for i, k in enumerate(link.sum(axis=1)))
        recall.append(sum(got.values()) / link.sum())
        work.append(sum(k * k for k in sizes if k < n // 12))
    assert min(recall) >= 0.95
    assert work[1] < 8 * work[0]  # four times the vectors: sixteen times if quadratic


def test_vectors_of_several_lengths_link(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 20)
    x = np.random.default_rng(2).standard_normal((60, 16)).tolist()
    rows = [*x, [1.0, 2.0], [1.0, 2.01], [2.0, -1.0], [1.0, 2.0, 0.0], [1.0, 2.0, 0.1], x[0]]
    d = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_links(d).collect()}
    assert [got[i] for i in range(60, 66)] == [(1, 60), (1, 60), (0, 62), (1, 63), (1, 63), (1, 0)]
    assert got[0] == (1, 0) and got[1] == (0, 1)


def test_large_leaves_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    x = np.random.default_rng(1).standard_normal((200, 8)) * 0.02 + 1
    d = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    assert {(r.n_links, r.component_id) for r in embedding_dedup.embedding_links(d).collect()} == {(199, 0)}


def test_packing_places_every_token_once(spark):
    lengths = [0, None, 1, 1, 1, 300, 512, 513, 20000, 8192, 8193, *range(1, 400), *[700] * 333]
    d = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long")
    rows = packing.packed(d, F.col("n_tokens")).collect()
    per_doc, bins = Counter(), defaultdict(list)
    for r in rows:
        per_doc[r.doc_id] += r.n_tokens
        if r.bin_id is not None:
            bins[r.bin_id].append((r.bin_offset, r.n_tokens, r.bin_size))
    assert per_doc == Counter({i: n or 0 for i, n in enumerate(lengths)})
    assert sorted(bins) == list(range(len(bins)))
    for parts in bins.values():
        at = 0
        for offset, n, size in sorted(parts):
            assert offset == at
            at += n
        size = parts[0][2]
        assert size == min(s for s in packing.LENGTHS if s >= at)
    total, room = sum(n for p in bins.values() for _, n, _ in p), sum(p[0][2] for p in bins.values())
    assert total > 0.97 * room
    assert packing.packed(d.limit(0), F.col("n_tokens")).count() == 0


def test_best_fit_equals_one_by_one_packing():
    rng = np.random.default_rng(5)
    items = rng.integers(1, 100, 500).tolist()
    plan = packing.best_fit(Counter(items), (100,), 0)
    rooms: list[int] = []
    for n in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(100 - n)
    assert plan.n_bins == len(rooms)


def plan_cost(histogram, lengths, cost):
    """Cost of a plan after cutting its bins down, checked piece by piece."""
    plan = packing.best_fit(dict(histogram), lengths, cost)
    runs = defaultdict(list)
    for length, rank, first, each, used in plan.runs:
        runs[length].append((rank, first, each, used))
    used_by = defaultdict(int)
    for length, count in sorted(histogram.items(), reverse=True):
        starts = sorted(runs[length])
        for nth in range(count):
            rank, first, each, used = [r for r in starts if r[0] <= nth][-1]
            b = first + (nth - rank) // each
            assert used_by[b] == used + (nth - rank) % each * length  # no gap, no overlap
            used_by[b] += length
    firsts = [f for f, _ in plan.bins]
    for b, used in used_by.items():
        assert used == plan.bins[np.searchsorted(firsts, b, "right") - 1][1] <= max(lengths)
    assert len(used_by) == plan.n_bins
    return sum(cost + min(c for c in lengths if c >= used) for used in used_by.values())


def least_cost(items, lengths, cost):
    """The optimum, by trying every partition of a few items."""
    best = [float("inf")]

    def go(i, bins):
        if i == len(items):
            best[0] = min(best[0], sum(cost + min(c for c in lengths if c >= b) for b in bins))
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= max(lengths):
                bins[j] += items[i]
                go(i + 1, bins)
                bins[j] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def test_packing_is_near_the_optimum_of_all_partitions():
    rng = np.random.default_rng(8)
    ratio = []
    for _ in range(60):
        lengths, cost = ((16, 40, 100), 8) if rng.random() < 0.5 else ((25, 50, 100), 0)
        items = rng.integers(1, 60, 8).tolist()
        best = least_cost(items, lengths, cost)
        got = plan_cost(Counter(items), lengths, cost)
        assert got >= best
        ratio.append(got / best)
    assert max(ratio) <= 1.5 and np.mean(ratio) < 1.08


def test_bins_are_priced_by_all_that_can_fill_them():
    # alone, an item of 60 is cheapest in a bin of 64; with the short items it fills one of 100
    assert plan_cost({60: 10, 20: 20}, (64, 100), 16) == 10 * (100 + 16)
    assert plan_cost({60: 10}, (64, 100), 16) == 10 * (64 + 16)
    large = {int(n): int(k) for n, k in enumerate(np.random.default_rng(2).integers(0, 10**7, 8192)) if n and k}
    plan = packing.best_fit(large)
    assert len(plan.runs) < 20 * len(large)
    plan_cost(Counter(np.random.default_rng(3).integers(1, 300, 3000).tolist()), packing.LENGTHS, packing.BIN_COST)


def test_mixing_shares_and_shortages(spark):
    rows = [("a", "x", "s1", 100, 3), ("a", "x", "s2", 900, 1), ("a", "y", "s3", 50, 1), ("b", "x", "s4", 1000, 1)]
    leaves = spark.createDataFrame([(d, lang, s, n, k) for d, lang, s, n, k in rows], "domain string, lang string, source string, supply long, rows long")
    got = {r.source: r.budget for r in mixing.leaf_budgets(leaves, 50, 1, {"a": 1, "b": 1}, {"x": 1, "y": 1}).collect()}
    # 1025 tokens: 512 to each domain; y can use 50 of its 256, the rest goes to x, where s1 is short as well
    assert got == {"s1": 100, "s2": 362, "s3": 50, "s4": 512}


def test_mixing_takes_prefixes_of_seeded_epochs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    d = spark.createDataFrame([(i, None if i % 2 else "en", "src" + str(i % 3), f"{'w ' * (i % 9)}", 1) for i in range(300)] + [(None, None, None, None, 1)],
                              "doc_id long, lang string, source string, text string, mix_copies int")
    small = {r.doc_id for r in mixing.mixed(d.drop("mix_copies"), F.lit("d0"), n_words(F.col("text")), 30, 1, {}, {}).collect()}
    large = {r.doc_id for r in mixing.mixed(d.drop("mix_copies"), F.lit("d0"), n_words(F.col("text")), 60, 1, {}, {}).collect()}
    assert small < large
    twice = mixing.mixed(d.drop("mix_copies"), F.lit("d0"), n_words(F.col("text")), 150, 4, {}, {}).agg(F.min("mix_copies"), F.max("mix_copies")).first()
    assert twice[0] >= 1 and 2 <= twice[1] <= 4
    assert mixing.mixed(d.drop("mix_copies").limit(0), F.lit("d0"), n_words(F.col("text")), 30, 1, {}, {}).count() == 0


def mixed_words(rows, percent, epochs):
    """Tokens read by leaf, and the rows, of rows (doc_id, source, n words); one domain and language."""
    spark = SparkSession.getActiveSession()
    d = spark.createDataFrame([(i, "en", s, " ".join(f"w{k}" for k in range(n)), 7, "own") for i, s, n in rows], "doc_id long, lang string, source string, text string, __id int, h string")
    out = mixing.mixed(d, F.lit("d0"), n_words(F.col("text")), percent, epochs, {}, {}).collect()
    read = {}
    for r in out:
        assert r["__id"] == 7 and r.h == "own"
        read[r.source] = read.get(r.source, 0) + r.mix_copies * len(r.text.split()) + r.mix_tokens
    return read, out


def test_mixing_loses_no_budget_at_long_documents(spark):
    read, _ = mixed_words([(1, "a", 1000), (2, "b", 10), (3, "b", 10)], 50, 1)
    assert read == {"a": 490, "b": 20}  # of 510; b's shortage goes to a, whose only document is read in part
    read, rows = mixed_words([(1, "a", 1000)], 80, 1)
    assert read == {"a": 800} and rows[0].mix_copies == 0
    assert mixed_words([(1, "a", 1000)], 250, 4)[0] == {"a": 2500}
    # repeated ids share what is left of the budget
    read, rows = mixed_words([(1, "a", 100)] * 4, 50, 1)
    assert read == {"a": 200} and {r.mix_tokens for r in rows} == {50}


def test_the_mixing_stage_cuts_the_last_document(spark):
    text = "  one two\nthree\t four   five "
    d = spark.createDataFrame([(1, text, "en", "s", 99)], "doc_id long, text string, lang string, source string, n_chars long")
    row = mixing.stage(spark, d, SF).first()
    assert row.text == "  one two\nthree\t four" and row.n_chars == len(row.text)
    for n, want in [(0, ""), (1, "  one"), (3, "  one two\nthree"), (9, text.rstrip())]:
        assert d.select(mixing.first_words(F.col("text"), F.lit(n))).first()[0] == want


def test_own_columns_survive_mixing_and_redaction(spark):
    d = spark.createDataFrame([(1, "mail a@b.cc now", "en", "s", 5, 6, 7)], "doc_id long, text string, lang string, source string, mix_copies int, spans int, __spans int")
    out = mixing.mixed(d, F.lit("x"), n_words(F.col("text")), 100, 1, {}, {})
    assert sorted(out.columns) == sorted([*[c for c in d.columns if c != "mix_copies"], "mix_domain", "mix_copies", "mix_tokens"])
    clean = pii.redacted(d).first()
    assert clean.text == "mail [EMAIL] now" and (clean.spans, clean["__spans"]) == (6, 7)


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    library = Tokenizer.from_str(spec)
    texts = ["", None, "Hello's  world\n\n ", "<|endoftext|>x", "é中😀 ﬁ", "I've 'll ''s 's\n't", "long text " * 4000, "same", "same", *[f"doc {i} " * (i % 7) for i in range(80)]]
    d = spark.createDataFrame([(len(texts) - i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    token_files.write_files(d, str(tmp_path / "f"), spec, 2)
    got = sorted(token_files.read_files(spark, str(tmp_path / "f")).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, t in zip(got, reversed(texts), strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    token_files.write_files(d.limit(0), str(tmp_path / "g"), spec, 2)
    assert token_files.read_files(spark, str(tmp_path / "g")).count() == 0


def test_token_files_of_null_and_repeated_ids(spark, tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    d = spark.createDataFrame([(None, "a b"), (None, None), (7, "x y z"), (7, "x y z"), (7, "other"), (-1, "")], "doc_id long, text string")
    token_files.write_files(d, str(tmp_path / "f"), spec, 2)
    got = sorted(token_files.read_files(spark, str(tmp_path / "f")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -1, 7, 7, 7]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(6)]
    library = Tokenizer.from_str(spec)
    assert sorted(r.n_tokens for r in got) == sorted(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in ("a b", "", "x y z", "x y z", "other", ""))


def test_code_lengths_are_limited_and_complete():
    counts = np.random.default_rng(1).integers(1, 1000, 300) ** 3
    bits = token_files.code_lengths(counts, 12)
    assert bits.max() <= 12 and (2.0 ** -bits).sum() == 1
    free = token_files.code_lengths(counts, 40)
    assert (counts * free).sum() <= (counts * bits).sum()


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    scores = {r.doc_id: r.predicted for r in toxicity.scored(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, p in scores.items() if not p}
    parts = plain_components([(r.doc_id, r.text) for r in kept.collect()], 5, 80)
    unique = corpus_pipeline.STAGES[1][1](spark, kept, SF)
    assert {r.doc_id for r in unique.collect()} == {i for i, (_, c) in parts.items() if i == c}
    clean = corpus_pipeline.STAGES[2][1](spark, unique, SF)
    assert clean.columns == docs.columns and clean.count() == unique.count()
    assert pii.with_spans(clean).where(F.size("pii") > 0).count() == 0
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in unique.collect()} and len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_no_text_is_lost_under_a_shared_id(spark):
    rows = [(1, "one two three four five six seven eight nine", "a"), (1, "quite another text with no shingle in common at all", "b"), (1, "", "c"), (1, "", "d"),
            (2, "one two three four five six seven eight nine", "e"), (None, "one two three four five six seven eight nine", "f"), (3, None, "g"), (3, "", "h")]
    d = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    got = jaccard_join.stage(spark, d, SF)
    assert got.columns == d.columns
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == sorted([
        ("1", rows[0][1]), ("1", rows[1][1]), ("1", ""), ("None", rows[0][1]), ("3", "")])
    assert jaccard_join.stage(spark, d.limit(0), SF).count() == 0


def test_the_pipeline_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def poured(budget, children):
    """Shares of {name: (weight, cap)}: proportional, short children give what they can't use to the others; whole tokens."""
    out, left, budget = {}, dict(children), Fraction(budget)
    while left:
        level = budget / sum(w for w, _ in left.values())
        short = {c: cap for c, (w, cap) in left.items() if cap <= level * w}
        if not short:
            return out | {c: int(level * w) for c, (w, _) in left.items()}
        out |= short
        budget -= sum(short.values())
        left = {c: v for c, v in left.items() if c not in short}
    return out


def plain_mix(rows, percent, seed):
    """(doc_id, words kept) of rows (doc_id, lang, source, n): hierarchical budgets, then prefixes of each leaf in hash order."""
    domain = lambda source: f"d{int(hashlib.md5((source or '').encode()).hexdigest()[0], 16) % 4}"
    leaves = defaultdict(list)
    for i, lang, source, n in rows:
        leaves[domain(source), lang or "", source or ""].append((i, n))
    cap = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    below = lambda k: {x[:k] for x in cap}
    total = lambda node: sum(c for leaf, c in cap.items() if leaf[:len(node)] == node)
    budgets = {(): sum(cap.values()) * percent // 100}
    for k, weights in ((1, mixing.DOMAIN_WEIGHTS), (2, mixing.LANG_WEIGHTS), (3, {})):
        for node in below(k - 1):
            kids = {c: (weights.get(c[-1], mixing.OTHER), total(c)) for c in below(k) if c[:-1] == node}
            budgets |= poured(budgets[node], kids)
    out = {}
    for leaf, docs in leaves.items():
        if not cap[leaf]:
            continue
        epochs, rest = divmod(budgets[leaf], cap[leaf])
        for i, n in sorted(docs, key=lambda d: hashlib.md5(f"{seed}:{epochs}:{d[0]}".encode()).hexdigest()):
            if epochs or n <= rest:
                out[i] = n
            elif rest > 0:
                out[i] = rest
            rest = max(0, rest - n)
    return out


def test_the_last_stages_equal_plain_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert got.columns == docs.columns
    texts = {r.doc_id: r for r in docs.collect()}
    want = plain_mix([(r.doc_id, r.lang, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in texts.values()], 80, mixing.SEED)
    mine = {r.doc_id: r.text for r in got.collect()}
    assert {i: len((t or "").split()) for i, t in mine.items()} == {i: n for i, n in want.items() if n or texts[i].text in (None, "") or i in mine}
    assert all((texts[i].text or "").startswith(t or "") for i, t in mine.items())
    rows = corpus_pipeline.STAGES[4][1](spark, got, SF).collect()
    pieces = Counter()
    for r in rows:
        pieces[r.doc_id] += r.n_tokens
    assert pieces == Counter({i: len((t or "").split()) for i, t in mine.items()})
    histogram = Counter(r.n_tokens for r in rows if r.n_tokens)
    bins = {r.bin_id: r.bin_size for r in rows if r.bin_id is not None}
    assert sum(size + packing.BIN_COST for size in bins.values()) == plan_cost(histogram, packing.LENGTHS, packing.BIN_COST)
