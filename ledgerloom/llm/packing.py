"""Operator 6: best-fit packing of token sequences into bins of several permitted lengths.

Items of one length are alike, so the packing is planned on the histogram of lengths, which the longest
permitted length bounds, not on documents.  Lengths go in descending order; each item takes the open bin with
the least room that still holds it.  Where none does, a bin is opened in the size of least cost per packed
token: every size is priced by what would fill it, this length and smaller ones that no open bin counts on; when all is
packed every bin is cut down to the smallest permitted length that holds its contents.  The plan lists, per length, runs of items that go to runs of bins
the same way.  Documents then only need their rank among the pieces of their length, which comes from counts
of hash buckets, so a very common length is spread over many tasks.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored, table

#: Permitted sequence lengths, and what a bin costs besides its length (both in tokens).
LENGTHS = (512, 1024, 2048, 4096, 8192)
BIN_COST = 64
#: Pieces of one length in one hash bucket are about this many.
BUCKET_ROWS = 4096


@dataclass
class Plan:
    """Runs of items (length, first rank, first bin, items a bin, offset in the bin) and runs of bins (first, used)."""

    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int]] = field(default_factory=list)
    n_bins: int = 0


def filling(capacity: int, length: int, free: dict[int, int], known: list[int]) -> dict[int, int]:
    """What would fill a bin opened for an item of ``length``: as many as fit of it, then of the longest that still fit.

    ``free`` counts the items that no open bin counts on, by length; ``known`` are its lengths in ascending order.
    """
    taken = {length: min(max(free.get(length, 0), 1), capacity // length)}
    room, below = capacity - taken[length] * length, length
    while True:
        at = min(bisect.bisect_right(known, room), bisect.bisect_left(known, below)) - 1
        while at >= 0 and not free[known[at]]:
            at -= 1
        if at < 0:
            return taken
        below = known[at]
        taken[below] = min(free[below], room // below)
        room -= taken[below] * below


def best_fit(histogram: dict[int, int], lengths: tuple[int, ...] = LENGTHS, bin_cost: int = BIN_COST) -> Plan:
    """Best-fit decreasing over (length: count); work and result grow with distinct lengths, not with items."""
    plan = Plan()
    open_runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room -> (first bin, bins, used)
    rooms: list[int] = []
    free, known = dict(histogram), sorted(histogram)

    def put(first: int, bins: int, used: int, room: int) -> None:
        if not open_runs[room]:
            bisect.insort(rooms, room)
        open_runs[room].append((first, bins, used))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, bins, used = open_runs[room].pop()
                if not open_runs[room]:
                    rooms.pop(at)
            else:
                fills = {c: filling(c, length, free, known) for c in lengths if c >= length}
                room = min(fills, key=lambda c: ((c + bin_cost) / sum(n * k for n, k in fills[c].items()), c))
                # as many alike as can be filled alike: each opening uses up a length, so there are few
                alike = min(free[n] // k for n, k in fills[room].items())
                first, bins, used = plan.n_bins, max(1, min(alike, left // fills[room][length])), 0
                for n, k in fills[room].items():
                    free[n] = max(0, free[n] - k * bins)
                while known and not free[known[-1]]:
                    known.pop()
                plan.n_bins += bins
            each = min(left, room // length)
            taken = min(bins, left // each)
            plan.runs.append((length, rank, first, each, used))
            rank, left = rank + taken * each, left - taken * each
            put(first, taken, used + each * length, room - each * length)
            if bins > taken:
                put(first + taken, bins - taken, used, room)
    plan.bins = sorted((first, used) for groups in open_runs.values() for first, _, used in groups)
    return plan


def pieces(docs: DataFrame, tokens: Column, longest: int) -> DataFrame:
    """Rows (doc_id, piece, n_tokens): documents cut into pieces of at most ``longest`` tokens; no tokens, one empty piece."""
    sized = docs.select("doc_id", F.coalesce(tokens, F.lit(0)).cast("long").alias("__n"))
    count = F.greatest(F.ceil(F.col("__n") / longest), F.lit(1)).cast("long")
    cut = sized.select("doc_id", "__n", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece"))
    return cut.select("doc_id", "piece", F.least(F.col("__n") - F.col("piece") * longest, F.lit(longest)).cast("long").alias("n_tokens"))


def packed(docs: DataFrame, tokens: Column, lengths: tuple[int, ...] = LENGTHS, bin_cost: int = BIN_COST) -> DataFrame:
    """Rows doc_id, piece, n_tokens, bin_id, bin_size, bin_offset: where each piece of each document goes.

    ``tokens`` counts a document's tokens (null: none).  A document longer than the longest permitted length is
    cut into pieces, none of its tokens is lost.  Documents without tokens keep a row with null bin columns.
    Repeated rows are packed one by one.  Other columns aren't read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokens, max(lengths)), "pieces")
    counts = cut.where("n_tokens > 0").groupBy("n_tokens").agg(F.count("*").alias("rows"))
    histogram = {r.n_tokens: r.rows for r in counts.collect()}  # at most max(lengths) rows
    plan = best_fit(histogram, lengths, bin_cost)
    by_length = spark.createDataFrame([(k, -(-v // BUCKET_ROWS)) for k, v in histogram.items()], "n_tokens long, buckets long")
    dealt = cut.where("n_tokens > 0").join(F.broadcast(by_length), "n_tokens").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece"), "buckets"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = dealt.groupBy("n_tokens", "bucket").agg(F.count("*").alias("rows")).select("n_tokens", "bucket", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("n_tokens", "bucket").orderBy("doc_id", "piece"))
    ranked = dealt.withColumn("nth", within - 1).join(offsets, ["n_tokens", "bucket"]).withColumn("rank", F.col("before") + F.col("nth"))

    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    bins = np.array(plan.bins, np.int64).reshape(-1, 2)
    sizes = np.array(sorted(lengths), np.int64)
    known = spark.sparkContext.broadcast((runs, bins, sizes))  # grows with distinct lengths, not with documents

    @F.pandas_udf("bin_id long, bin_size long, bin_offset long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        runs, bins, sizes = known.value
        firsts = np.searchsorted(runs[:, 0], np.unique(runs[:, 0]))
        distinct = runs[firsts, 0]
        # ranks of one length are increasing over its runs: one key for both
        scale = np.int64(runs[:, 1].max() + 1) if len(runs) else np.int64(1)
        slot = np.searchsorted(distinct, runs[:, 0])
        exact = slot.astype(float).max(initial=0) * float(scale) < 2.0**62
        for length, rank in batches:
            length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
            own = np.searchsorted(distinct, length)
            if exact:
                at = np.searchsorted(slot * scale + runs[:, 1], own * scale + np.minimum(rank, scale - 1), "right") - 1
            else:
                ends = np.append(firsts[1:], len(runs))
                at = np.array([firsts[o] + np.searchsorted(runs[firsts[o]:ends[o], 1], r, "right") - 1 for o, r in zip(own, rank, strict=True)])
            _, start, first, each, used = runs[at].T
            nth = rank - start
            bin_id = first + nth // each
            size = sizes[np.searchsorted(sizes, bins[np.searchsorted(bins[:, 0], bin_id, "right") - 1, 1])]
            yield pd.DataFrame({"bin_id": bin_id, "bin_size": size, "bin_offset": used + nth % each * length})

    placed = ranked.withColumn("at", place("n_tokens", "rank")).select("doc_id", "piece", "n_tokens", "at.*")
    none = cut.where("n_tokens = 0").select("doc_id", "piece", "n_tokens", *[F.lit(None).cast("long").alias(c) for c in ("bin_id", "bin_size", "bin_offset")])
    return placed.unionByName(none)


def query(spark, sf_dir):
    """Every document, words as tokens."""
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"), n_words(F.col("text")))


def stage(spark, docs, sf_dir):
    """Where each piece of each document goes, words as tokens (see ``packed`` for null, repeated and missing rows)."""
    return packed(docs, n_words(F.col("text")))
