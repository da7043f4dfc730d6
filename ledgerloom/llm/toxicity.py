"""Operator 1: toxicity as a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A document's features are the distinct character n-grams (3 to 5 characters of the case-folded text with runs
of white space as one blank), hashed into ``BUCKETS`` buckets.  A bucket's value is its log-count ratio
r = ln((toxic documents with it + 1) / toxic total) - ln((clean documents with it + 1) / clean total), and a
logistic regression is fitted on those values.  The fit uses at most ``MAX_PER_CLASS`` labelled documents of
each class, the ones with the smallest hashed ids; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, table

BUCKETS = 1 << 18
SIZES = (3, 4, 5)
#: Bound of the training sample, per class.
MAX_PER_CLASS = 3000
#: Features of the whole sample that the fit holds; the least telling buckets go first if there are more.
MAX_ENTRIES = 1 << 24
#: L2 penalty and rounds of the fit.
PENALTY, ROUNDS = 1e-3, 60


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text divisible by 5 (null ids too)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def gram_buckets(text: str | None, sizes: tuple[int, ...] = SIZES, buckets: int = BUCKETS) -> np.ndarray:
    """Distinct hashed n-grams of one text, in no order; null and empty texts have none."""
    folded = " ".join((text or "").lower().split())
    if not folded:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(f" {folded} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    seen = np.zeros(buckets, bool)
    for n in sizes:
        if len(codes) >= n:
            h = np.zeros(len(codes) - n + 1, np.uint64)
            for j in range(n):
                h = (h + codes[j:len(codes) - n + 1 + j] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            seen[(h >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def training_sample(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """Bounded labelled sample (text, toxic); ids with several labels count as toxic if any says so, of an id with
    several texts the first in order is learned from."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = known.where("toxic = 1").orderBy(*order).limit(max_per_class).union(
        known.where("toxic = 0").orderBy(*order).limit(max_per_class))
    # at most 2 * max_per_class rows of (id, label): the bound that makes the broadcast safe
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic", "doc_id")


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that have each bucket, by class."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        for toxic, raw in zip(b.column("toxic").to_pylist(), b.column("grams").to_pylist(), strict=True):
            counts[0 if toxic else 1, np.frombuffer(raw, np.int32)] += 1
    some = np.flatnonzero(counts.any(axis=0))
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[0, some]), pa.array(counts[1, some])], ["bucket", "n1", "n0"])


def _telling(number):
    """Buckets of each document that have a number, by these numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = number.value
        for b in batches:
            own = [numbers[np.frombuffer(g, np.int32)] for g in b.column("grams").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array([x[x >= 0].tobytes() for x in own], pa.binary())],
                                             ["doc_id", "toxic", "grams"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> tuple[np.ndarray, float]:
    """Weights per bucket (ratio times coefficient) and intercept.

    Without labelled rows of both classes the weights are zero and the intercept says the one class seen
    (none at all: clean).
    """
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            grams = [gram_buckets(t).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(grams, pa.binary())],
                                             ["doc_id", "toxic", "grams"])

    sample = training_sample(docs, labels, max_per_class)
    kinds = dict(sample.dtypes)
    rows = stored(sample.mapInArrow(features, f"doc_id {kinds['doc_id']}, toxic {kinds['toxic']}, grams binary"), "grams")
    # a row a bucket: documents of either class that have it
    counts = rows.select("toxic", "grams").mapInArrow(_bucket_counts, "bucket int, n1 long, n0 long").groupBy("bucket").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).toPandas()
    with_it = np.zeros((2, BUCKETS), np.int64)
    with_it[:, counts["bucket"].to_numpy()] = counts[["n1", "n0"]].to_numpy().T
    total = with_it.sum(axis=1, keepdims=True)
    ratio = np.subtract(*np.log((with_it + 1) / (total + BUCKETS)))
    telling = np.where(with_it.sum(axis=0) > 1, np.abs(ratio), 0)
    # only buckets that the ratio tells apart (twice as likely in one class), the most telling first, while they fit
    order = np.lexsort((np.arange(BUCKETS), -telling))
    fits = (telling[order] > 0.7) & (np.cumsum(with_it.sum(axis=0)[order]) <= MAX_ENTRIES)
    chosen = np.sort(order[fits])
    number = np.full(BUCKETS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(number)
    few = rows.mapInArrow(_telling(shared), f"doc_id {kinds['doc_id']}, toxic {kinds['toxic']}, grams binary")
    parts = sorted((str(r.doc_id), r.toxic, bytes(r.grams)) for r in few.toLocalIterator())  # at most MAX_ENTRIES numbers
    y = np.array([p[1] for p in parts], float)
    weights = np.zeros(BUCKETS)
    if len(set(y)) < 2:
        return weights, float(20 * y.mean() - 10) if len(y) else -10.0
    sizes = [len(p[2]) // 4 for p in parts]
    col = np.frombuffer(b"".join(p[2] for p in parts), np.int32)
    del parts
    row = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    ratio = ratio[chosen]
    val = ratio[col]
    balance = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    n_buckets = len(chosen)
    coef, bias = np.zeros(n_buckets), 0.0
    # accelerated gradient descent on the balanced, penalised logistic loss; its curvature bound sets the step
    probe = np.ones(n_buckets)
    for _ in range(8):
        probe /= np.linalg.norm(probe) or 1
        probe = np.bincount(col, val * (balance * np.bincount(row, val * probe[col], len(y)))[row], n_buckets) / len(y)
    step = 1 / (0.3 * np.linalg.norm(probe) + PENALTY + 0.5)
    look_c, look_b, t = coef, bias, 1.0
    for _ in range(ROUNDS):
        margin = np.bincount(row, val * look_c[col], len(y)) + look_b
        err = balance * (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - y) / len(y)
        new_c = look_c - step * (np.bincount(col, val * err[row], n_buckets) + PENALTY * look_c)
        new_b = look_b - step * err.sum()
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        look_c, look_b = new_c + (last - 1) / t * (new_c - coef), new_b + (last - 1) / t * (new_b - bias)
        coef, bias = new_c, new_b
    weights[chosen] = coef * ratio
    return weights, float(bias)


def scored(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """All columns of ``docs`` and ``score`` (0 to 1), ``predicted`` (1 if score >= 0.5, else 0).

    Repeated rows score alike; a null or empty text has no features and scores by the intercept.  Columns of
    ``docs`` named like the two new ones are replaced.  An empty table gives an empty result.
    """
    weights, bias = fit(docs, labels, max_per_class)
    model = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float64), bias))  # BUCKETS doubles

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, b = model.value
        for texts in batches:
            yield pd.Series([1 / (1 + np.exp(-np.clip(w[gram_buckets(t)].sum() + b, -35, 35))) for t in texts], dtype=float)

    return (docs.withColumn("score", score(F.col("text")))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def query(spark, sf_dir):
    """doc_id, held_out, score, predicted for every document."""
    out = scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def stage(spark, docs, sf_dir):
    """Documents that the classifier does not call toxic, all their rows and columns; null and empty texts are scored by
    the intercept, an empty table gives an empty one."""
    out = scored(docs, table(spark, sf_dir, "labels"))
    return out.where("predicted = 0").select(*docs.columns)
