"""Helpers shared by the operators: table reads, shared scratch tables, Arrow text access, word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir

#: Words everywhere: runs of characters other than these six white-space characters.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RE = r"[\x20\x09-\x0D]+"
#: Text bytes that one vectorised step of a Python worker handles.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RE), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, without building the filtered array: pieces of the split less its empty first and last."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACE_RE)
    return (F.size(pieces) - (F.element_at(pieces, 1) == "").cast("int")
            - ((F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")).cast("int")).cast("long")


# ---- Arrow access in Python workers -------------------------------------------------------------

def small_batches(batches: Iterator[pa.RecordBatch], text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about CHUNK_BYTES of text (at least one row)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        ends = np.cumsum(text_lengths(b.column(text_col)))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
            yield b.slice(at, to - at)
            at = to


def text_lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and the row offsets into it (nulls are empty)."""
    if col.null_count:
        col = col.fill_null("")
    if col.type == pa.large_string():
        col = col.cast(pa.string())
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if col.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


# ---- hashing of words, 64 bits ------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (shift-multiply rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the index of its row.  ``lower`` folds A-Z.

    A word's hash is a polynomial over its bytes; long inputs are cut at separators, so the tables of powers
    stay at CHUNK_BYTES unless a single word is longer.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    space = np.zeros(256, bool)
    space[list(SPACE_BYTES)] = True
    inner = ~space[data]
    start = inner.copy()
    start[1:] &= ~inner[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    start[heads] = inner[heads]
    starts = np.flatnonzero(start)
    stop = inner.copy()
    stop[:-1] &= ~inner[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = inner[tails]
    ends = np.flatnonzero(stop) + 1
    out = np.empty(len(starts), np.uint64)
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    at = 0
    while at < len(starts):
        lo = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, lo + CHUNK_BYTES, "right")))
        hi = ends[to - 1]
        powers = np.full(hi - lo, _BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((fold[data[lo:hi]].astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
        back = np.full(hi - lo, inverse, np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = (sums[e] - sums[s]) * back[s]
        at = to
    return mix(out), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles; fewer words: the whole sequence as one."""
    hashes, rows = word_hashes(data, offsets)
    n_rows = len(offsets) - 1
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    factors = mix(np.arange(1, k + 2, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    n = len(hashes)
    if n >= k:
        rolling = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            rolling += hashes[j:n - k + 1 + j] * factors[j]
        rolling = mix(rolling)
    out = []
    for r in range(n_rows):
        a, b = bounds[r], bounds[r + 1]
        if b - a >= k:
            s = np.sort(rolling[a:b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            parts = np.append(hashes[a:b] * factors[:b - a], factors[k:] * np.uint64(b - a))
            out.append(mix(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
