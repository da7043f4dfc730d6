"""Operator 13: periodic runs of words, by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q, at least max(12, 2 q) words long, that neither
neighbouring word extends.  Each of its words occurs twice or more inside it.  So a text is split at every word
that occurs once in its segment, segments shorter than 12 words go, and what is left is split again until no
segment has such a word.  Most texts end there.  Surviving segments are scanned lag by lag: a run of period q is
a stretch of equal words q apart, at least max(12, 2 q) - q long, so some window of half that length on a grid
equals the one q words on.  Windows are compared by rolling hashes, for many lags at once; what agrees is extended word
by word, exactly.

Work in a text is near n log n, also for texts of few different words.  Texts are handled row by row, in bounded
Arrow batches: no shuffle and no state besides one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table, words

MIN_LENGTH = 12
#: Windows that are compared in one step.
PAIRS = 1 << 20
OUT = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def split_rare(ids: np.ndarray) -> list[tuple[int, int]]:
    """Segments (start, end) of at least MIN_LENGTH words in which every word occurs twice or more."""
    at = np.arange(len(ids))
    segment = np.zeros(len(ids), np.int64)
    while len(at):
        # one number for each (segment, word)
        _, inverse, counts = np.unique(segment * (ids.max() + 1) + ids[at], return_inverse=True, return_counts=True)
        keep = counts[inverse] >= 2
        stable = keep.all()
        at, segment = at[keep], segment[keep]
        if not len(at):
            break
        new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (segment[1:] != segment[:-1])))
        number = np.cumsum(new) - 1
        size = np.bincount(number)
        long = size[number] >= MIN_LENGTH
        if stable and long.all():
            starts = at[new]
            return list(zip(starts.tolist(), (starts + size).tolist(), strict=True))
        at, segment = at[long], number[long]
    return []


def _equal_windows(x: np.ndarray, random: np.ndarray):
    """Pairs (lag, start), by lag and start, of windows that may begin a run of that lag: equal hashes.

    A run of period q has at least s = max(MIN_LENGTH, 2 q) - q words that equal the word q on, so it holds a window
    of s // 2 of them at a multiple of s - s // 2 + 1.  The hash is a sum of a random number for each word times
    powers of an odd base, modulo 2^64: equal windows always agree.
    """
    n = len(x)
    base = np.uint64(0x9E3779B97F4A7C15)
    powers = np.full(n + 1, base, np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(random[x] * powers[:-1], out=sums[1:])
    lags = np.arange(1, n // 2 + 1)
    need = np.maximum(MIN_LENGTH, 2 * lags) - lags
    window = need // 2
    step = need - window + 1
    count = np.maximum(0, (n - lags - window) // step + 1)
    ends = np.cumsum(count)
    at = 0
    while at < len(lags):
        base_count = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base_count + PAIRS, "right")))
        which = np.repeat(np.arange(at, to), count[at:to])
        start = (np.arange(len(which)) - np.repeat(ends[at:to] - count[at:to] - base_count, count[at:to])) * step[which]
        lag, length = lags[which], window[which]
        here = (sums[start + length] - sums[start]) * powers[lag]
        same = here == sums[start + lag + length] - sums[start + lag]
        yield from zip(lag[same].tolist(), start[same].tolist(), strict=True)
        at = to


def _stretch(x: np.ndarray, lag: int, start: int) -> tuple[int, int]:
    """Largest (start, end) around ``start`` whose words equal those ``lag`` on; empty if ``start`` itself differs."""
    end, size = start, 16
    while end < len(x) - lag:
        differ = np.flatnonzero(x[end:end + size][:len(x) - lag - end] != x[end + lag:end + lag + size])
        if len(differ):
            end += int(differ[0])
            break
        end, size = min(end + size, len(x) - lag), size * 2
    size = 16
    while start > 0:
        low = max(0, start - size)
        differ = np.flatnonzero(x[low:start] != x[low + lag:start + lag])
        if len(differ):
            return low + int(differ[-1]) + 1, end
        start, size = low, size * 2
    return start, end


def scan(x: np.ndarray, random: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment, by lags.

    A stretch of lag q of that length with a smaller period p has a p that divides q (Fine and Wilf) and lies in
    the run of period p, which is found before: windows inside such a run are passed over.
    """
    runs: list[tuple[int, int, int]] = []
    last_lag, passed, inside = 0, 0, []
    for lag, start in _equal_windows(x, random):
        if lag != last_lag:
            last_lag, passed = lag, 0
            inside = [(s, s + n) for s, n, q in runs if lag % q == 0]
        need = max(MIN_LENGTH, 2 * lag) - lag
        if start < passed or any(s <= start and start + lag + need // 2 <= e for s, e in inside):
            continue
        s, e = _stretch(x, lag, start)
        passed = max(passed, e)
        if e - s >= need and not any(a <= s and e + lag <= b for a, b in inside):
            runs.append((s, e - s + lag, lag))
    return runs


def periodic_runs(text: str | None) -> tuple[list[tuple[int, int, int]], str]:
    """Runs (start, length, period) of a text by start and period, and the words that no run drops, joined by a blank."""
    found = (text or "").encode().split()  # bytes split at exactly the six ASCII white-space characters
    if len(found) < MIN_LENGTH:
        return [], b" ".join(found).decode()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found))
    segments = split_rare(ids)
    if not segments:
        return [], b" ".join(found).decode()
    random = np.random.default_rng(13).integers(1, 1 << 63, len(number), np.uint64)
    runs = sorted((a + s, n, q) for a, b in segments for s, n, q in scan(ids[a:b], random))
    dropped = np.zeros(len(found) + 1, np.int64)
    for s, n, q in runs:
        dropped[s + q] += 1
        dropped[s + n] -= 1
    if runs:
        found = [found[i] for i in np.flatnonzero(np.cumsum(dropped)[:-1] == 0)]
    return runs, b" ".join(found).decode()


def _runs(texts: pa.Array) -> pa.Array:
    rows = [periodic_runs(t.as_py()) for t in texts]
    flat = [r for runs, _ in rows for r in runs]
    parts = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
    offsets = np.concatenate(([0], np.cumsum([len(runs) for runs, _ in rows]))).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(parts, fields=list(RUNS.value_type)))
    return pa.StructArray.from_arrays([runs, pa.array([c for _, c in rows], pa.string())], ["runs", "collapsed"])


def with_runs(rows: DataFrame, text: Column, name: str = "periodic", keep: list[str] | None = None) -> DataFrame:
    """All columns (or those of ``keep``), and a struct column ``name``: ``runs`` (start, length, period in words, by start then period)
    and ``collapsed`` (the kept words joined by one blank: of each run only its first period stays).

    Null, empty and blank texts have no runs and an empty collapsed text.  Every row is handled by itself, so
    repeated rows, ties and null ids give equal results; an empty table gives an empty one.  Other columns stay as
    they are; only a column that already has the name ``name`` is replaced.
    """
    kept = [c for c in (rows.columns if keep is None else keep) if c != name]
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text.alias("text"))
    schema = T.StructType([packed.schema["row"], T.StructField(name, T._parse_datatype_string(OUT))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches([batch]):
                yield pa.RecordBatch.from_arrays([part.column("row"), _runs(part.column("text"))], ["row", name])

    return packed.mapInArrow(run, schema).select("row.*", name)


def longest(runs: Column) -> Column:
    """The run of greatest length, of those the first, of those the one of least period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    return F.when(F.size(runs) > 0, F.struct((-best["s"]).alias("start"), best["l"].alias("length"), (-best["q"]).alias("period")))


def with_planted(doc_id: Column, text: Column) -> Column:
    """The text, or for one id in ten a text whose words from some word on repeat with some period (both from the id).

    Null ids plant nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        return F.when(n > 0, F.array_join(F.transform(w, lambda _, i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " "))

    planted = F.transform(F.array(words(text)), repeated)[0]
    return F.when(h % 10 == 0, planted).otherwise(text)


def query(spark, sf_dir):
    """Runs of every document, with its planted repetition."""
    docs = table(spark, sf_dir, "documents")
    out = with_runs(docs, with_planted(F.col("doc_id"), F.col("text")), keep=["doc_id"]).select("doc_id", F.col("periodic.runs").alias("runs"), F.col("periodic.collapsed").alias("collapsed"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    out = out.withColumn("best", longest(F.col("runs")))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
