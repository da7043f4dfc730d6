"""Operator 2: quality rules, with robust multivariate outliers by minimum covariance determinant (MCD).

Every document gets counts (words, symbols, repeated lines, repeated 8-word windows, capitals) and a vector of
four transformed statistics.  Per language and source the MCD looks for the half (here 75 %) of the documents
whose covariance has the least determinant: from a start at coordinate medians, concentration steps take the
documents with the least Mahalanobis distances and re-estimate mean and covariance from them.  Documents whose
squared distance exceeds a chi-square quantile are rejected.

A concentration step is one aggregation: distances fall into ``BINS_PER_DOUBLING`` bins per doubling, moments
are summed per (group, bin) and summed up to the bin that holds the 75 % point, so no group is collected or
sorted.  Statistics are whole numbers, so sums don't depend on the order of rows.  Groups with fewer than ``MIN_ROWS``
documents share an estimate with the language's other small groups, those of small languages with each other.
All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table, words

#: Statistics are held as whole multiples of 1 / UNIT.
UNIT = 1024
STATS = ["x0", "x1", "x2", "x3"]
#: Standard deviations that estimates don't go below (mean word length as log, symbols as log, repetition, capitals).
FLOORS = (0.05, 0.6, 0.12, 0.12)
#: Share of documents in the half, its consistency factor at four dimensions, and the cut (chi-square, 0.99999).
SHARE, CONSISTENCY, CUT = 0.75, 1.486, 28.47
STEPS, MIN_ROWS, BINS_PER_DOUBLING = 4, 50, 16
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8


def named(value: Column, body) -> Column:
    """``body`` of a value that is computed once: the element of an array of one is a local name in a lambda."""
    return F.transform(F.array(value), body)[0]


def n_repeat_words(word_array: Column) -> Column:
    """Words covered by windows of WINDOW words that occur more than once in the array.

    Windows are compared by a 64-bit hash of their words' hashes.  Only texts with equal windows sort (hash,
    position), which puts equal windows side by side; the words they cover follow from the distances of
    neighbouring positions.
    """
    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda acc, v: acc + v)

    def twice(rows: Column) -> Column:
        return F.filter(rows, lambda x, k: F.get(rows, k - 1)["h"].eqNullSafe(x["h"]) | F.get(rows, k + 1)["h"].eqNullSafe(x["h"]))

    def of_windows(w: Column) -> Column:
        rows = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = F.array_sort(F.transform(named(rows, twice), lambda x: x["i"]))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(named(starts, covered))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))

    hashes = F.transform(word_array, lambda w: F.xxhash64(w))
    return F.when(F.size(word_array) <= WINDOW, 0).otherwise(named(named(hashes, windows), of_windows))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and the transformed statistics, for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = named(words(text), lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), n_repeat_words(w).alias("repeat")))
    counted = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), of_words.alias("w"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("sym"), F.regexp_count(text, F.lit(r"\p{Lu}")).alias("upper"),
        named(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    long = {"n_words": "w.n", "word_chars": "w.chars", "n_symbols": "sym", "n_dup_lines": "dup", "n_repeat_words": "w.repeat", "n_upper": "upper"}
    out = counted.select("doc_id", "lang", "source", *[F.col(v).cast("long").alias(k) for k, v in long.items()])
    n, chars = F.col("n_words"), F.col("word_chars")
    vector = [F.log((chars + 500) / (n + 100)), F.log(1 + 100 * F.col("n_symbols") / (n + 20)), F.col("n_repeat_words") / (n + 20),
              F.col("n_upper") / (chars + 50)]
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return out.withColumn("base_failed", failed).withColumns({c: F.round(x * UNIT).cast("long") for c, x in zip(STATS, vector, strict=True)})


def with_groups(rows: DataFrame) -> DataFrame:
    """Column ``grp``: language and source, or what the documents of small groups share."""
    counts = rows.groupBy("lang", "source").agg(F.sum(F.when(F.col("base_failed"), 0).otherwise(1)).alias("n"))
    small = F.sum(F.when(F.col("n") < MIN_ROWS, F.col("n"))).over(Window.partitionBy("lang"))
    grp = (F.when(F.col("n") >= MIN_ROWS, F.concat_ws("\u0001", F.lit("source"), "lang", "source"))
           .when(small >= MIN_ROWS, F.concat_ws("\u0001", F.lit("lang"), "lang")).otherwise(F.lit("all")))
    return rows.join(counts.withColumn("grp", grp).select("lang", "source", "grp"), ["lang", "source"])


def _cholesky(df: DataFrame, cov: dict[tuple[int, int], Column]) -> DataFrame:
    """Columns l00, l10, l11, ...: the lower factor of a covariance given by its lower half."""
    df = df.withColumns({f"c{i}{j}": c for (i, j), c in cov.items()})
    for j in range(len(STATS)):
        done = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        df = df.withColumn(f"l{j}{j}", F.sqrt(F.col(f"c{j}{j}") - done))
        for i in range(j + 1, len(STATS)):
            done = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            df = df.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - done) / F.col(f"l{j}{j}"))
    return df


_PARAMS = [f"m{i}" for i in range(len(STATS))] + [f"l{i}{j}" for i in range(len(STATS)) for j in range(i + 1)]


def _floored(i: int, j: int, c: Column) -> Column:
    return c + F.lit((FLOORS[i] * UNIT) ** 2) if i == j else c


def with_distance(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Column ``d2``: squared Mahalanobis distance to the group's estimate (null without one)."""
    out = rows.join(params, "grp", "left")
    for i, x in enumerate(STATS):
        before = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", (F.col(x) - F.col(f"m{i}") - before) / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, len(STATS))), F.col("z0") * F.col("z0"))
    return out.withColumn("d2", d2).select(*rows.columns, "d2")


def estimates(rows: DataFrame) -> DataFrame:
    """Mean and covariance factor of each group's half with (close to) the least determinant."""
    sides = range(len(STATS))
    quartiles = rows.groupBy("grp").agg(*[F.percentile(x, F.lit([0.25, 0.5, 0.75])).alias(f"q{i}") for i, x in enumerate(STATS)], F.count("*").alias("n"))
    spread = {(i, j): _floored(i, j, F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) if i == j else F.lit(0.0)) for i in sides for j in range(i + 1)}
    start = _cholesky(quartiles.where(F.col("n") >= 2 * len(STATS) + 2).withColumns({f"m{i}": F.col(f"q{i}")[1] for i in sides}), spread)
    params = stored(start.select("grp", *_PARAMS), "mcd")
    for _ in range(STEPS):
        near = with_distance(rows, params).where("d2 IS NOT NULL").withColumn("bin", F.floor(F.log2(1 + F.col("d2")) * BINS_PER_DOUBLING))
        pairs = [(i, j) for i in sides for j in range(i + 1)]
        bins = near.groupBy("grp", "bin").agg(
            F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(STATS)],
            *[F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"s{i}{j}") for i, j in pairs])
        upto = F.sum("n").over(Window.partitionBy("grp").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        total = F.sum("n").over(Window.partitionBy("grp"))
        half = bins.where("n > 0").withColumn("before", F.coalesce(upto, F.lit(0))).withColumn("total", total).where(F.col("before") < F.ceil(F.col("total") * SHARE))
        sums = half.groupBy("grp").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in sides], *[F.sum(f"s{i}{j}").alias(f"s{i}{j}") for i, j in pairs])
        sums = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in sides})
        cov = {(i, j): _floored(i, j, CONSISTENCY * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))) for i, j in pairs}
        params = stored(_cholesky(sums, cov).select("grp", *_PARAMS), "mcd")
    return params


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed, kept and ``d2`` for every row of ``docs`` (doc_id, text, lang, source).

    Null and empty texts have no words and fail the base rules; null languages and sources count as empty
    names.  Documents that pass the base rules are kept unless d2 exceeds CUT; a group with too few documents
    for an estimate (fewer than ten) rejects none.  Ties and repeated rows are judged alike; an empty table
    gives an empty result; other columns aren't read.
    """
    rows = stored(with_groups(stored(statistics(docs), "statistics")), "grouped")
    params = estimates(rows.where("NOT base_failed").select("grp", *STATS))
    out = with_distance(rows, params)
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUT))


def query(spark, sf_dir):
    out = judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
