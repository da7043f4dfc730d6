"""Operator 11: line dedup against levelled sorted runs of line hashes.

Documents come in batches.  The store keeps, for each line key seen, in how many documents it was and the least and
greatest of their ids, as sorted runs: tables bucketed and sorted by the key's hash.  A new batch reduces its lines
to one row a key and merges that with the runs (a sort-merge join that only moves the batch: runs lie in buckets).
Keys that the runs already hold as common fall out of the batch, which is the anti-join; the rest becomes the
batch's own run at level 0.  ``FANOUT`` runs of a level are compacted into one of the next, so a store of n batches
has about FANOUT * log(n) runs, and a key is rewritten once a level.

Batches go from the greatest ids to the least, so the document that keeps a common line is known when the line gets
common.  Then one join of all lines with the common keys says which lines go.  A line in a third of all documents
is one row a batch in the merge, and only splittable joins see its many rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path, stored, table

FANOUT = 3
BATCHES = 5
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]
#: Stands for a null id, which counts as one document before all others.
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def key_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, text_hash, position, h1, h2: a row for each line with a key of at least ``min_chars`` code points.

    Two 64-bit hashes of different seeds stand for a key.  ``text_hash`` tells rows of one id with different texts apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("text_hash"),
                        F.posexplode(F.split(text, "\n")).alias("position", "line"))
    long = lines.where(F.length("line") >= min_chars).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    return long.select("doc", "text_hash", "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class RunStore:
    """Levelled sorted runs (h1, h2, n, least, greatest) in the shared folder; a key may be in several runs."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", scratch_path(self.spark, "line-run")).saveAsTable(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def add(self, rows: DataFrame) -> None:
        """A new run at level 0; full levels are compacted into one run of the next."""
        self._write(rows, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full = self.levels[level]
            # merged by full outer joins, in their buckets: Spark 4.1 takes a union of bucketed tables as dealt by key
            # though its partitions don't line up, so a sum over it by key is wrong
            merged = self.spark.table(full[0])
            for name in full[1:]:
                other = self.spark.table(name).toDF(*KEY, "n_", "least_", "greatest_")
                merged = merged.join(other.hint("merge"), KEY, "full").select(
                    *KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("n_", F.lit(0))).alias("n"),
                    F.least("least", "least_").alias("least"), F.greatest("greatest", "greatest_").alias("greatest"))
            self.levels[level] = []
            self._write(merged, level + 1)
            self._drop(full)
            level += 1

    def merged(self, batch: DataFrame) -> DataFrame:
        """The batch's keys with what the runs know: known_n, known_least, known_greatest (0 and nulls if nothing)."""
        out = batch.withColumns({"known_n": F.lit(0).cast("long"), "known_least": F.lit(None).cast("long"), "known_greatest": F.lit(None).cast("long")})
        for name in (name for level in self.levels for name in level):
            run = self.spark.table(name).select(*KEY, F.col("n").alias("n_"), F.col("least").alias("least_"), F.col("greatest").alias("greatest_"))
            out = out.join(run.hint("merge"), KEY, "left").withColumns({
                "known_n": F.col("known_n") + F.coalesce("n_", F.lit(0)), "known_least": F.least("known_least", "least_"),
                "known_greatest": F.greatest("known_greatest", "greatest_")}).drop("n_", "least_", "greatest_")
        return out

    def _drop(self, names: list[str]) -> None:
        """Drop runs, files included (they are external tables: the catalog alone keeps those)."""
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            where = self.spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first().data_type
            self.spark.sql(f"DROP TABLE {name}")
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
            path.getFileSystem(hadoop).delete(path, True)

    def close(self) -> None:
        self._drop([name for level in self.levels for name in level])
        self.levels = []


def ingest(store: RunStore, lines: DataFrame, min_docs: int) -> DataFrame:
    """Merge-anti-join a batch of lines (doc, h1, h2) with the store and add what is left as its own run.

    Returns the keys that got common with this batch (h1, h2, keeper).  Batches come by descending ids, each
    document in one batch, so ``keeper``, the greatest id so far, stays the greatest.
    """
    per_doc = lines.select("doc", *KEY).distinct()  # first by key and document: a common key is many small groups
    batch = per_doc.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("doc").alias("least"), F.max("doc").alias("greatest"))
    merged = stored(store.merged(batch).where(F.col("known_n") < min_docs), "line-batch")
    store.add(merged.select(*KEY, "n", "least", "greatest"))
    return merged.where(F.col("known_n") + F.col("n") >= min_docs).select(*KEY, F.greatest("known_greatest", "greatest").alias("keeper"))


def by_batch(lines: DataFrame, docs: DataFrame, batches: int) -> DataFrame:
    """Column ``batch``: ranges of ids of about equal numbers of documents, 0 for the greatest ids."""
    shares = F.lit([k / batches for k in range(1, batches)])
    cuts = docs.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(NO_ID)), shares, F.lit(10_000)).alias("cuts")).first().cuts or []
    above = [(F.col("doc") <= c).cast("int") for c in sorted(set(cuts))]
    return lines.withColumn("batch", sum(above, F.lit(0)))


def drops(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = BATCHES) -> DataFrame:
    """doc, text_hash, positions (ascending, from 0) of the lines that go; rows without any are missing."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    lines = by_batch(key_lines(docs, min_chars), docs, batches)
    lines.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    store, common = RunStore(spark), None
    for k in range(batches):
        found = ingest(store, lines.where(F.col("batch") == k), min_docs)
        common = found if common is None else common.unionByName(found)
    store.close()
    gone = lines.join(common, KEY).where("doc <> keeper").select("doc", "text_hash", "position")
    gone = stored(gone, "line-drops")
    return gone.groupBy("doc", "text_hash").agg(F.collect_set("position").alias("positions"))


def deduplicated(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = BATCHES, name: str = "lines") -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) and a struct ``name``: n_lines, n_dropped, kept (text of the lines that stay).

    Lines whose key (stripped, A-Z lower-cased) has ``min_chars`` code points or more and is in ``min_docs`` documents
    or more stay only in the document of greatest id.  A null or empty text is one empty line.  Rows of one id are
    one document: a line they share counts once, and each keeps it if the id does; rows of null id are one document
    below all others.  A line repeated inside a document counts once and all its places stay or go together.  An
    empty table gives an empty result.  Other columns stay; only one already named ``name`` is replaced.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    joined = rows.join(drops(docs, min_docs, min_chars, batches), ["doc", "text_hash"], "left")
    split = F.split(F.coalesce("row.text", F.lit("")), "\n")
    gone = F.coalesce("positions", F.array().cast("array<int>"))

    def kept(x: Column) -> Column:
        return F.when(F.size(gone) == 0, F.coalesce("row.text", F.lit(""))).otherwise(
            F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.get(x, i)), "\n"))

    out = F.transform(F.array(split), lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"), kept(x).alias("kept")))[0]
    return joined.select("row", out.alias("out")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != name], F.col("out").alias(name))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = deduplicated(docs)
    return out.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH l AS (
  SELECT doc_id, position, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS position, unnest(x) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
common AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.*, common.key IS NOT NULL AND l.doc_id <> common.keeper AS gone FROM l LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
