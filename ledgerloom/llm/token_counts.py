"""Operator 4: token counts by counting the pieces of each distinct pre-token once.

A sentencepiece BPE model merges neighbouring symbols, so a text can be cut wherever no piece of the
vocabulary spans the two characters: before a blank, around a line break, before closing punctuation.  Pieces
are counted once per distinct pre-token of the corpus and joined to the per-document pre-token frequencies;
ids are never made.  The ``HEAD`` most frequent pre-tokens are joined in the scan from a broadcast table of
bounded size, all others by a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, table

#: Pre-tokens in the broadcast table, and their greatest length in characters; what is longer is joined by a shuffle.
HEAD, HEAD_CHARS = 1 << 16, 64
#: Distinct pre-tokens that a task holds before it hands on its counts.
HELD = 1 << 18
BLANK = "▁"
LIMIT = 4096

_ODD = re.compile(r" *[^ ]+| +$")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text and its line breaks: a word stands for blank and word, "\\n" + s for s as it is."""
    if not text:
        return []
    out: list[str] = []
    # the model puts a blank before the text and treats its blank mark in a text as a blank
    for line in (" " + text.replace(BLANK, " ")).split("\n"):
        if line[:1] == " " and "  " not in line and line[-1:] != " ":
            out += line[1:].split(" ")
        elif "  " not in line and line[-1:] != " ":
            first, *rest = line.split(" ")
            if first:
                out.append("\n" + first)
            out += rest
        else:
            for m in _ODD.findall(line):
                word = m.lstrip(" ")
                out.append(word if word and len(m) == len(word) + 1 else "\n" + m)
        out.append("\n")
    out.pop()
    return out


def cut(pre: Counter, closing: str) -> Counter:
    """Frequencies with closing punctuation counted apart from the letter it follows."""
    out: Counter = Counter()
    for token, n in pre.items():
        stem = token.rstrip(closing)
        if len(stem) == len(token) or not stem[-1:].isalpha():
            out[token] += n
        else:
            out[stem] += n
            out["\n" + token[len(stem):]] += n
    return out


class Model:
    """A sentencepiece model as far as counting needs it; built from its bytes, so executors need no file."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        sp = self.processor
        pairs: set[tuple[str, str]] = set()
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
                piece = sp.id_to_piece(i)
                pairs.update(zip(piece, piece[1:]))
        self.base = len(sp.encode("\n"))
        self.line_break = len(sp.encode("\n\n")) - self.base
        if any(b == BLANK != a for a, b in pairs) or any("\n" in p for p in pairs) or sp.encode("a  b", out_type=str) == sp.encode("a b", out_type=str):
            raise ValueError("pieces of this model span blanks or line breaks, or it drops blanks")
        self.closing = "".join(c for c in ".,;:!?" if not any(b == c and a.isalpha() for a, b in pairs))

    def counts(self, tokens: list[str]) -> list[int]:
        """Pieces of each pre-token."""
        ids = self.processor.encode(["\n\n" if t == "\n" else t for t in tokens], num_threads=1)
        return [len(x) - (self.base if t[0] == "\n" else 0) for x, t in zip(ids, tokens, strict=True)]


def _vocabulary(closing: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = cut(held, closing)
            return pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.string()), pa.array(out.values(), pa.int64())], ["pre", "n"])

        for b in small_batches(batches):
            for text in b.column("text").to_pylist():
                held.update(pre_tokens(text))
            if len(held) > HELD:
                yield rows()
                held = Counter()
        if held:
            yield rows()

    return run


def _pieces(proto) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(proto.value)
        for b in small_batches(batches, "pre"):
            counts = model.counts(b.column("pre").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("pre"), b.column("n"), pa.array(counts, pa.int64())], ["pre", "n", "pieces"])

    return run


def _documents(head, closing: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        tail_type = pa.list_(pa.struct([("pre", pa.string()), ("n", pa.int64())]))
        for b in small_batches(batches):
            totals, tails = [], []
            for text in b.column("text").to_pylist():
                total, tail = 0, []
                for token, n in cut(Counter(pre_tokens(text)), closing).items():
                    pieces = known.get(token)
                    if pieces is None:
                        tail.append({"pre": token, "n": n})
                    else:
                        total += n * pieces
                totals.append(total)
                tails.append(tail)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), b.column("n_bytes"), pa.array(totals, pa.int64()),
                                              pa.array(tails, tail_type)], ["row", "doc_id", "n_bytes", "known", "tail"])

    return run


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """Columns doc_id, n_bytes, n_tokens for every row of ``docs`` (doc_id, text; other columns unread).

    Counts equal those of encoding each whole text.  Null and empty texts have no bytes and no tokens; repeated
    rows each give a row, null ids too; an empty table gives none.  Raises ValueError for a model whose pieces span blanks.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        proto = f.read()
    closing = Model(proto).closing
    model = spark.sparkContext.broadcast(proto)
    counted = docs.select("text").mapInArrow(_vocabulary(closing), "pre string, n long").groupBy("pre").agg(F.sum("n").alias("n"))
    vocabulary = stored(counted.mapInArrow(_pieces(model), "pre string, n long, pieces long"), "vocabulary")
    # at most HEAD pre-tokens of at most HEAD_CHARS characters: the bound of the broadcast
    frequent = vocabulary.where(F.length("pre") <= HEAD_CHARS).orderBy(F.desc("n"), "pre").limit(HEAD).select("pre", "pieces").toPandas()
    head = spark.sparkContext.broadcast(dict(zip(frequent["pre"], frequent["pieces"].tolist(), strict=True)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    rows = stored(rows.mapInArrow(_documents(head, closing), f"row long, doc_id {kind}, n_bytes long, known long, tail array<struct<pre string, n long>>"), "rows")
    tail = rows.select("row", F.explode("tail").alias("t")).select("row", "t.pre", "t.n")
    more = tail.join(vocabulary.select("pre", "pieces"), "pre").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    return rows.join(more, "row", "left").select("doc_id", "n_bytes", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_tokens"))


def query(spark, sf_dir):
    import public_tokenizers

    out = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
