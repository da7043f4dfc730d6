"""Operator 7: token ids in Huffman-coded files.

Every text is encoded with a tokenizers file, an end id is appended, and the ids of all documents are written
in ascending doc_id order as blocks of a canonical, length-limited Huffman code that is built from the counts
of all ids (package-merge).  A block stands alone: its payload starts at a bit 0 and ``CHECK_IDS`` ids apart its
bit offsets are noted, so that decoding runs from all checkpoints at once through one table.

The files: ``codebook`` (id, bits), ``blocks`` (shard, block, first: ids before it in its shard, documents,
payload, checkpoints).  Both are Parquet, so that writing commits by task and survives lost executors and
stores without local paths.
"""

from __future__ import annotations

import os
import sys
import types
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix, scratch_path, small_batches, stored, table

#: Longest code, ids between two checkpoints, ids of a block (a longer document makes a longer block).
MAX_BITS, CHECK_IDS, BLOCK_IDS = 18, 128, 1 << 18
#: Pre-tokens that a task remembers the ids of.
REMEMBERED = 1 << 21

# ---- ids of texts -------------------------------------------------------------------------------

_SPACES = {*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F}
#: Texts with characters from here on, or with unassigned ones, are encoded by the library as they are.
_PLAIN_BELOW = 0x3000


def _classes() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 other, 4 not told here, for code points below _PLAIN_BELOW."""
    out = np.full(_PLAIN_BELOW, 3, np.uint8)
    for c in range(_PLAIN_BELOW):
        kind = unicodedata.category(chr(c))
        out[c] = 0 if c in _SPACES else 1 if kind[0] == "L" else 2 if kind[0] == "N" else 4 if kind == "Cn" else 3
    return out


def pre_token_starts(codes: np.ndarray, kind: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Marks the first character of every pre-token of the byte-level BPE pattern.

    ``codes``: code points of texts one after the other, ``kind`` their classes, ``heads`` the texts' starts.
    A blank goes with the run after it, a longer white-space run gives its last character away, and 's 't 're
    've 'm 'll 'd stand alone where no blank or other sign is before them.
    """
    n = len(codes)
    head = np.zeros(n + 1, bool)
    head[heads] = True
    head[n] = True
    space = kind == 0
    before, blank = np.ones(n, np.uint8) * 9, np.zeros(n, bool)
    before[1:] = kind[:-1]
    blank[1:] = codes[:-1] == 32
    before[head[:-1]] = 9
    follows = np.zeros(n, bool)  # white space before a character of the same text that is none
    follows[:-1] = ~space[1:] & ~head[1:-1]
    start = np.where(space, (before != 0) | follows, np.where(before == 0, ~blank, before != kind))
    start[head[:-1]] = True
    quotes = np.flatnonzero((codes == 39) & start)
    if len(quotes):
        padded = np.append(codes, (0, 0, 0))
        one, two = padded[quotes + 1], padded[quotes + 2]
        one = np.where(head[np.minimum(quotes + 1, n)], 0, one)
        two = np.where(head[np.minimum(quotes + 2, n)], 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for at, size in ((quotes[short], 2), (quotes[long], 3)):
            start[at + 1] = False
            ends = at + size
            start[ends[ends < n]] = True
    return start


class Encoder:
    """Ids of texts, as the library gives them; pre-tokens are encoded once and remembered by a 64-bit hash."""

    def __init__(self, spec: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.end_id, self.newline = end_id, self.library.encode("\n", add_special_tokens=False).ids
        probe = "a b's\n\n c1  d!"
        cut = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(probe)] if self.library.pre_tokenizer else []
        self.plain = (cut == ["a", "Ġb", "'s", "ĊĊ", "Ġc", "1", "Ġ", "Ġd", "!"] and self.library.normalizer is None and len(self.newline) == 1)
        self.kinds = _classes()
        self.reset()

    def reset(self) -> None:
        # hashes in order, and the slot of each: pre-tokens are looked up a batch at a time
        self.keys, self.slot_of, self.n_slots = np.zeros(0, np.uint64), np.zeros(0, np.int32), 0
        self.flat, self.used = np.array([self.end_id] + [0] * 1023, np.uint32), 1
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.starts[0], self.sizes[0] = 0, 1  # slot 0: the end id

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids + [self.end_id], np.uint32) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, tokens: list[str]) -> int:
        """Encode new pre-tokens into the next slots, whose first it returns: those that hold more than white space in
        common texts, each after a line break."""
        solid = np.array([not t.isspace() for t in tokens], bool)
        some = [t for t, s in zip(tokens, solid.tolist(), strict=True) if s]
        texts = ["\n" + "\n".join(some[at:at + 256]) for at in range(0, len(some), 256)]
        joined = np.array([x for e in self.library.encode_batch_fast(texts, add_special_tokens=False) for x in e.ids], np.uint32)
        breaks = joined == self.newline[0]
        sizes = np.zeros(len(tokens), np.int64)
        sizes[solid] = np.diff(np.append(np.flatnonzero(breaks), len(joined))) - 1
        parts = [joined[~breaks]]
        starts = np.zeros(len(tokens), np.int64)
        starts[solid] = np.cumsum(sizes[solid]) - sizes[solid]
        held = len(parts[0])
        for i in np.flatnonzero(~solid).tolist():
            ids = np.array(self.library.encode(tokens[i], add_special_tokens=False).ids, np.uint32)
            starts[i], sizes[i] = held, len(ids)
            held += len(ids)
            parts.append(ids)
        first = self.n_slots + 1
        need_slots, need_ids = first + len(tokens), self.used + held
        if need_slots > len(self.starts):
            self.starts, self.sizes = (np.resize(x, 2 * need_slots) for x in (self.starts, self.sizes))
        if need_ids > len(self.flat):
            self.flat = np.resize(self.flat, 2 * need_ids)
        self.flat[self.used:need_ids] = np.concatenate(parts)
        self.starts[first:need_slots], self.sizes[first:need_slots] = self.used + starts, sizes
        self.used, self.n_slots = need_ids, self.n_slots + len(tokens)
        return first

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text and the end id."""
        out: list[np.ndarray | None] = [None] * len(texts)
        codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        odd = [not self.plain or (len(c) and (c.max() >= _PLAIN_BELOW or (self.kinds[c] == 4).any())) or any(s in t for s in self.special)
               for t, c in zip(texts, codes, strict=True)]
        hard = [i for i, o in enumerate(odd) if o]
        for i, ids in zip(hard, self._library([texts[i] for i in hard]), strict=True):
            out[i] = ids
        easy = [i for i, o in enumerate(odd) if not o]
        if easy:
            for i, ids in zip(easy, self._plain([codes[i] for i in easy]), strict=True):
                out[i] = ids
        return out  # type: ignore[return-value]

    def _plain(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        ends = np.cumsum([len(t) for t in texts])
        codes = np.concatenate(texts)
        slots = np.zeros(0, np.int64)
        bounds = np.zeros(len(texts), np.int64)
        if len(codes):
            heads = np.concatenate(([0], ends[:-1]))
            starts = np.flatnonzero(pre_token_starts(codes, self.kinds[codes], heads[heads < len(codes)]))
            stops = np.append(starts[1:], len(codes))
            base = 0x9E3779B97F4A7C15
            powers = np.full(len(codes), base, np.uint64)
            powers[0] = 1
            np.cumprod(powers, out=powers)
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum((codes + np.uint64(1)) * powers, out=sums[1:])
            powers[1:] = pow(base, -1, 1 << 64)
            np.cumprod(powers, out=powers)
            hashes = mix((sums[stops] - sums[starts]) * powers[starts])
            distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            if self.n_slots + len(distinct) > REMEMBERED:
                self.reset()
            place = np.searchsorted(self.keys, distinct)
            own = np.zeros(len(distinct), np.int64)
            there = np.zeros(len(distinct), bool)
            if len(self.keys):
                near = np.minimum(place, len(self.keys) - 1)
                there = self.keys[near] == distinct
                own = self.slot_of[near].astype(np.int64)
            new = np.flatnonzero(~there)
            if len(new):
                text = codes.tobytes().decode("utf-32-le")
                first = self._learn([text[a:b] for a, b in zip(starts[at[new]].tolist(), stops[at[new]].tolist(), strict=True)])
                own[new] = np.arange(first, first + len(new))
                self.keys = np.insert(self.keys, place[new], distinct[new])
                self.slot_of = np.insert(self.slot_of, place[new], own[new].astype(np.int32))
            slots = own[inverse]
            bounds = np.searchsorted(starts, ends)
        slots = np.insert(slots, bounds, 0)
        sizes = self.sizes[slots]
        upto = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[slots] - (upto - sizes), sizes) + np.arange(upto[-1])]
        return np.split(ids, upto[bounds + np.arange(len(texts))][:-1])


def _encoder(spec: str, end_id: int) -> Encoder:
    """The Python worker's encoder: it outlives a task, so what it remembers serves the worker's next tasks."""
    kept = sys.modules.setdefault("_ledgerloom_worker", types.ModuleType("_ledgerloom_worker")).__dict__
    key = (zlib.crc32(spec.encode()), len(spec), end_id)
    if kept.get("key") != key:
        kept.update(key=key, encoder=Encoder(spec, end_id))
    return kept["encoder"]


def _encode(spec, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value, end_id)
        for b in small_batches(batches):
            rows = encoder.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([packed_ids(r) for r in rows], pa.binary())], ["doc_id", "ids"])

    return run


def packed_ids(ids: np.ndarray) -> bytes:
    """Ids in 16 bits each if they fit, else 32, told apart by a first byte."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def unpacked_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.uint32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for b in small_batches(batches, "ids"):
        counts = np.bincount(np.concatenate([unpacked_ids(r) for r in b.column("ids").to_pylist()]))
        size = max(len(total), len(counts))
        total = np.pad(total, (0, size - len(total))) + np.pad(counts, (0, size - len(counts)))
    ids = np.flatnonzero(total)
    if len(ids):
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])


# ---- the code -----------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol in an optimal prefix code with no code longer than ``limit`` (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, marks = leaves, []
    for _ in range(limit - 1):
        marks.append(None if level is leaves else is_leaf)
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        by = np.argsort(both, kind="stable")
        level, is_leaf = both[by], by < n
    marks.append(is_leaf)
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for mark in reversed(marks):
        own = take if mark is None else int(mark[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


class Code:
    """Canonical code of (symbols, bits): codes ascend by (bits, symbol)."""

    def __init__(self, symbols: np.ndarray, bits: np.ndarray):
        by = np.lexsort((symbols, bits))
        self.symbols, self.bits = symbols[by].astype(np.int64), bits[by].astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(1 << (MAX_BITS - self.bits))))
        self.codes = self.first[:-1] >> (MAX_BITS - self.bits)

    def encode_table(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.symbols.max(initial=-1)) + 1
        codes, bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        codes[self.symbols], bits[self.symbols] = self.codes, self.bits
        return codes, bits

    def decode_table(self) -> np.ndarray:
        """By the next MAX_BITS bits: symbol and, in the low 5 bits, its length."""
        return np.repeat(self.symbols << 5 | self.bits, 1 << (MAX_BITS - self.bits))


def huffman_block(ids: np.ndarray, codes: np.ndarray, bits: np.ndarray) -> tuple[bytes, bytes]:
    """Payload of a block, and the bit offsets of every CHECK_IDS-th id (64-bit, little-endian)."""
    size = bits[ids]
    ends = np.cumsum(size)
    at = ends - size
    word = at >> 5
    shifted = codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
    firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    merged = np.bitwise_or.reduceat(shifted, firsts)
    out = np.zeros(int(ends[-1] >> 5) + 3, np.uint32)
    out[word[firsts]] |= (merged >> np.uint64(32)).astype(np.uint32)
    out[word[firsts] + 1] |= (merged & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out.astype(">u4").tobytes()[:int(ends[-1] + 7) // 8], at[::CHECK_IDS].astype("<u8").tobytes()


def decode_block(payload: bytes, checks: bytes, n: int, lookup: np.ndarray) -> np.ndarray:
    """Ids of a block: all checkpoints advance together, one id a step."""
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
    at = np.frombuffer(checks, "<u8").astype(np.int64)
    out = np.zeros((len(at), CHECK_IDS), np.uint32)
    last = len(window) - 1
    for i in range(CHECK_IDS):
        live = window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)
        entry = lookup[live >> np.uint32(32 - MAX_BITS)]
        out[:, i] = entry >> 5
        at = at + (entry & 31)
    return out.reshape(-1)[:n]


# ---- files --------------------------------------------------------------------------------------

_BLOCK = "shard int, block int, first long, n long, doc_ids array<long>, sizes array<long>, payload binary, checks binary"


def _blocks(tables) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codes, bits = tables.value
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            payload, checks = huffman_block(np.concatenate(ids), codes, bits)
            row = {"shard": shard, "block": block, "first": first, "n": held, "doc_ids": docs, "sizes": [len(i) for i in ids], "payload": payload, "checks": checks}
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))

        for b in small_batches(batches, "ids"):
            for doc, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                own = unpacked_ids(raw)
                if held and held + len(own) > BLOCK_IDS:
                    yield flush()
                    block, first, docs, ids, held = block + 1, first + held, [], [], 0
                docs.append(doc)
                ids.append(own)
                held += len(own)
        if held:
            yield flush()

    return run


def write_files(docs: DataFrame, path: str, spec: str, end_id: int) -> None:
    """Write the files for ``docs`` (doc_id, text; other columns unread) under ``path``.

    Null and empty texts are one end id; null ids come first, rows with one id in any order, each a document of its own.
    An empty table gives a codebook and blocks without rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(spec)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = stored(rows.mapInArrow(_encode(shared, end_id), "doc_id long, ids binary"), "ids")
    counts = encoded.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas()  # at most the vocabulary
    bits = code_lengths(counts["n"].to_numpy(np.int64))
    symbols = counts["id"].to_numpy(np.int64)
    spark.createDataFrame(list(zip(symbols.tolist(), bits.tolist(), strict=True)), "id long, bits long").coalesce(1).write.parquet(f"{path}/codebook")
    tables = spark.sparkContext.broadcast(Code(symbols, bits).encode_table())
    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(_blocks(tables), _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _decode(lookup, starts) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, before = lookup.value, starts.value
        for b in batches:
            for row in b.to_pylist():
                ids = decode_block(row["payload"], row["checks"], row["n"], table_)
                ends = np.cumsum(row["sizes"])
                parts = np.split(ids, ends[:-1])
                sums = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
                first = before[row["shard"]] + row["first"] + ends - np.array(row["sizes"])
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(first, pa.int64()), pa.array(row["sizes"], pa.int64()),
                                                  pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 for every document of the files."""
    book = spark.read.schema("id long, bits long").parquet(f"{path}/codebook").toPandas()  # at most the vocabulary
    lookup = spark.sparkContext.broadcast(Code(book["id"].to_numpy(np.int64), book["bits"].to_numpy(np.int64)).decode_table())
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("n"))  # a row per writing task
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = spark.sparkContext.broadcast({r.shard: r.before for r in totals.select("shard", before.alias("before")).collect()})
    return blocks.mapInArrow(_decode(lookup, starts), "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark, sf_dir):
    """All documents through the files and back; byte_bpe_50k, end id 2."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    path = scratch_path(spark, "token-files")
    write_files(table(spark, sf_dir, "documents"), path, spec, 2)
    return read_files(spark, path)
