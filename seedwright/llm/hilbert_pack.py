"""Operator 7: packing along a Hilbert curve.

A document's token counts, hashed into ``HASHED`` signed buckets and scaled to
unit length, are projected to ``DIMS`` dimensions; the Hilbert key of the
quantised point orders documents so that neighbours on the curve are alike.
Documents are dealt to tasks by ranges of (key, doc_id), so copies with equal
keys spread over tasks too, and each task packs its stretch of the curve into
sequences by cutting it every ``capacity`` tokens.  What is left at a task's end
goes into sequences of powers of two, which need no padding.

Tokens are written once before the range sort, so neither its sampling nor a
lost executor makes texts go through the tokenizer again.

Defined cases: null and empty texts are the end id alone; rows that repeat are
packed one by one, also without a doc_id; texts longer than a sequence are cut;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import mix64, scratch, table, text_slices, tidy
from seedwright.llm.segments import tokenizer

CAPACITY = 2048
HASHED = 64
DIMS = 4
BITS = 12
DEFAULT_TOKENIZER = "word_bpe_49k.json"

_PROJECT = np.random.default_rng(4242).standard_normal((HASHED, DIMS))


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert curve positions of integer points (rows by dimensions), after
    Skilling's transposed form."""
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[:, i] & q) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= np.where(high, 0, swap) if i else 0
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = top
    while q > 1:
        t ^= np.where((x[:, dims - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Curve positions of documents from their token ids."""
    rows = len(off) - 1
    h = mix64(ids.astype(np.uint64), 5)
    bucket = (h % np.uint64(HASHED)).astype(np.int64)
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    doc = np.repeat(np.arange(rows), np.diff(off))
    v = np.bincount(doc * HASHED + bucket, weights=sign, minlength=rows * HASHED).reshape(rows, HASHED)
    size = np.sqrt((v * v).sum(axis=1, keepdims=True))
    p = (v / np.where(size > 0, size, 1)) @ _PROJECT  # about standard normal
    grid = np.clip((p + 3) / 6, 0, 1) * ((1 << BITS) - 1)
    return hilbert_key(grid.astype(np.int64))


@tidy
def _tokens(batches: Iterator[pa.RecordBatch], tokenizer_path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in text_slices(batch, max_bytes=4 << 20):
            tok = tokenizer(tokenizer_path)
            width = 2 if max(len(tok.width) - 1, end_id) < 1 << 16 else 4
            ids, off = tok.encode(b.column("text"))
            n = np.diff(off) + 1
            flat = np.full(len(ids) + len(n), end_id, f"<u{width}")
            mine = np.ones(len(flat), bool)
            mine[np.cumsum(n) - 1] = False
            flat[mine] = ids
            ends = np.cumsum(n) * width
            yield pa.RecordBatch.from_pydict({
                "curve": pa.array(curve_keys(ids, off)), "doc_id": b.column("doc_id"),
                "n": pa.array(n), "width": pa.array(np.full(len(n), width, np.int32)),
                "ids": pa.Array.from_buffers(pa.binary(), len(n), [
                    None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()),
                    pa.py_buffer(flat.tobytes())])})


class _Packer:
    """Cuts a stream of documents into sequences."""

    def __init__(self, capacity: int, first: int, with_ids: bool):
        self.capacity, self.sequence, self.with_ids = capacity, first, with_ids
        self.open: list[tuple] = []  # (doc_id, start, ids, doc tokens)
        self.used = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        at, n = 0, len(ids)
        while at < n:
            take = min(n - at, self.capacity - self.used)
            self.open.append((doc_id, at, ids[at:at + take], n))
            self.used += take
            at += take
            if self.used == self.capacity:
                self._emit(self.open)
                self.open, self.used = [], 0

    def finish(self) -> None:
        """The open sequence as sequences of powers of two."""
        rest = self.open
        while self.used:
            size = 1 << (self.used.bit_length() - 1)
            part, room, later = [], size, []
            for doc_id, start, ids, n in rest:
                take = min(room, len(ids))
                if take:
                    part.append((doc_id, start, ids[:take], n))
                if take < len(ids):
                    later.append((doc_id, start + take, ids[take:], n))
                room -= take
            self._emit(part)
            rest, self.used = later, self.used - size

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, ids, n in pieces:
            raw = ids.astype("<u4").tobytes()
            row = (doc_id, start, len(ids), zlib.crc32(raw), n, self.sequence, at)
            self.rows.append((*row, raw) if self.with_ids else row)
            at += len(ids)
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        cols = list(zip(*self.rows, strict=True)) if self.rows else [()] * (7 + self.with_ids)
        out = {c: pa.array(v, pa.int64()) for c, v in zip(names, cols, strict=False)}
        if self.with_ids:
            out["ids"] = pa.array(cols[7], pa.binary())
        self.rows = []
        return pa.RecordBatch.from_pydict(out)


@tidy
def _packed(batches: Iterator[pa.RecordBatch], capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    p = _Packer(capacity, TaskContext.get().partitionId() << 40, with_ids)
    for batch in batches:
        doc, ids = batch.column("doc_id").to_pylist(), batch.column("ids")
        width = batch.column("width").to_pylist()
        for i, d in enumerate(doc):
            p.add(d, np.frombuffer(ids[i].as_buffer(), f"<u{width[i]}"))
            if len(p.rows) >= 8192:
                yield p.batch()
    p.finish()
    yield p.batch()


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset[, ids as little-endian 32-bit])."""
    spark = docs.sparkSession
    path = scratch(spark, "pack-tokens")
    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_tokens, tokenizer_path=tokenizer_path, end_id=end_id),
        "curve long, doc_id long, n long, width int, ids binary")
    tokens.write.option("compression", "zstd").parquet(path)
    order = ["curve", "doc_id", "n", "digest"]
    sized = spark.read.schema(tokens.schema).parquet(path).withColumn("digest", F.xxhash64("ids"))
    out = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long" + ", ids binary" * with_ids)
    return (sized.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("doc_id", "width", "ids")
            .mapInArrow(partial(_packed, capacity=capacity, with_ids=with_ids), out))


def op7_hilbert_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` packed into sequences of 2048 tokens."""
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(DEFAULT_TOKENIZER), with_ids=False)
