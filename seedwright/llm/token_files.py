"""Operator 1: token ids as Simple-8b binary shards.

A shard holds the ids of a range of documents in ascending ``doc_id`` order.
Ids go in blocks of ``BLOCK_IDS``; a block is a run of 64-bit words whose top
four bits select how many ids of how many bits the rest holds (120 x 0 bits to
1 x 60 bits).  Selector 15 is an escape: the next word is one raw 64-bit id.
The footer has a word offset for each block and (doc_id, tokens) for each
document, so any block decodes alone and in a few vector steps.

File: magic ``S8BSHARD``; words; block word offsets (int64, one more than
blocks); doc_id then n_tokens (int64 each); null flags (uint8); then the
trailer of seven int64: ids per block, ids, words, blocks, documents, version,
magic.

Defined cases: null and empty texts hold the end id alone; null ids sort
first; rows that repeat a doc_id are all written, ordered by their text's hash;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedwright.llm.common import local_path, saved, scratch, table, text_slices, tidy
from seedwright.llm.segments import tokenizer

BLOCK_IDS = 1024
MAGIC = b"S8BSHARD"
VERSION = 1
#: (ids, bits) by selector, then the escape.
SELECTORS = ((120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
             (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
#: Blocks coded in one numpy pass.
PASS_BLOCKS = 1024
DEFAULT_TOKENIZER = "byte_bpe_50k.json"


# ------------------------------------------------------------------ the coding

_BITS16 = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _bit_length(ids: np.ndarray) -> np.ndarray:
    top = int(ids.max()).bit_length()
    if top <= 16:
        return _BITS16[ids.astype(np.uint16)]
    out = np.zeros(len(ids), np.uint8)
    for b in range(top):
        out += (ids >= np.uint64(1 << b))
    return out


def encode_blocks(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offsets of blocks) of uint64 ids; the last block may be short."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    blocks = -(-n // block)
    bits = np.full(blocks * block, 255, np.uint8)
    bits[:n] = _bit_length(ids)
    bits = bits.reshape(blocks, block)

    def wider(a: np.ndarray, b: np.ndarray, by: int) -> np.ndarray:
        """Maximum of a at i and b at i + by; past the block nothing fits."""
        out = np.full_like(a, 255)
        if by < block:
            np.maximum(a[:, :-by], b[:, by:], out=out[:, :-by])
        return out

    m = {1: bits}
    for size, one, two in ((2, 1, 1), (3, 2, 1), (4, 2, 2), (5, 4, 1), (6, 4, 2), (7, 4, 3),
                           (8, 4, 4), (10, 8, 2), (12, 8, 4), (15, 8, 7), (20, 10, 10),
                           (30, 15, 15), (60, 30, 30), (120, 60, 60)):
        m[size] = wider(m[one], m[two], one)
    sel = np.full(bits.shape, ESCAPE, np.uint8)
    for s, (count, width) in enumerate(SELECTORS):  # the most ids that fit win
        none = (m[count] > width).view(np.uint8) * np.uint8(ESCAPE) | np.uint8(s)
        np.minimum(sel, none, out=sel)
    del m
    sel = sel.reshape(-1)
    counts = np.array([c for c, _ in SELECTORS] + [1], np.int64)
    # follow all blocks' chains of words at once
    at = np.arange(blocks, dtype=np.int64) * block
    stop = np.minimum(at + block, n)
    head = np.zeros(blocks * block, bool)
    while len(at):
        head[at] = True
        at = at + counts[sel[at]]
        live = at < stop
        at, stop = at[live], stop[live]
    start = np.flatnonzero(head)
    own = start // block
    kind = sel[start]
    size = np.where(kind == ESCAPE, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = kind.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(SELECTORS):
        pick = np.flatnonzero(kind == s)
        if not len(pick) or width == 0:
            continue
        acc = words[place[pick]]
        for j in range(count):
            acc |= ids[start[pick] + j] << np.uint64(j * width)
        words[place[pick]] = acc
    raw = np.flatnonzero(kind == ESCAPE)
    words[place[raw] + 1] = ids[start[raw]]
    off = np.zeros(blocks + 1, np.int64)
    np.cumsum(np.bincount(own, weights=size, minlength=blocks).astype(np.int64), out=off[1:])
    return words, off


def decode_words(words: np.ndarray) -> np.ndarray:
    """Ids of a run of whole blocks."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    kind = (words >> np.uint64(60)).astype(np.uint8)
    marks = np.flatnonzero(kind == ESCAPE)
    if len(marks):  # a raw word after an escape is no selector word
        head = np.ones(len(words), bool)
        i, last = 0, -1
        while i < len(marks):
            if marks[i] != last:
                last = marks[i] + 1
                head[last] = False
            i += 1
    else:
        head = np.ones(len(words), bool)
    place = np.flatnonzero(head)
    kind = kind[place]
    counts = np.array([c for c, _ in SELECTORS] + [1], np.int64)[kind]
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s, (count, width) in enumerate(SELECTORS):
        pick = np.flatnonzero(kind == s)
        if not len(pick) or width == 0:
            continue
        w = words[place[pick]]
        mask = np.uint64((1 << width) - 1)
        for j in range(count):
            out[start[pick] + j] = (w >> np.uint64(j * width)) & mask
    raw = np.flatnonzero(kind == ESCAPE)
    out[start[raw]] = words[place[raw] + 1]
    return out


# ------------------------------------------------------------------- the files

class ShardWriter:
    """Writes one shard with bounded memory."""

    def __init__(self, out):
        self.out = out
        self.out.write(MAGIC)
        self.wait: list[np.ndarray] = []
        self.n_wait = self.n_ids = self.n_words = 0
        self.block_off = [np.zeros(1, np.int64)]
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, n_tokens: np.ndarray,
            ids: np.ndarray) -> None:
        self.docs.append((doc_ids, n_tokens, nulls))
        self.wait.append(ids)
        self.n_wait += len(ids)
        step = PASS_BLOCKS * BLOCK_IDS
        if self.n_wait >= step:
            flat = np.concatenate(self.wait)
            whole = len(flat) // step * step
            for k in range(0, whole, step):
                self._put(flat[k:k + step])
            self.wait, self.n_wait = [flat[whole:]], len(flat) - whole

    def _put(self, ids: np.ndarray) -> None:
        words, off = encode_blocks(ids)
        self.out.write(words.astype("<u8").tobytes())
        self.block_off.append(off[1:] + self.n_words)
        self.n_words += len(words)
        self.n_ids += len(ids)

    def close(self) -> None:
        if self.n_wait:
            self._put(np.concatenate(self.wait))
        off = np.concatenate(self.block_off)
        ids, n, nulls = (np.concatenate(x) if self.docs else np.zeros(0, np.int64)
                         for x in (zip(*self.docs, strict=True) if self.docs else ((), (), ())))
        for a, kind in ((off, "<i8"), (ids, "<i8"), (n, "<i8"), (nulls, "u1")):
            self.out.write(np.asarray(a).astype(kind).tobytes())
        tail = (BLOCK_IDS, self.n_ids, self.n_words, len(off) - 1, len(ids), VERSION)
        self.out.write(np.array(tail, "<i8").tobytes() + MAGIC)


class ShardReader:
    """Random access to a shard's blocks."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        tail = f.read_at(56, size - 56)
        if tail[48:] != MAGIC or f.read_at(8, 0) != MAGIC:
            raise ValueError("not a complete token shard")
        self.block, self.n_ids, self.n_words, self.blocks, self.n_docs, version = \
            np.frombuffer(tail[:48], "<i8").tolist()
        if version != VERSION:
            raise ValueError(f"unknown token shard version {version}")
        at = 8 + 8 * self.n_words
        self.off = np.frombuffer(f.read_at(8 * (self.blocks + 1), at), "<i8")
        at += 8 * (self.blocks + 1)
        self.doc_ids = np.frombuffer(f.read_at(8 * self.n_docs, at), "<i8")
        self.n_tokens = np.frombuffer(f.read_at(8 * self.n_docs, at + 8 * self.n_docs), "<i8")
        self.nulls = np.frombuffer(f.read_at(self.n_docs, at + 16 * self.n_docs), "u1")

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks first to last - 1."""
        a, b = int(self.off[first]), int(self.off[last])
        return decode_words(np.frombuffer(self.f.read_at(8 * (b - a), 8 + 8 * a), "<u8"))


@tidy
def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer_path: str,
                 end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    fs = path = writer = out = None
    n_docs, part = 0, TaskContext.get().partitionId()
    for batch in batches:
        for b in text_slices(batch, max_bytes=4 << 20):
            if writer is None:
                fs, base = local_path(folder)
                fs.create_dir(base, recursive=True)
                # each attempt has a name of its own; the manifest names the one that counts
                name = f"shard-{part:06d}-{uuid.uuid4().hex[:12]}.s8b"
                path = f"{folder}/{name}"
                out = fs.open_output_stream(f"{base}/{name}")
                writer = ShardWriter(out)
            ids, off = tokenizer(tokenizer_path).encode(b.column("text"))
            n = np.diff(off) + 1
            flat = np.empty(len(ids) + len(n), np.uint64)
            ends = np.cumsum(n) - 1
            mine = np.ones(len(flat), bool)
            mine[ends] = False
            flat[mine], flat[ends] = ids, end_id
            key = b.column("doc_id")
            writer.add(key.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                       np.asarray(key.is_null().to_numpy(zero_copy_only=False), np.uint8), n, flat)
            n_docs += b.num_rows
    if writer is not None:
        writer.close()
        out.close()
        yield pa.RecordBatch.from_pydict({"shard": pa.array([part], pa.int64()), "path": [path],
                                          "n_docs": pa.array([n_docs], pa.int64()),
                                          "n_ids": pa.array([writer.n_ids], pa.int64())})


@tidy
def _read_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = local_path(row["path"])
            with fs.open_input_file(path) as f:
                r = ShardReader(f)
                crc = np.zeros(r.n_docs, np.int64)
                ends = np.cumsum(r.n_tokens)
                have, doc, seen = 0, 0, 0
                for k in range(0, r.blocks, PASS_BLOCKS):
                    raw = memoryview(r.ids(k, min(k + PASS_BLOCKS, r.blocks))
                                     .astype("<u4").tobytes())
                    got = have + len(raw) // 4
                    while doc < r.n_docs and seen < got:
                        stop = min(int(ends[doc]), got)
                        crc[doc] = zlib.crc32(raw[4 * (seen - have):4 * (stop - have)], int(crc[doc]))
                        seen = stop
                        if stop == ends[doc]:
                            doc += 1
                    have = got
                if have != r.n_ids or doc != r.n_docs:
                    raise ValueError(f"{row['path']} is damaged")
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(r.doc_ids, pa.int64(), mask=r.nulls.astype(bool)),
                "start": pa.array(row["base"] + ends - r.n_tokens, pa.int64()),
                "n_tokens": pa.array(r.n_tokens, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
                "shard": pa.array(np.full(r.n_docs, row["shard"]), pa.int64())})


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str,
                      end_id: int = 0) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into shards under ``folder``; returns the
    manifest (shard, path, n_docs, n_ids), one row per file.  The manifest is
    stored, so it names the files of the attempts that counted."""
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    manifest = ordered.mapInArrow(
        partial(_write_shard, folder=folder, tokenizer_path=tokenizer_path, end_id=end_id),
        "shard long, path string, n_docs long, n_ids long")
    return saved(manifest, "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard) from the files.  The running
    total is over one row per file."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = max(1, manifest.count())  # a number given here is not coalesced: a file, a task
    return (placed.select("shard", "path", "base").repartitionByRange(files, "shard")
            .mapInArrow(_read_shard, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"))


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` written as Simple-8b shards and read back."""
    import public_tokenizers
    manifest = write_token_files(table(spark, sf_dir, "documents"), scratch(spark, "token-files"),
                                 public_tokenizers.path(DEFAULT_TOKENIZER))
    return read_token_files(manifest)
