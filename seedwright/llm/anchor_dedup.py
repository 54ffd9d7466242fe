"""Operator 8: repeated word sequences by difference-cover anchors.

A difference cover D modulo v has, for any two positions, a shift below v that
takes both into D.  Anchors are hashes of window - v + 1 words at positions of
D only, so two equal windows always share an anchor at the same offset, from
wherever they start.  Anchors seen twice mark candidate windows; each candidate
is then extended to its whole window, whose 96-bit hash decides.

A task combines its own anchors first: one seen twice there is settled on the
spot and sent on once, without a position, to tell other tasks.  A passage that
a third of all documents share thus costs each task one row, and no group grows
past the number of tasks.  Texts move only for documents with a candidate.

Defined cases: null and empty texts have no words and the digest of the empty
string; shorter texts than a window keep all words; rows that repeat, with or
without a doc_id, are documents of their own and remove each other; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedwright.llm.common import (as_signed, bitmap, maybe_in, mix64, saved, span_hashes, table,
                                   text_bytes, text_slices, word_bounds, word_hashes,
                                   words_per_document)

# Perfect difference sets by period.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
}
#: Rows that a task holds before it combines and sends them.
HOLD_ROWS = 1_000_000
#: Sent for a hash that is already known to repeat.
KNOWN = 2


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of two fifths of the window."""
    period = max(p for p in COVERS if p == 1 or window - p + 1 >= 0.4 * window)
    return period, COVERS[period]


class _Sender:
    """Rows (key, check, rid, pos, n) of a task, combined by key."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, key: np.ndarray, check: np.ndarray, rid: np.ndarray, pos: np.ndarray):
        self.parts.append((key, check, rid, pos))
        self.rows += len(key)
        if self.rows >= HOLD_ROWS:
            yield from self.flush()

    def flush(self):
        if not self.rows:
            return
        key, check, rid, pos = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.rows = [], 0
        order = np.lexsort((check, key))
        same = np.zeros(len(key) + 1, bool)
        k, c = key[order], check[order]
        same[1:-1] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
        repeated = same[:-1] | same[1:]
        leads = np.flatnonzero(repeated & ~same[:-1])
        single = order[~repeated]
        yield _rows(key[single], check[single], rid[single], pos[single], 1)
        if len(leads):
            yield _rows(k[leads], c[leads], None, None, KNOWN)
            mine = order[repeated]
            spread = mix64(rid[mine].view(np.uint64) + pos[mine].astype(np.uint64))
            yield _rows(spread, np.full(len(mine), -1, np.int32), rid[mine], pos[mine], KNOWN)


def _rows(key, check, rid, pos, n: int) -> pa.RecordBatch:
    size = len(key)
    return pa.RecordBatch.from_pydict({
        "key": pa.array(as_signed(key)), "check": pa.array(check, pa.int32()),
        "rid": pa.nulls(size, pa.int64()) if rid is None else pa.array(rid, pa.int64()),
        "pos": pa.nulls(size, pa.int32()) if pos is None else pa.array(pos, pa.int32()),
        "n": pa.array(np.full(size, n, np.int32))})


_ROWS = "key long, check int, rid long, pos int, n int"


class _Words:
    """Word hashes of a slice of documents."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, self.t_off = text_bytes(batch.column("text"))
        self.starts, self.ends = word_bounds(self.data, self.t_off)
        self.off = words_per_document(self.starts, self.t_off)
        self.n = np.diff(self.off)
        self.rid = batch.column("rid").to_numpy(zero_copy_only=False)

    def hashes(self, seed: int) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends, seed=seed)

    def spread(self, offsets: np.ndarray, values: np.ndarray, before: int, after: int,
               last: np.ndarray) -> np.ndarray:
        """Marks, over all words, [p - before, p + after] of each document's
        positions p, up to its ``last``."""
        doc = np.repeat(np.arange(len(self.n)), np.diff(offsets))
        lo = np.maximum(values - before, 0)
        hi = np.minimum(values + after, last[doc])
        ok = hi >= lo
        size = len(self.starts) + 1
        step = np.bincount(self.off[doc[ok]] + lo[ok], minlength=size).astype(np.int64)
        step -= np.bincount(self.off[doc[ok]] + hi[ok] + 1, minlength=size)
        return np.cumsum(step)[:-1] > 0


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    period, cover = cover_for(window)
    length = window - period + 1
    inside = np.zeros(period, bool)
    inside[list(cover)] = True
    send = _Sender()
    for batch in batches:
        for b in text_slices(batch):
            w = _Words(b)
            doc = np.repeat(np.arange(len(w.n)), w.n)
            at = np.arange(len(w.starts)) - w.off[doc]
            n = w.n[doc]
            pick = np.flatnonzero((n >= window) & (at + length <= n) & inside[at % period])
            if not len(pick):
                continue
            key = mix64(span_hashes(w.hashes(1), pick, pick + length))
            yield from send.add(key, np.zeros(len(pick), np.int32), w.rid[doc[pick]],
                                at[pick].astype(np.int32))
    yield from send.flush()


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    period, _ = cover_for(window)
    send = _Sender()
    for batch in batches:
        for b in text_slices(batch):
            w = _Words(b)
            p = b.column("positions")
            off = np.asarray(p.offsets).astype(np.int64)
            mark = w.spread(off - off[0], p.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                            period - 1, 0, w.n - window)
            pick = np.flatnonzero(mark)
            if not len(pick):
                continue
            doc = np.searchsorted(w.off, pick, side="right") - 1
            key = mix64(span_hashes(w.hashes(2), pick, pick + window))
            check = mix64(span_hashes(w.hashes(3), pick, pick + window)) >> np.uint64(33)
            yield from send.add(key, check.astype(np.int32), w.rid[doc],
                                (pick - w.off[doc]).astype(np.int32))
    yield from send.flush()


def _kept(batches: Iterator[pa.RecordBatch], window: int, texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in text_slices(batch):
            w = _Words(b)
            gone = np.zeros(len(w.starts), bool)
            if "positions" in b.schema.names:
                p = b.column("positions")
                filled = p.fill_null([]) if p.null_count else p
                off = np.asarray(filled.offsets).astype(np.int64)
                gone = w.spread(off - off[0],
                                filled.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                                0, window - 1, w.n - 1)
            doc = np.repeat(np.arange(len(w.n)), w.n)
            s, e, d = w.starts[~gone], w.ends[~gone], doc[~gone]
            step = np.zeros(len(w.data) + 1, np.int8)
            step[s] += 1
            step[e] -= 1
            keep = np.cumsum(step, dtype=np.int8)[:-1] > 0
            blank = e[:-1][d[1:] == d[:-1]]  # after each kept word but a document's last
            data = w.data.copy()
            data[blank] = 32
            keep[blank] = True
            out = data[keep]
            size = np.bincount(d, weights=e - s, minlength=len(w.n)).astype(np.int64)
            n_kept = np.bincount(d, minlength=len(w.n))
            ends = np.cumsum(size + np.maximum(n_kept - 1, 0))
            raw = memoryview(out.tobytes())
            bounds = list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)) if len(ends) else []
            cols = {"doc_id": b.column("doc_id"), "n_words": pa.array(w.n.astype(np.int64)),
                    "n_removed": pa.array((w.n - n_kept).astype(np.int64)),
                    "kept_sha256": [hashlib.sha256(raw[x:y]).hexdigest() for x, y in bounds]}
            if texts:
                cols["kept_text"] = [bytes(raw[x:y]).decode() for x, y in bounds]
            yield pa.RecordBatch.from_pydict(cols)


def _repeated(rows: DataFrame) -> DataFrame:
    """(rid, positions) of keys that occur twice or more.  No key has more rows
    than there are flushes of tasks; rows that are equal share one list, which
    has each position once."""
    times = F.sum("n").over(Window.partitionBy("key", "check"))
    return (rows.withColumn("times", times)
            .filter("rid is not null and (times > 1 or n > 1)")
            .groupBy("rid").agg(F.collect_set("pos").alias("positions")))


def remove_repeats(docs: DataFrame, window: int = 50, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for each row:
    the words left when every word in a repeated window of ``window`` words is
    taken out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64("doc_id", "text").alias("rid"))
    anchors = saved(_repeated(docs.mapInArrow(partial(_anchors, window=window), _ROWS)), "anchors")
    bits = saved(bitmap(anchors, "rid"), "anchor-bits")
    hit = maybe_in(docs, "rid", bits)
    windows = _repeated(hit.join(anchors, "rid").select("rid", "text", "positions")
                        .mapInArrow(partial(_windows, window=window), _ROWS))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    touched = (hit.join(windows, "rid", "left").select("doc_id", "rid", "text", "positions")
               .mapInArrow(partial(_kept, window=window, texts=texts), out))
    rest = (maybe_in(docs, "rid", bits, inside=False)
            .mapInArrow(partial(_kept, window=window, texts=texts), out))
    return touched.unionByName(rest)


def op8_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 35-word windows taken out of all of ``documents``."""
    return remove_repeats(table(spark, sf_dir, "documents"), window=35, texts=False)
