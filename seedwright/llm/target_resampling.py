"""Operator 12: importance resampling towards a target distribution.

Features are runs of 1 to ``max_words`` consecutive words, hashed into a fixed
number of buckets.  A bucket's gain is the log ratio of its smoothed share in
the target to its share in the corpus; a document's weight is the sum of its
features' gains, and the highest weights plus Gumbel noise are drawn, which is
sampling without replacement in proportion to exp(weight).

A batch interns its n-grams in an open-addressed table of NumPy arrays: the
xxhash64 of the bytes is the key, collisions probe the next slot, and an
occurrence joins a slot only if its bytes equal those of the slot's owner.  A
slot stores its bucket and its count, so each distinct n-gram of a batch is
put into a bucket once.  The first pass adds the counts up by bucket; the
second gathers gains by the occurrences' slot ids.

What crosses tasks is one row per bucket and task, and the gains (``buckets``
rows, fixed).  Ranks come from a range-partitioned, written order of (score,
doc_id) and one offset per partition.

Defined cases: null, empty and wordless texts have no features, weight 0 and
are never drawn; a null doc_id hashes as the empty string and comes last among
equals; rows that repeat are documents of their own; an empty table gives no
rows, an empty target counts as no features; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedwright.llm.common import (LOWER_AZ, saved, table, text_bytes, text_slices, tidy,
                                   words_per_document)
from seedwright.operators.chunking import ranged

#: Bytes of text that one table interns.
BATCH_BYTES = 1 << 20

# The primes of xxhash64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161,
    9650029242287828579, 2870177450012600261))

#: Bytes of words: digits, letters and everything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


class Grams:
    """All n-grams of a batch of texts, as spans of one buffer in which the
    words of a document stand one blank apart."""

    def __init__(self, texts: pa.Array, max_words: int):
        data, t_off = text_bytes(texts)
        data = LOWER_AZ[data]
        m = _WORD[data]
        first, last = m.copy(), m.copy()
        first[1:] &= ~m[:-1]
        last[:-1] &= ~m[1:]
        edge = t_off[:-1]
        edge = edge[edge < len(data)]
        first[edge] = m[edge]
        edge = t_off[1:]
        edge = edge[edge > 0] - 1
        last[edge] = m[edge]
        starts = np.flatnonzero(first)
        size = np.flatnonzero(last) + 1 - starts
        self.word_off = words_per_document(starts, t_off)
        # one blank after each word; eight more bytes for loads at the end
        end = np.cumsum(size + 1) - 1
        buf = np.full(int(end[-1]) + 9 if len(end) else 8, 32, np.uint8)
        kept = np.ones(len(buf), bool)
        kept[end] = False
        kept[len(buf) - 8:] = False
        buf[kept] = data[m]
        self.buf, self.raw = buf, buf.tobytes()
        begin = end - size
        n = np.diff(self.word_off)
        doc = np.repeat(np.arange(len(n)), n)
        left = np.repeat(self.word_off[1:], n) - np.arange(len(starts))
        spans = [(begin[:len(begin) - k + 1][left[:len(begin) - k + 1] >= k],
                  end[k - 1:][left[:len(begin) - k + 1] >= k],
                  doc[:len(begin) - k + 1][left[:len(begin) - k + 1] >= k])
                 for k in range(1, max_words + 1)]
        self.start, self.end, self.doc = (np.concatenate(x) for x in zip(*spans, strict=True))
        self.size = self.end - self.start
        self.documents = len(n)

    def _load(self, at: np.ndarray, width: int) -> np.ndarray:
        """Little-endian integers of ``width`` bytes at any places."""
        view = np.ndarray((len(self.buf) - width + 1,), f"<u{width}", self.buf, 0, (1,))
        return view[at].astype(np.uint64)

    def keys(self) -> np.ndarray:
        """xxhash64, seed 0, of each n-gram's bytes."""
        size = self.size
        h = P5 + size.astype(np.uint64)
        at = self.start.copy()
        short = size < 32
        for lane in range(3):
            on = np.flatnonzero(short & (size >= 8 * lane + 8))
            if not len(on):
                break
            k = _rotl(self._load(at[on], 8) * P2, 31) * P1
            h[on] = _rotl(h[on] ^ k, 27) * P1 + P4
            at[on] += 8
        on = np.flatnonzero(short & (size & 4 > 0))
        h[on] = _rotl(h[on] ^ (self._load(at[on], 4) * P1), 23) * P2 + P3
        at[on] += 4
        for byte in range(1, 4):
            on = np.flatnonzero(short & (size & 3 >= byte))
            h[on] = _rotl(h[on] ^ (self.buf[at[on]].astype(np.uint64) * P5), 11) * P1
            at[on] += 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(~short).tolist():
            h[i] = xxhash.xxh64_intdigest(self.bytes_of(i))
        return h

    def bytes_of(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether n-grams a[i] and b[i] have the same bytes."""
        size = self.size[a]
        out = size == self.size[b]
        x, y = self.start[a], self.start[b]
        for lane in range(4):
            on = np.flatnonzero(out & (size > 8 * lane))
            if not len(on):
                break
            rest = np.minimum(size[on] - 8 * lane, 8).astype(np.uint64)
            drop = np.uint64(64) - np.uint64(8) * rest
            out[on] = ((self._load(x[on] + 8 * lane, 8) ^ self._load(y[on] + 8 * lane, 8)) << drop) == 0
        for i in np.flatnonzero(out & (size > 32) & (a != b)).tolist():
            out[i] = self.bytes_of(a[i]) == self.bytes_of(b[i])
        return out


class GramTable:
    """Open-addressed table over the n-grams of one batch."""

    def __init__(self, grams: Grams, buckets: int, keys: np.ndarray | None = None):
        key = grams.keys() if keys is None else keys
        n = len(key)
        room = 1 << max(4, int(2 * n).bit_length())
        owner = np.full(room, -1, np.int64)
        #: slot id of each occurrence
        self.slot = np.empty(n, np.int64)
        todo = np.arange(n)
        at = (key & np.uint64(room - 1)).astype(np.int64)
        while len(todo):
            free = owner[at] < 0
            owner[at[free]] = todo[free]
            held = owner[at]
            mine = key[held] == key[todo]
            mine[mine] = grams.same(held[mine], todo[mine])
            self.slot[todo[mine]] = at[mine]
            todo, at = todo[~mine], (at[~mine] + 1) & (room - 1)
        used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.slot, minlength=room)
        self.bucket = np.zeros(room, np.int64)
        self.bucket[used] = np.fromiter((zlib.crc32(grams.bytes_of(i)) % buckets for i in owner[used].tolist()),
                                        np.int64, len(used))

    def bucket_counts(self, buckets: int) -> np.ndarray:
        used = np.flatnonzero(self.count)
        out = np.zeros(buckets, np.int64)
        np.add.at(out, self.bucket[used], self.count[used])
        return out


@tidy
def _count(batches: Iterator[pa.RecordBatch], buckets: int, max_words: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for b in text_slices(batch, max_bytes=BATCH_BYTES):
            total += GramTable(Grams(b.column("text"), max_words), buckets).bucket_counts(buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})


def bucket_counts(texts: DataFrame, buckets: int, max_words: int) -> DataFrame:
    """(bucket, n) over all texts; a task sends a row per bucket at most."""
    part = texts.select("text").mapInArrow(partial(_count, buckets=buckets, max_words=max_words), "bucket int, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int, max_words: int) -> DataFrame:
    """(bucket, gain) of every bucket."""
    each = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    s = bucket_counts(docs, buckets, max_words).withColumnRenamed("n", "s")
    t = bucket_counts(target, buckets, max_words).withColumnRenamed("n", "t")
    both = each.join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    whole = Window.partitionBy()  # over the buckets, a fixed number of rows
    both = both.withColumn("all_s", F.sum("s").over(whole)).withColumn("all_t", F.sum("t").over(whole))
    ratio = F.expr(f"((t + 1) * cast(all_s + {buckets} as double)) / ((s + 1) * cast(all_t + {buckets} as double))")
    return both.select("bucket", F.floor(F.lit(1000) * F.log(ratio)).cast("long").alias("gain"))


@tidy
def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, max_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in text_slices(batch, max_bytes=BATCH_BYTES):
            grams = Grams(b.column("text"), max_words)
            t = GramTable(grams, len(gain))
            got = gain[t.bucket][t.slot]
            weight = np.zeros(grams.documents, np.int64)
            np.add.at(weight, grams.doc, got)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"),
                "n_words": pa.array(np.diff(grams.word_off), pa.int64()),
                "n_features": pa.array(np.bincount(grams.doc, minlength=grams.documents), pa.int64()),
                "weight": pa.array(weight, pa.int64())})


def weigh(docs: DataFrame, target: DataFrame, buckets: int = 10_000, max_words: int = 2,
          seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row, written."""
    rows = gains(docs, target, buckets, max_words).collect()  # ``buckets`` rows
    gain = np.zeros(buckets, np.int64)
    for r in rows:
        gain[r.bucket] = r.gain
    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
           .mapInArrow(partial(_weigh, gain=gain, max_words=max_words),
                       "doc_id long, n_words long, n_features long, weight long"))
    word = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(word, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return saved(out.withColumn("score", F.col("weight") + noise), "weighed")


def resample(docs: DataFrame, target: DataFrame, percent: int, buckets: int = 10_000, max_words: int = 2,
             seed: int = 2024, min_words: int = 20) -> DataFrame:
    """Every row with its rank among the drawn, null if it is not: the highest
    ``percent`` of the rows with ``min_words`` words, by (score down, doc_id)."""
    rows = weigh(docs, target, buckets, max_words, seed)
    can = rows.filter(F.col("n_words") >= min_words)
    # rows that are equal in all columns are spread by a number of their own
    keys = can.select("doc_id", "n_features", "weight", "score", (-F.col("score")).alias("down"),
                      F.col("doc_id").isNull().alias("last"), F.monotonically_increasing_id().alias("own"))
    order = ["down", "last", "doc_id", "own"]
    laid = ranged(keys, order)
    sizes = {r["_pid"]: r["n"] for r in laid.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a partition
    draw = percent * sum(sizes.values()) // 100
    starts, total = [], 0
    for pid in sorted(sizes):
        starts.append((pid, total))
        total += sizes[pid]
    before = docs.sparkSession.createDataFrame(starts, "_pid int, before long")
    place = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) + F.col("before")
    ranked = (laid.join(F.broadcast(before), "_pid")
              .withColumn("place", place.cast("long"))
              .withColumn("rank", F.when(F.col("place") <= draw, F.col("place"))))
    cols = ["doc_id", "n_features", "weight", "score"]
    rest = rows.filter(F.col("n_words") < min_words).select(*cols, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*cols, "rank").unionByName(rest)


def drawn(docs: DataFrame, target: DataFrame, percent: int, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn; doc_id must be unique."""
    ids = resample(docs, target, percent, **options).filter("rank is not null").select("doc_id")
    return docs.join(ids, "doc_id", "left_semi").select(*docs.columns)


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of ``documents`` drawn towards the texts of ``benchmark``."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10,
                    buckets=10_000, max_words=1, seed=2024, min_words=20)


def op12_sql() -> str:
    """The same in DuckDB, with words as rows and crc32 by its byte table."""
    step = "list_transform({}, lambda c: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    crc_table = "range(0, 256)"
    for _ in range(8):
        crc_table = step.format(crc_table)
    return rf"""
with tab as (select {crc_table} as bytes),
w as (select 0 as kind, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from documents
      union all
      select 1, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
v as (select word, hex(encode(word)) as h from (select distinct word from w)),
b as (select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
        lambda c, x: xor(c >> 8, bytes[xor(c, x) % 256 + 1])), 4294967295) % 10000 as bucket from v, tab),
f as (select kind, doc_id, bucket from w join b using (word)),
n as (select bucket, count(*) filter (kind = 0) as s, count(*) filter (kind = 1) as t from f group by bucket),
a as (select sum(s) as ss, sum(t) as tt from n),
g as (select bucket, cast(floor(1000 * ln(((t + 1) * cast(tot.ss + 10000 as double)) / ((s + 1) * cast(tot.tt + 10000 as double)))) as bigint) as gain from n, a tot),
d as (select doc_id, count(*) as n_features, sum(gain) as weight from f join g using (bucket) where kind = 0 group by doc_id),
e as (select o.doc_id, coalesce(n_features, 0) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
        cast(('0x' || substr(sha256('2024:' || o.doc_id), 1, 8))::bigint as double) as h
      from documents o left join d on d.doc_id = o.doc_id),
k as (select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) as bigint) as score from e),
r as (select doc_id, row_number() over (order by score desc, doc_id) as place, 10 * count(*) over () // 100 as draw from k where n_features >= 20)
select k.doc_id, k.n_features, k.weight, k.score, case when place <= draw then place end as rank
from k left join r on r.doc_id = k.doc_id
"""
