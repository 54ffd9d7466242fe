"""Operator 2: near duplicates by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum
and its maximum, so 64 permutations fill 128 values.  A band is two
permutations (four values); with 32 bands a pair at similarity 0.8 shares no
bucket with a probability of about 5e-8.  Two documents that share a bucket are
candidates; a link counts only when the full sets confirm it.

Copies (equal sets, told by 128 bits) are one class from the start, found by a
group minimum that combines before the shuffle.  Then two rounds follow.  In the
first, each bucket's least member is compared with the others, which joins
groups of near copies.  In the second, members that are still in different
components are compared: in buckets of up to ``SMALL_BUCKET`` members pair by
pair, in larger ones by two joins that together lose no link:

* pairs whose overlap could come from frequent shingles alone meet in their
  bucket (their first common one), if the bound on their overlap allows a link.
  Members with too few frequent shingles for any such link leave first;
* any other link needs a common rare shingle (in at most ``RARE`` members of
  large buckets), so these pairs meet on their rare shingles.

Members of the bucket's largest component are not compared with each other, and
nor are members of one component anywhere.

Defined cases: null and empty texts have an empty set, size 0, and are linked
with nothing; texts of fewer words than a shingle have their whole sequence as
one; rows that share a doc_id count as one document with several texts; rows
without a doc_id are returned with a null component and kept; an empty table
gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import (as_signed, bitmap, is_empty, maybe_in, mix64, saved, table,
                                   text_bytes, text_slices, tidy, word_bounds, word_hashes,
                                   words_per_document)
from seedwright.llm.components import components

PERMUTATIONS = 64
BANDS = 32
#: Signature values of 128 that must agree before sets are compared.  A pair at
#: similarity 0.8 agrees in 102.6 on average, standard deviation 4.5.
MIN_AGREE = 72
#: Buckets up to this size compare members pair by pair in the second round.
SMALL_BUCKET = 32
#: Members of large buckets that hold a rare shingle, at most.
RARE = 64

_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingle_hashes(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of the k-word shingles of each text, repeats included;
    shorter texts have their whole sequence as one."""
    data, t_off = text_bytes(texts)
    starts, ends = word_bounds(data, t_off)
    h = word_hashes(data, starts, ends, lower=True)
    w_off = words_per_document(starts, t_off)
    n = np.diff(w_off)
    out_n = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    off = np.concatenate([[0], np.cumsum(out_n)])
    first = np.repeat(w_off[:-1] - off[:-1], out_n) + np.arange(off[-1])
    left = np.repeat(w_off[1:], out_n) - first  # words from here to the end
    acc = np.zeros(len(first), np.uint64)
    for j in range(k):
        inside = left > j
        part = h[np.minimum(first + j, max(len(h) - 1, 0))] if len(h) else h
        acc = np.where(inside, mix64(acc * np.uint64(0xA24BAED4963EE407) + part, j + 1), acc)
    return acc, off


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, off = shingle_hashes(texts, k)
    return [np.unique(h[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]


@tidy
def _sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    values, per_band = 2 * PERMUTATIONS, 2 * PERMUTATIONS // BANDS
    for batch in batches:
        for b in text_slices(batch):
            sets = shingle_sets(b.column("text"), k)
            n = np.array([len(s) for s in sets], np.int64)
            rows = len(n)
            sig = np.zeros((rows, values), np.uint64)
            d = np.zeros((2, rows), np.uint64)
            full = np.flatnonzero(n)
            if len(full):
                x = np.concatenate([sets[i] for i in full])
                at = np.cumsum(n[full]) - n[full]
                for j in range(PERMUTATIONS):
                    y = x * _A[j] + _B[j]
                    sig[full, 2 * j] = np.minimum.reduceat(y, at)
                    sig[full, 2 * j + 1] = np.maximum.reduceat(y, at)
                for j in range(2):
                    d[j, full] = np.add.reduceat(mix64(x.copy(), 7 + j), at)
            bands = np.zeros((rows, BANDS), np.uint64)
            for j in range(per_band):
                bands = mix64(bands * np.uint64(0x9FB21C651E98DF25) + sig[:, j::per_band],
                              j + 1)
            bands ^= mix64(np.arange(BANDS, dtype=np.uint64), 99)
            small = (sig >> np.uint64(56)).astype(np.uint8) ^ sig.astype(np.uint8)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n": pa.array(n),
                "d1": pa.array(as_signed(d[0])), "d2": pa.array(as_signed(d[1])),
                "sig": pa.array([r.tobytes() for r in small], pa.binary()),
                "bands": pa.ListArray.from_arrays(
                    pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS),
                    pa.array(as_signed(np.ascontiguousarray(bands).reshape(-1))))})


@tidy
def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in text_slices(batch):
            sets = shingle_sets(b.column("text"), k)
            off = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict({
                "node": b.column("doc_id"),
                "members": pa.ListArray.from_arrays(pa.array(off), pa.array(as_signed(flat)))})


@tidy
def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
                .reshape(batch.num_rows, 2 * PERMUTATIONS) for c in ("sig_u", "sig_v"))
        keep = (x == y).sum(axis=1) >= MIN_AGREE
        yield batch.filter(pa.array(keep)).select(["u", "v"])


class _Confirmer:
    """Confirms candidate pairs on full sets; a set is made once."""

    def __init__(self, docs: DataFrame, classes: DataFrame, k: int, percent: int):
        self.docs, self.classes, self.k, self.percent = docs, classes, k, percent
        self.sets: DataFrame | None = None

    def make_sets(self, nodes: DataFrame) -> None:
        """The sets of these nodes, besides those at hand."""
        if self.sets is not None:
            nodes = nodes.join(self.sets.select("node"), "node", "left_anti")
        need = nodes.distinct()
        # an inner join: a semi join would be moved below the filter, to all texts
        mine = (maybe_in(self.docs.filter("doc_id is not null"), "doc_id", saved(bitmap(need, "node"), "set-bits"))
                .join(need.withColumnRenamed("node", "doc_id"), "doc_id"))
        made = saved(mine.mapInArrow(partial(_sets, k=self.k), "node long, members array<long>"), "sets")
        self.sets = made if self.sets is None else self.sets.unionByName(made)

    def may_link(self, n_u: str, n_v: str) -> Column:
        return F.lit(100) * F.least(n_u, n_v) >= F.lit(self.percent) * F.greatest(n_u, n_v)

    def __call__(self, pairs: DataFrame) -> DataFrame:
        side = self.classes.select("node", "n", "sig")
        u = side.select(*(F.col(c).alias(f"{c}_u" if c != "node" else "u") for c in side.columns))
        v = side.select(*(F.col(c).alias(f"{c}_v" if c != "node" else "v") for c in side.columns))
        near = (pairs.join(u, "u").join(v, "v").filter(self.may_link("n_u", "n_v"))
                .select("u", "v", "sig_u", "sig_v").mapInArrow(_agreeing, "u long, v long"))
        near = saved(near, "near-pairs")
        self.make_sets(near.select(F.col("u").alias("node")).union(near.select("v")))
        both = (near.join(self.sets.select(F.col("node").alias("v"), F.col("members").alias("y")), "v")
                .join(self.sets.select(F.col("node").alias("u"), F.col("members").alias("x")), "u"))
        shared = both.select("u", "v", F.size(F.array_intersect("x", "y")).cast("long").alias("i"),
                             (F.size("x") + F.size("y")).cast("long").alias("t"))
        return (shared.filter(F.lit(100) * F.col("i") >= F.lit(self.percent) * (F.col("t") - F.col("i")))
                .select("u", "v").distinct())


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v"))


def _other(df: DataFrame, *columns: str) -> DataFrame:
    """A copy for the other side of a pair."""
    names = {"node": "other"} | {c: f"other_{c}" for c in columns}
    return df.select("bucket", *(F.col(a).alias(b) for a, b in names.items()))


def _small_pairs(rows: DataFrame) -> DataFrame:
    """Pairs across components of small buckets; the lead's are compared already."""
    rest = rows.filter((F.col("m") <= SMALL_BUCKET) & (F.col("node") != F.col("lead"))).select("bucket", "node", "comp")
    return _ordered(rest.join(_other(rest, "comp"), "bucket").filter("node < other and comp <> other_comp"))


def _large_pairs(rows: DataFrame, classes: DataFrame, confirm: _Confirmer) -> DataFrame | None:
    """Pairs across components of large buckets that can be links."""
    rows = rows.filter(F.col("m") > SMALL_BUCKET)
    if is_empty(rows):
        return None
    biggest = (rows.groupBy("bucket", "comp").agg(F.count("*").alias("k")).groupBy("bucket")
               .agg(F.max_by("comp", F.struct("k", "comp")).alias("biggest")))
    rows = saved(rows.filter(F.col("node") != F.col("lead")).join(biggest, "bucket")
                 .select("bucket", "band", "node", "comp", (F.col("comp") != F.col("biggest")).alias("apart")), "large-rows")
    nodes = rows.groupBy("node").agg(F.first("comp").alias("comp"), F.max("apart").alias("apart"))
    confirm.make_sets(nodes.select("node"))
    held = (confirm.sets.join(nodes, "node").select("node", "comp", "apart", F.size("members").cast("long").alias("n"),
                                                    F.explode("members").alias("shingle")))
    times = held.groupBy("shingle").agg(F.count("*").alias("times"))
    held = saved(held.join(times, "shingle"), "held-shingles")
    frequent = held.groupBy("node").agg(F.count_if(F.col("times") > RARE).alias("frequent"))
    info = saved(frequent.join(classes.select("node", "n", "bands"), "node"), "large-nodes")
    # overlap that a link needs, times 100 + percent; bounds compare with it
    need = F.lit(confirm.percent) * (F.col("n") + F.col("other_n"))
    bound = F.lit(100 + confirm.percent) * F.least("frequent", "other_frequent")
    # 180 * f >= 80 * (n + other_n) and 100 * other_n >= 80 * n, for 80 percent
    p = confirm.percent
    rows = rows.join(info.filter(F.lit((100 + p) * 100) * F.col("frequent") >= F.lit(p * (100 + p)) * F.col("n")), "node")
    earlier = F.expr("exists(zip_with(slice(bands, 1, band), slice(other_bands, 1, band), (a, b) -> a = b), x -> x)")
    dense = (rows.filter("apart").join(_other(rows, "comp", "n", "apart", "frequent", "bands"), "bucket")
             .filter("comp <> other_comp and (not other_apart or node < other)")
             .filter(bound >= need).filter(confirm.may_link("n", "other_n")).filter(~earlier))
    rare = held.filter(F.col("times").between(2, RARE)).join(frequent, "node").withColumnRenamed("shingle", "bucket")
    light = (rare.filter("apart").join(_other(rare, "comp", "n", "apart", "frequent"), "bucket")
             .filter("comp <> other_comp and (not other_apart or node < other)")
             .filter(bound < need).filter(confirm.may_link("n", "other_n")))
    return _ordered(dense).unionByName(_ordered(light))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``percent`` is the least similarity of a link; the bands are laid out for
    80 and more."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = saved(docs.mapInArrow(
        partial(_sketch, k=shingle_words),
        "doc_id long, n long, d1 long, d2 long, sig binary, bands array<long>"), "sketch")
    classes = saved(sketch.filter("n > 0 and doc_id is not null").groupBy("n", "d1", "d2")
                    .agg(F.min(F.struct("doc_id", "sig", "bands")).alias("r"))
                    .select(F.col("r.doc_id").alias("node"), "n", "d1", "d2", "r.sig", "r.bands"),
                    "classes")
    bands = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = saved(bands.groupBy("bucket").agg(F.min("node").alias("lead"), F.count("*").alias("m")).filter("m > 1"),
                   "shared-buckets")
    bands = saved(maybe_in(bands, "bucket", bitmap(shared, "bucket")).join(shared, "bucket")
                  .select("bucket", "band", "node", "lead", "m"), "bands")
    confirm = _Confirmer(docs, classes, shingle_words, percent)
    first = bands.filter("node <> lead").select(F.col("lead").alias("u"), F.col("node").alias("v")).distinct()
    stars = components(confirm(first))
    rows = (bands.join(stars.select(F.col("u").alias("node"), F.col("v").alias("least")), "node", "left")
            .select("bucket", "band", "node", "lead", "m", F.coalesce("least", "node").alias("comp")))
    apart = rows.groupBy("bucket").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b")
    rows = saved(rows.join(apart.select("bucket"), "bucket", "left_semi").filter("m > 2"), "open-buckets")
    pairs = _small_pairs(rows)
    large = _large_pairs(rows, classes, confirm)
    pairs = saved((pairs if large is None else pairs.unionByName(large)).distinct(), "pairs")
    if not is_empty(pairs):
        stars = components(confirm(pairs).unionByName(stars))
    of = (classes.select("n", "d1", "d2", F.col("node").alias("class_id"))
          .join(stars.select(F.col("u").alias("class_id"), F.col("v").alias("least")), "class_id", "left")
          .select("n", "d1", "d2", F.coalesce("least", "class_id").alias("class_id")))
    return (sketch.select("doc_id", "n", "d1", "d2").join(of, ["n", "d1", "d2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op2_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all of ``documents``: two-word shingles, 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)
