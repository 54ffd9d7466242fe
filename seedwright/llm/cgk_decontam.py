"""Operator 9: benchmark decontamination by CGK random-walk embedding.

The CGK walk reads a word sequence with a pointer that, at each step, stays or
moves on by a random bit of (step, word).  Two sequences at a small edit
distance fall back into step, so their walks agree in most places: edit distance
becomes Hamming distance, and sampling places of the walk is a locality-
sensitive hash.  Items have windows of their own size, half to four fifths of it
(32 words at most), at every offset; documents have windows of these sizes every
half size, so each verbatim copy holds an aligned window, which hits in every
repeat.  Three of the walk's places are sampled, in ``repeats(size)`` walks: the
target is a recall of 0.95 at ``MAX_EDITS`` for every length.  An exact word edit
distance against the whole item decides on each place where a copy may start.

Two filters lose no window that lies in a copy.  It holds as many words of the
benchmark as its size less the edits allowed; and a walk is given up as soon as
the places sampled so far are those of no item.  A bitmap of fixed size
(``KEY_BITS``) holds the benchmark's words, and its items' keys after one, two
and three places.

A benchmark with at most ``LISTED_KEYS`` windows and ``LISTED_BYTES`` of text goes
to the tasks whole, which verify their own hits: nothing is shuffled.  A larger
one meets the hits by joins: windows by key, then each document with a hit once
with its places, then each place with its item.

Defined cases: null and empty texts match nothing, nor do items without words;
words compare after folding A-Z and dropping ASCII punctuation at their ends;
items that repeat are matched one by one, and so are rows that repeat; documents
without a doc_id are matched, with a null doc_id; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import (LOWER_AZ, as_signed, bitmap, maybe_in, mix64, saved, table, text_bytes,
                                   text_slices, tidy, word_bounds, word_hashes, words_per_document)

SIZES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)
SAMPLES = 3
KEY_BITS = 1 << 25
LISTED_KEYS = 1_000_000
LISTED_BYTES = 16 << 20
MAX_EDITS = 0.2


def repeats(size: int) -> int:
    """Walks of a window; items with windows of up to three words have no edits."""
    return 1 if size <= 3 else 24 if size == 4 or size >= 24 else 16


def _places(size: int) -> list[list[int]]:
    """The places that each repeat samples, one in each part of the walk (near
    its start, places would often be one word)."""
    rng = np.random.default_rng(917 + size)
    n = min(SAMPLES, 2 * size)
    edges = np.linspace(0, max(n, 1.8 * size), n + 1).astype(int)
    return [[int(rng.integers(a, b)) for a, b in zip(edges[:-1], edges[1:], strict=True)] for _ in range(repeats(size))]


PLACES = {c: _places(c) for c in SIZES}


def stride(size: int) -> int:
    return max(1, size // 2)


def size_class(words: int) -> int:
    """The largest window of which any placement of the item holds an aligned one."""
    return max(c for c in SIZES if c + stride(c) - 1 <= words)


_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_IS_PUNCT = np.zeros(256, bool)
_IS_PUNCT[list(_PUNCT)] = True
_PAD = np.uint64(0x6A09E667F3BCC909)
#: Words that a walk may read past the last one.
_TAIL = 2 * max(SIZES)


def _strip(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds without ASCII punctuation at the ends, one byte at least."""
    s, e = s.copy(), e.copy()
    for ahead in (True, False):
        at = np.arange(len(s))
        while len(at):
            byte = data[s[at]] if ahead else data[e[at] - 1]
            at = at[_IS_PUNCT[byte] & (e[at] - s[at] > 1)]
            if ahead:
                s[at] += 1
            else:
                e[at] -= 1
    return s, e


_FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_P = _PUNCT.decode()


def plain_words(text: str) -> list[str]:
    """The words of a text as they are compared."""
    return [w.strip(_P) or w[-1:] for w in re.findall(r"[^\x20\x09-\x0D]+", text.translate(_FOLD))]


class _Text:
    def __init__(self, texts: pa.Array):
        self.data, self.t_off = text_bytes(texts)
        self.starts, self.ends = word_bounds(self.data, self.t_off)
        self.off = words_per_document(self.starts, self.t_off)
        self.n = np.diff(self.off)
        low = LOWER_AZ[self.data]
        self.h = word_hashes(low, *_strip(low, self.starts, self.ends), seed=11)


class _Walks:
    """Walks over the words with hashes ``h``."""

    def __init__(self, h: np.ndarray):
        self.h = np.concatenate([h, np.zeros(_TAIL, np.uint64)])
        self.bits: dict[int, np.ndarray] = {}

    def keys(self, starts: np.ndarray, size: int, repeat: int, seen=None) -> tuple[np.ndarray, list[np.ndarray]]:
        """(starts that are left, their keys after each sampled place), the last
        ones being the windows' keys.  ``seen`` tells which keys may be an
        item's; without it all starts are left."""
        if repeat not in self.bits:
            self.bits[repeat] = mix64(self.h.copy(), 1000 + repeat)
        bits = self.bits[repeat]
        at = starts.copy()
        acc = np.full(len(starts), np.uint64(size * 64 + repeat), np.uint64)
        out: list[np.ndarray] = []
        places = PLACES[size][repeat]
        for step in range(places[-1] + 1):
            if step in places:
                word = np.where(at < starts + size, self.h[at], _PAD)
                acc = mix64(acc * np.uint64(0x9FB21C651E98DF25) + word, step)
                out.append(acc)
                if seen is not None:
                    ok = np.flatnonzero(seen(acc))
                    starts, at, acc = starts[ok], at[ok], acc[ok]
                    out = [acc]
                    if not len(ok):
                        return starts, out
            at = at + ((bits[at] >> np.uint64(step)) & np.uint64(1)).view(np.int64)  # fewer than 64 steps
        return starts, out


def _word_keys(h: np.ndarray) -> np.ndarray:
    return mix64(h.copy(), 99)


def _item_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of all windows of the items; ``part`` 0 for whole keys, else the
    places they are made of, or -1 for words."""
    for batch in batches:
        for b in text_slices(batch):
            t = _Text(b.column("text"))
            w = _Walks(t.h)
            known = np.unique(_word_keys(t.h))
            none = pa.array(np.zeros(len(known), np.int32))
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(as_signed(known)), "part": pa.array(np.full(len(known), -1, np.int32)), "size": none,
                "item": pa.array(np.zeros(len(known), np.int64)), "offset": none, "words": none})
            for i in range(b.num_rows):
                n = int(t.n[i])
                if n == 0:
                    continue
                size = size_class(n)
                offset = np.arange(n - size + 1)
                for r in range(repeats(size)):
                    _, keys = w.keys(t.off[i] + offset, size, r)
                    for part, key in enumerate(keys, start=1):
                        last = part == len(keys)
                        m = len(key)
                        yield pa.RecordBatch.from_pydict({
                            "key": pa.array(as_signed(key)), "part": pa.array(np.full(m, 0 if last else part, np.int32)),
                            "size": pa.array(np.full(m, size, np.int32)),
                            "item": pa.array([b.column("item")[i].as_py()] * m, pa.int64()),
                            "offset": pa.array(offset, pa.int32()), "words": pa.array(np.full(m, n, np.int32))})


def _bit_of(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(39)).astype(np.int64)


class _Seen:
    def __init__(self, where: np.ndarray):
        self.where = where

    def __call__(self, key: np.ndarray) -> np.ndarray:
        bit = _bit_of(key)
        return (self.where[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1


def _window_hits(t: _Text, sizes: dict[int, int], seen: _Seen) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, window starts, keys) that may be an item's.  ``sizes`` has the
    most edits of an item for each size."""
    known = np.concatenate([[0], np.cumsum(seen(_word_keys(t.h)), dtype=np.int64)])
    w = _Walks(t.h)
    for size, edits in sizes.items():
        step = stride(size)
        n = np.maximum(t.n - size + step, 0) // step  # windows of each document
        starts = np.repeat(t.off[:-1] - (np.cumsum(n) - n) * step, n) + np.arange(n.sum()) * step
        starts = starts[known[starts + size] - known[starts] >= size - edits]
        for r in range(repeats(size) if len(starts) else 0):
            left, keys = w.keys(starts, size, r, seen)
            if len(left):
                yield size, left, keys[-1]


class _Listed:
    """All windows of a small benchmark, by key, and the items' words."""

    def __init__(self, keys: pa.Table, items: pa.Table):
        order = np.argsort(keys["key"].to_numpy())
        key = keys["key"].to_numpy()[order].view(np.uint64)
        order = order[np.argsort(key, kind="stable")]
        self.key = keys["key"].to_numpy()[order].view(np.uint64)
        names = {x: i for i, x in enumerate(items["item"].to_pylist())}
        self.item = np.array([names[x] for x in keys["item"].to_pylist()], np.int64)[order]
        self.offset = keys["offset"].to_numpy()[order].astype(np.int64)
        self.text = items["text"].to_pylist()
        self.id = items["item_id"].to_pylist()
        words = _Text(items["text"].combine_chunks())
        self.n = words.n
        self.words = [words.h[a:b].tolist() for a, b in zip(words.off[:-1], words.off[1:], strict=True)]

    def places(self, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place where it would start) of windows with these keys."""
        lo, hi = np.searchsorted(self.key, keys, "left"), np.searchsorted(self.key, keys, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.item[at], np.repeat(starts, n) - self.offset[at]


def _stretch(start: int, words: int, max_edits: float, first: int, stop: int) -> tuple[int, int]:
    """Words of a document in which a copy that starts near ``start`` lies."""
    room = int(max_edits * words) + 1
    return max(first, start - room), min(stop, start + words + room)


_FOUND = "rid long, doc_id long, item_id long, item_words long, edits long, end_word long"


@tidy
def _verified_hits(batches: Iterator[pa.RecordBatch], shared, sizes: dict[int, int], max_edits: float) -> Iterator[pa.RecordBatch]:
    """The small benchmark's copies in the batch's own documents."""
    seen, listed = shared.value
    for batch in batches:
        for b in text_slices(batch):
            t = _Text(b.column("text"))
            found = [(np.zeros(0, np.int64),) * 2]
            for _, starts, keys in _window_hits(t, sizes, seen):
                item, start = listed.places(starts, keys)
                # one row for each item and place, from whichever window
                doc = np.searchsorted(t.off, np.repeat(starts, np.searchsorted(listed.key, keys, "right")
                                                       - np.searchsorted(listed.key, keys, "left")), "right") - 1
                found.append((doc * len(listed.n) + item, start))
            pair, start = (np.concatenate(x) for x in zip(*found, strict=True))
            spots = np.unique(np.stack([pair, start]), axis=1)
            best: dict[tuple[int, int], tuple[int, int]] = {}
            for pair, start in spots.T.tolist():
                doc, item = divmod(pair, len(listed.n))
                n = int(listed.n[item])
                lo, hi = _stretch(start, n, max_edits, int(t.off[doc]), int(t.off[doc + 1]))
                got = nearest(listed.words[item], t.h[lo:hi].tolist(), start - lo, max_edits)
                if got is not None:
                    x = (got[0], lo + got[1] - int(t.off[doc]))
                    best[doc, item] = min(best.get((doc, item), x), x)
            rows = [(b.column("rid")[d].as_py(), b.column("doc_id")[d].as_py(), listed.id[i], int(listed.n[i]), *x)
                    for (d, i), x in best.items()]
            yield _found_batch(rows)


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _FOUND.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, cols, strict=True)})


@tidy
def _hits(batches: Iterator[pa.RecordBatch], shared, sizes: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """(rid, pos, key) of windows that may be an item's, without text."""
    seen, _ = shared.value
    for batch in batches:
        for b in text_slices(batch):
            t = _Text(b.column("text"))
            rid = b.column("rid").to_numpy(zero_copy_only=False)
            for _, starts, keys in _window_hits(t, sizes, seen):
                doc = np.searchsorted(t.off, starts, "right") - 1
                yield pa.RecordBatch.from_pydict({"rid": pa.array(rid[doc]), "pos": pa.array(starts - t.off[doc]),
                                                  "key": pa.array(as_signed(keys))})


@tidy
def _stretches(batches: Iterator[pa.RecordBatch], max_edits: float) -> Iterator[pa.RecordBatch]:
    """The words around each place of a document where an item may start."""
    for batch in batches:
        for b in text_slices(batch):
            t = _Text(b.column("text"))
            rid, doc_id = b.column("rid").to_pylist(), b.column("doc_id").to_pylist()
            for i, places in enumerate(b.column("places").to_pylist()):
                out = []
                for p in places:
                    first, stop = int(t.off[i]), int(t.off[i + 1])
                    lo, hi = _stretch(p["start"] + first, p["words"], max_edits, first, stop)
                    text = t.data[t.starts[lo]:t.ends[hi - 1]].tobytes().decode() if hi > lo else ""
                    out.append((rid[i], doc_id[i], p["item"], p["start"] + first - lo, lo - first, text))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_pydict({
                    **{n: pa.array(c, pa.int64()) for n, c in zip(("rid", "doc_id", "item", "at", "first"), cols, strict=False)},
                    "around": pa.array(cols[5], pa.string())})


def best_edits(item: list, around: list) -> tuple[int, int]:
    """(edits, end) of the stretch of ``around`` nearest to ``item``."""
    code: dict = {}
    a = [code.setdefault(w, len(code)) for w in item]
    b = np.array([code.get(w, -1) for w in around], np.int64)
    ramp = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, np.int64)
    for i, w in enumerate(a):
        new = np.empty_like(row)
        new[0] = i + 1
        np.minimum(row[:-1] + (b != w), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - ramp) + ramp
    end = int(row.argmin())
    return int(row[end]), end


def nearest(item: list[int], around: list[int], at: int, max_edits: float) -> tuple[int, int] | None:
    """(edits, end) of the stretch of ``around`` nearest to ``item``, within
    ``max_edits`` of its words; ``at`` is where it would start.  Words are given
    by their hashes."""
    n, limit = len(item), int(max_edits * len(item))
    if 0 <= at and around[at:at + n] == item:
        return 0, at + n
    if limit == 0:
        return None
    # each word of the item that is nowhere around costs an edit
    have = set(around)
    if sum(w not in have for w in item) > limit:
        return None
    edits, end = best_edits(item, around)
    return (edits, end) if edits <= limit else None


@tidy
def _verified(batches: Iterator[pa.RecordBatch], max_edits: float) -> Iterator[pa.RecordBatch]:
    def hashed(text: str) -> list[int]:
        return _Text(pa.array([text])).h.tolist()

    item_words = lru_cache(1024)(hashed)
    for batch in batches:
        out = []
        for x in batch.to_pylist():
            item = item_words(x["item_text"])
            got = nearest(item, hashed(x["around"]), x["at"], max_edits)
            if got is not None:
                out.append((x["rid"], x["doc_id"], x["item"], len(item), got[0], x["first"] + got[1]))
        yield _found_batch(out)


def with_row_id(docs: DataFrame) -> DataFrame:
    """Documents with ``rid``, a hash that stands for doc_id and text."""
    return docs.withColumn("rid", F.xxhash64("doc_id", "text"))


def _key_filter(keys: DataFrame) -> _Seen:
    """Bitmap of all keys, KEY_BITS bits whatever their number."""
    h = F.expr("shiftrightunsigned(key, 39)")
    words = (keys.groupBy(F.shiftright(h, 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(key, 39) % 64 as int))")).alias("b"))
             .toArrow())
    where = np.zeros(KEY_BITS // 64, np.int64)
    where[words["w"].to_numpy()] = words["b"].to_numpy()
    return _Seen(where.astype("<i8").view(np.uint8))


def keys_by_size(parts: DataFrame) -> DataFrame:
    return parts.filter("part = 0").groupBy("size").agg(F.max("words").alias("n")).orderBy("size")


def contaminated(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """(rid, doc_id, item_id, item_words, edits, end_word) for each document row
    and item of which it holds a copy within ``max_edits`` of the item's words."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    items = saved(items.withColumn("item", F.xxhash64("item_id", "text")).distinct(), "items")
    parts = saved(items.select("item", "text").mapInArrow(
        _item_keys, "key long, part int, size int, item long, offset int, words int"), "item-keys")
    keys = parts.filter("part = 0").select("key", "item", "offset", "words")
    sizes = {r["size"]: int(max_edits * r["n"]) for r in keys_by_size(parts).collect()}  # of SIZES
    rows = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    if not sizes:
        return spark.createDataFrame([], _FOUND)
    seen = _key_filter(parts)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0]
    if keys.count() <= LISTED_KEYS and size <= LISTED_BYTES:
        listed = _Listed(keys.toArrow(), items.toArrow())
        shared = spark.sparkContext.broadcast((seen, listed))
        found = rows.mapInArrow(partial(_verified_hits, shared=shared, sizes=sizes, max_edits=max_edits), _FOUND)
    else:
        found = _joined_hits(rows, items, keys, spark.sparkContext.broadcast((seen, None)), sizes, max_edits)
    return (found.groupBy("rid", "doc_id", "item_id").agg(F.min(F.struct("edits", "end_word", "item_words")).alias("x"))
            .select("rid", "doc_id", "item_id", "x.item_words", "x.edits", "x.end_word"))


def _joined_hits(rows: DataFrame, items: DataFrame, keys: DataFrame, shared, sizes: dict[int, int],
                 max_edits: float) -> DataFrame:
    """Copies of a benchmark of any size.  Hits are keys and places; a document
    moves once, with its places, if it has any."""
    hits = rows.mapInArrow(partial(_hits, shared=shared, sizes=sizes), "rid long, pos long, key long").distinct()
    spots = (hits.join(keys, "key").select("rid", "item", "words", (F.col("pos") - F.col("offset")).cast("long").alias("start"))
             .distinct())
    spots = saved(spots.groupBy("rid").agg(F.collect_list(F.struct("item", "words", "start")).alias("places")), "places")
    texts = maybe_in(rows, "rid", saved(bitmap(spots, "rid"), "place-bits")).join(spots, "rid")
    around = (texts.select("rid", "doc_id", "text", "places")
              .mapInArrow(partial(_stretches, max_edits=max_edits),
                          "rid long, doc_id long, item long, at long, first long, around string").distinct())
    pairs = around.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item")
    return (pairs.select("rid", "doc_id", F.col("item_id").alias("item"), "item_text", "at", "first", "around")
            .mapInArrow(partial(_verified, max_edits=max_edits), _FOUND))


def op9_cgk_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of ``benchmark`` items in all of ``documents``."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rid")


def decontaminated(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """Documents that hold no copy of an item."""
    rows = with_row_id(docs)
    bad = contaminated(docs, benchmark, max_edits).select("rid").distinct()
    return rows.join(bad, "rid", "left_anti").select(*docs.columns)
