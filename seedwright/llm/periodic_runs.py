"""Operator 11: periodic runs of words by block convolution.

A run is a stretch of words with smallest period q, at least ``min_length``
words and ``min_exponent`` (3 or more) periods long, that no neighbour extends.

Distances are searched at dyadic scales.  At scale B, each block of B words at
a multiple of B is compared with the words that follow it by up to 2B: the sum
of squared differences of word numbers at every distance is one cyclic
correlation, taken exactly by number-theoretic transforms modulo as many primes
as the largest possible sum asks for, and it is zero where the block occurs
again.  A run of period q in [B, 2B) always holds an aligned block and its copy
at distance q, so it gives a zero.  Zeros of one distance in neighbouring blocks
are one seed, extended word by word to its whole stretch; the smallest distance
that gives a stretch is its period.

Blocks that cannot give a new run are not transformed: one of their words does
not come again within 2B words, or block and window lie inside a run that is
already known, whose period divides every distance found there.

Documents are handled in batches, each within one task; nothing is shuffled.

Defined cases: null and empty texts have no words, no runs and the digest of
the empty string; rows that repeat or lack a doc_id are handled one by one; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import (table, text_bytes, text_or_empty, text_slices, tidy, word_bounds,
                                   words_per_document)

# Primes below 2**32 with a power of two of at least 2**27 in
# p - 1, and a generator of each.
PRIMES = ((2013265921, 31), (2281701377, 3), (3221225473, 5))
#: Numbers that one batch of transforms holds.
TRANSFORM_CELLS = 1 << 19


# ------------------------------------------------------------------ transforms

@cache
def _twiddles(prime: int, root: int, half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    w = pow(root, (prime - 1) // (2 * half), prime)
    w = pow(w, -1, prime) if inverse else w
    out = np.ones(half, np.uint64)
    done = 1
    while done < half:
        out[done:2 * done] = out[:done] * np.uint64(pow(w, done, prime)) % np.uint64(prime)
        done *= 2
    return out


def _forward(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Transforms of the rows, in bit-reversed order."""
    p = np.uint64(prime)
    m, size = x.shape
    half = size // 2
    while half:
        v = x.reshape(m, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1]
        low, high = (a + b) % p, (a + (p - b)) % p * _twiddles(prime, root, half, False) % p
        x = np.stack([low, high], axis=2).reshape(m, size)
        half //= 2
    return x


def _backward(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Inverse of ``_forward``, times the row length."""
    p = np.uint64(prime)
    m, size = x.shape
    half = 1
    while half < size:
        v = x.reshape(m, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1] * _twiddles(prime, root, half, True) % p
        x = np.stack([(a + b) % p, (a + (p - b)) % p], axis=2).reshape(m, size)
        half *= 2
    return x


def zero_mismatch(pattern: np.ndarray, window: np.ndarray, lags: int, top: int) -> np.ndarray:
    """Whether row i of ``pattern`` equals window[i, lag:lag + B], for each lag,
    by the sum of squared differences; no value exceeds ``top``."""
    m, block = pattern.shape
    size = 1 << (window.shape[1] - 1).bit_length()
    zero = np.ones((m, lags), bool)
    need, have = block * top * top, 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        a = np.zeros((m, size), np.uint64)
        a[:, 0] = pattern[:, 0]
        a[:, size - block + 1:] = pattern[:, :0:-1]
        b = np.zeros((m, size), np.uint64)
        b[:, :window.shape[1]] = window
        both = _backward(_forward(a % p, prime, root) * _forward(b % p, prime, root) % p, prime, root)
        both = both[:, :lags] * np.uint64(pow(size, -1, prime) * 2 % prime) % p
        own = (pattern * pattern % p).sum(axis=1, dtype=np.uint64) % p
        total = np.zeros((m, window.shape[1] + 1), np.uint64)
        np.cumsum(window * window % p, axis=1, out=total[:, 1:])
        other = (total[:, block:block + lags] - total[:, :lags]) % p
        zero &= (own[:, None] + other) % p == both
        have *= prime
        if have > need:
            return zero
    raise OverflowError(f"sums up to {need} need more primes")


# ------------------------------------------------------------------------ runs

class _Runs:
    """Runs found so far in a batch: starts, ends and periods."""

    def __init__(self):
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        start, end, period = (np.concatenate(x) for x in (
            (self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        new = np.ones(len(start), bool)  # the least period of a stretch
        new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        self.start, self.end, self.period = start[new], end[new], period[new]

    def reach(self, at: np.ndarray) -> np.ndarray:
        """The greatest end of a run that starts at or before each place."""
        if not len(self.start):
            return np.zeros(len(at), np.int64)
        far = np.maximum.accumulate(self.end)
        i = np.searchsorted(self.start, at, side="right")
        return np.where(i > 0, far[np.maximum(i - 1, 0)], 0)


def _again(code: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Distance to the same word's next place in the document."""
    order = np.argsort(code, kind="stable")
    gap = np.full(len(code), np.iinfo(np.int64).max)
    a, b = order[:-1], order[1:]
    same = (code[a] == code[b]) & (doc[a] == doc[b])
    gap[a[same]] = (b - a)[same]
    return gap


def _extend(code: np.ndarray, at: np.ndarray, stop: np.ndarray, dist: np.ndarray, step: int,
            width: int) -> np.ndarray:
    """How many words from ``at`` on (backwards if ``step`` is -1), before
    ``stop``, equal the words ``dist`` later."""
    out = np.zeros(len(at), np.int64)
    room = (stop - at) * step
    live = np.flatnonzero(room > 0)
    while len(live):
        rows = max(1, TRANSFORM_CELLS // width)
        on = []
        for k in range(0, len(live), rows):
            i = live[k:k + rows]
            shift = out[i][:, None] + np.arange(width)
            inside = shift < room[i][:, None]
            x = np.where(inside, at[i][:, None] + step * shift, at[i][:, None])
            same = inside & (code[x] == code[np.minimum(x + dist[i][:, None], len(code) - 1)])
            whole = same.all(axis=1)
            out[i] += np.where(whole, width, np.argmin(same, axis=1))
            on.append(i[whole])
        live = np.concatenate(on)
        live = live[out[live] < room[live]]
        width = min(2 * width, TRANSFORM_CELLS)
    return out


def _seeds(code: np.ndarray, starts: np.ndarray, stops: np.ndarray, block: int, least: int,
           most: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of each zero of the blocks at ``starts``."""
    found = []
    size = most - least + block
    held = np.unique(code[(starts[:, None] + np.arange(block)).ravel()])
    rank = np.zeros(int(code.max()) + 1, np.uint64)
    rank[held] = np.arange(1, len(held) + 1, dtype=np.uint64)  # 0: in no block
    for k in range(0, len(starts), max(1, TRANSFORM_CELLS // (2 * size))):
        s = starts[k:k + max(1, TRANSFORM_CELLS // (2 * size))]
        x = s[:, None] + least + np.arange(size)
        inside = x < stops[k:k + len(s)][:, None]
        window = np.where(inside, rank[code[np.minimum(x, len(code) - 1)]], np.uint64(0))
        zero = zero_mismatch(rank[code[s[:, None] + np.arange(block)]], window, most - least + 1, len(held) + 1)
        i, lag = np.nonzero(zero)
        found.append((s[i], lag + least))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def find_runs(code: np.ndarray, off: np.ndarray, min_length: int, min_exponent: int) -> _Runs:
    """All runs of the documents whose words are code[off[i]:off[i + 1]]."""
    runs = _Runs()
    n = np.diff(off)
    if not len(code) or int(n.max()) < min_length:
        return runs
    doc = np.repeat(np.arange(len(n)), n)
    gap = _again(code, doc)
    block = 1 << ((min_length + 1) // 3).bit_length() - 1
    least = 1
    while block == least or least == 1 or min_exponent * block <= int(n.max()):
        most = 2 * block - 1
        fit = np.flatnonzero(n >= max(min_length, min_exponent * least))
        if not len(fit):
            break
        blocks = np.maximum((n[fit] - least) // block, 0)  # whole blocks with a word after them
        own = np.repeat(fit, blocks)
        starts = off[own] + (np.arange(len(own)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * block
        lone = np.concatenate([[0], np.cumsum(gap > most)])
        known = runs.reach(starts)
        go = (lone[starts + block] == lone[starts]) & (known < np.minimum(starts + block + most, off[own + 1]))
        starts, own, known = starts[go], own[go], known[go]
        if len(starts):
            s, d = _seeds(code, starts, off[own + 1], block, least, most)
            i = np.searchsorted(starts, s)
            new = s + block + d > known[i]
            s, d, o = s[new], d[new], own[i[new]]
            if len(s):
                # zeros of one distance in neighbouring blocks are one seed
                order = np.lexsort((s, d))
                s, d, o = s[order], d[order], o[order]
                head = np.ones(len(s), bool)
                head[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1] + block) | (o[1:] != o[:-1])
                lead = np.flatnonzero(head)
                tail = np.append(lead[1:], len(s)) - 1
                a, b, d, o = s[lead], s[tail] + block, d[lead], o[lead]
                start = a - _extend(code, a - 1, off[o] - 1, d, -1, block)
                end = b + _extend(code, b, off[o + 1] - d, d, 1, block) + d
                long = end - start >= np.maximum(min_length, min_exponent * d)
                runs.add(start[long], end[long], d[long])
        block *= 2
        least = block
    return runs


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, the same for the same bytes."""
    off = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    step = np.zeros(len(data) + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    body = data[np.cumsum(step, dtype=np.int8)[:-1] > 0]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(body)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


@tidy
def _collapse(batches: Iterator[pa.RecordBatch], min_length: int, min_exponent: int,
              texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in text_slices(batch):
            data, t_off = text_bytes(b.column("text"))
            starts, ends = word_bounds(data, t_off)
            off = words_per_document(starts, t_off)
            runs = find_runs(_numbers(data, starts, ends), off, min_length, min_exponent)
            step = np.zeros(len(starts) + 1, np.int64)
            np.add.at(step, runs.start + runs.period, 1)
            np.add.at(step, runs.end, -1)
            kept = np.cumsum(step)[:-1] == 0
            # the kept words with one blank after each, but a document's last
            size = np.where(kept, ends - starts + 1, 0)
            mark = np.zeros(len(data) + 1, np.int8)
            mark[starts[kept]] += 1
            mark[ends[kept]] -= 1
            total = np.concatenate([[0], np.cumsum(size)])
            out = np.full(int(total[-1]), 32, np.uint8)
            solid = np.ones(len(out), bool)
            solid[total[1:][kept] - 1] = False
            out[solid] = data[np.cumsum(mark, dtype=np.int8)[:-1] > 0]
            raw = memoryview(out.tobytes())
            bounds = total[off].tolist()
            bodies = [raw[x:max(x, y - 1)] for x, y in zip(bounds, bounds[1:], strict=False)]
            order = np.lexsort((runs.period, runs.start))
            owner = np.searchsorted(off, runs.start[order], side="right") - 1
            rows: list[list[tuple[int, int, int]]] = [[] for _ in bodies]
            for o, s, e, q in zip(owner.tolist(), (runs.start[order] - off[owner]).tolist(),
                                  (runs.end[order] - off[owner]).tolist(), runs.period[order].tolist(), strict=True):
                rows[o].append((s, e - s, q))
            best = [min(r, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if r else (None, None, None) for r in rows]
            cols = {
                "doc_id": b.column("doc_id"), "n_runs": pa.array([len(r) for r in rows], pa.int64()),
                **{name: pa.array([x[k] for x in best], pa.int64()) for k, name in enumerate(("start", "length", "period"))},
                "exponent_milli": pa.array([None if s is None else 1000 * n // q for s, n, q in best], pa.int64()),
                "runs_sha256": [hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in r).encode()).hexdigest() for r in rows],
                "collapsed_sha256": [hashlib.sha256(x).hexdigest() for x in bodies]}
            if texts:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                cols["runs"] = pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in rows], kind)
                cols["collapsed"] = [bytes(x).decode() for x in bodies]
            yield pa.RecordBatch.from_pydict(cols)


def periodic_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, texts: bool = True) -> DataFrame:
    """For each row its runs, the one of the greatest exponent, and the words
    left when every run keeps its first period only; ``texts`` adds the runs
    and the words themselves."""
    if min_exponent < 3 or min_length < 2:
        raise ValueError("min_exponent must be 3 or more, min_length 2 or more")
    out = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")
    if texts:
        out += ", runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(partial(_collapse, min_length=min_length, min_exponent=min_exponent, texts=texts), out))


def with_periods(docs: DataFrame) -> DataFrame:
    """The query's input: the documents whose hashed doc_id ends in 0 repeat
    some of their words from a place on, the rest stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(text_or_empty(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, words).alias("_w"))
    d = d.withColumn("_n", F.size("_w").cast("long")).withColumn("_g", F.expr("_h div 10"))
    d = d.withColumn("_a", F.expr("if(_n > 0, _g % _n, 0)"))
    d = d.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0L, _n - 1), i -> "
                      "get(_w, cast(if(i < _a, i, _a + (i - _a) % _p) as int))), ' ')")
    return d.select("doc_id", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all of ``documents``."""
    return periodic_runs(with_periods(table(spark, sf_dir, "documents")), min_length=24, min_exponent=3, texts=False)
