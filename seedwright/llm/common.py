"""Helpers shared by the operators: inputs, scratch tables, word hashing.

Words are maximal runs of bytes outside space and 0x09-0x0D, so word work is
done on the UTF-8 buffers that Arrow hands over: a polynomial hash modulo
2**64 of every word comes from one cumulative sum, with no Python string.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.session import checkpoint_dir

#: Whitespace of every contract here, as a Java / RE2 character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Bytes of text that one numpy pass handles; temporaries are about 40 times it.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts the lineage, so a
    lost executor costs a reread and no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


# --------------------------------------------------------------- bitmap filter

BITMAP_WORDS = 1 << 16


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """Fixed-size filter over a long key: at most ``BITMAP_WORDS`` rows of
    64 bits (1 MB), whatever the number of keys."""
    h = F.pmod(F.xxhash64(F.col(key)), F.lit(BITMAP_WORDS * 64))
    return (keys.select(h.alias("_h"))
            .groupBy(F.shiftright("_h", 6).alias("_word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(_h % 64 as int))")).alias("_bits")))


def maybe_in(df: DataFrame, key: str, bits: DataFrame, inside: bool = True,
             always: str = "false") -> DataFrame:
    """Rows of ``df`` whose key may be in ``bits`` (every key that is, and some
    others), or the rest; rows for which ``always`` holds stay as well.  The
    broadcast side has ``BITMAP_WORDS`` rows at most."""
    cols = df.columns
    df = df.withColumn("_h", F.pmod(F.xxhash64(F.col(key)), F.lit(BITMAP_WORDS * 64)))
    found = F.expr("_bits is not null and (shiftright(_bits, cast(_h % 64 as int)) & 1L) = 1L")
    return (df.withColumn("_word", F.shiftright("_h", 6))
            .join(F.broadcast(bits), "_word", "left")
            .filter((found if inside else ~found) | F.expr(always)).select(*cols))


# --------------------------------------------------------------- worker memory

def tidy(f):
    """For task functions: gives freed memory back when the task ends, as Spark
    keeps its Python workers for later tasks of other operators."""
    @functools.wraps(f)
    def task(*args, **kwargs):
        try:
            yield from f(*args, **kwargs)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass
    return task


# ------------------------------------------------------------------- text data

def text_slices(batch: pa.RecordBatch, column: str = "text",
                max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose texts hold about ``max_bytes``."""
    n = batch.num_rows
    if n == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < n:
        done = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, done + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text array; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64, len(texts) + 1, texts.offset * 8)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = x + np.uint64(seed)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15 | 5  # odd, 5 modulo 8
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least ``n``."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        inv = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inv):
            p = np.full(max(n, 1 << 12), b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _POWERS[base] = (out[0], out[1])
    return have


_SYMBOL = mix64(np.arange(256, dtype=np.uint64), 0x1234567)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of all words; a document's end also ends a word."""
    m = _IS_WORD[data]
    first = m.copy()
    first[1:] &= ~m[:-1]
    edge = offsets[:-1]
    edge = edge[edge < len(data)]
    first[edge] = m[edge]
    last = m.copy()
    last[:-1] &= ~m[1:]
    edge = offsets[1:]
    edge = edge[edge > 0] - 1
    last[edge] = m[edge]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                base: int = BASE) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span."""
    p, q = powers(len(values) + 1, base)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[:len(values)], out=total[1:])
    return (total[ends] - total[starts]) * q[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False, seed: int = 0) -> np.ndarray:
    """A mixed 64-bit hash of each word.  Long inputs go in word-aligned
    chunks, so temporaries stay bounded."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + CHUNK_BYTES, side="right")))
        part = data[lo:ends[j - 1]]
        sym = _SYMBOL[LOWER_AZ[part]] if lower else _SYMBOL[part]
        out[i:j] = span_hashes(sym, starts[i:j] - lo, ends[i:j] - lo)
        i = j
    out ^= (ends - starts).astype(np.uint64) << np.uint64(56)
    return mix64(out, seed)


def words_per_document(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets into the word arrays, one more than documents."""
    return np.searchsorted(starts, offsets).astype(np.int64)


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def documents_like(df: DataFrame) -> DataFrame:
    """The five columns of ``documents``, whatever else the input carries."""
    return df.select(*DOCUMENT_COLUMNS)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def local_path(uri: str) -> tuple[object, str]:
    """(pyarrow filesystem, path) of a folder URI as Spark writes it."""
    import pyarrow.fs as pafs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        uri = os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)
