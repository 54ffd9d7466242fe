"""Operator 3: toxicity by a weighted lexicon and Aho-Corasick.

Texts are folded first: lower case, compatibility forms and accents taken off,
look-alike letters of other scripts and digits or signs that stand for letters
inside a word replaced, punctuation turned into blanks.  The lexicon (whole
words and word beginnings with log-odds weights) and its exception phrases are
learned from labelled rows; a match inside an exception phrase does not count.
The weights' sum, alone and per word, goes through a fitted logistic curve, so
the score is a probability.

Fitting uses at most about ``MAX_FIT_ROWS`` labelled rows, picked by a hash of
their doc_id, and of near copies only one, so that a text copied often does not
make its words look telling.  Only rows with crc32(doc_id) mod 3 other than 1
are used.  What reaches the driver is the lexicon and three numbers per fitting
row.

Defined cases: null and empty texts score as texts without a match; without
toxic (or clean) labels the built-in lexicon and curve are used; null labels are
left out, and of several labels of a document the highest counts; rows that
repeat or lack a doc_id are scored one by one; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import as_signed, bitmap, maybe_in, saved, table, text_slices, tidy
from seedwright.llm.minmax_dedup import shingle_hashes

MAX_FIT_ROWS = 20_000
REJECT_AT = 0.7
#: Lengths of word beginnings that may enter the lexicon.
PREFIXES = (4, 5, 6, 7, 8)
MAX_WEIGHT = 6.0
#: Distinct entries that a task counts before it sends them on.
HELD_ENTRIES = 200_000

# Used only where there are no labels to learn from.
SEED_LEXICON = {" idiot": 4.0, " moron": 4.0, " stupid": 4.0, " scum": 4.0, " loser": 4.0, " worthless": 4.0,
                " pathetic": 4.0, " disgusting": 4.0, " trash": 3.0, " clown": 3.0}
SEED_EXCEPTIONS = (" trash can ", " clown fish ", " loser bracket ")
SEED_CURVE = (-3.0, 1.5, 0.5)

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j",
    "к": "k", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ß": "ss", "æ": "ae", "œ": "oe",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "\u200b": None, "\u200c": None, "\u200d": None, "\u2060": None,
    "\ufeff": None, "\u00ad": None,
})
LOOKALIKES.update(dict.fromkeys(range(0x300, 0x370)))  # combining accents
# Signs that stand for letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
                       "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})

_SIGN = re.compile(r"[0-9@$]+(?=[a-z])|(?<=[a-z])[!|+]+(?=[a-z])|(?<=[a-z])[0-9]+(?![0-9a-z])")
_BLANKS = {i: " " for i in range(128) if not chr(i).isalnum()}


def fold(text: str) -> str:
    """The folded text between two blanks."""
    t = text.lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKD", t).translate(LOOKALIKES)
    t = _SIGN.sub(lambda m: m.group().translate(SIGNS), t)
    return f" {t.translate(_BLANKS)} "


def held_out(col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 3 == 1, F.lit(False))


class Matcher:
    """Sums of weights over folded texts."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...]):
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        for p, w in lexicon.items():
            self.auto.add_word(p, (len(p), w))
        for p in exceptions:
            self.auto.add_word(p, (len(p), None))
        if len(self.auto):
            self.auto.make_automaton()
        self.empty = not len(self.auto)

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) outside exception phrases."""
        if self.empty:
            return []
        found, free = [], []
        for end, (size, w) in self.auto.iter(folded):
            (free if w is None else found).append((end + 1 - size, end + 1, w))
        if not (free and found):
            return found
        # both in order of their starts: a match is free if a phrase that starts
        # no later reaches its end
        free.sort(key=lambda m: m[0])
        found.sort(key=lambda m: m[0])
        out, reach, k = [], -1, 0
        for m in found:
            while k < len(free) and free[k][0] <= m[0]:
                reach = max(reach, free[k][1])
                k += 1
            if m[1] > reach:
                out.append(m)
        return out

    def total(self, folded: str) -> float:
        """Each start counts once, with its highest weight."""
        best: dict[int, float] = {}
        for a, _, w in self.matches(folded):
            best[a] = max(best.get(a, 0.0), w)
        return sum(best.values())


def _curve(total: np.ndarray, words: np.ndarray, curve: tuple[float, float, float]) -> np.ndarray:
    c, a, b = curve
    z = c + a * np.log1p(total) + b * np.log1p(100 * total / np.maximum(words, 1))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# --------------------------------------------------------------------- fitting

@tidy
def _with_copy_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in text_slices(batch):
            h, off = shingle_hashes(b.column("text"), 3)
            low = np.zeros(b.num_rows, np.uint64)
            full = np.flatnonzero(np.diff(off))
            if len(full):
                low[full] = np.minimum.reduceat(h, off[full])
            yield pa.RecordBatch.from_pydict({"toxic": b.column("toxic"), "text": b.column("text"),
                                              "copy_key": pa.array(as_signed(low))})


@tidy
def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold each word and word beginning."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = set(fold(text or "").split())
            entries = {f" {w} " for w in words if len(w) >= 3}
            entries.update(f" {w[:k]}" for w in words for k in PREFIXES if len(w) >= k)
            counts[toxic].update(entries)
        if sum(map(len, counts)) > HELD_ENTRIES:
            yield from _counted(counts)
            counts = (Counter(), Counter())
    yield from _counted(counts)


def _counted(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    for toxic in (0, 1):
        keys = list(counts[toxic])
        for k in range(0, len(keys), 50_000):
            part = keys[k:k + 50_000]
            n = pa.array([counts[toxic][x] for x in part], pa.int64())
            zero = pa.array([0] * len(part), pa.int64())
            yield pa.RecordBatch.from_pydict({"entry": part, "bad": n if toxic else zero,
                                              "clean": zero if toxic else n})


_WORD = re.compile(r"[^ ]+")


def around(folded: str, a: int) -> tuple[str, str, str]:
    """The word before the blank at ``a``, the word after it, and the next one."""
    word_end = folded.find(" ", a + 1)
    last = a
    while last > 0 and folded[last - 1] == " ":
        last -= 1
    after = _WORD.search(folded, word_end)
    return folded[folded.rfind(" ", 0, last) + 1:last], folded[a + 1:word_end], after.group() if after else ""


def _count_phrases(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    """Two-word phrases around matches, with their documents by label."""
    m = Matcher(lexicon, ())
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            t = fold(text or "")
            seen = set()
            for a in {a for a, _, _ in m.matches(t)}:
                before, word, after = around(t, a)
                if before:
                    seen.add(f" {before} {word} ")
                if after:
                    seen.add(f" {word} {after} ")
            counts[toxic].update(seen)
    yield from _counted(counts)


def _significant(counts: DataFrame, n_bad: int, n_clean: int) -> list[tuple[str, int, int]]:
    """Entries whose share of toxic documents stands out from chance, allowing
    for the number of entries tried; common base words never do."""
    rate = n_bad / (n_bad + n_clean)
    tried = counts.count()
    share = F.col("bad") / (F.col("bad") + F.col("clean"))
    gain = (F.col("bad") * F.log(share / rate)
            + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    rows = (counts.filter("bad > 0").filter(share >= max(0.6, min(0.95, 2 * rate)))
            .filter(gain >= math.log(max(tried, 2)) + 5).collect())
    return [(r["entry"], r["bad"], r["clean"]) for r in rows]


def _pick(entries: list[tuple[str, int, int]], n_bad: int, n_clean: int) -> dict[str, float]:
    """The lexicon: of entries that begin one another, the longest that still
    covers nearly all documents of the shorter one, or else the shorter."""
    by_stem: dict[str, tuple[int, int]] = {e: (a, b) for e, a, b in entries}
    kept: dict[str, tuple[int, int]] = {}
    for e in sorted(by_stem, key=lambda x: (len(x.rstrip(" ")), x)):
        a, b = by_stem[e]
        longer = [x for x in by_stem if x != e and x.startswith(e.rstrip(" ")) and len(x) > len(e)
                  and by_stem[x][0] >= 0.97 * a]
        if longer:
            continue
        if any(e.startswith(k.rstrip(" ")) for k in kept if not k.endswith(" ")):
            continue
        kept[e] = (a, b)
    odds = (n_bad + 1) / (n_clean + 1)
    return {e: round(min(MAX_WEIGHT, math.log((a + 0.5) / (b + 0.5) / odds)), 4) for e, (a, b) in kept.items()}


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps on (1, log sum, log density)."""
    total, words = x.T
    f = np.column_stack([np.ones(len(y)), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))])
    w, ridge = np.zeros(3), np.diag([1e-3, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        g = f.T @ (y - p) - ridge @ w
        step = np.linalg.solve((f * (p * (1 - p))[:, None]).T @ f + ridge, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    # more matches never lower the score
    return float(w[0]), float(max(w[1], 0.0)), float(max(w[2], 0.0))


@tidy
def _totals(batches: Iterator[pa.RecordBatch], model: tuple) -> Iterator[pa.RecordBatch]:
    m = Matcher(*model[:2])
    for batch in batches:
        for b in text_slices(batch):
            folded = [fold(t or "") for t in b.column("text").to_pylist()]
            yield b.drop_columns(["text"]).append_column("total", pa.array([m.total(t) for t in folded], pa.float64())) \
                .append_column("words", pa.array([t.count(" ") for t in folded], pa.int64()))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> tuple:
    """(lexicon, exception phrases, curve) learned from labelled rows."""
    labels = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = labels.count()
    share = min(1.0, max_rows / n) if n else 0.0
    sample = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = (maybe_in(docs, "doc_id", saved(bitmap(sample, "doc_id"), "label-bits"))
            .join(sample, "doc_id").select("toxic", "text")
            .mapInArrow(_with_copy_key, "toxic int, text string, copy_key long")
            .groupBy("toxic", "copy_key").agg(F.min("text").alias("text")))
    rows = saved(rows.select("toxic", "text"), "fit-rows")
    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_bad, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_bad or not n_clean:
        return SEED_LEXICON, SEED_EXCEPTIONS, SEED_CURVE

    def counted(f) -> DataFrame:
        c = rows.mapInArrow(f, "entry string, bad long, clean long")
        return saved(c.groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean")), "entries")

    lexicon = _pick(_significant(counted(_count_entries), n_bad, n_clean), n_bad, n_clean)
    if not lexicon:
        return SEED_LEXICON, SEED_EXCEPTIONS, SEED_CURVE
    # phrases with a match that clean documents use at least as often as others
    free = tuple(r["entry"] for r in counted(partial(_count_phrases, lexicon=lexicon))
                 .filter("clean >= 3").filter(F.col("bad") * n_clean <= F.col("clean") * n_bad).collect())
    got = rows.mapInArrow(partial(_totals, model=(lexicon, free)), "toxic int, total double, words long").toArrow()
    x = np.column_stack([got["total"].to_numpy(), got["words"].to_numpy()])
    return lexicon, free, _fit_curve(x, got["toxic"].to_numpy().astype(float))


# --------------------------------------------------------------------- scoring

def _scored(batches: Iterator[pa.RecordBatch], model: tuple) -> Iterator[pa.RecordBatch]:
    for b in _totals(batches, model):
        score = _curve(b.column("total").to_numpy(), b.column("words").to_numpy(), model[2])
        yield b.drop_columns(["total", "words"]).append_column("score", pa.array(score, pa.float64()))


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(partial(_scored, model=model), "doc_id long, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= REJECT_AT).cast("int").alias("predicted")))


@tidy
def _not_rejected(batches: Iterator[pa.RecordBatch], model: tuple) -> Iterator[pa.RecordBatch]:
    m = Matcher(*model[:2])
    for batch in batches:
        for b in text_slices(batch):
            folded = [fold(t or "") for t in b.column("text").to_pylist()]
            s = _curve(np.array([m.total(t) for t in folded]), np.array([t.count(" ") for t in folded]), model[2])
            yield b.filter(pa.array(s < REJECT_AT))


def without_toxic(docs: DataFrame, model: tuple) -> DataFrame:
    """The rows that score below the threshold, unchanged."""
    return docs.mapInArrow(partial(_not_rejected, model=model), docs.schema)


def op3_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all of ``documents``, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
