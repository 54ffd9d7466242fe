"""Operator 5: ordinal quality by cumulative-link regression.

Grades 0 < 1 < ... < K - 1 share one weight vector over hashed text features and
have K - 1 ordered thresholds: P(grade > j) = sigmoid(w.x - t_j).  The thresholds
are kept in order by fitting their gaps' logarithms.  Scoring gives the
probability of each tail, the expected grade and a selection by tail probability.

Features are sparse: words, word pairs and character shapes of words, each kind
with ``SLOTS`` hash slots of its own, log counts scaled to length one within the
kind.  A few measures of the whole text that are not hashed stand beside them.

Fitting uses at most about ``MAX_FIT_ROWS`` graded rows, picked by a hash of
their doc_id and written as sparse rows.  Each step sends the weights to the
tasks, which return the gradient of their rows: ``FIT_TASKS`` vectors of fixed
length reach the driver, no rows.  Scoring reads every whole text.

Defined cases: null and empty texts have zero features and the score that
follows; null grades are left out and of several grades of a document the
highest counts; without two distinct grades every document gets the one grade
there is (0 without any) with certainty; rows that repeat or lack a doc_id are
scored one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import (bitmap, maybe_in, mix64, saved, table, text_bytes, text_slices, tidy,
                                   word_bounds, word_hashes, words_per_document)

MAX_FIT_ROWS = 20_000
FIT_TASKS = 8
#: Hash slots of each kind of feature.
SLOTS = 1 << 16
KINDS = ("words", "pairs", "shapes")
STEPS = 40
RATE = 0.2
#: Sparse rows that a gradient is made of at a time.
ROWS_AT_ONCE = 256
RIDGE = 1e-4
SELECT_AT = 0.5

#: Byte classes of a word's shape: lower, upper, digit, other ASCII, beyond ASCII.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 4
#: Measures that are not hashed.
MEASURES = ("log_words", "word_bytes", "signs", "capitals", "digits", "repeats", "line_ends", "short")
HASHED = SLOTS * len(KINDS)


class Features(NamedTuple):
    """Sparse rows: row i has ``slot[off[i]:off[i + 1]]`` with these values."""
    off: np.ndarray
    slot: np.ndarray
    value: np.ndarray
    measures: np.ndarray


class Model(NamedTuple):
    mean: np.ndarray       # of the measures
    scale: np.ndarray
    weights: np.ndarray    # HASHED slots, then the measures
    thresholds: np.ndarray
    grades: tuple[int, ...]


def features(texts: pa.Array) -> Features:
    data, t_off = text_bytes(texts)
    rows = len(t_off) - 1
    starts, ends = word_bounds(data, t_off)
    off = words_per_document(starts, t_off)
    n = np.diff(off)
    doc = np.repeat(np.arange(rows), n)
    h = word_hashes(data, starts, ends, lower=True)
    size = ends - starts
    kinds = _CLASS[data]
    first, last = (kinds[starts], kinds[ends - 1]) if len(starts) else (np.zeros(0, np.uint8),) * 2
    # of each class, the bytes in each word: its shape
    shape = np.zeros(len(starts), np.uint64)
    part = np.zeros((5, len(starts)), np.int64)
    for c in range(5):
        total = np.concatenate([[0], np.cumsum(kinds == c)])
        part[c] = total[ends] - total[starts]
        shape = shape * np.uint64(4) + np.minimum(part[c], 3).astype(np.uint64)
    edge = data[np.maximum(ends - 1, 0)].astype(np.uint64) if len(ends) else np.zeros(0, np.uint64)
    shape = mix64((shape * np.uint64(25) + first.astype(np.uint64) * np.uint64(5) + last.astype(np.uint64))
                  * np.uint64(256) + edge, 3)
    follows = doc[1:] == doc[:-1]
    pairs = mix64(h[:-1] * np.uint64(0x9FB21C651E98DF25) + h[1:], 5)[follows]
    found = []
    for k, (key, owner) in enumerate(((h, doc), (pairs, doc[:-1][follows]), (shape, doc))):
        cell, count = np.unique(owner * SLOTS + (key % np.uint64(SLOTS)).astype(np.int64), return_counts=True)
        owner, value = cell // SLOTS, np.log1p(count)
        length = np.sqrt(np.bincount(owner, weights=value * value, minlength=rows))
        found.append((owner, cell % SLOTS + k * SLOTS, value / length[owner]))
    owner, slot, value = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(owner, kind="stable")
    low = np.maximum(n, 1)
    line_ends = np.concatenate([[0], np.cumsum(data == 10)])
    repeats = np.zeros(rows)
    if len(h):
        by = np.lexsort((h, doc))
        same = (h[by][1:] == h[by][:-1]) & (doc[by][1:] == doc[by][:-1])
        repeats = np.bincount(doc[by][1:][same], minlength=rows)

    def share(c: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=c, minlength=rows) / low

    long = np.maximum(size, 1)
    measures = np.stack([
        np.log1p(n), share(size), share(part[3] / long), share(part[1] / long), share(part[2] / long), repeats / low,
        np.log1p(100 * (line_ends[t_off[1:]] - line_ends[t_off[:-1]]) / low), (n < 20).astype(float)], axis=1)
    return Features(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int64),
                    slot[order], value[order], measures)


def _lists(off: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), values)


@tidy
def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in text_slices(batch):
            x = features(b.column("text"))
            wide = np.arange(b.num_rows + 1) * len(MEASURES)
            yield pa.RecordBatch.from_pydict({
                "grade": b.column("grade"), "slot": _lists(x.off, pa.array(x.slot, pa.int32())),
                "value": _lists(x.off, pa.array(x.value.astype(np.float32))),
                "measures": _lists(wide, pa.array(x.measures.reshape(-1)))})


def _read(batch: pa.RecordBatch, mean: np.ndarray, scale: np.ndarray) -> Features:
    slot, value, measures = batch.column("slot"), batch.column("value"), batch.column("measures")
    off = np.asarray(slot.offsets).astype(np.int64)
    z = measures.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES))
    return Features(off - off[0], slot.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                    value.flatten().to_numpy(zero_copy_only=False).astype(float), _standard(z, mean, scale))


def _standard(measures: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((measures - mean) / scale, -8, 8)


def _product(x: Features, w: np.ndarray) -> np.ndarray:
    """w.x of each row; the measures are standardised."""
    total = np.concatenate([[0.0], np.cumsum(x.value * w[x.slot])])
    return total[x.off[1:]] - total[x.off[:-1]] + x.measures @ w[HASHED:]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def loss_slopes(eta: np.ndarray, y: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of minus the log likelihood: by each row's w.x, and by each
    threshold (summed over rows)."""
    upper = np.concatenate([t, [np.inf]])[y]
    lower = np.concatenate([[-np.inf], t])[y]
    a, b = _sigmoid(upper - eta), _sigmoid(lower - eta)
    like = np.maximum(a - b, 1e-9)
    da, db = a * (1 - a), b * (1 - b)
    by_t = np.array([-(da / like)[y == j].sum() + (db / like)[y == j + 1].sum() for j in range(len(t))])
    return (da - db) / like, by_t


@tidy
def _gradient(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    w, t, mean, scale = shared.value
    g = np.zeros(len(w) + len(t))
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS_AT_ONCE):
            b = batch.slice(k, ROWS_AT_ONCE)
            x = _read(b, mean, scale)
            by_row, by_t = loss_slopes(_product(x, w), b.column("y").to_numpy(), t)
            g[:HASHED] += np.bincount(x.slot, weights=x.value * np.repeat(by_row, np.diff(x.off)), minlength=HASHED)
            g[HASHED:len(w)] += x.measures.T @ by_row
            g[len(w):] += by_t
    yield pa.RecordBatch.from_pydict({"g": pa.array([g.astype(np.float32).tobytes()], pa.binary())})


def fit_ordinal(rows: DataFrame, grades: tuple[int, ...], steps: int = STEPS,
                use: tuple[str, ...] = (*KINDS, "measures")) -> Model:
    """Cumulative-link (proportional odds) maximum likelihood with a ridge, by
    full gradients.  ``rows`` are sparse rows with ``y``, the place of their
    grade; ``use`` leaves kinds of features out."""
    spark = rows.sparkSession
    k = len(grades)
    stats = rows.select("y", *[F.get("measures", F.lit(j)).alias(m) for j, m in enumerate(MEASURES)])
    got = stats.agg(F.count("*").alias("n"), *[F.count_if(F.col("y") == j).alias(f"n{j}") for j in range(k)],
                    *[F.mean(m).alias(f"mean_{m}") for m in MEASURES],
                    *[F.stddev_pop(m).alias(f"std_{m}") for m in MEASURES]).first()
    n = got["n"]
    mean = np.array([got[f"mean_{m}"] for m in MEASURES])
    scale = np.array([got[f"std_{m}"] for m in MEASURES]) + 1e-6
    share = np.cumsum([got[f"n{j}"] / n for j in range(k - 1)])
    start = np.log(share / (1 - share))
    live = np.concatenate([np.repeat([kind in use for kind in KINDS], SLOTS), np.repeat("measures" in use, len(MEASURES))])
    # weights, then t_0 and the logarithms of the gaps
    size = len(live)
    par = np.concatenate([np.zeros(size), [start[0]], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, steps + 1):
        w, p = par[:size], par[size:]
        t = np.cumsum(np.concatenate([[p[0]], np.exp(p[1:])]))
        shared = spark.sparkContext.broadcast((w, t, mean, scale))
        parts = rows.mapInArrow(partial(_gradient, shared=shared), "g binary").collect()  # a row a task
        shared.destroy()
        g = sum(np.frombuffer(r.g, np.float32).astype(float) for r in parts) / n
        tail = np.cumsum(g[size:][::-1])[::-1]  # a gap moves all later thresholds
        g = np.concatenate([(g[:size] + RIDGE * w) * live, [tail[0]], tail[1:] * np.exp(p[1:])])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        par = par - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    p = par[size:]
    return Model(mean, scale, par[:size], np.cumsum(np.concatenate([[p[0]], np.exp(p[1:])])), grades)


def graded_rows(docs: DataFrame, grades: DataFrame, max_rows: int = MAX_FIT_ROWS) -> tuple[DataFrame, tuple[int, ...]]:
    """(sparse rows with ``y``, the grades in order) of a sample of the graded rows."""
    grades = (grades.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade"))
              .filter("doc_id is not null and grade is not null")
              .groupBy("doc_id").agg(F.max("grade").alias("grade")))
    n = grades.count()
    part = int(min(1.0, max_rows / n) * 1_000_000) if n else 0
    sample = grades.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < part)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = (maybe_in(docs, "doc_id", saved(bitmap(sample, "doc_id"), "grade-bits")).join(sample, "doc_id")
            .select("text", "grade").mapInArrow(_rows, "grade int, slot array<int>, value array<float>, measures array<double>"))
    rows = saved(rows.repartition(FIT_TASKS), "graded")
    names = tuple(sorted(r["grade"] for r in rows.select("grade").distinct().collect()))  # the grades
    place = F.array_position(F.array(*[F.lit(g) for g in names]), F.col("grade")) - 1 if names else F.lit(0)
    return rows.withColumn("y", place.cast("int")).coalesce(FIT_TASKS), names


def fit(docs: DataFrame, grades: DataFrame, max_rows: int = MAX_FIT_ROWS, use: tuple[str, ...] = (*KINDS, "measures")) -> Model:
    """A model from ``grades(doc_id, grade)``."""
    rows, names = graded_rows(docs, grades, max_rows)
    if len(names) < 2:
        none = np.zeros(len(MEASURES))
        return Model(none, none + 1, np.zeros(HASHED + len(MEASURES)), np.zeros(0), names or (0,))
    return fit_ordinal(rows, names, use=use)


@tidy
def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        for b in text_slices(batch):
            x = features(b.column("text"))
            eta = _product(x._replace(measures=_standard(x.measures, model.mean, model.scale)), model.weights)
            tails = _sigmoid(eta[:, None] - model.thresholds[None, :])
            steps = np.diff(np.array(model.grades, float))
            flat = np.ascontiguousarray(tails).reshape(-1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "expected_grade": pa.array(model.grades[0] + tails @ steps, pa.float64()),
                "tails": _lists(np.arange(len(eta) + 1) * tails.shape[1], pa.array(flat))})


def score(docs: DataFrame, model: Model, at_least: int | None = None) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept): the tail is
    P(grade >= at_least), by default of the second lowest grade."""
    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
           .mapInArrow(partial(_scored, shared=docs.sparkSession.sparkContext.broadcast(model)),
                       "doc_id long, expected_grade double, tails array<double>"))
    if len(model.grades) < 2:
        tail: Column = F.lit(1.0)
    else:
        at = 1 if at_least is None else model.grades.index(at_least)
        tail = F.lit(1.0) if at == 0 else F.get("tails", F.lit(at - 1))
    return out.select("doc_id", "expected_grade", tail.alias("tail_probability")) \
        .withColumn("kept", F.col("tail_probability") >= SELECT_AT)


def graded_labels(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 poor, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of all of ``documents``, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, graded_labels(table(spark, sf_dir, "labels"))))
