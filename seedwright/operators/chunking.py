"""Chunking: one chunk per sample, greedy minimum-length packing, fixed-size
slices, and the dense global chunk index.

Ordered operators work on keys and lengths only; texts never leave the JVM and
are joined back by key.  No step sends a whole source to one task:

1. range-partition the keys by their order and write them with the partition's
   index, so both passes see the same layout;
2. a small summary of each partition (group totals, or the packing tables of its
   first segment);
3. combine the summaries in partition order;
4. finish each partition from its offset.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def ranged(keys: DataFrame, order_cols: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partitioned and written with the partition index as data
    (``_pid``), so every later pass sees one layout."""
    n = _partitions(keys, partitions)
    return written(keys.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()), "ranged")


def _pids(pdf) -> list:
    """Partition indexes present in a batch, in order of appearance."""
    return list(dict.fromkeys(pdf["_pid"].tolist()))


def join_back(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with nulls equal; the keys come from the left."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in keys:
        cond = cond & left[c].eqNullSafe(r[f"_r_{c}"])
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in keys])


# ---------------------------------------------------------------------------
# Grouped exclusive prefix sums (C5 dense index, C3 slice starts)
# ---------------------------------------------------------------------------

def grouped_prefix(df: DataFrame, group_cols: list[str], order_cols: list[str], value_col: str,
                   out: str, partitions: int | None = None, lean: bool = False) -> DataFrame:
    """Adds ``out`` = sum of ``value_col`` over earlier rows of the same group
    in ``order_cols`` order.  ``order_cols`` must start with ``group_cols``
    and be unique per row, or ``df`` be ``lean``: keys and numbers only, which
    travel with the order, so that nothing is joined back."""
    carried = [c for c in df.columns if c not in order_cols and c != out] if lean else []
    r = ranged(df.select(*order_cols, *carried, F.coalesce(F.col(value_col), F.lit(0)).cast("long").alias("_v")),
               order_cols, partitions)
    inside = Window.partitionBy("_pid", *group_cols).orderBy(*order_cols) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = r.withColumn("_before", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    # one row per partition and group: at most partitions + groups
    totals = r.groupBy("_pid", *group_cols).agg(F.sum("_v").alias("_t"))
    earlier = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_base", F.coalesce(F.sum("_t").over(earlier), F.lit(0))).drop("_t")
    placed = join_back(local, offsets, ["_pid", *group_cols])
    at = (F.col("_before") + F.col("_base")).alias(out)
    if lean:
        return placed.select(*[c for c in df.columns if c != out], at)
    return join_back(df, placed.select(*order_cols, at), order_cols)


def dense_index(df: DataFrame, order_cols: list[str], out: str = "chunk_id",
                partitions: int | None = None, lean: bool = False) -> DataFrame:
    """``row_number() over (order by order_cols) - 1`` without a single-task
    window: per-partition counts, offsets, local positions.  ``lean`` as in
    ``grouped_prefix``."""
    return (grouped_prefix(df.withColumn("_one", F.lit(1).cast("long")), [], order_cols,
                           "_one", out, partitions, lean).drop("_one"))


# ---------------------------------------------------------------------------
# C3 fixed-size slices across documents
# ---------------------------------------------------------------------------

def _labels(rows: DataFrame, g: list[str]) -> list[str]:
    return [c for c in ("source", "split") if c in rows.columns and c not in g]


def fixed_slices(rows: DataFrame, size: int = 1000, partitions: int | None = None,
                 group_cols: list[str] | None = None) -> DataFrame:
    """Per group (default source, split): ``' '.join(texts)`` cut every
    ``size`` characters, without ever building the joined string.  Output:
    group columns (+ source/split labels), chunk_no, text."""
    g = group_cols or ["source_ord", "split_ord"]
    labels = _labels(rows, g)
    rows = rows.filter(F.col("text").isNotNull()).withColumn("plen", (F.length("text") + 1).cast("long"))
    total = rows.groupBy(*g).agg((F.sum("plen") - 1).alias("_total"))
    pieces = join_back(grouped_prefix(rows, g, [*g, "ord"], "plen", "start", partitions), total, g)
    # each text with the blank after it, but for the group's last one
    piece = F.when(F.col("start") + F.col("plen") > F.col("_total"), F.col("text")) \
        .otherwise(F.concat(F.col("text"), F.lit(" ")))
    first = (F.lit(size) - F.col("start") % size).cast("int")  # up to the next cut
    cuts = F.concat(F.array(F.left(piece, first)),
                    F.regexp_extract_all(F.substring(piece, first + 1, F.length(piece)),
                                         F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))
    parts = pieces.select(*g, *labels, "start", F.posexplode(cuts).alias("_i", "part")).filter("part <> ''")
    k = (F.floor(F.col("start") / size) + F.col("_i")).cast("long")
    return (parts.withColumn("lo", F.greatest("start", k * size))
            .groupBy(*g, *labels, k.alias("chunk_no"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lo", "part"))),
                                          lambda x: x["part"]), "").alias("text")))


# ---------------------------------------------------------------------------
# C2 greedy minimum-length packing, exact and sharded
# ---------------------------------------------------------------------------
# Fold per group, in order:  if len(cur) >= min: emit cur; cur = text
#                            elif cur: cur += " " + text    else: cur = text
# The state is the length L of cur (0 = empty).  After an emit the state is
# the new text's length whatever came before, so a shard's behaviour for any
# carry-in is described by a short table (see _Segment.flushes).

class _Segment:
    """One group segment of a partition: lengths ``x`` in order.

    ``P[i]`` is the sum of 1 + x_j before row i.  A row r with a text, where cur
    is started, holds until ``stop[r]``, the first row that finds ``mn`` in hand;
    cur is emitted there and started again at ``start[stop[r]]``, the first row
    from there on with a text (empties vanish)."""

    def __init__(self, x: np.ndarray, mn: int):
        m = len(x)
        self.m, self.mn = m, mn
        self.P = np.zeros(m + 1, dtype=np.int64)
        np.cumsum(1 + x, out=self.P[1:])
        full = np.append(np.flatnonzero(x > 0), m)
        self.start = full[np.searchsorted(full, np.arange(m + 1))]
        self.stop = np.searchsorted(self.P[:m], self.P[:m] + 1 + mn, side="left")

    def flushes(self) -> tuple[np.ndarray, np.ndarray]:
        """For every row t: (emits after a flush at t, final state); row m: none."""
        m = self.m
        emits = (self.stop < m).astype(np.int64)
        nxt = self.start[self.stop]
        last = nxt == m  # no start follows
        hop = np.where(last, np.arange(m), nxt)
        count = np.where(last, 0, emits)
        while True:  # twice as far each time
            far = hop[hop]
            if np.array_equal(far, hop):
                break
            count = count + count[hop]
            hop = far
        final = np.where(self.stop < m, 0, self.P[m] - self.P[:m] - 1)
        n = np.append((count + emits[hop]) if m else [], 0).astype(np.int64)
        state = np.append(final[hop] if m else [], 0).astype(np.int64)
        return n[self.start], state[self.start]

    def assign(self, c: int, n: int) -> tuple[np.ndarray, int, int]:
        """Chunk number per row (-1 for an empty that vanishes), state and chunk
        number after the last row, entered with state ``c`` in chunk ``n``."""
        m = self.m
        bounds, numbers = [], []  # rows before bounds[i] (from the one before) have numbers[i]
        if c > 0:
            t = int(np.searchsorted(self.P[:m], self.mn - c, side="left"))
            bounds.append(t)
            numbers.append(n)
            if t >= m:
                return np.full(m, n, dtype=np.int64), int(c + self.P[m]), n
            n += 1
        else:
            t = 0
        stop, start = self.stop.tolist(), self.start.tolist()
        r, state = start[t], 0
        while True:
            bounds.append(r)
            numbers.append(-1)
            if r >= m:
                break
            t = stop[r]
            bounds.append(t)
            numbers.append(n)
            if t >= m:
                state = int(self.P[m] - self.P[r] - 1)
                break
            n += 1
            r = start[t]
        sizes = np.diff(np.array([0, *bounds]))
        return np.repeat(np.array(numbers, dtype=np.int64), sizes), state, n


def _apply_carry(tab: dict, c: int, mn: int) -> tuple[int, int]:
    """Emits and final state of a segment entered with state ``c``."""
    if c <= 0:
        return tab["fresh"]
    Ps = tab["P"]
    i = bisect.bisect_left(Ps, mn - c)
    if i < len(Ps) and i < tab["m"]:
        return 1 + tab["fl"][i], tab["fi"][i]
    return 0, c + tab["Pm"]


def pack_min_chars(rows: DataFrame, min_chars: int | None,
                   partitions: int | None = None,
                   group_cols: list[str] | None = None) -> DataFrame:
    """Greedy packing per group (default source, split) in ``ord`` order.
    ``min_chars`` null/0/negative -> one chunk per row.  Null texts are
    dropped (counted by the caller).  Output: group columns (+ source/split
    labels), chunk_no, text."""
    g = group_cols or ["source_ord", "split_ord"]
    rows = rows.filter(F.col("text").isNotNull())
    keys = g + _labels(rows, g)
    if not min_chars or min_chars <= 0:
        return dense_within(rows, g)
    mn = int(min_chars)
    order = g + ["ord"]
    r = ranged(rows.select(*order, F.length("text").cast("long").alias("len")), order, partitions)
    # pass 1: carry tables for the first segment of each partition
    sum_schema = ("pid int, first_g string, last_g string, single boolean, "
                  "P array<long>, fl array<long>, fi array<long>, m long, Pm long, "
                  "fresh_fl long, fresh_fi long, last_fl long, last_fi long")

    def gkey(pdf):
        k = pdf[g[0]].astype(str)
        for c in g[1:]:
            k = k + "\x1f" + pdf[c].astype(str)
        return k

    def summarise(key, pdf):
        pid = int(key[0])
        pdf = pdf.sort_values(order, kind="stable", na_position="first")
        g = gkey(pdf).to_numpy()
        x = pdf["len"].to_numpy(dtype=np.int64)
        cuts = np.flatnonzero(g[1:] != g[:-1]) + 1
        starts = np.concatenate([[0], cuts])
        ends = np.concatenate([cuts, [len(g)]])
        seg = _Segment(x[starts[0]:ends[0]], mn)
        P, m = seg.P, seg.m
        rfl, rfi = seg.flushes()
        fresh = (int(rfl[0]), int(rfi[0]))
        K = min(m - 1, int(np.searchsorted(P[:m], mn - 1, side="left")))
        single = len(starts) == 1
        if single:
            last = (0, 0)
        else:
            n, state = _Segment(x[starts[-1]:ends[-1]], mn).flushes()
            last = (int(n[0]), int(state[0]))
        return pd.DataFrame([{
            "pid": pid, "first_g": g[0], "last_g": g[-1], "single": single,
            "P": P[:K + 1].tolist(), "fl": rfl[:K + 1].tolist(), "fi": rfi[:K + 1].tolist(),
            "m": m, "Pm": int(P[m]), "fresh_fl": fresh[0], "fresh_fi": fresh[1],
            "last_fl": last[0], "last_fi": last[1]}])

    cols = ["_pid"] + g + ["len"]
    # lengths and keys of one range partition at a time
    summary = sorted(r.select(*cols, "ord").groupBy("_pid").applyInPandas(summarise, sum_schema).collect(),
                     key=lambda s: s["pid"])
    starts: dict = {}
    cur_g, carry, count = None, 0, 0
    for s in summary:
        if s["first_g"] == cur_g:
            c, base = carry, count
        else:
            c, base = 0, 0
        starts[s["pid"]] = (c, base)
        tab = {"P": s["P"], "fl": s["fl"], "fi": s["fi"], "m": s["m"], "Pm": s["Pm"],
               "fresh": (s["fresh_fl"], s["fresh_fi"])}
        fl, fi = _apply_carry(tab, c, mn)
        if s["single"]:
            cur_g, carry, count = s["first_g"], fi, base + fl
        else:
            cur_g, carry, count = s["last_g"], s["last_fi"], s["last_fl"]
    bc = rows.sparkSession.sparkContext.broadcast(starts)
    out_schema = T.StructType([f for f in r.schema.fields if f.name not in ("len", "_pid")]
                              + [T.StructField("chunk_no", T.LongType())])

    def assign(it):
        state, n, prev, cur_pid = 0, 0, None, None
        for pdf in it:
            if len(pdf) == 0:
                continue
            g = gkey(pdf).to_numpy()
            pids = pdf["_pid"].to_numpy()
            x = pdf["len"].to_numpy(dtype=np.int64)
            res = np.empty(len(pdf), dtype=np.int64)
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (pids[1:] != pids[:-1])) + 1
            bounds = np.concatenate([[0], cuts, [len(g)]])
            for a, b in zip(bounds[:-1], bounds[1:]):
                if pids[a] != cur_pid:  # a new partition: its carry-in
                    cur_pid = pids[a]
                    state, n = bc.value.get(int(cur_pid), (0, 0))
                elif g[a] != prev:      # a new group inside the partition
                    state, n = 0, 0
                res[a:b], state, n = _Segment(x[a:b], mn).assign(state, n)
                prev = g[a]
            pdf = pdf.drop(columns=["len", "_pid"])
            pdf["chunk_no"] = res
            yield pdf[pdf["chunk_no"] >= 0]

    # a partition's rows together and in order, whatever files they were read from
    placed = r.repartition(_partitions(rows, partitions), "_pid").sortWithinPartitions("_pid", *order)
    assigned = join_back(rows, placed.mapInPandas(assign, out_schema), order)
    return (assigned.groupBy(*keys, "chunk_no")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))),
                                          lambda e: e["text"]), " ").alias("text")))


def dense_within(rows: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """One chunk per row; chunk_no = position inside its group."""
    g = group_cols or ["source_ord", "split_ord"]
    return (grouped_prefix(rows.withColumn("_one", F.lit(1).cast("long")), g, g + ["ord"],
                           "_one", "chunk_no")
            .select(*g, *_labels(rows, g), "chunk_no", "text"))


def pack_sources(rows: DataFrame, default_min: int | None = None, partitions: int | None = None) -> DataFrame:
    """C2 over tagged rows whose specs carry their own ``min_chars``: each source
    with its minimum, or the default.  One pass per distinct minimum."""
    keys = ["source_ord", "split_ord", "source", "split"]
    rows = rows.withColumn("min_chars", F.coalesce("min_chars", F.lit(default_min).cast("int"))).filter("text is not null")
    out = None
    for (mn,) in rows.select("min_chars").distinct().orderBy("min_chars").collect():
        part = rows.filter(F.col("min_chars").eqNullSafe(F.lit(mn))).drop("min_chars")
        packed = pack_min_chars(part, mn, partitions).select(*keys, "chunk_no", "text")
        out = packed if out is None else out.unionByName(packed)
    return rows.select(*keys, F.lit(0).cast("long").alias("chunk_no"), "text").limit(0) if out is None else out
