"""Sharded chunkers against plain sequential versions."""
import random

from pyspark.sql import functions as F

from seedwright.operators.chunking import dense_index, fixed_slices, pack_min_chars


def fold(texts, mn):
    out, cur = [], ""
    for t in texts:
        if len(cur) >= mn:
            out.append(cur)
            cur = t
        else:
            cur = cur + " " + t if cur else t
    if cur:
        out.append(cur)
    return out


def _rows(spark, groups):
    data = [(g, i, t) for g, texts in groups.items() for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "source string, ord long, text string")


def test_pack_matches_fold(spark):
    rnd = random.Random(7)
    for trial in range(4):
        groups = {f"g{k}": ["x" * rnd.choice([0, 0, 1, 3, 7, 12, 30]) for _ in range(rnd.randint(1, 60))]
                  for k in range(rnd.randint(1, 3))}
        mn = rnd.choice([1, 5, 20, 50])
        for parts in (1, 3, 7):
            got = (pack_min_chars(_rows(spark, groups), mn, partitions=parts, group_cols=["source"])
                   .orderBy("source", "chunk_no").collect())
            exp = [(g, c) for g in sorted(groups) for c in fold(groups[g], mn)]
            assert [(r["source"], r["text"]) for r in got] == exp, (trial, parts, mn)
            for g in groups:
                nos = [r["chunk_no"] for r in got if r["source"] == g]
                assert nos == list(range(len(nos)))


def test_fixed_slices_rejoin(spark):
    groups = {"a": ["hello", "", "world" * 50, "x"], "b": ["y" * 2500]}
    got = fixed_slices(_rows(spark, groups), 100, partitions=3, group_cols=["source"]) \
        .orderBy("source", "chunk_no").collect()
    for g, texts in groups.items():
        joined = " ".join(texts)
        parts = [r["text"] for r in got if r["source"] == g]
        assert parts == [joined[i:i + 100] for i in range(0, len(joined), 100)]


def test_dense_index_is_row_number(spark):
    df = spark.range(0, 997).select((F.col("id") * 7919 % 997).alias("k"))
    got = dense_index(df, ["k"], "pos", partitions=5).orderBy("k").collect()
    assert [r["pos"] for r in got] == list(range(997))
    assert [r["k"] for r in got] == list(range(997))


def test_segment_tables_match_fold():
    import numpy as np

    from seedwright.operators.chunking import _Segment

    def run(x, mn, state, n):
        out = []
        for size in x:
            if state >= mn:
                n, state = n + 1, size
            elif state:
                state += 1 + size
                out.append(n)
                continue
            else:
                state = size
            out.append(n if size else -1)
        return out, state, n

    rnd = random.Random(3)
    for _ in range(3000):
        x = [rnd.choice([0, 0, 1, 2, 3, 9]) for _ in range(rnd.randrange(1, 12))]
        mn, state, n = rnd.randrange(1, 8), rnd.randrange(10), rnd.randrange(3)
        seg = _Segment(np.array(x, np.int64), mn)
        got = seg.assign(state, n)
        assert (got[0].tolist(), *got[1:]) == run(x, mn, state, n)
        emits, final = seg.flushes()
        for t in range(len(x)):
            _, last, k = run(x[t:], mn, 0, 0)
            assert (emits[t], final[t]) == (k, last)
