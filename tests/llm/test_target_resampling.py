import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import ODD, SF, empty, frame, lower_az, pseudo, rng

from seedwright.llm.target_resampling import (Grams, GramTable, drawn, op12_sql,
                                              op12_target_resampling, resample)


def features(text, most):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(text))
    return len(w), [" ".join(w[i:i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, percent, buckets, most, seed, least):
    def tally(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, most)[1])
    s, t = tally([x for _, x in docs]), tally(target)
    ss, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        n, f = features(text, most)
        w = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    can = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {}
    for k, r in enumerate(can[:percent * len(can) // 100]):
        rank.setdefault(r, []).append(k + 1)
    out = []
    for r in rows:
        at = rank.get(r) if r[1] >= least else None
        out.append((r[0], r[2], r[3], r[4], at.pop() if at else None))
    return sorted(map(str, out))


def test_keys_are_xxhash64_and_slots_hold_equal_bytes():
    texts = ["Hello wörld the quick brown fox a-b-c the the", None, "", "x" * 31 + " " + "y" * 32 + " " + "y" * 32,
             " ".join("z" * n for n in range(1, 90)), "tail"]
    g = Grams(pa.array(texts), 3)
    all_bytes = [g.bytes_of(i) for i in range(len(g.size))]
    assert [int(k) for k in g.keys()] == [xxhash.xxh64_intdigest(b) for b in all_bytes]
    assert sorted(b.decode() for b in all_bytes) == sorted(f for t in texts for f in features(t, 3)[1])
    # all keys equal: only the bytes tell n-grams apart
    for keys in (None, np.zeros(len(all_bytes), np.uint64)):
        t = GramTable(g, 97, keys)
        where = {}
        for b, s in zip(all_bytes, t.slot.tolist(), strict=True):
            assert where.setdefault(b, s) == s
            assert t.bucket[s] == zlib.crc32(b) % 97 and t.count[s] == all_bytes.count(b)
        assert len(set(where.values())) == len(where)


@pytest.mark.parametrize("most,buckets,percent", [(1, 10_000, 10), (3, 50, 60)])
def test_equals_brute_force(spark, most, buckets, percent):
    r = rng(most)
    texts = ODD + [" ".join(pseudo(r, r.randrange(60))) for _ in range(80)] + ["Target words only " * 10] * 5 + ["y" * 40 + " b " * 4000]
    ids = [None if i % 11 == 3 else i for i in range(len(texts))]
    target = ["target words", None, "", "only target", "WORDS"]
    df, tdf = frame(spark, texts, ids).repartition(4), frame(spark, target)
    options = {"buckets": buckets, "max_words": most, "seed": 7, "min_words": 20}
    got = resample(df, tdf, percent, **options).collect()
    assert sorted(str(tuple(x)) for x in got) == brute(list(zip(ids, texts, strict=True)), target, percent, buckets, most, 7, 20)


def test_repeated_rows_and_drawn_rows(spark):
    df = frame(spark, ["a b c " * 10] * 40, [1] * 20 + list(range(20)))
    got = resample(df, frame(spark, ["a"]), 50)
    assert sorted(x.rank for x in got.collect() if x.rank is not None) == list(range(1, 21))
    df = frame(spark, ["plain text here " * 9] * 50 + ["rare target " * 12] * 10, range(60))
    rows = drawn(df, frame(spark, ["rare target"] * 50), 10)
    assert rows.columns == df.columns
    assert len(ids := [x.doc_id for x in rows.collect()]) == 6 and min(ids) >= 50


def test_empty(spark):
    assert resample(empty(spark), frame(spark, ["a"]), 10).collect() == []
    rows = resample(frame(spark, ["w " * 20, None]), empty(spark), 100).collect()
    assert sorted((x.doc_id, x.rank) for x in rows if x.rank) == [(0, 1)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as from '{SF}/{name}.parquet'")
    got = op12_target_resampling(spark, SF)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.sql(op12_sql()).fetchall()))
