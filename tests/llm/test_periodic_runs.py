import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import ODD, SF, empty, frame, pseudo, rng, words

from seedwright.llm.common import table
from seedwright.llm.periodic_runs import (PRIMES, find_runs, op11_periodic_runs, periodic_runs,
                                          zero_mismatch)


def brute(w, least=24, exponent=3):
    """Every maximal stretch of every period, by comparing words."""
    out, n = {}, len(w)
    for q in range(1, n // exponent + 1):
        begin = None
        for k in range(n - q + 1):
            if k < n - q and w[k] == w[k + q]:
                begin = k if begin is None else begin
            elif begin is not None:
                if k - begin + q >= max(least, exponent * q):
                    out.setdefault((begin, k + q), q)
                begin = None
    return sorted((s, e - s, q) for (s, e), q in out.items())


def expected(doc_id, w, least=24, exponent=3):
    runs = brute(w, least, exponent)
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else None
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    text = " ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def repeated(r, n, k):
    w = [r.randrange(k) for _ in range(n)]
    for _ in range(r.randrange(4) if n > 30 else 0):
        at, q = r.randrange(n), r.randrange(1, n // 4 + 1)
        root = [r.randrange(k) for _ in range(q)]
        size = r.randrange(q, 6 * q + 30)
        w[at:at + size] = [root[i % q] for i in range(size)]
    return w


@pytest.mark.parametrize("least,exponent", [(24, 3), (2, 3), (5, 4), (60, 5)])
def test_runs_equal_brute_force(least, exponent):
    r = rng(least)
    for _ in range(60):
        docs = [repeated(r, r.randrange(300), r.choice([1, 2, 3, 40])) for _ in range(4)]
        off = np.cumsum([0] + [len(d) for d in docs])
        got = find_runs(np.array([x for d in docs for x in d], np.int64), off, least, exponent)
        got = sorted(zip(got.start.tolist(), (got.end - got.start).tolist(), got.period.tolist(), strict=True))
        assert got == sorted((s + int(o), n, q) for d, o in zip(docs, off, strict=False) for s, n, q in brute(d, least, exponent))


def test_mismatch_sums_are_exact_with_large_numbers():
    r = np.random.default_rng(1)
    p0 = PRIMES[0][0]
    pattern = r.integers(1, 1 << 31, (3, 8)).astype(np.uint64)
    window = r.integers(1, 1 << 31, (3, 15)).astype(np.uint64)
    window[0, 3:11] = pattern[0]
    window[1, :8] = pattern[1]
    window[2, :8] = pattern[2]
    window[2, 0] = (int(pattern[2, 0]) + p0) % (1 << 32)  # differs by a prime: zero modulo it
    got = zero_mismatch(pattern, window, 8, 1 << 32)
    assert [(int(i), int(j)) for i, j in zip(*np.nonzero(got), strict=True)] == [(0, 3), (1, 0)]
    with pytest.raises(OverflowError):
        zero_mismatch(pattern, window, 8, 1 << 60)


def test_long_runs_stay_linear():
    x = np.zeros(400_000, np.int64)
    got = find_runs(x, np.array([0, len(x)]), 24, 3)
    assert (got.start.tolist(), got.end.tolist(), got.period.tolist()) == ([0], [400_000], [1])
    x[200_000:] = np.arange(200_000) % 50_000
    got = find_runs(x, np.array([0, len(x)]), 24, 3)
    assert (0, 200_001, 1) in zip(got.start.tolist(), got.end.tolist(), got.period.tolist(), strict=True)
    assert 50_000 in got.period.tolist()


def test_operator_equals_brute_force(spark):
    r = rng(3)
    texts = ODD + ["ha " * 500, "x y\n" * 40, " ".join(pseudo(r, 9)) * 30, "q " * 9000 + "z" * 6000]
    for _ in range(40):
        texts.append("\t".join(f"w{x}" for x in repeated(r, r.randrange(200), r.choice([2, 30]))))
    texts += texts[-3:]
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    rows = periodic_runs(frame(spark, texts, ids).repartition(5)).collect()
    keys = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = sorted((str(tuple(x[k] for k in keys)) for x in rows))
    cut = [w if len(w := words(t)) < 3000 else None for t in texts]
    want = [expected(i, w) for i, w in zip(ids, cut, strict=True) if w is not None]
    long = [x for x in rows if x.length is not None and x.length == 9000]
    assert len(long) == 1 and (long[0].period, long[0].collapsed) == (1, "q " + "z" * 6000)
    assert sorted(map(str, want)) == sorted(x for x in got if ", 9000, 1, " not in x)
    for x in rows:
        assert hashlib.sha256(x.collapsed.encode()).hexdigest() == x.collapsed_sha256
        assert len(x.runs) == x.n_runs


def test_query_equals_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    got = {x.doc_id: tuple(x) for x in op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    changed = 0
    for x in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", x.text or "")
        h = zlib.crc32(str(x.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += 1
        if len(w) < 3000:
            assert got[x.doc_id] == expected(x.doc_id, w), x.doc_id
    assert changed > 5


def test_empty(spark):
    assert periodic_runs(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(empty(spark), min_exponent=2)
