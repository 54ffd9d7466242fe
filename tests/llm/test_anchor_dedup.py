import hashlib
import time
from collections import Counter

import pytest
from helpers import ODD, empty, frame, pseudo, rng, words

from seedwright.llm.anchor_dedup import COVERS, cover_for, remove_repeats


def brute(texts, window):
    seen = Counter()
    for t in texts:
        w = words(t)
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for t in texts:
        w = words(t)
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = b"\1" * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_covers_hit_every_difference():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [35, 5, 1])
def test_equals_brute_force(spark, window):
    r = rng(window)
    shared = [pseudo(r, n) for n in (34, 35, 36, 50, 90)]
    texts = ODD + [" ".join(pseudo(r, 200)) for _ in range(3)] + ["x " * 120, "y z " * 60]
    for k in range(60):
        w = pseudo(r, r.randrange(80), 5000)
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(shared)
        texts.append(("\n" if k % 2 else "  ").join(w))
    texts += texts[-3:]
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    df = frame(spark, texts, ids).repartition(6)
    got = sorted((str(x.doc_id), x.n_words, x.n_removed, x.kept_sha256, x.kept_text) for x in remove_repeats(df, window).collect())
    assert got == sorted((str(i), *w) for i, w in zip(ids, brute(texts, window), strict=True))


def test_equal_rows_cost_in_proportion(spark):
    r = rng(4)
    text = " ".join(pseudo(r, 400, 10**6))
    took = {}
    for k in (50, 400, 3200):
        df = frame(spark, [text] * k, [None] * k).repartition(4)
        t = time.monotonic()
        rows = remove_repeats(df, 35).collect()
        took[k] = time.monotonic() - t
        assert len(rows) == k and {(x.n_words, x.n_removed) for x in rows} == {(400, 400)}
    assert took[3200] < 8 * took[400] + 5, took


def test_long_word_and_long_text(spark):
    r = rng(5)
    w = pseudo(r, 30_000, 10**6)
    texts = [" ".join(w[:20_000]) + " " + "x" * 20_000, " ".join(w[19_900:]), "x" * 20_000]
    got = sorted((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in remove_repeats(frame(spark, texts), 35, texts=False).collect())
    assert got == [(i, *b[:3]) for i, b in enumerate(brute(texts, 35))]


def test_cover_and_empty(spark):
    assert cover_for(35)[0] == 21 and cover_for(1)[0] == 1
    assert remove_repeats(empty(spark), 35).collect() == []
