from collections import defaultdict

import pytest
from helpers import ODD, edited, empty, frame, lower_az, pseudo, rng, words

from seedwright.llm.minmax_dedup import SMALL_BUCKET, near_duplicates


def brute(docs, k, percent):
    """(size, component) by comparing all pairs."""
    sets, parent = {}, {}
    for d, t in docs:
        w = words(lower_az(t))
        sets[d] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k \
            else frozenset([tuple(w)] if w else [])
        parent[d] = d

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    by = defaultdict(list)
    for d, s in sets.items():
        if s:
            by[s].append(d)
    reps = [(min(v), s) for s, v in by.items()]
    for v in by.values():
        for d in v:
            x, y = find(d), find(min(v))
            parent[max(x, y)] = min(x, y)
    for i, (a, s) in enumerate(reps):
        for b, t in reps[:i]:
            n = len(s & t)
            if 100 * n >= percent * (len(s) + len(t) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check(df, docs, k):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, k, 80).collect()}
    want = brute(docs, k, 80)
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {}
    return want


@pytest.mark.parametrize("k", [2, 5])
def test_odd_texts(spark, k):
    texts = ODD + ["One two three four five six", "one TWO three four five six", "one two"]
    check(frame(spark, texts), list(enumerate(texts)), k)


def test_hot_group_of_near_copies(spark):
    """A group larger than any small bucket, with members that link to none."""
    r = rng(3)
    base = pseudo(r, 150)
    texts = [" ".join(edited(r, base, r.choice([0, 0.01, 0.02, 0.05, 0.08, 0.12, 0.2]))) for _ in range(260)]
    texts += [texts[0]] * 40 + [" ".join(pseudo(r, r.randrange(5, 90))) for _ in range(40)]
    r.shuffle(texts)
    want = check(frame(spark, texts).repartition(5), list(enumerate(texts)), 2)
    sizes = defaultdict(int)
    for _, c in want.values():
        sizes[c] += 1
    assert max(sizes.values()) > 3 * SMALL_BUCKET and sum(n == 1 for n in sizes.values()) > 20


def test_crowded_bucket_of_many_components(spark):
    """Over a thousand members share buckets; few of them are linked."""
    r = rng(1024)
    base = [pseudo(r, 6, 10**6) for _ in range(30)]
    texts = []
    for _ in range(1100):
        parts = list(base) + [pseudo(r, r.choice([1, 2, 3, 30, 60]), 10**6)]
        for _ in range(r.choice([0, 0, 1, 3])):
            del parts[r.randrange(len(parts) - 1)]
        texts.append(" ".join(" ".join(x) for x in parts))
    want = check(frame(spark, texts).repartition(4), list(enumerate(texts)), 2)
    sizes = defaultdict(int)
    for _, c in want.values():
        sizes[c] += 1
    assert sum(n == 1 for n in sizes.values()) > len(texts) / 8


def test_very_long_texts(spark):
    r = rng(12)
    w = pseudo(r, 30_000, 10**6)
    texts = [" ".join(w), " ".join(w[:-2000]), " ".join(w[:15_000]), "x" * 30_000, "x" * 30_000 + " y", "x" * 30_000]
    check(frame(spark, texts), list(enumerate(texts)), 2)


def test_null_and_repeated_ids(spark):
    df = frame(spark, ["a b c d e f", "a b c d e f", "z", None, "z"], [None, 5, 5, None, 7])
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 2).collect()), key=str)
    assert rows == sorted([(None, 5, None, True), (5, 5, 5, True), (5, 1, 5, True), (None, 0, None, True), (7, 1, 5, False)], key=str)
    assert near_duplicates(empty(spark), 2).collect() == []
