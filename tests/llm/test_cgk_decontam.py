import pytest
from helpers import ODD, SF, edited, empty, frame, pseudo, rng

from seedwright.llm import cgk_decontam
from seedwright.llm.cgk_decontam import (PLACES, SIZES, best_edits, contaminated, decontaminated, op9_cgk_decontam,
                                         plain_words, repeats, size_class, stride)

BENCH = "item_id long, text string"


def test_every_placement_holds_an_aligned_window():
    for n in range(1, 200):
        c = size_class(n)
        assert c in SIZES
        for at in range(c * 2):
            assert any((at + o) % stride(c) == 0 for o in range(n - c + 1))


def test_windows_are_of_the_items_size_and_sampled():
    for n in range(4, 71):
        assert size_class(n) >= 0.45 * n
        assert len(PLACES[size_class(n)]) == repeats(size_class(n)) and all(
            len(set(p)) == 3 < 2 * size_class(n) for p in PLACES[size_class(n)])


@pytest.fixture(params=["whole", "joined"])
def path(request, monkeypatch):
    """Both ways of meeting the benchmark."""
    if request.param == "joined":
        monkeypatch.setattr(cgk_decontam, "LISTED_KEYS", 0)
    return request.param


def test_edit_distance_of_best_stretch():
    assert best_edits(list("abc"), list("xxabcxx")) == (0, 5)
    assert best_edits(list("abcd"), list("xxabdxx"))[0] == 1
    assert best_edits(list("abc"), [])[0] == 3


def test_query_finds_verbatim_items(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id): r.edits for r in op9_cgk_decontam(spark, SF).collect()}
    assert want <= set(got) and all(got[p] == 0 for p in want)
    for (d, i), e in got.items():  # the rest is confirmed by the exact distance over the whole text
        w = plain_words(items[i])
        assert best_edits(w, plain_words(docs[d]))[0] <= e <= 0.2 * len(w)


def test_edited_copies_and_clean_documents(spark, path):
    r = rng(8)
    items = [(i, " ".join(pseudo(r, r.randrange(15, 56), 3000))) for i in range(40)]
    texts, want = [], set()
    for k in range(200):
        i, t = items[k % 40]
        copy = edited(r, t.split(), 0.1)
        texts.append(" ".join(pseudo(r, r.randrange(50), 3000) + [w.title() + "," for w in copy] + pseudo(r, 30, 3000)))
        want.add((k, i))
    texts += [" ".join(pseudo(r, 100, 3000)) for _ in range(100)]
    got = {(x.doc_id, x.item_id) for x in contaminated(frame(spark, texts), spark.createDataFrame(items, BENCH)).collect()}
    assert len(got & want) >= 0.95 * len(want)
    assert not {d for d, _ in got if d >= 200}


def test_whole_copy_after_a_part_of_it(spark, path):
    r = rng(5)
    texts, items = [], []
    for k, n in enumerate((59, 59, 31, 47, 18)):
        w = pseudo(r, n, 10**6)
        items.append((k, " ".join(w)))
        texts.append(" ".join([*w[:2 * n // 3], *pseudo(r, 5, 10**6), *w]))
        texts.append(" ".join([*w, *pseudo(r, 5, 10**6), *w[n // 3:]]))
    got = {(x.doc_id, x.item_id): x.edits for x in contaminated(frame(spark, texts), spark.createDataFrame(items, BENCH)).collect()}
    assert got == {(d, d // 2): 0 for d in range(len(texts))}


def test_recall_at_every_length(spark):
    r = rng(6)
    lengths = (5, 6, 8, 9, 11, 12, 15, 17, 20, 23, 24, 30, 35, 36, 46, 47, 50, 59, 62, 71, 96, 200)
    items = [(n, " ".join(pseudo(r, n, 10**6))) for n in lengths]
    for rate, least in ((0.1, 0.99), (0.2, 0.95)):
        texts = [" ".join([*pseudo(r, r.randrange(50), 10**6), *edited(r, t.split(), rate), *pseudo(r, 20, 10**6)])
                 for _, t in items for _ in range(60)]
        got = {(x.doc_id, x.item_id) for x in contaminated(frame(spark, texts), spark.createDataFrame(items, BENCH)).collect()}
        found = {n: sum((60 * k + j, n) in got for j in range(60)) / 60 for k, n in enumerate(lengths)}
        print(rate, found)
        assert not {n: v for n, v in found.items() if v < least}


def test_both_ways_give_the_same_rows(spark, monkeypatch):
    r = rng(2)
    common = "once upon a time there was".split()
    items = [(i, " ".join(pseudo(r, r.randrange(4, 60), 200) + (common if i % 2 else []))) for i in range(40)]
    items.append((99, " ".join(pseudo(r, 2500, 300))))  # one very long item
    texts = [" ".join(pseudo(r, 60, 200) + common * 3 + edited(r, items[k % 41][1].split(), 0.1 * (k % 3))) for k in range(120)]
    texts += ["x" * 9000, " ".join(common * 2000), texts[0], texts[0]]
    df, bench = frame(spark, texts, [None if k % 13 == 0 else k for k in range(len(texts))]), spark.createDataFrame(items, BENCH)
    rows = {}
    for keys in (10**6, 0):
        monkeypatch.setattr(cgk_decontam, "LISTED_KEYS", keys)
        rows[keys] = sorted(map(str, contaminated(df, bench).collect()))
    assert rows[0] == rows[10**6] and len(rows[0]) > 100


def test_odd_cases(spark, path):
    bench = spark.createDataFrame([(1, "same text here twice"), (1, "same text here twice"), (2, None), (3, ""), (None, "word")], BENCH)
    df = frame(spark, ODD, [None, *range(1, len(ODD))])
    got = sorted((x.doc_id, x.item_id) for x in contaminated(df, bench).filter("item_id is not null").collect())
    assert got == [(9, 1), (10, 1)]
    left = decontaminated(df, bench)
    assert left.count() == len(ODD) - 3 and left.columns == df.columns
    assert contaminated(empty(spark), bench).collect() == []
    assert contaminated(df, spark.createDataFrame([], BENCH)).collect() == []
