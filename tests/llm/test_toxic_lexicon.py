import time
import zlib

import pytest
from helpers import ODD, empty, frame, pseudo, rng

from seedwright.llm.toxic_lexicon import REJECT_AT, Matcher, around, fit, fold, score, without_toxic

LABELS = "doc_id long, toxic int"


def test_fold_reaches_the_plain_word():
    for t in ("IDIOT!", "1d10t", "іdіоt", "ｉｄｉｏｔ", "ídïot", "id!ot", "idi0t", "@ idiot", "i\u200bdiot"):
        assert " idiot " in fold(t), t
    assert fold("wor%%% 24") == " wor    24 "


def test_exception_phrases_and_longest_match():
    m = Matcher({" clown": 2.0, " clown ": 3.0, " scum": 1.0}, (" clown fish ",))
    assert m.total(fold("a clown fish swims")) == 0
    assert m.total(fold("a clown, a scumbag")) == 4.0
    assert Matcher({}, ()).total(" x ") == 0


def test_matcher_equals_brute_force():
    r = rng(9)
    for _ in range(300):
        def piece():
            return " " + "".join(r.choice("ab ") for _ in range(r.randrange(1, 5)))
        lexicon = {piece(): float(r.randrange(1, 5)) for _ in range(r.randrange(1, 6))}
        free = tuple({piece() for _ in range(r.randrange(4))} - set(lexicon))
        text = fold("".join(r.choice("ab  ") for _ in range(r.randrange(60))))
        spans = [(i, i + len(p)) for p in free for i in range(len(text)) if text.startswith(p, i)]
        best = {}
        for p, w in lexicon.items():
            for i in range(len(text)):
                if text.startswith(p, i) and not any(a <= i and i + len(p) <= b for a, b in spans):
                    best[i] = max(best.get(i, 0.0), w)
        assert Matcher(lexicon, free).total(text) == sum(best.values()), (lexicon, free, text)


def test_many_exceptions_and_long_words():
    m = Matcher({" clown": 2.0}, (" clown fish ",))
    t = time.monotonic()
    assert m.total(fold("a clown fish " * 20_000 + "clown")) == 2.0
    assert time.monotonic() - t < 2
    long = "x" * 200
    assert around(fold(f"grim wolf {long} end"), 5) == ("grim", "wolf", long)
    assert around(fold(f"{long}   wolf"), 203) == (long, "wolf", "")
    assert around(" wolf ", 0) == ("", "wolf", "")


@pytest.fixture(scope="module")
def corpus():
    r = rng(1)
    texts, labels = [], []
    for d in range(900):
        w = pseudo(r, r.randrange(5, 120), 3000)
        bad = d % 5 == 0
        if bad:
            for _ in range(1 + len(w) // 40):
                w.insert(r.randrange(len(w)), r.choice(["grob", "GR0B,", "snarky", "zwibel" + r.choice("abcdef")]))
        elif d % 7 == 0:
            w[1:1] = ["snarky", "wolf"]
        texts.append(" ".join(w))
        labels.append((d, int(bad)))
    return texts, labels


def test_learns_words_stems_and_exceptions(spark, corpus):
    texts, labels = corpus
    docs = frame(spark, texts)
    model = fit(docs, spark.createDataFrame([*labels, (None, 1), (3, None)], LABELS))
    assert any(e.startswith(" grob") for e in model[0]) and any(e.startswith(" zwib") for e in model[0])
    got = {r.doc_id: r for r in score(docs, model).collect()}
    held = [d for d in got if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    hit = [got[d].predicted for d in held if d % 5 == 0]
    false = [got[d].predicted for d in held if d % 5]
    assert sum(hit) / len(hit) > 0.85 and sum(false) / len(false) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= REJECT_AT) for r in got.values())
    kept = without_toxic(docs, model)
    assert {r.doc_id for r in kept.collect()} == {d for d in got if not got[d].predicted} and kept.schema == docs.schema


def test_held_out_labels_do_not_matter(spark, corpus):
    texts, labels = corpus
    docs = frame(spark, texts)
    flipped = [(d, 1 - y if zlib.crc32(str(d).encode()) % 3 == 1 else y) for d, y in labels]
    assert fit(docs, spark.createDataFrame(labels, LABELS)) == fit(docs, spark.createDataFrame(flipped, LABELS))


def test_odd_cases(spark):
    docs = frame(spark, ODD + ["you idiot, scum and moron"], [None, *range(1, len(ODD) + 1)])
    model = fit(docs, spark.createDataFrame([], LABELS))  # built-in lexicon
    got = score(docs, model).collect()
    assert len(got) == len(ODD) + 1
    assert [r.doc_id for r in got if r.predicted] == [len(ODD)]
    assert score(empty(spark), model).collect() == []
    assert without_toxic(empty(spark), model).collect() == []
