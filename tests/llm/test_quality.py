from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, SF, empty, frame, pseudo, rng, sf_copy, words

from seedwright.llm.license_digest import known_digests, known_texts, op10_license_digest, op10_sql, scan
from seedwright.llm.license_texts import KNOWN
from seedwright.llm.ordinal_quality import (HASHED, KINDS, MEASURES, SLOTS, features, fit, fit_ordinal, loss_slopes,
                                            op5_ordinal_quality, score)
from seedwright.llm.quality_rules import RULES, Rule, evaluate, op6_quality_rules, op6_sql


def in_duckdb(sql, name="documents"):
    c = duckdb.connect()
    c.sql(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    t = c.sql(sql)
    return t.columns, t.fetchall()


@pytest.mark.parametrize("query,sql", [(op6_quality_rules, op6_sql()), (op10_license_digest, op10_sql())])
def test_queries_equal_sql(spark, query, sql):
    names, want = in_duckdb(sql)
    got = query(spark, SF).select(*names).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def plain_counts(t):
    w, t = words(t), t or ""
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    marked = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(marked)


def test_counts_equal_plain_python(spark):
    r = rng(4)
    texts = ODD + ["a b c d e f g h " * 3, "a " * 40, "x\ny\nx\n \n\nx", "# | <b> é"]
    for _ in range(40):
        w = pseudo(r, 60, 12)
        texts.append(" ".join(w + w[5:25]) + r.choice(["", "\n" + " ".join(w[:4]) + "\n" + " ".join(w[:4])]))
    got = {x.doc_id: x for x in evaluate(frame(spark, texts)).collect()}
    for d, t in enumerate(texts):
        x = got[d]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == plain_counts(t), t[:60]
        assert x.base_failed == (x.n_words < 20 or 100 * x.n_repeat_words > 30 * x.n_words)
        assert x.kept == (not x.base_failed and not x.broken_rules)
    assert evaluate(empty(spark)).collect() == []


def test_rules_can_be_replaced(spark):
    df = frame(spark, ["one two three " * 9, None], [None, None])
    assert evaluate(df, RULES[:0]).columns == evaluate(df).columns
    [a, _] = sorted(evaluate(df, (Rule("many", "n_words / n_lines", "<=", 3),)).collect(), key=lambda x: -x.n_words)
    assert a.broken_rules == ["many"]


def test_licences(spark):
    mit = KNOWN[1][2]
    texts = ["MIT  licence\n\nCopyright (c) 2020 Ann. All Rights Reserved.\n\n" + mit.replace("sublicense", "sub-licence"),
             "x y\n" + "Released under the MIT License.\n" * 2 + "z", "about\n\n" + KNOWN[2][2].replace(", ", ",\n") + "\n\nend",
             "released, under the mit licence", *ODD]
    df = frame(spark, texts, [None, *range(1, len(texts))])
    got = {x.doc_id: x for x in scan(df, known_texts(spark)).collect()}
    assert len(got) == len(texts)
    assert got[None].license == "MIT" and [got[i].licenses for i in (1, 2, 3)] == ["MIT"] * 3
    assert got[1].license is None and got[3].license == "MIT" and got[5].n_matches == 0
    assert scan(empty(spark), known_texts(spark)).collect() == []
    assert {x.licenses for x in scan(df, known_texts(spark).limit(0)).collect()} == {""}


def test_features_equal_plain_python():
    texts = [t for t in ODD if t] + ["", "The the THE cat", "cat the", "a%% b2 C-d", "x" * 9000 + " y"]
    x = features(pa.array(texts))
    word_slots = {}
    for i, t in enumerate(texts):
        slot, value = x.slot[x.off[i]:x.off[i + 1]], x.value[x.off[i]:x.off[i + 1]]
        w = [v.lower() if v.isascii() else v for v in words(t)]
        counts = [Counter(w), Counter(zip(w, w[1:], strict=False))]
        for k, c in enumerate(counts):
            mine = value[(slot // SLOTS) == k]
            want = np.log1p(sorted(c.values()))
            assert np.allclose(sorted(mine), want / np.sqrt((want ** 2).sum()) if len(want) else []), t[:40]
        for kind in range(3):
            mine = value[(slot // SLOTS) == kind]
            assert not len(mine) or np.isclose((mine ** 2).sum(), 1)
        assert np.isclose(x.measures[i][0], np.log1p(len(w))) and x.measures[i][7] == (len(w) < 20)
        if len(set(w)) == 1 and w:
            word_slots.setdefault(w[0], set()).add(int(slot[slot < SLOTS][0]))
    assert all(len(v) == 1 for v in word_slots.values())
    a, b = features(pa.array(["cat sat"])), features(pa.array(["sat cat"]))
    assert set(a.slot[a.slot < SLOTS]) == set(b.slot[b.slot < SLOTS])  # words alike, pairs not
    assert set(a.slot[a.slot // SLOTS == 1]) != set(b.slot[b.slot // SLOTS == 1])


def test_slopes_equal_differences():
    r = np.random.default_rng(2)
    eta, y, t = r.normal(size=30), r.integers(0, 4, 30), np.array([-1.0, 0.2, 1.5])

    def loss(eta, t):
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        return -np.log(1 / (1 + np.exp(-(edges[y + 1] - eta))) - 1 / (1 + np.exp(-(edges[y] - eta))))

    by_row, by_t = loss_slopes(eta, y, t)
    e = 1e-6
    assert np.allclose(by_row, (loss(eta + e, t) - loss(eta - e, t)) / (2 * e), atol=1e-5)
    for j in range(3):
        d = np.eye(3)[j] * e
        assert np.isclose(by_t[j], (loss(eta, t + d) - loss(eta, t - d)).sum() / (2 * e), atol=1e-4)


def test_ordinal_fit_recovers_a_known_model(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(6000, 4))
    y = np.digitize(x @ [1, 2, 0, -1] + r.logistic(size=6000), [-1, 0.5, 2])
    rows = spark.createDataFrame([(int(g), [0, 1, SLOTS, 2 * SLOTS + 5], v.tolist(), [0.0] * len(MEASURES)) for g, v in zip(y, x, strict=True)],
                                 "y int, slot array<int>, value array<float>, measures array<double>").repartition(3)
    m = fit_ordinal(rows, (0, 1, 2, 3), steps=150)
    assert np.allclose(m.weights[[0, 1, SLOTS, 2 * SLOTS + 5]], [1, 2, 0, -1], atol=0.2)
    assert np.allclose(m.thresholds, [-1, 0.5, 2], atol=0.2) and (np.diff(m.thresholds) > 0).all()
    only = fit_ordinal(rows, (0, 1, 2, 3), steps=20, use=("words",))
    assert np.flatnonzero(only.weights).tolist() == [0, 1] and len(only.weights) == HASHED + len(MEASURES) and len(KINDS) == 3


def test_query_scores_every_document(spark):
    got = op5_ordinal_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = [r.kept == (labels[r.doc_id] == 1) for r in got if labels.get(r.doc_id) is not None]
    assert np.mean(right) > 0.9 and all(0 <= r.expected_grade <= 2 for r in got)


def test_ordinal_grades_documents(spark):
    r = rng(6)
    texts, grades = [], []
    for d in range(400):
        g = d % 3
        w = pseudo(r, r.randrange(30, 100), 2000)
        texts.append(" ".join(x + "%%%" if r.random() < (0.9, 0.3, 0.0)[g] else x for x in w))
        grades.append((d, g))
    docs = frame(spark, texts + ODD)
    m = fit(docs, spark.createDataFrame([*grades[:300], (None, 1), (5, None)], "doc_id long, grade int"))
    got = {x.doc_id: x for x in score(docs, m).collect()}
    held = range(300, 400)
    assert np.mean([got[d].kept == (d % 3 > 0) for d in held]) > 0.9
    assert np.mean([got[d].expected_grade for d in held if d % 3 == 2]) > np.mean([got[d].expected_grade for d in held if d % 3 == 1])
    assert len(got) == len(texts) + len(ODD)
    one = fit(docs, spark.createDataFrame([], "doc_id long, grade int"))
    assert {x.tail_probability for x in score(docs, one).collect()} == {1.0}
    assert score(empty(spark), m).collect() == []
    assert len(features(pa.array([], pa.string())).off) == 1
    rows = sorted(map(str, score(frame(spark, ["a b", "a b", None], [None, 3, None]), m).collect()))
    assert len(rows) == 3


COMMON = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not COMMON.is_dir(), reason="no licence texts on this machine")
def test_whole_licences_by_digest(spark):
    want = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
            "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3"}
    names = [n for n in want if (COMMON / n).is_file()]
    texts = [(COMMON / n).read_text(encoding="utf-8") for n in names]
    changed = [t.upper().replace(",", " ,").replace("\n", "\r\n") for t in texts]
    more = [t + "\none line more" for t in texts]
    got = {r.doc_id: r for r in scan(frame(spark, texts + changed + more), known_texts(spark), known_digests(spark)).collect()}
    n = len(names)
    assert [got[i].license for i in range(n)] == [want[x] for x in names] == [got[n + i].license for i in range(n)]
    assert all(got[2 * n + i].license is None for i in range(n))
    assert all(got[i].license in got[i].licenses for i in range(n))


def test_known_texts_of_the_input_folder(spark, tmp_path):
    path = sf_copy(tmp_path, spark, frame(spark, ["You may do as you please.", "Other"]),
                   licenses=spark.createDataFrame([("Own-1.0", "You may do as you please!", "x")], "license string, text string, note string"))
    got = {r.doc_id: r.license for r in op10_license_digest(spark, path).collect()}
    assert got == {0: "Own-1.0", 1: None}


def test_long_texts(spark):
    r = rng(31)
    w = pseudo(r, 20_000, 500)
    texts = [" ".join(w) + " " + " ".join(w[:300]), "x" * 20_000 + " y", "\n".join(w[:5000]) + "\n" + "\n".join(w[:200])]
    got = {x.doc_id: x for x in evaluate(frame(spark, texts)).collect()}
    for d, t in enumerate(texts):
        x = got[d]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == plain_counts(t)
    mit = KNOWN[1][2]
    scanned = {x.doc_id: x for x in scan(frame(spark, [texts[0] + "\n\n" + KNOWN[2][2] + "\n\n" + "z" * 9000, mit]), known_texts(spark)).collect()}
    assert scanned[0].licenses == "MIT" and scanned[0].license is None and scanned[1].license == "MIT"
