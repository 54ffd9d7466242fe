import sys
from pathlib import Path

import pytest
from helpers import ODD, edited, empty, frame, pseudo, rng, sf_copy

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as cp  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"
BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    r = rng(12)
    clean = [" ".join(pseudo(r, 60, 4000)) for _ in range(60)]
    texts, labels = list(clean), [(d, 1, 0) for d in range(60)]
    for d in range(60, 100):
        w = pseudo(r, 50, 4000)
        w[7:7] = ["grobian", "fool"]
        texts.append(" ".join(w))
        labels.append((d, 1, 1))
    item = " ".join(pseudo(r, 30, 9000))
    texts += [clean[0], clean[0], " ".join(edited(r, clean[1].split(), 0.02)), clean[2] + " " + item + " end",
              "write to ann@example.com " + " ".join(pseudo(r, 30, 4000)), *ODD]
    docs = frame(spark, texts)
    return sf_copy(tmp_path_factory.mktemp("p"), spark, docs, labels=spark.createDataFrame(labels, LABELS),
                   benchmark=spark.createDataFrame([(1, item), (2, None)], BENCH))


def test_stages_take_effect_one_after_another(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    base = docs.columns[:5]
    left = [None] * 5
    for k, (name, stage) in enumerate(cp.STAGES):
        docs = cp.saved(stage(spark, docs, sf), f"t-{name}")
        left[k] = {r.doc_id for r in docs.collect()}
        if k < 4:
            assert docs.columns == base
    assert left[0] == set(range(60)) | {d for d in range(100, 105 + len(ODD))}
    gone = left[0] - left[1]
    assert {100, 101, 102} <= gone and not gone & set(range(60)) and 115 in gone  # the copy within ODD
    assert left[1] - left[2] == {103} and left[3] == left[2] == left[4]
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]


def test_run_equals_stages_and_redacts(spark, sf):
    rows = cp.run(spark, sf).collect()
    assert {r.doc_id for r in rows} >= set(range(60)) and not {100, 101, 103, 60} & {r.doc_id for r in rows}
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id = 104")
    assert cp.pii(spark, docs, sf).first().text.startswith("write to [EMAIL] ")


def test_empty_tables(spark, tmp_path):
    sf = sf_copy(tmp_path, spark, empty(spark), labels=spark.createDataFrame([], LABELS),
                 benchmark=spark.createDataFrame([], BENCH))
    assert cp.run(spark, sf).collect() == []


def test_null_and_repeated_ids_and_long_texts(spark, tmp_path):
    r = rng(21)
    clean = [" ".join(pseudo(r, 40, 10**6)) for _ in range(6)]
    long = " ".join(pseudo(r, 30_000, 10**6)) + " " + "z" * 20_000
    texts = [*clean, clean[0], clean[0], clean[1], " ".join(pseudo(r, 40, 10**6)), long, long, None, None]
    ids = [0, 1, 2, 3, 4, 5, None, 6, None, 2, 8, 9, None, 10]
    sf = sf_copy(tmp_path, spark, frame(spark, texts, ids), labels=spark.createDataFrame([(0, 1, 0), (1, 1, 1), (None, 1, 1)], LABELS),
                 benchmark=spark.createDataFrame([(1, clean[4])], BENCH))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in cp.STAGES[1:]:
        docs = cp.saved(stage(spark, docs, sf), f"n-{name}")
        kept[name] = sorted((-1 if x.doc_id is None else x.doc_id) for x in docs.collect())
    # copies with an id go; rows without an id stay; both rows of id 2 stay
    assert kept["near_duplicates"] == [-1, -1, -1, 0, 1, 2, 2, 3, 4, 5, 8, 10]
    assert kept["decontamination"] == [-1, -1, -1, 0, 1, 2, 2, 3, 5, 8, 10]
    assert kept["pii"] == kept["decontamination"]
    pieces = docs.groupBy("doc_id").sum("length").collect()
    assert {x.doc_id for x in pieces} == {None, 0, 1, 2, 3, 5, 8, 10}
