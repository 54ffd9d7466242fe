import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD, SF, empty, frame
from tokenizers import Tokenizer

from seedwright.llm.hilbert_pack import curve_keys, hilbert_key, op7_hilbert_pack, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_point_by_unit_steps(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hilbert_key(points, bits)
    assert sorted(keys) == list(range(len(points)))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_copies_share_a_key():
    ids = np.array([5, 9, 9, 40, 5, 9, 9, 40, 7])
    a, b, c, d = curve_keys(ids, np.array([0, 4, 8, 9, 9]))
    assert a == b != c and d >= 0


def check(rows, docs, capacity):
    tok = Tokenizer.from_file(PATH)
    want = sorted((str(d), tuple(tok.encode(t or "", add_special_tokens=False).ids) + (1,)) for d, t in docs)
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
        raw = np.frombuffer(bytes(r.ids), "<u4")
        assert len(raw) == r.length and zlib.crc32(raw.tobytes()) == r.ids_crc32
        pieces[str(r.doc_id), r.doc_tokens].append((r.start, tuple(raw.tolist())))
    assert sum(r.length for r in rows) == sum(len(i) for _, i in want)
    for d, ids in want:
        have = pieces[d, len(ids)]
        for at, part in [p for p in have if ids[p[0]:p[0] + len(p[1])] == p[1]]:
            assert at + len(part) <= len(ids)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == [0, *np.cumsum([r.length for r in s])[:-1].tolist()]
        total = sum(r.length for r in s)
        assert total == capacity or total & (total - 1) == 0 and total < capacity
    return want, pieces


def test_query_packs_every_id_once_without_padding(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = pack(spark.read.parquet(f"{SF}/documents.parquet"), PATH).collect()
    want, pieces = check(rows, docs, 2048)
    for d, ids in want:
        assert tuple(i for _, p in sorted(pieces[d, len(ids)]) for i in p) == ids
    assert op7_hilbert_pack(spark, SF).count() == len(rows)


def test_odd_texts(spark):
    ids = [None, 3, 3, *range(4, len(ODD) + 1)]
    rows = pack(frame(spark, ODD, ids).repartition(3), PATH, capacity=64).collect()
    check(rows, list(zip(ids, ODD, strict=True)), 64)
    assert pack(empty(spark), PATH).collect() == []


def test_long_texts_and_ties(spark):
    long = " ".join(f"word{i % 97} and{i}" for i in range(12_000))
    texts = [long, long, "x" * 20_000 + " end", "tie", "tie", "tie", ""]
    ids = [1, 2, 3, 4, 5, 6, 7]
    rows = pack(frame(spark, texts, ids).repartition(3), PATH, 2048).collect()
    check(rows, list(zip(ids, texts, strict=True)), 2048)


def test_neighbours_on_the_curve_are_more_alike(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tok = Tokenizer.from_file(PATH)
    bags = {d: set(tok.encode(t, add_special_tokens=False).ids) for d, t in docs.items()}

    def alike(pairs):
        return np.mean([len(bags[a] & bags[b]) / max(1, len(bags[a] | bags[b])) for a, b in pairs])

    seqs = defaultdict(list)
    for r in op7_hilbert_pack(spark, SF).collect():
        seqs[r.sequence_id].append((r.offset, r.doc_id))
    near = [(a, b) for s in seqs.values() for (_, a), (_, b) in itertools.pairwise(sorted(s)) if a != b]
    r = np.random.default_rng(3)
    names = sorted(docs)
    chance = [tuple(r.choice(names, 2, replace=False)) for _ in range(4000)]
    print(alike(near), alike(chance))
    assert alike(near) > 1.3 * alike(chance)
