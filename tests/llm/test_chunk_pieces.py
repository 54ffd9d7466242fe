import hashlib

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD, SF, empty, frame, pseudo, rng

from seedwright.llm.chunk_pieces import (DEFAULT_MODEL, ChunkTable, encode, marked_words,
                                         op13_chunk_pieces, pieces)
from seedwright.llm.common import table

MODEL = public_tokenizers.path(DEFAULT_MODEL)
MARKS = ["  ", "a ", " a", "a▁ b", "▁▁ a ▁", "a\x00b", "</s> <s> <unk> <0x41>", "😀  😀 ", "x" * 9000,
         "  　 q", "a \n b", "日本語 テキスト", "é " * 3, "퟿ ￿", "word " * 5000]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("cuts", [True, False])
def test_words_joined_by_a_blank_are_the_text(cuts):
    texts = ["", None, " ", "  a  b ", "a▁ b c", "▁ x", "é ", "no", " lead"]
    words, off = marked_words(pa.array(texts), cuts)
    words = [w.decode() for w in words.to_pylist()]
    got = [" ".join(words[a:b]) for a, b in zip(off, off[1:], strict=False)]
    assert got == [t or "" for t in texts]
    assert off[1] == off[0] == off[2] and (cuts or len(words) == 7)


def test_equals_library(spark):
    r = rng(13)
    texts = ODD + MARKS + [(" " * r.randrange(1, 4)).join(pseudo(r, 50)) for _ in range(30)] + ["same words again"] * 20
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    sp = library()
    want = []
    for i, t in zip(ids, texts, strict=True):
        x = sp.encode(t or "") + [sp.eos_id()]
        want.append(str((i, len(x), x, sp.decode(x))))
    rows = encode(frame(spark, texts, ids).repartition(4), MODEL).collect()
    assert sorted(str((x.doc_id, x.n_tokens, list(x.ids), x.decoded)) for x in rows) == sorted(want)


def test_model_that_may_not_be_cut(spark, monkeypatch):
    assert pieces(MODEL).cuts
    p = pieces(MODEL)
    monkeypatch.setattr(p, "cuts", False)
    sp = library()
    assert p.encode(["", "a b"]) == [sp.encode(""), sp.encode("a b")]


def test_table_segments_each_word_once_and_stays_bounded(monkeypatch):
    p = pieces(MODEL)
    seen = []
    plain = p.encode
    monkeypatch.setattr(p, "encode", lambda words: seen.extend(words) or plain(words))
    t = ChunkTable(p, False, words=5)
    assert t.slots([b"a", b"b", b""]) == [0, 1, 2] and t.slots([b"b", b"c", b"d"]) == [1, 3, 4]
    assert seen == ["a", "b", "", "c", "d"]
    assert t.slots([b"d", b"a"]) == [0, 1] and len(t.slot) == 2  # full before, so emptied
    assert [t.ids[0], t.decoded[0]] == [library().encode("d"), b"d"]
    assert len(ChunkTable(p, True, size=3).slots([b"abcd", b"e"])) == 2


def test_query_equals_library(spark):
    sp = library()
    got = {x.doc_id: tuple(x)[1:] for x in op13_chunk_pieces(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        x = sp.encode(d.text or "") + [2]
        assert got[d.doc_id] == (len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(),
                                 hashlib.sha256(sp.decode(x).encode()).hexdigest())


def test_empty(spark):
    assert encode(empty(spark), MODEL).collect() == []
