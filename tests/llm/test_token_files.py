import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import ODD, SF, empty, frame, sf_copy
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seedwright.llm.common import scratch, table
from seedwright.llm.segments import SegmentTokenizer
from seedwright.llm.token_files import (BLOCK_IDS, decode_words, encode_blocks, op1_token_files,
                                        read_token_files, write_token_files)

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = ODD + ["a  b", "a\n\nb  c \n d", "x <|endoftext|> y<|endoftext|>z", "a b   c\u3000d", "don't we'll 'S 12a\x1cb \x1c c",
              "é ́x É", "x\u0085y \u0085", "x|y a|> q≠z a.b,c! d≠s é.é,ß! ×.÷,", "ab É\u00ad x\u00adñ ªµ"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_segments_equal_whole_texts(name):
    plain, fast = Tokenizer.from_file(public_tokenizers.path(name)), SegmentTokenizer(public_tokenizers.path(name), 50)
    for texts in (HARD, HARD[::-1], HARD * 2):
        ids, off = fast.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[off[i]:off[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab Z9.,'!\n\t é×\u00a0\u3000<|", max_size=60))
def test_segments_of_random_texts(text):
    plain = Tokenizer.from_file(PATH) if not hasattr(test_segments_of_random_texts, "plain") \
        else test_segments_of_random_texts.plain
    test_segments_of_random_texts.plain = plain
    ids, _ = SegmentTokenizer.encode(FAST, pa.array([text]))
    assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


FAST = SegmentTokenizer(PATH)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300),
       st.integers(1, 40))
def test_words_round_trip(ids, times):
    ids = np.array(ids * times, np.uint64)
    words, off = encode_blocks(ids)
    assert np.array_equal(decode_words(words), ids)
    for b in range(len(off) - 1):
        assert np.array_equal(decode_words(words[off[b]:off[b + 1]]), ids[b * BLOCK_IDS:(b + 1) * BLOCK_IDS])


def expected(docs):
    tok, at, out = Tokenizer.from_file(PATH), 0, []
    for d, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def rows(df):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.orderBy("start").collect()]


def test_query_equals_plain_encoding(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").orderBy("doc_id").collect()]
    assert rows(op1_token_files(spark, SF)) == expected(docs)


def test_odd_texts_ids_and_empty(spark, tmp_path):
    df = frame(spark, HARD, [None, 7, 7, *range(len(HARD), 3, -1)][:len(HARD)]).repartition(4)
    got = rows(read_token_files(write_token_files(df, scratch(spark, "t"), PATH)))
    assert len(got) == len(HARD) and [g[0] for g in got] == sorted((g[0] for g in got), key=lambda x: (x is not None, x))
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    want = sorted((w[0] is not None, w[0] or 0, *w[2:]) for w in expected([(r.doc_id, r.text) for r in df.collect()]))
    assert sorted((g[0] is not None, g[0] or 0, *g[2:]) for g in got) == want
    assert rows(op1_token_files(spark, sf_copy(tmp_path, spark, empty(spark)))) == []


def test_long_texts(spark, tmp_path):
    docs = [(0, " ".join(f"word{i % 97} and{i}" for i in range(40_000))), (1, "x" * 20_000), (2, "é " * 20_000), (3, "")]
    path = sf_copy(tmp_path, spark, frame(spark, [t for _, t in docs], [d for d, _ in docs]))
    got = sorted(tuple(r)[:4] for r in op1_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(docs)
