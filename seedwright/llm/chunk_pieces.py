"""Operator 13: SentencePiece encoding and decoding by a distinct-chunk table.

When no piece of a model has a whitespace marker behind another character, no
merge reaches over the place before a blank, so a text falls into marked words
that are segmented on their own.  A task keeps a table of the distinct ones it
has met: each is segmented and decoded by the library once, whichever batch it
comes in, and a document gathers its ids, and the text they decode to, by the
positions of its words.  The table is emptied when it holds ``TABLE_WORDS``
words or ``TABLE_BYTES`` bytes of them, so memory does not grow with the corpus.
Nothing is shuffled.

A table over all tasks (distinct words made by a shuffle, joined back by block
and position) was built first: a fifteenth of all words is distinct here, and
the joins wrote five times the input to disk.

A model whose pieces may cross a marker, or that changes its input, gets whole
texts as words: slower, and as exact.

Defined cases: null and empty texts have the end id only and decode to the
empty string; rows that repeat, or lack a doc_id, are encoded one by one; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import table, text_bytes, text_slices, tidy

DEFAULT_MODEL = "piece_bpe_32k.model"
#: Text of one pass over the table.
PASS_BYTES = 8 << 20
TABLE_WORDS = 500_000
TABLE_BYTES = 32 << 20
MARK = "▁"
_MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)


class Pieces:
    """A model, and whether its texts may be cut before blanks."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.eos = self.sp.eos_id()
        self.mark = self.sp.piece_to_id(MARK)
        with open(path, "rb") as f:
            model = pb.ModelProto.FromString(f.read())
        norm = model.normalizer_spec
        own = any(p.type == p.USER_DEFINED for p in model.pieces)
        crossing = any(MARK in p.piece.lstrip(MARK) for p in model.pieces)
        self.cuts = (not crossing and not own and not norm.precompiled_charsmap and norm.add_dummy_prefix
                     and norm.escape_whitespaces and not norm.remove_extra_whitespaces
                     and not model.trainer_spec.treat_whitespace_as_suffix and not self.sp.is_unknown(self.mark))

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word with its marker.  A word without characters stands
        for a text's last blank: the marker alone."""
        ids = self.sp.encode(words, num_threads=1)
        return [x if w or not self.cuts else [self.mark] for w, x in zip(words, ids, strict=True)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.sp.decode(ids, num_threads=1) if ids else []


def pieces(path: str) -> Pieces:
    """One per worker process and file."""
    home = sys.modules.setdefault("_seedwright_pieces", type(sys)("_seedwright_pieces"))
    if path not in home.__dict__:
        home.__dict__[path] = Pieces(path)
    return home.__dict__[path]


def marked_words(texts: pa.Array, cuts: bool) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets): the words of text i stand at offsets[i]:offsets[i + 1].
    Joined by one blank they are the text again.  A text is cut at a blank that
    follows neither a blank nor a marker; an empty text has no word."""
    data, t_off = text_bytes(texts)
    full = t_off[:-1] < t_off[1:]
    first = t_off[:-1][full]
    if not cuts or len(data) == 0:
        cut = np.zeros(0, np.int64)
    else:
        blank = data == 32
        marker = np.zeros(len(data), bool)
        marker[2:] = (data[:-2] == _MARK_BYTES[0]) & (data[1:-1] == _MARK_BYTES[1]) & (data[2:] == _MARK_BYTES[2])
        go = blank.copy()
        go[1:] &= ~(blank | marker)[:-1]
        go[first] = False
        cut = np.flatnonzero(go)
    # the blank at a cut belongs to no word
    kept = np.ones(len(data), bool)
    kept[cut] = False
    starts = np.sort(np.concatenate([first, cut]))
    before = np.concatenate([[0], np.cumsum(kept)])
    off = np.concatenate([before[starts], before[-1:]]).astype(np.int64)
    body = data[kept]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(body)])
    return words, np.searchsorted(starts, t_off)


class ChunkTable:
    """Distinct words with their number of ids, ids and decoded text."""

    def __init__(self, model: Pieces, digest: bool, words: int = TABLE_WORDS, size: int = TABLE_BYTES):
        self.model, self.digest, self.words, self.size = model, digest, words, size
        self._empty()

    def _empty(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.held = 0
        self.n: list[int] = []
        self.ids: list = []  # decimals joined by blanks, or lists
        self.decoded: list[bytes] = []

    def slots(self, words: list[bytes]) -> list[int]:
        """Places of distinct words; what is new is segmented."""
        if len(self.slot) >= self.words or self.held >= self.size:
            self._empty()
        new = [w for w in words if w not in self.slot]
        ids = self.model.encode([w.decode() for w in new])
        self.slot.update(zip(new, range(len(self.n), len(self.n) + len(new)), strict=True))
        self.held += sum(map(len, new))
        self.n += map(len, ids)
        self.decoded += (t.encode() for t in self.model.decode(ids))
        self.ids += ((" ".join(map(str, x)).encode() for x in ids) if self.digest else ids)
        return list(map(self.slot.__getitem__, words))


@tidy
def _encode(batches: Iterator[pa.RecordBatch], model: str, digest: bool) -> Iterator[pa.RecordBatch]:
    p = pieces(model)
    known = ChunkTable(p, digest)
    end = b"%d" % p.eos
    for batch in batches:
        for b in text_slices(batch, max_bytes=PASS_BYTES):
            words, off = marked_words(b.column("text"), p.cuts)
            coded = words.dictionary_encode()
            slot = np.array(known.slots(coded.dictionary.to_pylist()), np.int64)
            at = slot[coded.indices.to_numpy(zero_copy_only=False)] if len(slot) else slot
            n, ids, text = [], [], []
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                mine = at[lo:hi].tolist()
                n.append(1 + sum(map(known.n.__getitem__, mine)))
                body = b" ".join(map(known.decoded.__getitem__, mine))
                if digest:
                    line = b" ".join([*map(known.ids.__getitem__, mine), end])
                    ids.append(hashlib.sha256(line).hexdigest())
                    text.append(hashlib.sha256(body).hexdigest())
                else:
                    ids.append([i for k in mine for i in known.ids[k]] + [p.eos])
                    text.append(body.decode())
            a, t = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                a: pa.array(ids, pa.string() if digest else pa.list_(pa.int32())), t: pa.array(text, pa.string())})


def encode(docs: DataFrame, model: str, digest: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: the library's ids of the
    whole text and the end id, and the text that they decode to.  With
    ``digest`` (doc_id, n_tokens, ids_sha256, decoded_sha256): the sha256 of the
    ids' decimals joined by blanks and of the decoded text."""
    out = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest
           else "doc_id long, n_tokens long, ids array<int>, decoded string")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(partial(_encode, model=model, digest=digest), out))


def op13_chunk_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` through the public 32k model."""
    import public_tokenizers
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path(DEFAULT_MODEL), digest=True)
