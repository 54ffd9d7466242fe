"""Exact tokenisation by distinct segments.

The vocabularies used here cut a text into pieces with a regular expression
before merging.  No piece reaches from a non-space into a following space, nor
from a letter into a following punctuation mark (apostrophes apart), so a text
cut at such places has the ids of its segments in order.  Each distinct
segment goes through the tokenizers library once per worker while the table
has room; finding segments, looking them up and gathering ids is numpy work on
the UTF-8 bytes.  Segments are told apart by 128 bits of hash.
"""

from __future__ import annotations

import os
import re
import sys

import numpy as np
import pandas as pd
import pyarrow as pa

from seedwright.llm.common import mix64, span_hashes, text_bytes

#: Distinct segments that a worker remembers (about 60 bytes each).
TABLE_SEGMENTS = 500_000

#: Bytes that one hashing pass takes.
_PASS = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: 1: white space, 2: punctuation that ends a word (no apostrophe, none of |>).
_KIND = _SPACE.astype(np.uint8)
_KIND[list(b".,;:!?%&*$#()[]{}\"/<=+@~^")] = 2
#: Segments that may stand one after another in a text: a blank, then only
#: characters whose normal form has as many bytes and that are not blanks.
_CHAINED = re.compile(r"[ \n][!-~\u00C0-\u00FF]+\Z")
_CHAIN = 128
_SYM = [mix64(np.arange(256, dtype=np.uint64), s) for s in (0x51ED, 0xA0761D)]


def cut_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all segments of the texts in ``data``, ascending."""
    kind = _KIND[data]
    at = np.flatnonzero(kind)
    kind = kind[at]
    back = [data[np.maximum(at - k, 0)] for k in (1, 2, 3)]
    prev, prev2, prev3 = back
    wide = prev >= 0x80
    letter = _LETTER[prev] | (wide & (prev2 == 0xC3) & (prev != 0x97) & (prev != 0xB7))
    # a last character that may be white space: lead bytes C2, E1, E2, E3
    maybe_space = ((prev2 == 0xC2) & ((prev == 0x85) | (prev == 0xA0))) | \
        ((prev3 >= 0xE1) & (prev3 <= 0xE3))
    solid = ((prev > 0x20) & (prev < 0x7F)) | (wide & ~maybe_space)
    cut = np.zeros(len(data), bool)
    cut[at[np.where(kind == 1, solid, letter)]] = True
    edge = offsets[:-1]
    cut[edge[edge < len(data)]] = True
    return np.flatnonzero(cut)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """A polynomial hash and a plain sum of the bytes' random values."""
    out = [np.empty(len(starts), np.uint64) for _ in range(2)]
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + _PASS, side="right")))
        part = data[lo:ends[j - 1]]
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[0][i:j] = span_hashes(_SYM[0][part], a, b)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_SYM[1][part], out=total[1:])
        out[1][i:j] = total[b] - total[a]
        i = j
    size = (ends - starts).astype(np.uint64) << np.uint64(50)
    return [mix64(out[0] ^ size), out[1]]


class SegmentTokenizer:
    """Ids of whole texts, equal to ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, table_segments: int = TABLE_SEGMENTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.room = table_segments
        # bytes that an id stands for: a vocabulary character is one byte
        vocab = self.tok.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token.removesuffix("</w>"))
        #: whether the vocabulary leaves out white space
        self.drops_blanks = int(not self.tok.encode(" ", add_special_tokens=False).ids)
        self.key = np.zeros(0, np.uint64)      # sorted
        self.check = np.zeros(0, np.uint64)    # second hash, by key
        self.slot = np.zeros(0, np.int64)      # row in ``off``, by key
        self.ids = np.zeros(0, np.uint32)
        self.off = np.zeros(1, np.int64)

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.fromiter((i for x in got for i in x), np.uint32),
                np.cumsum([0, *map(len, got)], dtype=np.int64))

    def _encode_new(self, segs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of segments.  Chained ones are encoded as
        longer texts and told apart by the bytes that their ids stand for."""
        chained = np.array([_CHAINED.match(s) is not None and "<|" not in s for s in segs])
        alone, alone_off = self._flat([s for s, c in zip(segs, chained, strict=True) if not c])
        words = [s for s, c in zip(segs, chained, strict=True) if c]
        flat, _ = self._flat(["".join(words[k:k + _CHAIN]) for k in range(0, len(words), _CHAIN)])
        drop = self.drops_blanks
        ends = np.cumsum([len(s.encode()) - drop for s in words], dtype=np.int64)
        reach = np.cumsum(self.width[flat]) if len(flat) else np.zeros(0, np.int64)
        stop = np.searchsorted(reach, ends, side="right")
        if len(ends) and not (reach[-1] == ends[-1] and np.array_equal(reach[stop - 1], ends)):
            flat, off = self._flat(segs)
            return flat, off[1:]
        n = np.zeros(len(segs), np.int64)
        n[~chained] = np.diff(alone_off)
        n[chained] = np.diff(stop, prepend=0)
        out = np.empty(int(n.sum()), np.uint32)
        mine = np.repeat(chained, n)
        out[mine], out[~mine] = flat, alone
        return out, np.cumsum(n)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        data, t_off = text_bytes(texts)
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts = cut_points(data, t_off)
        ends = np.append(starts[1:], len(data))
        h, h2 = _hashes(data, starts, ends)
        code, uniq = pd.factorize(h)
        first = np.empty(len(uniq), np.int64)
        first[code[::-1]] = np.arange(len(h) - 1, -1, -1)
        if not np.array_equal(h2[first][code], h2):  # two segments share 64 bits
            return self._plain(texts)
        at = np.searchsorted(self.key, uniq)
        inside = np.minimum(at, max(len(self.key) - 1, 0))
        hit = (self.key[inside] == uniq) if len(self.key) else np.zeros(len(uniq), bool)
        if not np.array_equal(self.check[inside[hit]], h2[first[hit]]):
            return self._plain(texts)
        slot = np.empty(len(uniq), np.int64)
        slot[hit] = self.slot[inside[hit]]
        ids, off = self.ids, self.off
        new = np.flatnonzero(~hit)
        if len(new):
            raw = data.tobytes()
            a, b = starts[first[new]].tolist(), ends[first[new]].tolist()
            more, more_off = self._encode_new([raw[x:y].decode() for x, y in zip(a, b, strict=True)])
            slot[new] = len(off) - 1 + np.arange(len(new))
            ids = np.concatenate([ids, more])
            off = np.concatenate([off, off[-1] + more_off])
            if len(off) - 1 <= self.room:
                self.ids, self.off = ids, off
                order = np.argsort(uniq[new])
                put = at[new][order]
                self.key = np.insert(self.key, put, uniq[new][order])
                self.check = np.insert(self.check, put, h2[first[new]][order])
                self.slot = np.insert(self.slot, put, slot[new][order])
        row = slot[code]
        lens = (off[1:] - off[:-1])[row]
        stop = np.cumsum(lens)
        pos = np.arange(int(stop[-1]), dtype=np.int64)
        pos += np.repeat(off[:-1][row] - (stop - lens), lens)
        seg_off = np.searchsorted(starts, t_off)
        return ids[pos], np.concatenate([[0], stop])[seg_off]

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._flat([t or "" for t in texts.to_pylist()])


def tokenizer(path: str) -> SegmentTokenizer:
    """One per worker process and file."""
    home = sys.modules.setdefault("_seedwright_tokenizers", type(sys)("_seedwright_tokenizers"))
    if path not in home.__dict__:
        home.__dict__[path] = SegmentTokenizer(path)
    return home.__dict__[path]
