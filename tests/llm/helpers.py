"""Small frames with the odd cases that every operator must handle."""
from __future__ import annotations

import os
import random
import re

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def frame(spark, texts, ids=None):
    """documents with clashing extra columns, for whatever reads them."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None if t is None else len(t))
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("score", "key", "pos", "n", "row", "unit", "text_", "node", "kept", "total", "_t", "rid"):
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


ODD = ["", None, " ", "\n\n\t", "a", "A a", "word", "é😀 ñandú  ß", "x\x0by\x0cz", "same text here twice",
       "same text here twice", "...", "a" * 5000, "tab\tsep\r\nline", "\u00a0nbsp\u00a0", "\u0000nul"]


def pseudo(rng, n, vocabulary=400):
    return [f"{'bcdfghklmnprst'[w % 14]}{'aeiou'[w % 5]}{'xyzvw'[(w // 5) % 5]}{w}"
            for w in (int(vocabulary * rng.random() ** 2) for _ in range(n))]


def edited(rng, ws, rate):
    out = list(ws)
    for _ in range(int(rate * len(ws))):
        a = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.5:
            out[a] = f"new{rng.randrange(300)}"
        elif kind < 0.75 and len(out) > 2:
            del out[a]
        else:
            out.insert(a, f"ins{rng.randrange(300)}")
    return out


def sf_copy(tmp_path, spark, docs, **tables):
    """A folder laid out like the test tables."""
    path = str(tmp_path / "sf")
    docs.write.parquet(os.path.join(path, "documents.parquet"))
    for name, df in tables.items():
        df.write.parquet(os.path.join(path, f"{name}.parquet"))
    return path


def rng(seed):
    return random.Random(seed)
