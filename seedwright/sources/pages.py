"""Paged documents: one chunk per page.

``read_pdf_pages`` scans a folder of PDFs with the ``binaryFile`` source and
runs a user-supplied page extractor per file in ``mapInPandas`` (no PDF
library is bundled); pages leave the task in batches, whatever a file holds.
``html_text`` turns raw web pages into page text with built-in regex functions.
``page_texts`` is the reference's clean-up: collapse whitespace, strip, optional
1-indexed page filter, and one chunk per page in the order of the documents and of
the pages in each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import collapse_ws
from ..session import written

# Html clean-up patterns.
SCRIPT_RE = r"(?is)<script\b.*?</script>"
STYLE_RE = r"(?is)<style\b.*?</style>"
COMMENT_RE = r"(?s)<!--.*?-->"
TAG_RE = r"(?s)<[^>]*>"

PAGE_SCHEMA = "path string, page_no int, raw string, error string"
#: Pages, and characters of them, that a task holds before it passes them on.
PAGE_ROWS = 256
PAGE_CHARS = 4 << 20


def html_text(html) -> F.Column:
    t = F.regexp_replace(html, SCRIPT_RE, " ")
    t = F.regexp_replace(t, STYLE_RE, " ")
    t = F.regexp_replace(t, COMMENT_RE, " ")
    t = F.regexp_replace(t, TAG_RE, " ")
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return t


def sql_html_text(e: str) -> str:
    t = f"regexp_replace({e}, '{SCRIPT_RE}', ' ', 'g')"
    t = f"regexp_replace({t}, '{STYLE_RE}', ' ', 'g')"
    t = f"regexp_replace({t}, '{COMMENT_RE}', ' ', 'g')"
    t = f"regexp_replace({t}, '{TAG_RE}', ' ', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&nbsp;", " "), ("&amp;", "&")):
        t = f"replace({t}, '{ent}', '{ch}')"
    return t


def normalise_pages(pages: DataFrame, text_col: str = "raw",
                    pages_filter: list[int] | None = None) -> DataFrame:
    """Collapse whitespace, strip, drop empties; keep 1-indexed ``page_no``
    in ``pages_filter`` when given (empty list = all)."""
    out = pages
    if pages_filter:
        out = out.filter(F.col("page_no").isin(pages_filter))
    # written first: pushed below the clean-up, the filter would do it all twice
    out = written(out.withColumn("text", collapse_ws(F.col(text_col))), "pages")
    return out.filter(F.col("text") != "")


def extracted_pages(files: Iterable[tuple[str, bytes]], extractor: Callable[[bytes], Iterable[str]],
                    rows: int = PAGE_ROWS, chars: int = PAGE_CHARS) -> Iterable[pd.DataFrame]:
    """Frames of (path, page_no, raw, error), a few pages each.  A file that
    fails keeps the pages read so far and gets one row with the error."""
    held, size = [], 0
    for path, content in files:
        n = 0
        try:
            for n, text in enumerate(extractor(content), start=1):
                held.append((path, n, text, None))
                size += len(text or "")
                if len(held) >= rows or size >= chars:
                    yield pd.DataFrame(held, columns=["path", "page_no", "raw", "error"])
                    held, size = [], 0
        except Exception as e:  # noqa: BLE001 - per-file isolation
            held.append((path, n + 1, None, repr(e)))
    if held:
        yield pd.DataFrame(held, columns=["path", "page_no", "raw", "error"])


def read_pdf_pages(spark: SparkSession, folder: str, extractor: Callable[[bytes], Iterable[str]],
                   pattern: str = "*.pdf") -> DataFrame:
    """Non-recursive scan; ``extractor(bytes)`` yields page texts.  Rows
    (source, path, page_no, raw, error), the source being the file's base name;
    other files go on when one fails.  A folder that is missing, or has no such
    file, has no pages."""
    def extract(batches):
        yield from extracted_pages(((p, c) for pdf in batches for p, c in zip(pdf["path"], pdf["content"], strict=True)),
                                   extractor)

    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                 .option("recursiveFileLookup", "false").load(folder).select("path", "content"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, content binary")
    pages = files.mapInPandas(extract, PAGE_SCHEMA)
    return pages.withColumn("source", F.element_at(F.split("path", "/"), -1))


def page_texts(pages: DataFrame, pages_filter: list[int] | None = None) -> DataFrame:
    """C4: pages (source, path, page_no, raw, error) as chunk rows (source,
    source_ord, split_ord, part, chunk_no, text, error): a page is a chunk, in the
    order of its document's path and its number.  Pages without text, and rows
    that hold an error, are left to the caller, who writes the texts first."""
    if pages_filter:
        pages = pages.filter(F.col("page_no").isin(pages_filter) | F.col("error").isNotNull())
    return pages.select("source", F.lit(0).alias("source_ord"), F.lit(0).alias("split_ord"), F.col("path").alias("part"),
                        F.col("page_no").cast("long").alias("chunk_no"), collapse_ws(F.col("raw")).alias("text"), "error")
