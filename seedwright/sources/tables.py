"""Seed sources: spec strings, text-column scans and the tagged union.

A spec reads ``name[:text_field[:split,split,...[:min_chars]]]``.  ``name``
is resolved to a table by a ``TableResolver``: a folder of tables (parquet by
default), each with an optional split column and an order column.  A split
that does not exist, or a text column that is missing, contributes no rows and
the run goes on; the outcome is kept in ``SourceRead.status``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip
from .files import readable_files


@dataclass
class SourceSpec:
    name: str
    text_field: str | None = None
    splits: list[str] = field(default_factory=lambda: ["train"])
    min_chars: int | None = None


def parse_spec(spec: str) -> SourceSpec:
    """Split on every ``:``; empty field -> fall back later; splits are a
    comma list, stripped, default ``["train"]``; a bad min_chars -> none."""
    parts = spec.split(":")
    text_field = parts[1] if len(parts) > 1 else None
    splits = [s.strip() for s in parts[2].split(",")] if len(parts) > 2 else ["train"]
    min_chars = None
    if len(parts) > 3:
        try:
            min_chars = int(parts[3])
        except ValueError:
            min_chars = None
    return SourceSpec(parts[0], text_field, splits, min_chars)


def resolve_specs(specs: list[str], text_fields: list[str] | None = None) -> list[SourceSpec]:
    """Text field per spec: the spec's own, else ``text_fields[i]``, else the
    sole ``text_fields[0]``, else ``"text"``."""
    text_fields = text_fields if text_fields is not None else ["text"]
    default = text_fields[0] if len(text_fields) == 1 else "text"
    out = []
    for i, s in enumerate(specs):
        sp = parse_spec(s)
        if not sp.text_field:
            sp.text_field = text_fields[i] if i < len(text_fields) else default
        out.append(sp)
    return out


def spec_columns(spec: Column, pos: Column, text_fields: list[str]) -> dict[str, Column]:
    """The same resolution for specs that arrive as a table column."""
    parts = F.split(spec, ":")
    n = F.size(parts)
    fld = F.when(n > 1, parts.getItem(1))
    default = text_fields[0] if len(text_fields) == 1 else "text"
    tf = F.array(*[F.lit(t) for t in text_fields]) if text_fields else F.array().cast("array<string>")
    by_pos = F.when(pos < F.lit(len(text_fields)), F.element_at(tf, (pos + 1).cast("int")))
    splits = F.when(n > 2, F.transform(F.split(parts.getItem(2), ","), lambda s: py_strip(s))) \
        .otherwise(F.array(F.lit("train")))
    min_chars = F.when(n > 3, py_strip(parts.getItem(3)).try_cast("int"))
    return {
        "name": parts.getItem(0),
        "text_field": F.coalesce(F.nullif(fld, F.lit("")), by_pos, F.lit(default)),
        "splits": splits,
        "min_chars": min_chars,
    }


@dataclass
class TableSource:
    """``order_col`` gives the rows their order; without one they stand in the
    order of their files and of their places in them.  ``check_files`` tries
    each file first and reads the sound ones only (one more scan)."""
    path: str
    split_col: str | None = None
    order_col: str | None = None
    fmt: str = "parquet"
    check_files: bool = False


class TableResolver:
    """Maps a spec name to a table.  ``tables`` overrides per name; otherwise
    ``{root}/{name}.{fmt}`` (or ``{root}/{name}``) is read."""

    def __init__(self, root: str | None = None, tables: dict[str, TableSource] | None = None,
                 fmt: str = "parquet"):
        self.root = root
        self.tables = tables or {}
        self.fmt = fmt

    def source(self, name: str) -> TableSource:
        if name in self.tables:
            return self.tables[name]
        if self.root is None:
            return TableSource(name, fmt=self.fmt)
        p = os.path.join(self.root, f"{name}.{self.fmt}")
        return TableSource(p if os.path.exists(p) or "://" in p else os.path.join(self.root, name),
                           fmt=self.fmt)


@dataclass
class SourceRead:
    frame: DataFrame
    status: list[tuple[str, str, str]]  # (source, split, "ok" | reason)
    files: DataFrame | None = None  # (source, path, length, rows, status) of the files that were tried


_WHOLE = ("byte", "short", "integer", "long")


def _order(df: DataFrame, src: TableSource) -> tuple[Column, Column]:
    """(part, ord): rows are ordered by part, then by ord."""
    if not src.order_col:
        if src.fmt == "parquet":
            if src.check_files:
                return F.col("_path"), F.col("_row")
            return F.col("_metadata.file_path"), F.col("_metadata.row_index")
        return F.lit(""), F.monotonically_increasing_id()
    if src.order_col not in df.columns:
        raise LookupError(f"no column {src.order_col}")
    c = F.col(src.order_col)
    if df.schema[src.order_col].dataType.typeName() in _WHOLE:
        return F.lit(""), c.cast("long")
    return F.coalesce(c.cast("string"), F.lit("")), F.lit(0).cast("long")


def _spec_rows(spark: SparkSession, src: TableSource, sp: SourceSpec,
               pos: int) -> tuple[DataFrame, list, DataFrame | None]:
    """All splits of a spec from one scan, (source, split, status) of each, and
    the files that were tried."""
    field_name = sp.text_field or "text"
    files = None
    if src.check_files:
        df, files = readable_files(spark, src.path, src.fmt, [field_name, src.order_col, src.split_col])
        files = files.select(F.lit(sp.name).alias("source"), "*")
    else:
        df = spark.read.format(src.fmt).load(src.path)
    if field_name not in df.columns:
        raise LookupError(f"no column {field_name}")
    part, place = _order(df, src)
    wanted = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(j).cast("int").alias("split_ord"))
                       for j, s in enumerate(sp.splits)])
    value = F.col(src.split_col).cast("string") if src.split_col else F.lit("train")
    # which of the wanted splits hold rows: a scan of the split column alone
    held = {"train"}
    if src.split_col:
        held = {r[0] for r in df.filter(value.isin(*sp.splits)).select(value).distinct().collect()}
    status = [(sp.name, s, "ok" if s in held else "missing") for s in sp.splits]
    rows = df.select(part.alias("part"), place.alias("ord"),
                     F.col(field_name).cast("string").alias("text"),
                     F.filter(wanted, lambda w: w["split"] == value).alias("_w"))
    rows = rows.select("part", "ord", "text", F.explode("_w").alias("_s"))
    return rows.select(F.lit(sp.name).alias("source"), F.lit(pos).cast("int").alias("source_ord"),
                       F.col("_s.split").alias("split"), F.col("_s.split_ord").alias("split_ord"),
                       "part", "ord", "text", F.lit(sp.min_chars).cast("int").alias("min_chars")), status, files


def read_sources(spark: SparkSession, specs: list[SourceSpec], resolver: TableResolver) -> SourceRead:
    """S2+S3: all (spec, split) pairs as one tagged frame, one scan per spec:
    source, source_ord, split, split_ord, part, ord, text, min_chars.  Inside a
    split, rows stand in the order of (part, ord)."""
    out, status, tried = None, [], None
    for i, sp in enumerate(specs):
        try:
            rows, seen, files = _spec_rows(spark, resolver.source(sp.name), sp, i)
        except (LookupError, PySparkException) as e:  # a failing source is left out, the run goes on
            why = str(e) if isinstance(e, LookupError) else e.getCondition() or type(e).__name__
            status += [(sp.name, s, f"error: {why}") for s in sp.splits]
            continue
        status += seen
        out = rows if out is None else out.unionByName(rows)
        if files is not None:
            tried = files if tried is None else tried.unionByName(files)
    if out is None:
        out = spark.createDataFrame(
            [], "source string, source_ord int, split string, split_ord int, part string, ord long, "
                "text string, min_chars int")
    return SourceRead(out, status, tried)
