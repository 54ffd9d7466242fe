"""The whole job: read, chunk, index, shuffle, limit, resume, generate, refine,
write records, progress and status, for one task or all.

Everything between the sources and the records works on keys; the texts stay in
the store (``operators.texts``).  Progress is kept by content: a chunk counts as
done for a configuration (model, seed, agents per stage, rounds) when its text was
processed under it, wherever it stands in its source.  Chunks that gave nothing
are recorded with their status, so a rerun does not pay for them again unless it
asks to.  A run counts when it is committed (``operators.output``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.chunking import dense_index, fixed_slices, pack_sources
from ..operators.generation import (PARSE_COUNTS, content_wave, instruction_replies, pairs_from_replies,
                                    with_texts)
from ..operators.output import chat_records, chunk_status, commit, commits, output_records, write_jsonl
from ..operators.refinement import refine
from ..operators.selection import due_chunks, limit_chunks, order_chunks, read_states, run_states
from ..operators.texts import TEXT_COUNTS, TextStore
from ..session import scratch_scope, written
from ..sources.catalog import Catalog
from ..sources.pages import page_texts, read_pdf_pages
from ..sources.tables import TableResolver, read_sources, resolve_specs


@dataclass
class JobConfig:
    chunking: str = "sample"  # sample, pack or slice; paged documents have a chunk per page
    min_chars: int | None = None
    slice_size: int = 1000
    shuffle: bool = False
    seed: int | str = 0
    max_chunks: int = 0
    agents: int = 3
    rounds: int = 1  # 0: no refinement
    min_refinements: int = 1
    mcq_fallback: str = "full"
    include_content: bool = False
    debug: bool = False
    retry_empty: bool = False
    max_attempts: int = 0  # 0: a failed chunk is tried again by every run

    def fingerprint(self, model: str) -> str:
        """What the outputs of a chunk depend on."""
        return "|".join(map(str, (model, self.seed, self.agents, self.rounds, self.min_refinements,
                                  self.mcq_fallback, self.debug)))


@dataclass
class PageInput:
    """A folder of paged documents; ``extractor(bytes)`` yields page texts."""
    folder: str
    extractor: Callable[[bytes], Iterable[str]]
    pages: list[int] | None = None  # 1-indexed; none: all
    pattern: str = "*.pdf"


def observed(counts: Observation, names: Iterable[str]) -> dict[str, int]:
    """What was counted on the way; zeros where the plan was empty."""
    got = counts._jo.getOrEmpty()
    return {n: int(got.apply(n)) if got.contains(n) else 0 for n in names}


def chunk_key(task, text_key):
    """Progress key: task and text, not position."""
    return F.sha2(F.concat_ws("\u0001", task, F.coalesce(F.hex(text_key), F.lit(""))), 256)


ORDER = ["source_ord", "split_ord", "part", "chunk_no"]
#: Files named in the report of a run over paged documents; all are counted.
PAGE_ERRORS = 1000


def build_chunks(spark: SparkSession, specs: list[str], resolver: TableResolver, cfg: JobConfig, texts: TextStore,
                 text_fields: list[str] | None = None) -> tuple[DataFrame, dict]:
    """(chunk_id, source, text_key) in source order, and a report: each split's
    status, the files that were tried, the rows read and their null texts."""
    read = read_sources(spark, resolve_specs(specs, text_fields), resolver)
    counts = Observation()
    rows = read.frame.withColumnRenamed("ord", "chunk_no").withColumn("null_text", F.col("text").isNull())
    if cfg.chunking not in ("sample", "pack", "slice"):
        raise ValueError(f"unknown chunking {cfg.chunking!r}")
    lean = texts.refer(rows, "seeds" if cfg.chunking == "sample" else "rows", counts=counts)
    if cfg.chunking != "sample":
        # number the rows, then put texts to the numbers: the chunkers need one order
        placed = dense_index(lean.filter("not null_text").drop("null_text"), ORDER, "ord", lean=True)
        rows = texts.attach(placed.drop("part", "chunk_no"), "rows").drop("text_key")
        rows = rows.withColumn("text", F.coalesce("text", F.lit("")))  # an empty text has no key
        if cfg.chunking == "pack":
            rows = pack_sources(rows, cfg.min_chars)
        else:
            rows = fixed_slices(rows, cfg.slice_size)
        lean = texts.keep(rows.select("source", "source_ord", "split_ord", F.lit("").alias("part"), "chunk_no", "text"),
                          "seeds")
    chunks = dense_index(lean.select(*ORDER, "source", "text_key"), ORDER, lean=True)
    files = read.files.filter("status <> 'ok'").collect() if read.files is not None else []
    report = {"sources": read.status, "unreadable_files": [(r.source, r.path, r.status) for r in files],
              "read": observed(counts, TEXT_COUNTS)}
    return chunks.select("chunk_id", "source", "text_key"), report


def build_page_chunks(spark: SparkSession, pages: PageInput, texts: TextStore) -> tuple[DataFrame, dict]:
    """(chunk_id, source, text_key), a chunk per page with text, and a report:
    how many files failed, and where the first ``PAGE_ERRORS`` of them did."""
    counts = Observation()
    raw = read_pdf_pages(spark, pages.folder, pages.extractor, pages.pattern)
    lean = texts.keep(page_texts(raw, pages.pages), "seeds", counts=counts)
    failed = lean.filter("error is not null").select("source", "chunk_no", "error")
    named = failed.orderBy("source").limit(PAGE_ERRORS).collect()
    chunks = dense_index(lean.filter("text_key is not null").select(*ORDER, "source", "text_key"), ORDER, lean=True)
    report = {"sources": [(r.source, "train", f"error: page {r.chunk_no}: {r.error}") for r in named],
              "failed_files": failed.count(), "unreadable_files": [], "read": observed(counts, TEXT_COUNTS)}
    return chunks.select("chunk_id", "source", "text_key"), report


def process(chunks: DataFrame, catalog: Catalog, completer, cfg: JobConfig, texts: TextStore,
            counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(output pairs, chunk status) of chunks (task, chunk_id, source, text_key)."""
    full = chunks.filter(F.col("text_key").isNotNull())
    contents = content_wave(full, catalog, completer, texts, cfg.seed, cfg.agents, cfg.debug, keep_rejected=True)
    replies = instruction_replies(contents.filter("kept").drop("kept"), catalog, completer, texts, cfg.seed,
                                  cfg.agents, cfg.debug)
    failed = None
    for wave, column in ((contents, "content_error"), (replies, "reply_error")):
        if column in wave.columns:
            bad = wave.filter(F.col(column).isNotNull()).select("task", "chunk_id")
            failed = bad if failed is None else failed.unionByName(bad)
    pairs = refine(pairs_from_replies(replies, counts), completer, cfg.rounds, cfg.min_refinements,
                   mcq_fallback=cfg.mcq_fallback)
    pairs = written(pairs, "job-pairs")
    return pairs, chunk_status(chunks, pairs, failed)


def run_chunks(spark: SparkSession, chunks: DataFrame, texts: TextStore, catalog: Catalog, completer,
               out_dir: str, progress_dir: str, tasks: list[str] | None, cfg: JobConfig,
               run_id: str | None = None, **facts) -> dict:
    """Generate, write and commit the chunks (chunk_id, source, text_key) that
    are due; a run id that is committed already does nothing."""
    run_id = run_id or uuid.uuid4().hex[:12]
    if any(c["run"] == run_id for c in commits(spark, out_dir)):
        return {"run": run_id, "chunks": {}, "replies": {}}
    names = F.array(*[F.lit(t) for t in (tasks or catalog.tasks)])
    chunks = chunks.select(F.explode(names).alias("task"), "chunk_id", "source", "text_key")
    chunks = limit_chunks(order_chunks(chunks, cfg.shuffle, cfg.seed), cfg.max_chunks, cfg.debug).drop("pos")
    chunks = chunks.withColumn("chunk_key", chunk_key(F.col("task"), F.col("text_key")))
    mark = cfg.fingerprint(completer.model)
    states = read_states(spark, out_dir, progress_dir)
    if states is not None:
        chunks = due_chunks(chunks, states, mark, cfg.retry_empty, cfg.max_attempts)
    chunks = written(chunks, "job-chunks")
    texts.narrow("seeds", chunks)
    counts = Observation()
    pairs, status = process(chunks.drop("chunk_key"), catalog, completer, cfg, texts, counts)
    full = with_texts(pairs, texts) if cfg.include_content else pairs
    records = chat_records(output_records(full, completer.model, cfg.include_content))
    write_jsonl(records, f"{out_dir}/run={run_id}", mode="overwrite")
    status = written(chunks.select("task", "chunk_id", "chunk_key").join(status, ["task", "chunk_id"]), "job-status")
    run_states(status, mark, time.time_ns()).write.mode("overwrite").parquet(f"{progress_dir}/run={run_id}")
    by_status = {r["status"]: r["n"] for r in status.groupBy("status").agg(F.count("*").alias("n")).collect()}
    n = status.agg(F.sum("n_pairs")).first()[0] or 0
    commit(spark, out_dir, run_id, records=int(n), **facts)
    return {"run": run_id, "chunks": by_status, "replies": observed(counts, PARSE_COUNTS)}


def run(spark: SparkSession, specs: list[str], resolver: TableResolver | None, catalog: Catalog, completer,
        out_dir: str, progress_dir: str, tasks: list[str] | None = None, cfg: JobConfig | None = None,
        text_fields: list[str] | None = None, pages: PageInput | None = None) -> dict:
    """Run the job over tables (``specs``) or over paged documents (``pages``);
    returns the sources' status, what was counted on the way and the counts by
    chunk status.  Intermediate tables are removed when the run is committed."""
    cfg = cfg or JobConfig()
    with scratch_scope(spark, "run"):
        texts = TextStore(spark)
        if pages is not None:
            chunks, report = build_page_chunks(spark, pages, texts)
        else:
            chunks, report = build_chunks(spark, specs, resolver, cfg, texts, text_fields)
        return {**report, **run_chunks(spark, chunks, texts, catalog, completer, out_dir, progress_dir, tasks, cfg)}
