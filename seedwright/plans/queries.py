"""Registered queries: one per operator of the inventory, each with a DuckDB
twin.  Every query reads the given tables (or data Spark derives from them)
over their whole extent; the model is the deterministic offline completer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import mcq as M
from ..functions.parse import modified_pair, pair_blocks
from ..functions.prompts import EDITOR_SYSTEM, editor_prompt
from ..functions.text import collapse_ws, keep_instruction_reply, strip_fences, strip_markdown
from ..operators import output as O
from ..operators.agents import dealt, drawn_agents
from ..operators.chunking import dense_index, fixed_slices, grouped_prefix, pack_min_chars
from ..operators.completion import OfflineCompleter
from ..operators.generation import (content_requests, content_wave, generate_pairs, instruction_replies,
                                    instruction_requests, parse_report, with_texts)
from ..operators.mcq import complete_samples, inspect_rows, mcq_filter, sample_n
from ..operators.refinement import refine
from ..operators.selection import (fold_states, limit_chunks, order_chunks, parse_progress,
                                   progress_rows, resume_filter, skip_empty, source_id)
from ..operators.texts import TextStore
from ..session import written
from ..sources.catalog import load_catalog
from ..sources.pages import html_text, normalise_pages, page_texts
from ..sources.tables import TableResolver, TableSource, read_sources, resolve_specs, spec_columns

TASK = "reading_comprehension"
SEED = 42
MODEL = "offline"
PACK_MIN = 20000
SLICE = 1000
MAX_CHUNKS = 100

_catalogs: dict = {}


def catalog(spark: SparkSession, tasks: list[str] | None = None):
    key = (spark.sparkContext.applicationId, tuple(tasks or ()))
    if key not in _catalogs:
        _catalogs[key] = load_catalog(spark, tasks=tasks)
    return _catalogs[key]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _longs(df: DataFrame) -> DataFrame:
    """Integer columns as BIGINT, to line up with the SQL twins."""
    return df.select(*[F.col(f.name).cast("bigint").alias(f.name)
                       if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))
                       else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------------------
# shared Spark building blocks
# ---------------------------------------------------------------------------

#: Columns of a pair with its texts.
LINEAGE = ["task", "chunk_id", "source", "original_text", "content_pos", "instr_pos", "block_pos", "agent",
           "instruction_agent", "transformed_content", "transformation_type", "instruction", "answer", "pair_id",
           "goal_no", "round", "parent_pair_id", "done"]
PAIR = LINEAGE[:14]


def doc_chunks(spark, sf, task: str = TASK, with_skipped: bool = False) -> tuple[DataFrame, TextStore]:
    """C1 + C5 + P1 over ``documents``: (task, chunk_id, source, text_key), a
    chunk per document, id by doc_id; and the store of the texts."""
    texts = TextStore(spark)
    keys = texts.refer(_t(spark, sf, "documents").select("doc_id", "source", "text"), "seeds")
    c = dense_index(keys, ["doc_id"], "chunk_id", lean=True).withColumn("task", F.lit(task))
    c = c.select("task", "chunk_id", "source", "text_key")
    return (c if with_skipped else skip_empty(c)[0]), texts


def doc_numbers(spark, sf) -> DataFrame:
    """The chunks without any text: (chunk_id, source) of documents that have one."""
    d = _t(spark, sf, "documents").select("doc_id", "source", F.coalesce(F.col("text") != "", F.lit(False)).alias("full"))
    return dense_index(d, ["doc_id"], "chunk_id", lean=True).filter("full").select("chunk_id", "source")


def for_tasks(chunks: DataFrame, cat) -> DataFrame:
    return chunks.drop("task").withColumn("task", F.explode(F.array(*[F.lit(t) for t in cat.tasks])))


def flagship_pairs(spark, sf, nested: bool = False) -> tuple[DataFrame, TextStore]:
    """Pairs with keys of their texts, and the store."""
    chunks, texts = doc_chunks(spark, sf)
    return generate_pairs(chunks, catalog(spark), OfflineCompleter(MODEL), texts, SEED, nested=nested), texts


def refined(spark, sf, rounds: int = 1, min_ref: int = 1) -> tuple[DataFrame, TextStore]:
    pairs, texts = flagship_pairs(spark, sf, nested=True)
    return refine(pairs, OfflineCompleter(MODEL), max_rounds=rounds, min_refinements=min_ref,
                  mcq_fallback="parity"), texts


def refined_with_texts(spark, sf, rounds: int = 1, min_ref: int = 1) -> DataFrame:
    return with_texts(*refined(spark, sf, rounds, min_ref)).select(*LINEAGE)


def _docs_resolver(sf: str) -> TableResolver:
    return TableResolver(sf, tables={
        "documents": TableSource(f"{sf}/documents.parquet", split_col="lang", order_col="doc_id"),
        "benchmark": TableSource(f"{sf}/benchmark.parquet", order_col="item_id")})


UNION_SPECS = ["documents:text:en, de,fr,es", "benchmark", "documents:body", "documents:text:xx"]


def _by_source(spark, sf) -> DataFrame:
    """documents grouped by their ``source`` column, ordered by doc_id."""
    return _t(spark, sf, "documents").select(
        F.lit("documents").alias("table"), "source", F.col("doc_id").alias("ord"), "text")


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------

def q_generate_pairs(spark, sf):
    return _longs(with_texts(*flagship_pairs(spark, sf)).select(*PAIR))


def _drawn(spark, sf, stage, pos, name):
    cat = catalog(spark)
    chunks = dealt(doc_numbers(spark, sf))
    d = drawn_agents(for_tasks(chunks, cat), cat, stage, 3, SEED, False, pos, name)
    return _longs(d.select("task", "chunk_id", pos, name))


def q_sample_content_agents(spark, sf):
    return _drawn(spark, sf, "content", "content_pos", "content_agent")


def q_sample_instruction_agents(spark, sf):
    return _drawn(spark, sf, "instruction", "instr_pos", "instruction_agent")


def _prompt_digest(rows: DataFrame, keys: list[str]) -> DataFrame:
    p = F.col("user_prompt")
    return _longs(rows.select(*keys, F.md5(p).alias("prompt_md5"), F.length(p).cast("bigint").alias("prompt_len")))


def q_content_prompt(spark, sf):
    chunks, texts = doc_chunks(spark, sf)
    rows, prompt = content_requests(chunks, catalog(spark), texts, SEED)
    return _prompt_digest(prompt.render(rows), ["task", "chunk_id", "content_pos"])


def _instr_prompts(spark, sf, one_shot: bool):
    cat = catalog(spark)
    if not one_shot:
        cat = replace(cat, one_shots=cat.one_shots.limit(0))
    chunks, texts = doc_chunks(spark, sf)
    contents = content_wave(chunks, cat, OfflineCompleter(MODEL), texts, SEED)
    rows, prompt = instruction_requests(contents, cat, texts, SEED)
    return _prompt_digest(prompt.render(rows), ["task", "chunk_id", "content_pos", "instr_pos"])


def q_instruction_prompt(spark, sf):
    return _instr_prompts(spark, sf, False)


def q_one_shot_prompt(spark, sf):
    return _instr_prompts(spark, sf, True)


def q_irrelevant_filter(spark, sf):
    cat = catalog(spark)
    comp = OfflineCompleter(MODEL)
    chunks, texts = doc_chunks(spark, sf)
    cw = content_wave(chunks, cat, comp, texts, SEED, keep_rejected=True)
    c = cw.select(F.lit("content").alias("stage"), "chunk_id", "content_pos",
                  F.lit(-1).alias("instr_pos"), "kept")
    rep = instruction_replies(cw.filter("kept").drop("kept"), cat, comp, texts, SEED)
    i = rep.select(F.lit("instruction").alias("stage"), "chunk_id", "content_pos", "instr_pos",
                   keep_instruction_reply(F.col("reply")).alias("kept"))
    return _longs(c.unionByName(i))


def _flagship_replies(spark, sf):
    cat = catalog(spark)
    comp = OfflineCompleter(MODEL)
    chunks, texts = doc_chunks(spark, sf)
    return instruction_replies(content_wave(chunks, cat, comp, texts, SEED), cat, comp, texts, SEED)


def q_parse_pairs(spark, sf):
    rep = _flagship_replies(spark, sf).filter(keep_instruction_reply(F.col("reply")))
    ex = rep.select("task", "chunk_id", "content_pos", "instr_pos",
                    F.explode(pair_blocks(F.col("reply"))).alias("b"))
    return _longs(ex.select("task", "chunk_id", "content_pos", "instr_pos",
                            F.col("b.block_pos").alias("block_pos"),
                            F.col("b.status").alias("status"),
                            F.col("b.instruction").alias("instruction"),
                            F.col("b.answer").alias("answer")))


def q_parse_failures(spark, sf):
    rep = parse_report(_flagship_replies(spark, sf))
    return rep.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def q_strip_markdown(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", strip_markdown(F.col("text")).alias("md_stripped"),
                    strip_fences(F.col("text")).alias("fence_stripped"),
                    collapse_ws(F.col("text")).alias("collapsed"))


def q_parse_modified(spark, sf):
    """Editor replies to whole documents, four a document."""
    d = _t(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    ex = d.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("v"))
    req = (ex.withColumn("sys", F.concat(F.lit(EDITOR_SYSTEM + " #"), F.col("v").cast("string")))
           .withColumn("usr", editor_prompt(F.col("text"), F.col("source"), F.col("lang"))))
    rep = OfflineCompleter(MODEL).complete(req, "sys", "usr", "reply")
    m = F.col("_m")
    return _longs(rep.withColumn("_m", modified_pair(F.col("reply"), "parity")).select("doc_id", "v", m.isNotNull().alias("ok"),
                             m["instruction"].alias("instruction"), m["answer"].alias("answer")))


def q_normalize_pages(spark, sf):
    p = _t(spark, sf, "pages").select("page_id", html_text(F.col("html")).alias("raw"))
    return normalise_pages(p).select("page_id", "text")


def _spec_table(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents")
    g = d.groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs"),
                                F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    spec = F.concat_ws(":", F.col("source"),
                       F.when(F.col("first") % 3 == 0, F.lit("")).otherwise(F.lit("text")),
                       F.array_join(F.col("langs"), " , "),
                       F.when(F.col("n") % 2 == 0, (F.col("n") * 100).cast("string"))
                       .otherwise(F.lit("x")))
    spec = F.when(F.col("first") % 5 == 1, F.col("source")).otherwise(spec)
    return g.select("source", spec.alias("spec"))


def q_source_spec(spark, sf):
    specs = _spec_table(spark, sf)
    # spec order = source name order; a spec table is a handful of rows
    specs = dense_index(specs, ["source"], "spec_pos")
    cols = spec_columns(F.col("spec"), F.col("spec_pos"), ["text", "body"])
    return _longs(specs.select("spec_pos", "spec", cols["name"].alias("name"),
                               cols["text_field"].alias("text_field"),
                               F.array_join(cols["splits"], ",").alias("splits"),
                               cols["min_chars"].alias("min_chars")))


def _union(spark, sf) -> DataFrame:
    specs = resolve_specs(UNION_SPECS, ["text"])
    return read_sources(spark, specs, _docs_resolver(sf)).frame


def q_union_sources(spark, sf):
    return _longs(_union(spark, sf).select("source", "source_ord", "split", "split_ord", "ord", "text"))


def q_chunk_sample(spark, sf):
    texts = TextStore(spark)
    keys = texts.refer(_union(spark, sf).select("source", "split", "source_ord", "split_ord", "ord", "text"), "seeds")
    c = texts.attach(dense_index(keys, ["source_ord", "split_ord", "ord"], "chunk_id", lean=True), "seeds")
    return _longs(c.select("chunk_id", "source", "split", "ord", "text"))


def q_page_chunks(spark, sf):
    """Pages of a site as the pages of a document: a chunk per page with text."""
    p = _t(spark, sf, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("path"), "page_id", "html")
    numbers = grouped_prefix(p.select("path", "page_id", F.lit(1).cast("long").alias("one")), ["path"],
                             ["path", "page_id"], "one", "before", lean=True)
    p = p.join(numbers.select("page_id", "before"), "page_id")
    pages = p.select(F.col("path").alias("source"), "path", (F.col("before") + 1).cast("int").alias("page_no"),
                     html_text(F.col("html")).alias("raw"), F.lit(None).cast("string").alias("error"))
    texts = TextStore(spark)
    rows = texts.keep(page_texts(pages), "seeds").filter("text_key is not null")
    chunks = dense_index(rows.select("source", "part", "chunk_no", "text_key"), ["part", "chunk_no"], "chunk_id", lean=True)
    return _longs(texts.attach(chunks, "seeds").select("chunk_id", "source", F.col("chunk_no").alias("page_no"), "text"))


def q_chunk_min_chars(spark, sf):
    p = pack_min_chars(_by_source(spark, sf), PACK_MIN, group_cols=["source"])
    return _longs(p.select("source", "chunk_no", "text",
                           F.length("text").cast("bigint").alias("n_chars")))


def q_chunk_fixed(spark, sf):
    f = fixed_slices(_by_source(spark, sf), SLICE, group_cols=["source"])
    return _longs(f.select("source", "chunk_no", "text"))


def q_chunk_index(spark, sf):
    p = pack_min_chars(_by_source(spark, sf), PACK_MIN, group_cols=["source"])
    c = dense_index(p, ["source", "chunk_no"], "chunk_id")
    return _longs(c.select("chunk_id", "source", "chunk_no"))


def q_limit_chunks(spark, sf):
    c = order_chunks(doc_numbers(spark, sf))
    return _longs(limit_chunks(c, MAX_CHUNKS).select("chunk_id", "source"))


def q_shuffle_chunks(spark, sf):
    c = order_chunks(doc_numbers(spark, sf).withColumn("task", F.lit(TASK)), shuffle=True, seed=SEED)
    return _longs(c.select("chunk_id", "pos"))


def q_resume_anti(spark, sf):
    lines = _t(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("value"))
    done = parse_progress(lines)
    return _longs(resume_filter(doc_numbers(spark, sf), done, ["chunk_id"]).select("chunk_id", "source"))


def q_progress_append(spark, sf):
    return _longs(progress_rows(flagship_pairs(spark, sf)[0], source_id("corpus/documents")))


def q_progress_states(spark, sf):
    """The job's progress log: latest state and attempts of each chunk, from a
    snapshot of the earlier runs and the later ones."""
    d = _t(spark, sf, "documents").select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.lit(1) + F.length("source") % 4)).alias("at"))
    h = F.crc32(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("at").cast("string")).cast("binary"))
    status = F.element_at(F.array(*[F.lit(x) for x in ("processed_chunk", "empty_chunk", "error_chunk")]), (h % 3 + 1).cast("int"))
    log = d.select(F.lit(TASK).alias("task"), F.sha2(F.col("doc_id").cast("string"), 256).alias("chunk_key"),
                   F.col("source").alias("config"), status.alias("status"), (h % 7).alias("n_pairs"),
                   F.lit(1).cast("long").alias("attempts"), F.col("at").cast("long").alias("at"))
    snapshot = fold_states(log.filter("at <= 2"))
    return _longs(fold_states(snapshot.unionByName(log.filter("at > 2"))))


def q_refine_round(spark, sf):
    return _longs(refined_with_texts(spark, sf, 1, 1))


def q_refine_fallback(spark, sf):
    return _longs(refined_with_texts(spark, sf, 1, 3))


def q_refine_two_rounds(spark, sf):
    return _longs(refined_with_texts(spark, sf, 2, 1))


def q_output_pairs(spark, sf):
    return _longs(O.output_records(refined(spark, sf)[0], MODEL))


def q_output_with_content(spark, sf):
    return _longs(O.output_records(refined_with_texts(spark, sf), MODEL, include_content=True))


def _chats(spark, sf):
    return O.chat_records(O.output_records(refined_with_texts(spark, sf), MODEL, include_content=True))


def q_chat_records(spark, sf):
    c = _chats(spark, sf)
    m = F.col("messages")
    return _longs(c.select("task", "chunk_id", "pair_id",
                           m[0]["role"].alias("user_role"), m[0]["content"].alias("user_content"),
                           m[1]["role"].alias("assistant_role"),
                           m[1]["content"].alias("assistant_content"),
                           F.col("metadata.source").alias("meta_source"),
                           F.col("metadata.model").alias("meta_model"),
                           F.col("metadata.agent").alias("meta_agent"),
                           F.col("metadata.transformed_content").alias("meta_transformed_content")))


def q_chunk_status_counts(spark, sf):
    chunks, _ = doc_chunks(spark, sf, with_skipped=True)
    st = O.chunk_status(chunks, O.output_records(refined(spark, sf)[0], MODEL))
    return O.status_counts(st)


def q_all_tasks(spark, sf):
    cat = catalog(spark)
    c, texts = doc_chunks(spark, sf)
    p = generate_pairs(for_tasks(c, cat), cat, OfflineCompleter(MODEL), texts, SEED)
    return _longs(p.select("task", "chunk_id", "content_pos", "instr_pos", "block_pos", "agent",
                           "transformation_type", "instruction", "answer"))


def _flat(spark, sf):
    return O.flatten_chat(_chats(spark, sf))


def q_mcq_filter(spark, sf):
    return _longs(mcq_filter(_flat(spark, sf)).select("pair_id", "instruction", "answer", "agent"))


def q_mcq_letter(spark, sf):
    f = _flat(spark, sf)
    return f.select("pair_id", M.has_choices(F.col("instruction")).alias("has_choices"),
                    M.answer_letter(F.col("answer")).alias("letter"))


def q_flatten_chat(spark, sf):
    conv = _t(spark, sf, "conversations")
    u = conv.select("conv_id", "turn", "role", F.col("text").alias("q"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.lit("user").alias("role"), F.col("text").alias("a"))
    pairs = u.join(a, ["conv_id", "turn", "role"], "left")  # turns without an answer stay
    recs = O.chat_records(pairs.select("conv_id", "turn", F.col("q").alias("instruction"),
                                       F.col("a").alias("answer"),
                                       F.lit("conversations").alias("source"),
                                       F.lit(MODEL).alias("model")))
    flat = O.flatten_chat(recs)
    return _longs(flat.select("conv_id", "turn", "instruction", "answer", "source"))


def q_inspect_sample(spark, sf):
    # written without their texts: the sample is drawn from them and their number is counted
    flat = written(_flat(spark, sf).select("pair_id", "instruction", "answer", "agent"), "samples")
    s = sample_n(flat, 5, SEED, "pair_id")
    r = inspect_rows(s)
    return _longs(r.select("pair_id", "question", "choices", "answer", "agent",
                           "instruction_agent", "total"))


def q_inspect_complete(spark, sf):
    r = inspect_rows(complete_samples(_flat(spark, sf)))
    return _longs(r.select("pair_id", "question", "choices", "answer", "agent",
                           "transformed_content", "source"))


def q_split_choices(spark, sf):
    r = inspect_rows(_flat(spark, sf))
    return r.select("pair_id", "question", "choices",
                    F.size("choice_lines").cast("bigint").alias("n_choice_lines"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "generate_pairs": q_generate_pairs,
    "parse_pairs": q_parse_pairs,
    "parse_failures": q_parse_failures,
    "parse_modified": q_parse_modified,
    "strip_markdown": q_strip_markdown,
    "irrelevant_filter": q_irrelevant_filter,
    "normalize_pages": q_normalize_pages,
    "source_spec": q_source_spec,
    "union_sources": q_union_sources,
    "chunk_sample": q_chunk_sample,
    "page_chunks": q_page_chunks,
    "chunk_min_chars": q_chunk_min_chars,
    "chunk_fixed": q_chunk_fixed,
    "chunk_index": q_chunk_index,
    "limit_chunks": q_limit_chunks,
    "shuffle_chunks": q_shuffle_chunks,
    "resume_anti": q_resume_anti,
    "progress_append": q_progress_append,
    "progress_states": q_progress_states,
    "sample_content_agents": q_sample_content_agents,
    "sample_instruction_agents": q_sample_instruction_agents,
    "content_prompt": q_content_prompt,
    "instruction_prompt": q_instruction_prompt,
    "one_shot_prompt": q_one_shot_prompt,
    "refine_round": q_refine_round,
    "refine_fallback": q_refine_fallback,
    "refine_two_rounds": q_refine_two_rounds,
    "output_pairs": q_output_pairs,
    "output_with_content": q_output_with_content,
    "chat_records": q_chat_records,
    "chunk_status_counts": q_chunk_status_counts,
    "all_tasks": q_all_tasks,
    "mcq_filter": q_mcq_filter,
    "mcq_letter": q_mcq_letter,
    "flatten_chat": q_flatten_chat,
    "inspect_sample": q_inspect_sample,
    "inspect_complete": q_inspect_complete,
    "split_choices": q_split_choices,
}
