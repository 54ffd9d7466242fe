"""SQL twins of ``queries.QUERIES`` (DuckDB dialect, pre-registered tables)."""

from __future__ import annotations

from ..functions import mcq as M
from ..functions.parse import sql_block_fields, sql_blocks_list, sql_modified_fields
from ..functions.prompts import EDITOR_SYSTEM, sql_content_prompt, sql_editor_prompt, sql_instruction_prompt
from ..functions.text import (sql_collapse_ws, sql_is_missing, sql_keep_instruction_reply,
                              sql_str, sql_strip, sql_strip_fences, sql_strip_markdown)
from ..operators.agents import sql_sample
from ..operators.completion import sql_offline_reply_h
from ..sources.catalog import BUNDLED
from ..sources.pages import sql_html_text
from ..sources.tables import resolve_specs
from . import oracle as Q
from .queries import MAX_CHUNKS, MODEL, PACK_MIN, SEED, SLICE, TASK, UNION_SPECS


def _tasks() -> list[str]:
    import os
    import re
    d = os.path.join(BUNDLED, "instruction_generation")
    return sorted(re.match(r"(\w+?)_instruction\.json$", f).group(1)
                  for f in os.listdir(d) if f.endswith("_instruction.json"))


def doc_chunks(task: str = TASK, with_skipped: bool = False) -> str:
    base = (f"SELECT '{task}' AS task, row_number() OVER (ORDER BY doc_id) - 1 AS chunk_id, "
            f"source, text FROM documents")
    if with_skipped:
        return base
    return f"SELECT * FROM ({base}) WHERE NOT {sql_is_missing('text')}"


def all_task_chunks() -> str:
    lst = "[" + ", ".join(f"'{t}'" for t in _tasks()) + "]"
    return f"SELECT unnest({lst}) AS task, chunk_id, source, text FROM ({doc_chunks()})"


def flagship() -> str:
    return Q.generated_pairs_sql(doc_chunks(), [TASK], SEED)


def refined(rounds: int = 1, min_ref: int = 1) -> str:
    ctes = [f"c0 AS MATERIALIZED ({Q.refine_start_sql(flagship())})"]
    for r in range(1, rounds + 1):
        ctes.append(f"c{r} AS MATERIALIZED ({Q.refine_round_sql(f'SELECT * FROM c{r - 1}', r, min_ref)})")
    return (f"WITH {', '.join(ctes)} SELECT * REPLACE (CAST(goal_no AS BIGINT) AS goal_no, "
            f"CAST(round AS BIGINT) AS round) FROM c{rounds}")


def output_records(include_content: bool = False) -> str:
    cols = (f"task, chunk_id, pair_id, coalesce(instruction, '') AS instruction, "
            f"coalesce(answer, '') AS answer, source, '{MODEL}' AS model")
    if include_content:
        cols += (", original_text, CASE WHEN transformed_content IS NULL OR "
                 "transformed_content <> original_text THEN transformed_content END "
                 "AS transformed_content, agent")
    return f"SELECT {cols} FROM ({refined()})"


def _replies() -> str:
    return Q.replies_sql(Q.contents_sql(doc_chunks(), [TASK], SEED), [TASK], SEED)


def _instr_prompts(one_shot: bool) -> str:
    contents = Q.contents_sql(doc_chunks(), [TASK], SEED)
    s = sql_sample(contents, Q.agents_values([TASK]), "instruction", 3, SEED, "instr_pos",
                   ["content_pos"])
    j = (f"SELECT s.*, o.instruction AS si, o.answer AS sa FROM ({s}) s "
         f"LEFT JOIN ({Q.shots_values([TASK])}) o ON o.task = s.task")
    si, sa = ("si", "sa") if one_shot else ("NULL::VARCHAR", "NULL::VARCHAR")
    p = sql_instruction_prompt("instr_pos_template", "content", si, sa)
    return (f"SELECT task, chunk_id, content_pos, instr_pos, md5({p}) AS prompt_md5, "
            f"CAST(length({p}) AS BIGINT) AS prompt_len FROM ({j})")


# -- sources --------------------------------------------------------------

_TABLES = {"documents": {"cols": {"doc_id", "text", "lang", "source", "n_chars"},
                         "split": "lang", "ord": "doc_id"},
           "benchmark": {"cols": {"item_id", "text"}, "split": None, "ord": "item_id"}}


def union_sources() -> str:
    parts = []
    for i, sp in enumerate(resolve_specs(UNION_SPECS, ["text"])):
        meta = _TABLES[sp.name]
        if sp.text_field not in meta["cols"]:
            continue
        for j, split in enumerate(sp.splits):
            where = f"WHERE {meta['split']} = {sql_str(split)}" if meta["split"] else ""
            if not meta["split"] and split != "train":
                continue
            parts.append(f"SELECT '{sp.name}' AS source, CAST({i} AS BIGINT) AS source_ord, "
                         f"{sql_str(split)} AS split, CAST({j} AS BIGINT) AS split_ord, "
                         f"CAST({meta['ord']} AS BIGINT) AS ord, CAST({sp.text_field} AS VARCHAR) AS text "
                         f"FROM {sp.name} {where}")
    return " UNION ALL ".join(parts)


def page_chunks() -> str:
    t = sql_collapse_ws(sql_html_text("html"))
    p = (f"SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS source, page_id, {t} AS text FROM pages")
    n = f"SELECT *, row_number() OVER (PARTITION BY source ORDER BY page_id) AS page_no FROM ({p})"
    return (f"SELECT row_number() OVER (ORDER BY source, page_no) - 1 AS chunk_id, source, page_no, text "
            f"FROM ({n}) WHERE text <> ''")


def progress_states() -> str:
    """One grouping of the whole log; crc32 by its byte table."""
    table = "range(0, 256)"
    for _ in range(8):
        table = f"list_transform({table}, lambda c: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    log = ("SELECT doc_id, source, n, hex(encode(doc_id || '|' || n)) AS h "
           "FROM (SELECT doc_id, source, unnest(range(1, 2 + length(source) % 4)) AS n FROM documents)")
    crc = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h) // 2), "
           "lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)), "
           "lambda c, x: xor(c >> 8, bytes[xor(c, x) % 256 + 1])), 4294967295)")
    rows = f"SELECT doc_id, source, n, {crc} AS h FROM ({log}), (SELECT {table} AS bytes)"
    return (f"SELECT '{TASK}' AS task, sha256(CAST(doc_id AS VARCHAR)) AS chunk_key, source AS config, "
            f"['processed_chunk', 'empty_chunk', 'error_chunk'][arg_max(h, n) % 3 + 1] AS status, "
            f"arg_max(h, n) % 7 AS n_pairs, count(*) AS attempts, max(n) AS \"at\" FROM ({rows}) GROUP BY doc_id, source")


def packed() -> str:
    m = PACK_MIN
    return f"""
WITH RECURSIVE d AS (
  SELECT source, doc_id, text, length(text) AS len,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
  FROM documents WHERE text IS NOT NULL),
f(source, rn, state, chunk_no, absorbed) AS (
  SELECT source, rn, len, 0, len = 0 FROM d WHERE rn = 1
  UNION ALL
  SELECT d.source, d.rn,
         CASE WHEN f.state >= {m} THEN d.len WHEN f.state = 0 THEN d.len
              ELSE f.state + 1 + d.len END,
         CASE WHEN f.state >= {m} THEN f.chunk_no + 1 ELSE f.chunk_no END,
         (f.state >= {m} OR f.state = 0) AND d.len = 0
  FROM f JOIN d ON d.source = f.source AND d.rn = f.rn + 1)
SELECT f.source, CAST(f.chunk_no AS BIGINT) AS chunk_no,
       string_agg(d.text, ' ' ORDER BY d.rn) AS text
FROM f JOIN d ON d.source = f.source AND d.rn = f.rn
WHERE NOT f.absorbed
GROUP BY f.source, f.chunk_no"""


def fixed() -> str:
    return (f"SELECT source, CAST(k AS BIGINT) AS chunk_no, substr(t, k * {SLICE} + 1, {SLICE}) AS text "
            f"FROM (SELECT source, t, unnest(range(0, CAST(ceil(length(t) / {SLICE}) AS BIGINT))) AS k "
            f"FROM (SELECT source, string_agg(text, ' ' ORDER BY doc_id) AS t FROM documents "
            f"WHERE text IS NOT NULL GROUP BY source))")


def spec_table() -> str:
    g = ("SELECT source, list_sort(list_distinct(list(lang) FILTER (WHERE lang IS NOT NULL))) AS langs, "
         "count(*) AS n, min(doc_id) AS first FROM documents GROUP BY source")
    spec = ("CASE WHEN first % 5 = 1 THEN source ELSE concat_ws(':', source, "
            "CASE WHEN first % 3 = 0 THEN '' ELSE 'text' END, array_to_string(langs, ' , '), "
            "CASE WHEN n % 2 = 0 THEN CAST(n * 100 AS VARCHAR) ELSE 'x' END) END")
    return f"SELECT source, {spec} AS spec FROM ({g})"


def source_spec() -> str:
    s = f"SELECT row_number() OVER (ORDER BY source) - 1 AS spec_pos, spec FROM ({spec_table()})"
    p = "string_split(spec, ':')"
    n = f"len({p})"
    splits = (f"CASE WHEN {n} > 2 THEN array_to_string(list_transform(string_split({p}[3], ','), "
              f"lambda x: {sql_strip('x')}), ',') ELSE 'train' END")
    return (f"SELECT spec_pos, spec, {p}[1] AS name, "
            f"coalesce(nullif(CASE WHEN {n} > 1 THEN {p}[2] END, ''), "
            f"CASE WHEN spec_pos < 2 THEN ['text', 'body'][spec_pos + 1] END, 'text') AS text_field, "
            f"{splits} AS splits, "
            f"CAST(CASE WHEN {n} > 3 THEN TRY_CAST({sql_strip(p + '[4]')} AS INTEGER) END AS BIGINT) "
            f"AS min_chars FROM ({s})")


# -- mcq / inspector ------------------------------------------------------

def _defaults(cols: set[str]) -> dict[str, str]:
    out = {}
    for k, v in M.INSPECT_DEFAULTS.items():
        out[k] = f"coalesce({k}, {sql_str(v)})" if k in cols else sql_str(v)
    return out


_FLAT_COLS = {"task", "chunk_id", "pair_id", "instruction", "answer", "source", "model",
              "original_text", "transformed_content", "agent"}


def inspect_sql(src: str) -> str:
    d = _defaults(_FLAT_COLS)
    ins = d["instruction"]
    return (f"SELECT pair_id, {M.sql_question_part(ins)} AS question, "
            f"{M.sql_choices_part(ins)} AS choices, {d['answer']} AS answer, "
            f"{d['agent']} AS agent, {d['instruction_agent']} AS instruction_agent, "
            f"{d['transformed_content']} AS transformed_content, {d['source']} AS source "
            f"FROM ({src})")


def oracle() -> dict[str, str]:
    flat = output_records(include_content=True)
    parse_base = f"SELECT * FROM ({_replies()}) WHERE {sql_keep_instruction_reply('reply')}"
    blocks = (f"SELECT task, chunk_id, content_pos, instr_pos, unnest(bl) AS b, "
              f"generate_subscripts(bl, 1) - 1 AS block_pos FROM "
              f"(SELECT *, {sql_blocks_list('reply')} AS bl FROM ({parse_base}))")
    bf = sql_block_fields("b")
    edit = (f"SELECT doc_id, v, {sql_offline_reply_h('md5(concat_ws(chr(1), sys, usr))', 'usr')} AS reply "
            f"FROM (SELECT doc_id, v, {sql_str(EDITOR_SYSTEM + ' #')} || CAST(v AS VARCHAR) AS sys, "
            f"{sql_editor_prompt('text', 'source', 'lang')} AS usr "
            f"FROM (SELECT doc_id, text, source, lang, unnest(range(4)) AS v FROM documents))")
    mf = sql_modified_fields("reply")
    all_chunks = all_task_chunks()
    status_src = (f"SELECT c.task, c.chunk_id, c.text, n.n_pairs FROM ({doc_chunks(with_skipped=True)}) c "
                  f"LEFT JOIN (SELECT task, chunk_id, count(*) AS n_pairs FROM ({output_records()}) "
                  f"GROUP BY task, chunk_id) n ON n.task = c.task AND n.chunk_id = c.chunk_id")
    status = (f"CASE WHEN {sql_is_missing('text')} THEN 'skipped_chunk' "
              f"WHEN coalesce(n_pairs, 0) = 0 THEN 'empty_chunk' ELSE 'processed_chunk' END")
    shuffle_key = f"md5(concat_ws('|', '{SEED}', task, CAST(chunk_id AS VARCHAR)))"
    content_s = sql_sample(all_chunks, Q.agents_values(), "content", 3, SEED, "content_pos")
    instr_s = sql_sample(all_chunks, Q.agents_values(), "instruction", 3, SEED, "instr_pos")
    cp_s = sql_sample(doc_chunks(), Q.agents_values([TASK]), "content", 3, SEED, "content_pos")
    cp = sql_content_prompt("content_pos_template", "text")
    letter = M.sql_answer_letter("answer")
    complete_src = (f"SELECT * FROM ({flat}) WHERE NOT {sql_is_missing('answer')} "
                    f"AND contains(coalesce(instruction, ''), 'Choices')")
    return {
        "generate_pairs": flagship(),
        "parse_pairs": (f"SELECT task, chunk_id, content_pos, instr_pos, block_pos, "
                        f"{bf['status']} AS status, {bf['instruction']} AS instruction, "
                        f"{bf['answer']} AS answer FROM ({blocks})"),
        "parse_failures": (
            f"SELECT status, count(*) AS n FROM ("
            f"SELECT 'filtered' AS status FROM ({_replies()}) WHERE NOT {sql_keep_instruction_reply('reply')} "
            f"UNION ALL SELECT 'no_blocks' FROM (SELECT {sql_blocks_list('reply')} AS bl FROM ({parse_base})) "
            f"WHERE len(bl) = 0 "
            f"UNION ALL SELECT {bf['status']} FROM ({blocks})) GROUP BY status"),
        "parse_modified": (f"SELECT doc_id, CAST(v AS BIGINT) AS v, {mf['ok']} AS ok, "
                           f"CASE WHEN {mf['ok']} THEN {mf['instruction']} END AS instruction, "
                           f"CASE WHEN {mf['ok']} THEN {mf['answer']} END AS answer FROM ({edit})"),
        "strip_markdown": (f"SELECT doc_id, {sql_strip_markdown('text')} AS md_stripped, "
                           f"{sql_strip_fences('text')} AS fence_stripped, "
                           f"{sql_collapse_ws('text')} AS collapsed FROM documents"),
        "irrelevant_filter": (
            f"SELECT 'content' AS stage, chunk_id, content_pos, CAST(-1 AS BIGINT) AS instr_pos, kept "
            f"FROM ({Q.contents_sql(doc_chunks(), [TASK], SEED, keep_rejected=True)}) "
            f"UNION ALL SELECT 'instruction' AS stage, chunk_id, content_pos, instr_pos, "
            f"{sql_keep_instruction_reply('reply')} AS kept FROM ({_replies()})"),
        "normalize_pages": (f"SELECT page_id, text FROM (SELECT page_id, "
                            f"{sql_collapse_ws(sql_html_text('html'))} AS text FROM pages) "
                            f"WHERE text <> ''"),
        "source_spec": source_spec(),
        "union_sources": union_sources(),
        "chunk_sample": (f"SELECT row_number() OVER (ORDER BY source_ord, split_ord, ord) - 1 "
                         f"AS chunk_id, source, split, ord, text FROM ({union_sources()})"),
        "page_chunks": page_chunks(),
        "chunk_min_chars": f"SELECT source, chunk_no, text, CAST(length(text) AS BIGINT) AS n_chars FROM ({packed()})",
        "chunk_fixed": fixed(),
        "chunk_index": (f"SELECT row_number() OVER (ORDER BY source, chunk_no) - 1 AS chunk_id, "
                        f"source, chunk_no FROM ({packed()})"),
        "limit_chunks": f"SELECT chunk_id, source FROM ({doc_chunks()}) WHERE chunk_id < {MAX_CHUNKS}",
        "shuffle_chunks": (f"SELECT chunk_id, pos FROM (SELECT chunk_id, row_number() OVER "
                           f"(PARTITION BY task ORDER BY {shuffle_key}, chunk_id) - 1 AS pos "
                           f"FROM ({doc_chunks()}))"),
        "resume_anti": (f"SELECT chunk_id, source FROM ({doc_chunks()}) c WHERE chunk_id NOT IN "
                        f"(SELECT TRY_CAST({sql_strip('CAST(doc_id AS VARCHAR)')} AS BIGINT) FROM labels "
                        f"WHERE TRY_CAST({sql_strip('CAST(doc_id AS VARCHAR)')} AS BIGINT) IS NOT NULL)"),
        "progress_append": f"SELECT DISTINCT task, 'corpus_documents' AS source_id, chunk_id FROM ({flagship()})",
        "progress_states": progress_states(),
        "sample_content_agents": (f"SELECT task, chunk_id, content_pos, content_pos_name AS content_agent "
                                  f"FROM ({content_s})"),
        "sample_instruction_agents": (f"SELECT task, chunk_id, instr_pos, instr_pos_name AS "
                                      f"instruction_agent FROM ({instr_s})"),
        "content_prompt": (f"SELECT task, chunk_id, content_pos, md5({cp}) AS prompt_md5, "
                           f"CAST(length({cp}) AS BIGINT) AS prompt_len FROM ({cp_s})"),
        "instruction_prompt": _instr_prompts(False),
        "one_shot_prompt": _instr_prompts(True),
        "refine_round": refined(1, 1),
        "refine_fallback": refined(1, 3),
        "refine_two_rounds": refined(2, 1),
        "output_pairs": output_records(),
        "output_with_content": flat,
        "chat_records": (f"SELECT task, chunk_id, pair_id, 'user' AS user_role, instruction AS user_content, "
                         f"'assistant' AS assistant_role, answer AS assistant_content, "
                         f"source AS meta_source, model AS meta_model, agent AS meta_agent, "
                         f"transformed_content AS meta_transformed_content FROM ({flat})"),
        "chunk_status_counts": (f"SELECT task, status, count(*) AS n FROM (SELECT task, {status} AS status "
                                f"FROM ({status_src})) GROUP BY task, status"),
        "all_tasks": (f"SELECT task, chunk_id, content_pos, instr_pos, block_pos, agent, "
                      f"transformation_type, instruction, answer FROM "
                      f"({Q.generated_pairs_sql(all_chunks, None, SEED)})"),
        "mcq_filter": (f"SELECT pair_id, instruction, coalesce({letter}, answer) AS answer, agent "
                       f"FROM ({flat}) WHERE {M.sql_has_choices('instruction')}"),
        "mcq_letter": (f"SELECT pair_id, {M.sql_has_choices('instruction')} AS has_choices, "
                       f"{letter} AS letter FROM ({flat})"),
        "flatten_chat": ("SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS answer, "
                         "'conversations' AS source FROM conversations u LEFT JOIN conversations a "
                         "ON a.conv_id = u.conv_id AND a.turn - 1 = u.turn "
                         "AND u.role = 'user' AND a.role = 'assistant'"),
        "inspect_sample": (f"SELECT pair_id, question, choices, answer, agent, instruction_agent, "
                           f"(SELECT count(*) FROM ({flat})) AS total FROM ({inspect_sql(flat)}) "
                           f"ORDER BY md5('{SEED}|' || pair_id) LIMIT 5"),
        "inspect_complete": (f"SELECT pair_id, question, choices, answer, agent, transformed_content, "
                             f"source FROM ({inspect_sql(complete_src)})"),
        "split_choices": (f"SELECT pair_id, question, choices, CAST(len(string_split(choices, chr(10))) "
                          f"AS BIGINT) AS n_choice_lines FROM ({inspect_sql(flat)})"),
    }
