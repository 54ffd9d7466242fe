"""DuckDB twins of the registered queries.

Each builder returns one SQL string over the pre-registered tables.  The
agent catalogue (configuration, not data) is inlined as a VALUES list built
from the same files and the same placeholder rule as ``load_catalog``.
"""

from __future__ import annotations

import json
import os
import re

from ..functions.parse import sql_block_fields, sql_blocks_list, sql_modified_fields
from ..functions.prompts import (EDITOR_SYSTEM, GOALS, SUGGESTER_SYSTEM, sql_content_prompt,
                                 sql_editor_prompt, sql_instruction_prompt,
                                 sql_suggester_prompt)
from ..functions.text import (sql_is_missing, sql_keep_content_reply,
                              sql_keep_instruction_reply, sql_slug, sql_str)
from ..operators.agents import sql_sample
from ..operators.completion import sql_offline_reply_h
from ..sources.catalog import BUNDLED, DEFAULT_PARAMS, SLOT_RE, TEXT


def catalog_rows(tasks: list[str] | None = None, params: dict | None = None,
                 root: str = BUNDLED):
    """Usable agents and one-shots, resolved like ``load_catalog``."""
    params = DEFAULT_PARAMS if params is None else params
    agents, shots = [], []
    for stage_dir, stage in (("content_generation", "content"),
                             ("instruction_generation", "instruction")):
        d = os.path.join(root, stage_dir)
        for fn in sorted(os.listdir(d)):
            m = re.match(r"(\w+?)_(content|instruction)\.json$", fn)
            if not m or (tasks and m.group(1) not in tasks):
                continue
            task = m.group(1)
            with open(os.path.join(d, fn), encoding="utf-8") as f:
                doc = json.load(f)
            lst = doc if isinstance(doc, list) else doc.get("agents", [])
            if stage == "instruction" and isinstance(doc, dict) and doc.get("one_shot_example"):
                ex = doc["one_shot_example"]
                shots.append((task, ex.get("instruction"), ex.get("answer")))
            for pos, a in enumerate(lst):
                tpl = a["user_prompt_template"]
                slots = set(re.findall(SLOT_RE, tpl))
                if slots - {"text", *params} or "{{" in tpl or "}}" in tpl:
                    continue
                for k in sorted(params):
                    v = params[k]
                    tpl = tpl.replace("{" + k + "}", "{text}" if v is TEXT else str(v))
                agents.append((task, stage, pos, a["name"], a["system_prompt"], tpl))
    return agents, shots


def agents_values(tasks=None) -> str:
    agents, _ = catalog_rows(tasks)
    rows = ",\n".join(f"({sql_str(t)}, {sql_str(s)}, {p}, {sql_str(n)}, {sql_str(sp)}, {sql_str(tp)})"
                      for t, s, p, n, sp, tp in agents)
    return (f"SELECT * FROM (VALUES {rows}) AS v(task, stage, agent_pos, name, "
            f"system_prompt, template)")


def shots_values(tasks=None) -> str:
    _, shots = catalog_rows(tasks)
    if not shots:
        return "SELECT NULL::VARCHAR AS task, NULL::VARCHAR AS instruction, NULL::VARCHAR AS answer WHERE false"
    rows = ",\n".join(f"({sql_str(t)}, {sql_str(i)}, {sql_str(a)})" for t, i, a in shots)
    return f"SELECT * FROM (VALUES {rows}) AS v(task, instruction, answer)"


# ---------------------------------------------------------------------------
# Generation stages as CTE chains
# ---------------------------------------------------------------------------

def doc_chunks_sql(task_sql: str = "'reading_comprehension'") -> str:
    """C1+C5 on ``documents``: one chunk per document, dense id by doc_id."""
    return (f"SELECT {task_sql} AS task, row_number() OVER (ORDER BY doc_id) - 1 AS chunk_id, "
            f"source, text FROM documents")


def contents_sql(chunks: str, tasks, seed, k: int = 3, keep_rejected: bool = False) -> str:
    sampled = sql_sample(chunks, agents_values(tasks), "content", k, seed, "content_pos")
    req = (f"SELECT *, content_pos_system AS system_prompt, "
           f"{sql_content_prompt('content_pos_template', 'text')} AS user_prompt FROM ({sampled})")
    hashed = f"SELECT *, md5(concat_ws(chr(1), system_prompt, user_prompt)) AS h FROM ({req})"
    rep = (f"SELECT task, chunk_id, source, text, content_pos, content_pos_name AS content_agent, "
           f"{sql_slug('content_pos_name')} AS transformation_type, "
           f"{sql_offline_reply_h('h', 'user_prompt')} AS content FROM ({hashed})")
    if keep_rejected:
        return f"SELECT *, {sql_keep_content_reply('content')} AS kept FROM ({rep})"
    return f"SELECT * FROM ({rep}) WHERE {sql_keep_content_reply('content')}"


def replies_sql(contents: str, tasks, seed, k: int = 3) -> str:
    sampled = sql_sample(contents, agents_values(tasks), "instruction", k, seed, "instr_pos",
                         ["content_pos"])
    joined = (f"SELECT s.*, o.instruction AS shot_i, o.answer AS shot_a FROM ({sampled}) s "
              f"LEFT JOIN ({shots_values(tasks)}) o ON o.task = s.task")
    req = (f"SELECT *, instr_pos_system AS system_prompt, "
           f"{sql_instruction_prompt('instr_pos_template', 'content', 'shot_i', 'shot_a')} "
           f"AS user_prompt FROM ({joined})")
    hashed = f"SELECT *, md5(concat_ws(chr(1), system_prompt, user_prompt)) AS h FROM ({req})"
    return (f"SELECT task, chunk_id, source, text, content_pos, content, transformation_type, "
            f"instr_pos, instr_pos_name AS instruction_agent, "
            f"{sql_offline_reply_h('h', 'user_prompt')} AS reply FROM ({hashed})")


def pairs_sql(replies: str) -> str:
    kept = f"SELECT * FROM ({replies}) WHERE {sql_keep_instruction_reply('reply')}"
    listed = f"SELECT *, {sql_blocks_list('reply')} AS bl FROM ({kept})"
    un = f"SELECT *, unnest(bl) AS b, generate_subscripts(bl, 1) - 1 AS block_pos FROM ({listed})"
    f = sql_block_fields("b")
    fields = (f"SELECT *, {f['instruction']} AS instruction, {f['answer']} AS answer, "
              f"{f['status']} AS status FROM ({un})")
    return (f"SELECT task, chunk_id, source, text AS original_text, content_pos, instr_pos, "
            f"block_pos, instruction_agent AS agent, instruction_agent, "
            f"content AS transformed_content, transformation_type, instruction, answer, "
            f"md5(concat_ws('|', task, cast(chunk_id AS VARCHAR), cast(content_pos AS VARCHAR), "
            f"cast(instr_pos AS VARCHAR), cast(block_pos AS VARCHAR))) AS pair_id "
            f"FROM ({fields}) WHERE status = 'parsed'")


def generated_pairs_sql(chunks: str, tasks, seed, k: int = 3) -> str:
    return pairs_sql(replies_sql(contents_sql(chunks, tasks, seed, k), tasks, seed, k))


LINEAGE = ("task, chunk_id, source, original_text, content_pos, instr_pos, block_pos, "
           "agent, instruction_agent, transformed_content, transformation_type, instruction, "
           "answer, pair_id, goal_no, round, parent_pair_id, done")


def refine_start_sql(pairs: str) -> str:
    """Valid pairs with round bookkeeping columns."""
    return (f"SELECT task, chunk_id, source, original_text, content_pos, instr_pos, block_pos, "
            f"agent, instruction_agent, transformed_content, transformation_type, instruction, "
            f"answer, pair_id, NULL::INTEGER AS goal_no, 0 AS round, "
            f"NULL::VARCHAR AS parent_pair_id, false AS done FROM ({pairs}) "
            f"WHERE NOT {sql_is_missing('instruction')} AND NOT {sql_is_missing('answer')}")


def refine_round_sql(cur: str, round_no: int, min_refinements: int = 1) -> str:
    """One round with per-chunk fallback: a chunk with fewer than
    ``min_refinements`` pairs, or with no successful refinement, keeps its
    pairs and stops (done)."""
    goals = " UNION ALL ".join(f"SELECT {i + 1} AS goal_no, {sql_str(g)} AS goal"
                               for i, g in enumerate(GOALS))
    counted = (f"SELECT *, count(*) OVER (PARTITION BY task, chunk_id) AS n_in_chunk "
               f"FROM ({cur})")
    active = f"SELECT * EXCLUDE (goal_no) FROM ({counted}) WHERE NOT done AND n_in_chunk >= {min_refinements}"
    x = f"SELECT a.*, g.goal_no, g.goal FROM ({active}) a CROSS JOIN ({goals}) g"
    sreq = (f"SELECT *, {sql_str(SUGGESTER_SYSTEM)} AS s_sys, "
            f"{sql_suggester_prompt('instruction', 'answer', 'goal')} AS s_user FROM ({x})")
    srep = (f"SELECT *, {sql_offline_reply_h('md5(concat_ws(chr(1), s_sys, s_user))', 's_user')} "
            f"AS suggestions FROM ({sreq})")
    sok = f"SELECT * FROM ({srep}) WHERE NOT {sql_is_missing('suggestions')}"
    ereq = (f"SELECT *, {sql_str(EDITOR_SYSTEM)} AS e_sys, "
            f"{sql_editor_prompt('instruction', 'answer', 'suggestions')} AS e_user FROM ({sok})")
    erep = (f"SELECT *, {sql_offline_reply_h('md5(concat_ws(chr(1), e_sys, e_user))', 'e_user')} "
            f"AS modified FROM ({ereq})")
    mf = sql_modified_fields("modified")
    parsed = (f"SELECT *, {mf['ok']} AS ok, {mf['instruction']} AS new_instruction, "
              f"{mf['answer']} AS new_answer FROM ({erep}) WHERE NOT {sql_is_missing('modified')}")
    new = (f"SELECT task, chunk_id, source, original_text, content_pos, instr_pos, block_pos, "
           f"'Refinement Round {round_no}, Goal ' || goal_no AS agent, instruction_agent, "
           f"transformed_content, transformation_type, new_instruction AS instruction, "
           f"new_answer AS answer, md5(pair_id || '|r{round_no}g' || goal_no) AS pair_id, "
           f"goal_no, {round_no} AS round, pair_id AS parent_pair_id, false AS done "
           f"FROM ({parsed}) WHERE ok AND NOT {sql_is_missing('new_instruction')} "
           f"AND NOT {sql_is_missing('new_answer')}")
    keep_old = (f"SELECT {LINEAGE.replace(', done', '')}, true AS done FROM ({cur}) v "
                f"WHERE NOT EXISTS (SELECT 1 FROM new_r n WHERE n.task = v.task "
                f"AND n.chunk_id = v.chunk_id)")
    return (f"WITH new_r AS MATERIALIZED ({new}) "
            f"SELECT {LINEAGE} FROM new_r UNION ALL SELECT {LINEAGE} FROM ({keep_old})")
