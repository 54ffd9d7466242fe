"""Prompt text and prompt assembly as Column expressions (and SQL twins).

The fixed strings below are sent to the model; they must equal the
reference's bytes for the requests to be the same, so they are stated
plainly here and nowhere else.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import sql_str, with_long

# ---------------------------------------------------------------------------
# Prompt text, in the order the stages use it.
# ---------------------------------------------------------------------------

# Content stage suffix.  It really starts with a backslash-n pair, not with
# newlines.
CONTENT_IRRELEVANCE = (
    "\\n\\nCritically evaluate if the provided text is relevant and suitable for "
    "your specific transformation task. If you have any doubts about the "
    "relevance of the text, classify it as IRRELEVANT and output ONLY the word "
    "'IRRELEVANT' and nothing else."
)

# Instruction stage clauses.  The first two sentences are joined without a
# space ("type.Reflect").
SELF_CONTAINED = (
    "The provided content that you see will not be passed to the next user. "
    "Therefore, it is important that the instruction is self-contained with all "
    "information needed to complete the task based on the specified format for "
    "its type.Reflect on whether the task requires the content to be included "
    "directly in the instruction. For tasks like text extraction or text "
    "modification, include the relevant content directly after the main "
    "instruction, marked with the '**TEXT**' tag. For Retrieval-Augmented "
    "Generation (RAG) tasks, the instruction should clearly state the query and "
    "provide the necessary retrieved documents/contextual information separately "
    "within the instruction field. Ensure the instruction is self-contained with "
    "all information needed to complete the task based on the specified format "
    "for its type."
)
IRRELEVANT_CLAUSE = (
    "If the content is not relevant or suitable for generating a meaningful "
    "instruction in your domain, output only the word 'IRRELEVANT' without any "
    "additional text. Skip content that doesn't fit your expertise area."
)
CONCISE = "Aim for conciseness in the generated instruction/question."
ONE_SHOT_BLOCK = (
    "Here is an example of the expected format:\n\n```\n{instruction}\n{answer}\n"
    "```\n\nPlease follow this format strictly to generate a new instruction "
    "based on the provided content.\n\n"
)

# Refinement goals, numbered from 1.
GOALS = [
    "Make the question more challenging while maintaining its core concept",
    "Add relevant context to make the question more practical and applied",
    "Increase the precision and specificity of both the question and answer",
]

SUGGESTER_SYSTEM = (
    "You are an expert in educational content refinement,\n"
    "specializing in creating suggestions to achieve specific modification "
    "goals while maintaining the original format."
)
SUGGESTER_USER = (
    "\nBased on the following instruction-answer pair, provide detailed "
    "suggestions to achieve the specified goal.\nMaintain the exact same format "
    "as the original in your suggestions.\n\nOriginal instruction:\n"
    "{instruction}\n\nOriginal answer:\n{answer}\n\nGoal:\n{goal}\n\n"
    "Provide your suggestions as a numbered list.\n"
)
EDITOR_SYSTEM = (
    "You are an expert editor specializing in applying modifications to "
    "educational content.\nYour output must maintain the exact same format as "
    "the original instruction and answer pair."
)
EDITOR_USER = (
    "\nUsing the suggestions below, modify the instruction and answer to achieve "
    "the goal.\nYour response must follow this exact format:\n\n"
    "Modified Instruction:\n[Your modified instruction here]\n\n"
    "Modified Answer:\n[Your modified answer here]\n\n"
    "Original instruction:\n{instruction}\n\nOriginal answer:\n{answer}\n\n"
    "Suggestions:\n{suggestions}\n\nRemember to maintain the same format as the "
    "original content (including multiple choice options if present) but "
    "prefix with \"Modified Instruction:\" and \"Modified Answer:\"."
)

# Marker inside every instruction-stage prompt, used by the offline completer
# to tell the stages apart (like a model would, from the prompt alone).
INSTRUCTION_MARKER = CONCISE
SUGGESTER_MARKER = "Provide your suggestions as a numbered list."
EDITOR_MARKER = "Modified Instruction:"

_SLOT = re.compile(r"\{([A-Za-z_]+)\}")


def _pieces(template: str):
    """Split a fixed template into literal parts and slot names."""
    pos, out = 0, []
    for m in _SLOT.finditer(template):
        out.append(("lit", template[pos:m.start()]))
        out.append(("slot", m.group(1)))
        pos = m.end()
    out.append(("lit", template[pos:]))
    return [p for p in out if not (p[0] == "lit" and p[1] == "")]


def fill(template: str, **values: Column) -> Column:
    """Single-pass ``template.format(**values)`` for a fixed template."""
    return F.concat(*[F.lit(v) if k == "lit" else values[v]
                      for k, v in _pieces(template)])


def sql_fill(template: str, **values: str) -> str:
    return "(" + " || ".join(sql_str(v) if k == "lit" else f"({values[v]})"
                             for k, v in _pieces(template)) + ")"


# ---------------------------------------------------------------------------
# Stage prompts.  ``template`` is a per-agent column whose only remaining
# slot is ``{text}`` (the catalogue resolves the others, see catalog.py).
# The template is scanned once, so braces inside the text are safe.
# ---------------------------------------------------------------------------

def content_prompt(template: Column, text: Column) -> Column:
    return F.concat(with_long(template, "{text}", text),
                    F.lit(CONTENT_IRRELEVANCE))


def sql_content_prompt(template: str, text: str) -> str:
    return f"(replace({template}, '{{text}}', {text}) || {sql_str(CONTENT_IRRELEVANCE)})"


INSTRUCTION_TAIL = f"{SELF_CONTAINED}\n\n{CONCISE}\n\n{IRRELEVANT_CLAUSE}"


def instruction_prompt(template: Column, content: Column,
                       one_shot_instruction: Column, one_shot_answer: Column) -> Column:
    """Instruction prompt; the one-shot block is used when the task has one."""
    body = with_long(template, "{text}", content)
    with_shot = F.concat(body, F.lit("\n\n"),
                         fill(ONE_SHOT_BLOCK, instruction=one_shot_instruction,
                              answer=one_shot_answer),
                         F.lit(INSTRUCTION_TAIL))
    plain = F.concat(body, F.lit("\n\n" + INSTRUCTION_TAIL))
    has_shot = one_shot_instruction.isNotNull() & one_shot_answer.isNotNull()
    return F.when(has_shot, with_shot).otherwise(plain)


def sql_instruction_prompt(template: str, content: str, shot_i: str, shot_a: str) -> str:
    body = f"replace({template}, '{{text}}', {content})"
    with_shot = (f"({body} || chr(10) || chr(10) || "
                 f"{sql_fill(ONE_SHOT_BLOCK, instruction=shot_i, answer=shot_a)} || "
                 f"{sql_str(INSTRUCTION_TAIL)})")
    plain = f"({body} || {sql_str(chr(10) + chr(10) + INSTRUCTION_TAIL)})"
    return (f"(CASE WHEN {shot_i} IS NOT NULL AND {shot_a} IS NOT NULL "
            f"THEN {with_shot} ELSE {plain} END)")


def suggester_prompt(instruction: Column, answer: Column, goal: Column) -> Column:
    return fill(SUGGESTER_USER, instruction=instruction, answer=answer, goal=goal)


def sql_suggester_prompt(instruction: str, answer: str, goal: str) -> str:
    return sql_fill(SUGGESTER_USER, instruction=instruction, answer=answer, goal=goal)


def editor_prompt(instruction: Column, answer: Column, suggestions: Column) -> Column:
    return fill(EDITOR_USER, instruction=instruction, answer=answer,
                suggestions=suggestions)


def sql_editor_prompt(instruction: str, answer: str, suggestions: str) -> str:
    return sql_fill(EDITOR_USER, instruction=instruction, answer=answer,
                    suggestions=suggestions)
