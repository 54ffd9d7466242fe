"""Reply parsers as native Column expressions (no Python per row).

``pair_blocks`` turns an instruction-stage reply into an array of
``struct(block_pos, instruction, answer, status)``; ``modified_pair`` turns an
editor reply into ``struct(instruction, answer)`` or null.  Each has a DuckDB
twin built from the same patterns (RE2 has no lookahead, so the twins consume
the terminator instead, which leaves group 1 unchanged).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import (WS, drop_markdown, let, py_strip, sql_str, sql_strip, sql_strip_fences,
                   sql_strip_markdown, strip_fences, strip_long, strip_markdown, where_found)

# Reply markers and patterns.
INSTRUCTION_MARK = "Instruction:"
# The marks in any case, with the letters that (?iu) folds to i and s.
_FOLDS = {"i": "Ii\u0130\u0131", "s": "Ss\u017f"}


def _any_case(mark: str) -> str:
    return "".join(f"[{_FOLDS.get(c.lower(), c.upper() + c.lower())}]" if c.isalpha() else c for c in mark)


ANY_INSTRUCTION_RE = _any_case(INSTRUCTION_MARK)
ANY_ANSWER_RE = _any_case("Answer:")
INSTR_RE2 = rf"(?is)Instruction:{WS}*(.*?)(?:Answer:|$)"
ANSWER_RE2 = rf"(?is)Answer:{WS}*(.*?)(?:Instruction:|$)"

MOD_INSTRUCTION_MARK = "Modified Instruction:"
MOD_ANSWER_MARK = "Modified Answer:"
MOD_INSTR_RE2 = rf"(?s)Modified Instruction:{WS}*(.*?)(?:Modified Answer:|$)"
MOD_ANSWER_RE2 = rf"(?s)Modified Answer:{WS}*(.*?)(?:Modified Instruction:|$)"
MCQ_QUESTION_END_RE = r"Choices:|[A-D]\)"
MCQ_QUESTION_RE2 = rf"(?s)Modified Instruction:{WS}*(.*?)(?:Choices:|{WS}*[A-D]\))"
# Lazy body: for "A) one\nB) two" this keeps only "A)" (the reference's
# behaviour, kept under mcq_fallback="parity").
MCQ_CHOICES_RE = rf"(?s)(?:Choices:{WS}*|\n{WS}*)((?:[A-D]\).*?\n?)+)"
# mcq_fallback="full": every choice line from the first one on.
MCQ_FULL_CHOICES_RE = rf"(?s)(?:Choices:{WS}*|\n{WS}*)((?:[A-D]\)[^\n]*(?:\n|\z))+)"


# --- cutting -------------------------------------------------------------
# A lazy group with a lookahead tests the lookahead at every character; a cut at
# the first match of a mark finds the same text in one search.

def _after(c: Column, mark: str) -> Column:
    """What follows the first match of ``mark``; null where there is none."""
    return F.get(F.split(c, mark, 2), F.lit(1))


def _before(c: Column, mark: str) -> Column:
    """What stands before the first match of ``mark``; all where there is none."""
    return F.get(F.split(c, mark, 2), F.lit(0))


def _stripped(c: Column) -> Column:
    return let(F.coalesce(c, F.lit("")), strip_long)


# --- instruction/answer pairs ------------------------------------------

def clean_reply(c: Column) -> Column:
    return strip_fences(drop_markdown(c))  # one strip, at the end, does for both


def sql_clean_reply(e: str) -> str:
    return sql_strip_fences(sql_strip_markdown(e))


def pair_blocks(reply: Column) -> Column:
    """All non-blank blocks of a reply, parsed, with a per-block status:
    ``parsed``, ``missing_marker`` (the reference logs these) or ``empty``; a
    block that did not parse keeps its text."""
    # cut at the mark, which goes back in front of every piece but the first
    pieces = F.transform(F.split(clean_reply(reply), INSTRUCTION_MARK),
                         lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(INSTRUCTION_MARK), p)))
    blocks = F.filter(pieces, lambda b: strip_long(b) != "")
    # cut at the first answer mark, both parts at their first instruction mark:
    # each text is searched once
    halves = F.transform(blocks, lambda b: F.struct(b.alias("block"), F.split(b, ANY_ANSWER_RE, 2).alias("h")))
    cut = F.transform(halves, lambda s: F.struct(
        s["block"].alias("block"), F.split(F.get(s["h"], F.lit(0)), ANY_INSTRUCTION_RE, 2).alias("x"),
        F.split(F.get(s["h"], F.lit(1)), ANY_INSTRUCTION_RE, 2).alias("y")))
    # an instruction after the answer ends at the next answer mark
    late = lambda s: _before(F.get(s["y"], F.lit(1)), ANY_ANSWER_RE)
    fields = F.transform(cut, lambda s: F.struct(
        s["block"].alias("block"),
        (s["y"].isNotNull() & ((F.size(s["x"]) > 1) | (F.size(s["y"]) > 1))).alias("both"),
        _stripped(F.coalesce(F.get(s["x"], F.lit(1)), late(s))).alias("instruction"),
        _stripped(F.get(s["y"], F.lit(0))).alias("answer")))

    def one(s, i):
        status = (F.when(~s["both"], F.lit("missing_marker"))
                  .when((s["instruction"] == "") | (s["answer"] == ""), F.lit("empty"))
                  .otherwise(F.lit("parsed")))
        return F.struct(i.cast("bigint").alias("block_pos"),
                        s["instruction"].alias("instruction"), s["answer"].alias("answer"),
                        status.alias("status"),
                        F.when(status != "parsed", s["block"]).alias("failed_text"))

    return F.transform(fields, one)


def parsed_pairs(reply: Column) -> Column:
    """Only the valid pairs, in block order."""
    return F.filter(pair_blocks(reply), lambda s: s["status"] == "parsed")


def sql_blocks_list(reply: str) -> str:
    """DuckDB list of the non-blank blocks (marker split without lookahead)."""
    split = (f"string_split(replace({sql_clean_reply(reply)}, "
             f"{sql_str(INSTRUCTION_MARK)}, chr(1) || {sql_str(INSTRUCTION_MARK)}), chr(1))")
    return f"list_filter({split}, lambda b: {sql_strip('b')} <> '')"


def sql_block_fields(b: str) -> dict:
    ins = sql_strip(f"regexp_extract({b}, {sql_str(INSTR_RE2)}, 1)")
    ans = sql_strip(f"regexp_extract({b}, {sql_str(ANSWER_RE2)}, 1)")
    has_both = (f"(regexp_matches({b}, '(?is)Instruction:') AND "
                f"regexp_matches({b}, '(?is)Answer:'))")
    status = (f"(CASE WHEN NOT {has_both} THEN 'missing_marker' "
              f"WHEN {ins} = '' OR {ans} = '' THEN 'empty' ELSE 'parsed' END)")
    return {"instruction": ins, "answer": ans, "status": status}


# --- modified (refined) pairs -------------------------------------------

def normalise_modified(c: Column) -> Column:
    t = where_found(strip_markdown(c), "\r\n", lambda x: F.replace(x, F.lit("\r\n"), F.lit("\n")))
    return let(where_found(t, "\n\n", lambda x: F.regexp_replace(x, "\n+", "\n")), strip_long)


def sql_normalise_modified(e: str) -> str:
    t = sql_strip_markdown(e)
    t = f"regexp_replace({t}, chr(13) || chr(10), chr(10), 'g')"
    return sql_strip(f"regexp_replace({t}, '\\n+', chr(10), 'g')")


def modified_pair(reply: Column, mcq_fallback: str = "full",
                  normalised: Column | None = None) -> Column:
    """Editor reply -> struct(instruction, answer) or null.

    ``mcq_fallback``: ``full`` (all choice lines, answer left null so the row is
    dropped), ``parity`` (reference: lazy choices, answer = choices) or ``off``.
    """
    def pair(t):
        ins = _stripped(_before(_after(t, MOD_INSTRUCTION_MARK), MOD_ANSWER_MARK))
        ans = _stripped(_before(_after(t, MOD_ANSWER_MARK), MOD_INSTRUCTION_MARK))
        return let(F.struct(ins.alias("instruction"), ans.alias("answer")), lambda p: F.when(
            (p["instruction"] != "") & (p["answer"] != ""), p).otherwise(fallback(t)))

    def fallback(t):
        if mcq_fallback == "off":
            return F.lit(None).cast("struct<instruction:string,answer:string>")
        choices_re = MCQ_CHOICES_RE if mcq_fallback == "parity" else MCQ_FULL_CHOICES_RE
        # the question ends at the first choice, so there is none without one
        cut = F.split(_after(t, MOD_INSTRUCTION_MARK), MCQ_QUESTION_END_RE, 2)
        q = let(cut, lambda a: F.when(F.size(a) > 1, py_strip(F.get(a, F.lit(0)))))
        ch = py_strip(F.regexp_extract(t, choices_re, 1))
        return let(F.struct(q.alias("q"), ch.alias("ch")), lambda c: F.when(
            (c["q"] != "") & (c["ch"] != ""), F.struct(
                F.concat(c["q"], F.lit("\nChoices:\n"), c["ch"]).alias("instruction"),
                (c["ch"] if mcq_fallback == "parity" else F.lit(None).cast("string")).alias("answer"))))

    return F.when(reply.isNotNull(), let(normalise_modified(reply) if normalised is None else normalised, pair))


def sql_modified_fields(reply: str) -> dict:
    """(ok, instruction, answer) SQL expressions, parity fallback."""
    t = sql_normalise_modified(reply)
    ins = sql_strip(f"regexp_extract({t}, {sql_str(MOD_INSTR_RE2)}, 1)")
    ans = sql_strip(f"regexp_extract({t}, {sql_str(MOD_ANSWER_RE2)}, 1)")
    primary_ok = (f"(contains({t}, 'Modified Instruction:') AND contains({t}, 'Modified Answer:') "
                  f"AND {ins} <> '' AND {ans} <> '')")
    q = sql_strip(f"regexp_extract({t}, {sql_str(MCQ_QUESTION_RE2)}, 1)")
    ch = sql_strip(f"regexp_extract({t}, {sql_str(MCQ_CHOICES_RE)}, 1)")
    fb_ok = (f"(regexp_matches({t}, {sql_str(MCQ_QUESTION_RE2)}) AND "
             f"regexp_matches({t}, {sql_str(MCQ_CHOICES_RE)}) AND {q} <> '' AND {ch} <> '')")
    ok = f"({reply} IS NOT NULL AND ({primary_ok} OR {fb_ok}))"
    instruction = f"(CASE WHEN {primary_ok} THEN {ins} ELSE {q} || chr(10) || 'Choices:' || chr(10) || {ch} END)"
    answer = f"(CASE WHEN {primary_ok} THEN {ans} ELSE {ch} END)"
    return {"ok": ok, "instruction": instruction, "answer": answer}
