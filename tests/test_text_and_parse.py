"""Goldens for the text primitives and reply parsers (FIXTURES.md section 3)."""
from pyspark.sql import functions as F

from seedwright.functions import mcq as M
from seedwright.functions.parse import modified_pair, parsed_pairs
from seedwright.functions.text import (collapse_ws, is_irrelevant, keep_content_reply,
                                       keep_instruction_reply, py_strip, strip_markdown)


def _col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, raw string")
    return [r[0] for r in df.orderBy("id").select(fn(F.col("raw"))).collect()]


def test_strip_matches_python(spark):
    cases = [" x ", "\x1cy\x1f", "\x85z\t", "  only  ", "　", "a b "]
    assert _col(spark, cases, py_strip) == [c.strip() for c in cases]


def test_collapse_ws(spark):
    cases = ["a   b\n\nc", "\x1c\x1d", "x y"]
    import re
    assert _col(spark, cases, collapse_ws) == [re.sub(r"\s+", " ", c).strip() for c in cases]


def test_irrelevant_filters(spark):
    cases = ["IRRELEVANT", " irrelevant\n", "IRRELEVANT.", "", "   ", None, "fine"]
    assert _col(spark, cases, keep_content_reply) == [False, False, True, False, True, False, True]
    assert _col(spark, cases, keep_instruction_reply) == [False, False, True, False, False, False, True]
    assert _col(spark, [" IRRELEVANT "], is_irrelevant) == [True]


def test_strip_markdown_eats_snake_case(spark):
    assert _col(spark, ["**TEXT** snake_case_x"], strip_markdown) == ["TEXT snakecasex"]


def _pairs(spark, raw):
    r = _col(spark, [raw], lambda c: parsed_pairs(c))[0]
    return [(p["instruction"], p["answer"]) for p in r]


def test_parse_pairs_goldens(spark):
    assert _pairs(spark, "Instruction: a\nAnswer: b") == [("a", "b")]
    assert _pairs(spark, "Instruction: a\nAnswer: b\nInstruction: c\nAnswer: d") == [("a", "b"), ("c", "d")]
    assert _pairs(spark, "Preamble.\nInstruction: a\nAnswer: b") == [("a", "b")]
    assert _pairs(spark, "Instruction: a\nanswer: b") == [("a", "b")]
    # lower-case answer: inside the question ends the instruction early
    assert _pairs(spark, "Instruction: the answer: x\nAnswer: y") == [("the", "x\nAnswer: y")]
    assert _pairs(spark, "Instruction: a") == []
    assert _pairs(spark, "Instruction: a\nAnswer:   ") == []
    assert _pairs(spark, "```\nInstruction: a\nAnswer: b\n```") == [("a", "b")]
    assert _pairs(spark, "**Instruction:** use_it\r\n**Answer:** ok") == [("useit", "ok")]


def _mod(spark, raw, mode="parity"):
    r = _col(spark, [raw], lambda c: modified_pair(c, mode))[0]
    return None if r is None else (r["instruction"], r["answer"])


def test_parse_modified_goldens(spark):
    assert _mod(spark, "Modified Instruction: q\n\nModified Answer: a") == ("q", "a")
    assert _mod(spark, "Modified Answer: a\nModified Instruction: q") == ("q", "a")
    assert _mod(spark, "modified instruction: q\nmodified answer: a") is None
    # MCQ fallback keeps only the first label (D8 parity)
    assert _mod(spark, "Modified Instruction: Pick one\nA) one\nB) two") == ("Pick one\nChoices:\nA)", "A)")
    assert _mod(spark, "Modified Instruction: Pick\nChoices: A) x") == ("Pick\nChoices:\nA)", "A)")
    full = _mod(spark, "Modified Instruction: Pick one\nA) one\nB) two", "full")
    assert full == ("Pick one\nChoices:\nA) one\nB) two", None)


def test_mcq_helpers(spark):
    ins = ["Q? B) x", "no choices", "xB) z", "  C) y", "AB)"]
    assert _col(spark, ins, M.has_choices) == [True, False, False, True, False]
    ans = ["B) x", "B", "  C) y", "xB) z", None]
    assert _col(spark, ans, M.answer_letter) == ["B", None, "C", None, None]
