"""Multiple-choice helpers (Column expressions and DuckDB twins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_CHARS, let, py_strip, sql_str, sql_strip, strip_long

# A choice label "X)" preceded by a non-word character or the
# start (Python's Unicode \b, spelled out so Java and RE2 agree).
CHOICE_RE = r"(?:^|[^\p{L}\p{N}_])[A-Z]\)"
LETTER_RE = r"^([A-Z])\)"
CHOICES_MARK = "Choices:"

# Inspector defaults for missing keys.
INSPECT_DEFAULTS = {
    "instruction": "No instruction provided.",
    "answer": "No answer provided.",
    "agent": "No agent information",
    "instruction_agent": "No instruction agent information",
    "transformed_content": "No transformed content",
    "source": "No source available",
    "original_text": "No original text available",
}
NO_CHOICES = "No choices provided"


def has_choices(instruction: Column) -> Column:
    return F.coalesce(F.coalesce(instruction, F.lit("")).rlike(CHOICE_RE), F.lit(False))


def sql_has_choices(e: str) -> str:
    return f"coalesce(regexp_matches(coalesce({e}, ''), {sql_str(CHOICE_RE)}), false)"


def answer_letter(answer: Column) -> Column:
    """Leading ``X)`` of the stripped answer, else null (a bare ``B`` too)."""
    return F.nullif(F.regexp_extract(F.ltrim(F.coalesce(answer, F.lit("")), F.lit(WS_CHARS)), LETTER_RE, 1),
                    F.lit(""))


def sql_answer_letter(e: str) -> str:
    return f"nullif(regexp_extract({sql_strip(f'coalesce({e}, {chr(39)}{chr(39)})')}, {sql_str(LETTER_RE)}, 1), '')"


def question_part(instruction: Column) -> Column:
    return let(F.split(instruction, CHOICES_MARK, 2).getItem(0), strip_long)


def choices_part(instruction: Column) -> Column:
    parts = F.split(instruction, CHOICES_MARK, 2)
    return F.when(F.size(parts) > 1, py_strip(parts.getItem(1))).otherwise(F.lit(NO_CHOICES))


def sql_question_part(e: str) -> str:
    return sql_strip(f"(CASE WHEN position('Choices:' IN {e}) > 0 THEN "
                     f"substr({e}, 1, position('Choices:' IN {e}) - 1) ELSE {e} END)")


def sql_choices_part(e: str) -> str:
    rest = f"substr({e}, position('Choices:' IN {e}) + 8)"
    return (f"(CASE WHEN position('Choices:' IN {e}) > 0 THEN {sql_strip(rest)} "
            f"ELSE {sql_str(NO_CHOICES)} END)")
