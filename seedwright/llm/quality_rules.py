"""Operator 6: quality rules compiled from a threshold table.

A rule is a row (name, measure, comparison, bound); measures are SQL
expressions over counted columns.  ``evaluate`` compiles the counts and the
whole table into projections over one scan: no shuffle and no user function.

Repeated 8-word windows are found inside the row: window hashes are compared
with their distinct ones, and only texts that repeat sort (hash, position)
pairs, so the cost is n log n in a text's words.

Defined cases: null and empty texts have no words and fail the base rules;
ratios over nothing are 0; rows that repeat or lack a doc_id are judged one by
one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import table, text_or_empty

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Common words of the languages at hand.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "it", "for", "on", "with", "as", "was", "be", "by", "are",
              "le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "qui", "dans", "pour", "sur",
              "el", "los", "las", "una", "y", "por", "para", "su", "con", "no",
              "der", "die", "das", "und", "ist", "nicht", "ein", "eine", "von", "zu", "den", "dem", "mit", "auf")


class Rule(NamedTuple):
    name: str
    measure: str
    comparison: str
    bound: float


#: Both engines evaluate these expressions as they stand.
RULES = (
    Rule("short_words", "word_chars / n_words", ">=", 1.5),
    Rule("long_words", "word_chars / n_words", "<=", 25.0),
    Rule("symbols", "n_symbols / n_words", "<=", 0.1),
    Rule("exclamations", "n_exclamations / n_words", "<=", 0.2),
    Rule("stop_words", "n_stop_words / n_words", ">=", 0.01),
    Rule("letterless_words", "n_letterless / n_words", "<=", 0.4),
    Rule("stutters", "n_stutters / n_words", "<=", 0.2),
    Rule("repeated_lines", "n_dup_lines / n_lines", "<=", 0.5),
    Rule("open_lines", "n_open_lines / n_lines", "<=", 0.3),
)


def _measure(rule: Rule) -> str:
    top, bottom = rule.measure.split(" / ")
    return f"coalesce(cast({top} as double) / nullif({bottom}, 0), 0.0D)"


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """Names of the rules that a row breaks, as one expression."""
    broken = [F.expr(f"if({_measure(r)} {r.comparison} {r.bound!r}D, null, '{r.name}')") for r in rules]
    return F.array_compact(F.array(*broken))


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id and the counted columns) for each row."""
    def drop(chars: str) -> Column:
        return F.char_length(F.translate("_t", chars, ""))

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_t"))
    d = d.select("doc_id", "_t",
                 F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_words"),
                 F.filter(F.split("_t", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    size = F.size("_words")
    d = d.select(
        "doc_id", "_t", "_words", size.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_lines", lambda s: s.rlike(r"\.\.\.[\x20\x09-\x0D]*$"))).cast("long").alias("n_open_lines"),
        F.when(size >= WINDOW, F.transform(F.sequence(F.lit(1), size - (WINDOW - 1)),
                                           lambda i: F.xxhash64(F.slice("_words", i, WINDOW))))
        .otherwise(F.array().cast("array<long>")).alias("_h"))
    d = d.select(
        "doc_id", "n_words", "n_lines", "n_dup_lines", "n_open_lines",
        drop(" \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (F.char_length("_t") - drop("#*$%&|<>")).cast("long").alias("n_symbols"),
        (F.char_length("_t") - drop("!")).cast("long").alias("n_exclamations"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_words", lambda w: ~w.rlike(r"\p{L}"))).cast("long").alias("n_letterless"),
        F.size(F.filter("_words", lambda w, i: (i > 0) & (F.get("_words", i - 1) == w))).cast("long").alias("n_stutters"),
        F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
               F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .alias("_sorted"))
    last = F.size("_sorted") - 1

    def hash_at(k: Column) -> Column:
        return F.get("_sorted", k)["h"]

    repeated = F.filter("_sorted", lambda x, k: ((k > 0) & (hash_at(k - 1) == x["h"]))
                        | ((k < last) & (hash_at(k + 1) == x["h"])))
    d = d.withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    covered = F.aggregate(
        "_at", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, p: F.struct((p + WINDOW).alias("end"),
                                (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n")),
        lambda acc: acc["n"])
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_sorted", "_at")


def evaluate(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, base_failed, broken_rules and kept for each row."""
    d = counts(docs)
    base = ((F.col("n_words") < MIN_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))
    d = d.withColumn("base_failed", base).withColumn("broken_rules", compile_rules(rules))
    return d.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over all of ``documents``."""
    return evaluate(table(spark, sf_dir, "documents")).select(*RESULT)


def op6_sql() -> str:
    """The same in DuckDB, with windows as rows."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)

    def ratio(r: Rule) -> str:
        top, bottom = r.measure.split(" / ")
        return f"coalesce(cast({top} as double) / nullif({bottom}, 0), 0.0)"

    verdict = " and ".join(f"{ratio(r)} {r.comparison} {r.bound!r}" for r in RULES)
    return rf"""
with t as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
      from t),
g as (select doc_id, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') as gram
      from (select doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as i from w where len(words) >= {WINDOW})),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as k from g) where k > 1),
c as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + {WINDOW})) as p from r) group by doc_id),
m as (select w.doc_id, cast(len(words) as bigint) as n_words,
        cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(length(t) - length(replace(t, '!', '')) as bigint) as n_exclamations,
        cast(len(ls) as bigint) as n_lines,
        cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
        cast(len(list_filter(ls, lambda x: regexp_matches(x, '\.\.\.[\x20\x09-\x0D]*$'))) as bigint) as n_open_lines,
        cast(len(list_filter(words, lambda x: lower(x) in ({stops}))) as bigint) as n_stop_words,
        cast(len(list_filter(words, lambda x: not regexp_matches(x, '\p{{L}}'))) as bigint) as n_letterless,
        cast(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) as bigint) as n_stutters,
        cast(coalesce(c.n, 0) as bigint) as n_repeat_words
      from w left join c on w.doc_id = c.doc_id),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from m)
select {', '.join(RESULT[:-1])}, not base_failed and {verdict} as kept from b
"""
