"""Instruction refinement (R1-R10): pair x goal -> suggestion wave -> editor
wave -> parse, looped per chunk with the reference's fallback:

* a chunk with fewer than ``min_refinements`` pairs stops before the round;
* a chunk whose round produced nothing keeps its previous pairs and stops;
* otherwise the refined pairs replace the previous ones.

The per-chunk decisions are made on the keys ``(task, chunk_id)``; a chunk holds
at most 27 x p pairs, so no group grows with the corpus, and the pairs with their
answers stay where they are.  Chunks that stop are set aside: a round reads and
writes only the chunks that are still active, and the loop ends when there are
none.  Each round's result is written as parquet, and each wave of a model that
is called, so a lost executor never replays a call; the waves of a reply that is
an expression are one stage with the parser.  Pairs carry the keys of their seed
text and content.

Pairs that come with their chunk in one row (``generation.chunk_pairs``) stay there:
the rounds are expressions on its array, what a chunk keeps is decided in its row,
and nothing is written or moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import modified_pair, normalise_modified
from ..functions.prompts import (EDITOR_SYSTEM, GOALS, SUGGESTER_SYSTEM, editor_prompt,
                                 suggester_prompt)
from ..functions.text import is_missing, let
from ..session import written
from .completion import Prompt
from .generation import pair_rows

KEY = ["task", "chunk_id"]
PLACE = ["task", "chunk_id", "source", "text_key", "content_pos", "instr_pos", "block_pos"]
PAIR = [*PLACE, "agent", "instruction_agent", "content_key", "transformation_type",
        "instruction", "answer", "pair_id", "goal_no", "round", "parent_pair_id", "done"]

#: Most chunks that stop in a round whose keys are broadcast.
STOPPED_KEYS = 100_000


def refine_start(pairs: DataFrame) -> DataFrame:
    """Keep pairs with both fields, add round bookkeeping."""
    return (pairs.filter(~is_missing(F.col("instruction")) & ~is_missing(F.col("answer")))
            .withColumn("goal_no", F.lit(None).cast("int"))
            .withColumn("round", F.lit(0))
            .withColumn("parent_pair_id", F.lit(None).cast("string"))
            .withColumn("done", F.lit(False))
            .select(*PAIR))


def _suggestions(r: DataFrame) -> DataFrame:
    return (r.withColumn("system_prompt", F.lit(SUGGESTER_SYSTEM))
            .withColumn("user_prompt", suggester_prompt(F.col("instruction"), F.col("answer"), F.col("goal"))))


def _edits(r: DataFrame) -> DataFrame:
    return (r.withColumn("system_prompt", F.lit(EDITOR_SYSTEM))
            .withColumn("user_prompt", editor_prompt(F.col("instruction"), F.col("answer"), F.col("suggestions"))))


def _settled(rows: DataFrame, completer, name: str) -> DataFrame:
    """Rows with a reply, written where a model was called for it."""
    return rows if completer.inline else written(rows, name)


def _replied(rows: DataFrame, out: str) -> DataFrame:
    """Rows whose reply is not missing; exploded, as a filter would be pushed below
    the reply and make it again."""
    reply = F.filter(F.array(out), lambda r: ~is_missing(r))
    return rows.select(*[c for c in rows.columns if c != out], F.explode(reply).alias(out))


def _stopped(active: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """The active pairs of chunks without a new one.  Keys are compared first;
    the pairs themselves are only moved where more chunks stop than can be
    broadcast."""
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    made = new.select(*[F.col(k).alias(f"_{k}") for k in KEY]).distinct()
    gone = active.select(*KEY).distinct().join(made, same, "left_anti")
    gone = written(gone.select(*[F.col(k).alias(f"_{k}") for k in KEY]), name)
    return active.join(F.broadcast(gone) if gone.count() <= STOPPED_KEYS else gone, same, "left_semi")


def refine_round(active: DataFrame, completer, round_no: int, min_refinements: int = 1,
                 goals: list[str] | None = None, mcq_fallback: str = "full") -> tuple[DataFrame, DataFrame]:
    """One round over the active pairs: (pairs of the chunks that were refined,
    pairs of the chunks that stop, marked ``done``)."""
    goals = goals or GOALS
    x = active
    if min_refinements > 1:  # a chunk that is active has a pair
        enough = active.groupBy(*KEY).count().filter(F.col("count") >= min_refinements).select(*KEY)
        x = active.join(enough, KEY, "left_semi")
    x = x.drop("goal_no")
    x = x.select("*", F.posexplode(F.array(*[F.lit(g) for g in goals])).alias("_g", "goal"))
    x = x.withColumn("goal_no", (F.col("_g") + 1).cast("int")).drop("_g")
    pair = [F.col("instruction"), F.col("answer")]
    srep = completer.ask(x, Prompt([F.lit("suggest"), *pair, F.col("goal")], _suggestions), "suggestions",
                         wave=f"suggest_r{round_no}")
    sok = _replied(_settled(srep.drop("goal"), completer, f"suggest-{round_no}"), "suggestions")
    erep = completer.ask(sok, Prompt([F.lit("edit"), *pair, F.col("suggestions")], _edits), "modified",
                         wave=f"edit_r{round_no}")
    # only what the result needs, and the reply normalised once: the parser reads it many times
    erep = erep.select(*PLACE, "instruction_agent", "content_key", "transformation_type", "pair_id", "goal_no",
                       normalise_modified(F.col("modified")).alias("_t"))
    erep = _settled(erep, completer, f"edit-{round_no}")
    # exploded, as filters on a column would be pushed below it and parse each reply again;
    # a missing reply makes no pair
    made = F.array(modified_pair(F.col("_t"), mcq_fallback, F.col("_t")))
    whole = F.filter(made, lambda m: m.isNotNull() & ~is_missing(m["instruction"]) & ~is_missing(m["answer"]))
    new = (erep.select("*", F.explode(whole).alias("_m"))
           .select(*PLACE,
                   F.format_string(f"Refinement Round {round_no}, Goal %d", F.col("goal_no")).alias("agent"),
                   "instruction_agent", "content_key", "transformation_type",
                   F.col("_m.instruction").alias("instruction"),
                   F.col("_m.answer").alias("answer"),
                   F.md5(F.concat(F.col("pair_id"), F.lit(f"|r{round_no}g"),
                                  F.col("goal_no").cast("string"))).alias("pair_id"),
                   "goal_no", F.lit(round_no).alias("round"),
                   F.col("pair_id").alias("parent_pair_id"), F.lit(False).alias("done")))
    new = written(new.select(*PAIR), f"round-{round_no}")
    return new, _stopped(active, new, f"stopped-{round_no}").withColumn("done", F.lit(True)).select(*PAIR)


def _whole(p: Column) -> Column:
    return ~is_missing(p["instruction"]) & ~is_missing(p["answer"])


#: Fields of a pair in its chunk's row that a round leaves as they are.
KEPT = ["content_no", "instr_pos", "block_pos", "instruction_agent"]


def _chunk_round(pairs: Column, completer, round_no: int, goals: list[str], mcq_fallback: str) -> Column:
    """The array of a round's new pairs of an array of pairs."""
    def of_pair(p):
        both = [p["instruction"], p["answer"]]

        def of_goal(g, i):
            goal_no = (i + 1).cast("int")
            suggestions = completer.reply(F.lit(SUGGESTER_SYSTEM), suggester_prompt(*both, g))

            def edited(s):
                reply = completer.reply(F.lit(EDITOR_SYSTEM), editor_prompt(*both, s))
                return F.when(~is_missing(s), let(normalise_modified(reply), lambda t: modified_pair(t, mcq_fallback, t)))

            return let(let(suggestions, edited), lambda m: F.when(m.isNotNull() & _whole(m), F.struct(
                *[p[c].alias(c) for c in KEPT],
                F.format_string(f"Refinement Round {round_no}, Goal %d", goal_no).alias("agent"),
                m["instruction"].alias("instruction"), m["answer"].alias("answer"),
                F.md5(F.concat(p["pair_id"], F.lit(f"|r{round_no}g"), goal_no.cast("string"))).alias("pair_id"),
                goal_no.alias("goal_no"), F.lit(round_no).alias("round"), p["pair_id"].alias("parent_pair_id"),
                F.lit(False).alias("done"))))

        return F.filter(F.transform(F.array(*[F.lit(g) for g in goals]), of_goal), lambda x: x.isNotNull())

    return F.flatten(F.transform(pairs, of_pair))


def refine_chunks(chunks: DataFrame, completer, max_rounds: int = 1, min_refinements: int = 1,
                  goals: list[str] | None = None, mcq_fallback: str = "full") -> DataFrame:
    """``refine`` of the rows of ``generation.chunk_pairs``."""
    kept = [*KEPT, "agent", "instruction", "answer", "pair_id"]

    def marked(pairs, done, **more):
        names = [c for c in [*kept, "goal_no", "round", "parent_pair_id"] if c not in more]
        return F.transform(pairs, lambda p: F.struct(
            *[p[c].alias(c) for c in names], *[v.alias(c) for c, v in more.items()], F.lit(done).alias("done")))

    def round_of(r):
        def step(pairs):
            # a chunk's pairs are done together
            going = ~F.get(pairs, F.lit(0))["done"] & (F.size(pairs) >= min_refinements)
            new = F.when(going, _chunk_round(pairs, completer, r, goals or GOALS, mcq_fallback))
            return let(new, lambda n: F.when(F.size(n) > 0, n).when(F.get(pairs, F.lit(0))["done"], pairs)
                       .otherwise(marked(pairs, True)))
        return step

    pairs = marked(F.filter("pairs", _whole), False, goal_no=F.lit(None).cast("int"), round=F.lit(0),
                   parent_pair_id=F.lit(None).cast("string"))
    for r in range(1, max_rounds + 1):
        pairs = let(pairs, round_of(r))
    return pair_rows(chunks, pairs, PAIR)


def refine(pairs: DataFrame, completer, max_rounds: int = 1, min_refinements: int = 1,
           goals: list[str] | None = None, mcq_fallback: str = "full") -> DataFrame:
    """``refine_instructions``: up to ``max_rounds`` rounds per chunk (none: the
    valid pairs as they are).  ``pairs``: rows, or chunks with their pairs."""
    if "pairs" in pairs.columns:
        return refine_chunks(pairs, completer, max_rounds, min_refinements, goals, mcq_fallback)
    active, aside = refine_start(written(pairs, "pairs")), []
    for r in range(1, max_rounds + 1):
        if not active.take(1):
            break
        active, stopped = refine_round(active, completer, r, min_refinements, goals, mcq_fallback)
        aside.append(stopped)
    for stopped in aside:
        active = active.unionByName(stopped)
    return active
