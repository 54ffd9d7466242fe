"""A round of refinement leaves the pairs where they are; replies hold long texts once."""
import hashlib

from pyspark.sql import functions as F

from seedwright import session
from seedwright.functions.prompts import EDITOR_SYSTEM, INSTRUCTION_TAIL, SUGGESTER_USER, editor_prompt
from seedwright.functions.text import with_long
from seedwright.operators.completion import OfflineCompleter, _reply_spec
from seedwright.operators.refinement import refine

PAIR = ("task string, chunk_id long, source string, text_key binary, content_pos int, instr_pos int, block_pos int, "
        "agent string, instruction_agent string, content_key binary, transformation_type string, instruction string, "
        "answer string, pair_id string")


def _pairs(spark, n=60):
    row = ("s", b"t", 0, 0, 0, "ag", "ag", b"c", "ty")
    return spark.createDataFrame([("t", i // 2, *row, f"Q{i}", f"A{i}", f"p{i}") for i in range(n)], PAIR)


def test_a_round_moves_keys_only(spark, monkeypatch):
    names, plain = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, name: names.append(name) or plain(s, name))
    got = refine(_pairs(spark), OfflineCompleter("offline"), mcq_fallback="parity")
    assert not any(n.startswith(("suggest", "edit")) for n in names) and "round-1" in names
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    rows = got.collect()
    refined = {r.chunk_id for r in rows if r.round == 1}
    stopped = {r.chunk_id for r in rows if r.round == 0}
    assert refined and not refined & stopped and refined | stopped == set(range(30))
    assert all(r.done == (r.round == 0) for r in rows)


def test_chunks_that_stop_keep_their_pairs(spark, monkeypatch):
    from seedwright.operators import refinement
    pairs, comp = _pairs(spark, 40), OfflineCompleter("offline")
    few = refine(pairs, comp, min_refinements=3)
    assert sorted(r.pair_id for r in few.collect()) == sorted(f"p{i}" for i in range(40))
    broadcast = sorted(map(str, refine(pairs, comp, max_rounds=3).collect()))
    monkeypatch.setattr(refinement, "STOPPED_KEYS", -1)
    assert sorted(map(str, refine(pairs, comp, max_rounds=3).collect())) == broadcast
    lost = pairs.withColumn("chunk_id", F.when(F.col("chunk_id") > 3, F.col("chunk_id")))
    assert refine(lost, comp, min_refinements=99).count() == 40


def test_long_texts_are_put_in_as_replace_does(spark):
    marks = ["{text}", "a{text}", "{text}b", "a {text} b{text}{text}", "none", "", "{TEXT}", "$1\\{text}\\E", None]
    rows = [(m, t) for m in marks for t in ("x" * 5000, "", "{text}", "$0 \\ é", None)]
    df = spark.createDataFrame(rows, "m string, t string")
    for m, t, got in df.select("m", "t", with_long(F.col("m"), "{text}", F.col("t"))).collect():
        if m is None or t is None:
            assert got is None or "{text}" not in (m or "")
        else:
            assert got == m.replace("{text}", t)
    assert "replace(" not in df.select(with_long(F.col("m"), "{text}", F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def _reply(kind, system, user, texts):
    h = hashlib.md5(f"{system}\x01{user}".encode()).hexdigest()
    parts = next(p for digits, p in _reply_spec()[kind] if h[0] in digits or digits == "*")
    if parts is None:
        return None
    return "".join(h[p[0] - 1:p[0] - 1 + p[1]] if isinstance(p, tuple) else texts.get(p, p) for p in parts).strip()


def test_texts_of_a_reply_are_not_looked_through(spark):
    """An answer that holds a token of the reply's template had the body put into it."""
    pairs = [(f"Q{i} \x02ANSWER\x03", f"A{i} \x02BODY\x03 \x023,6\x03", "s") for i in range(60)]
    df = spark.createDataFrame(pairs, "i string, a string, s string").select(
        "*", F.lit(EDITOR_SYSTEM).alias("sys"), editor_prompt(F.col("i"), F.col("a"), F.col("s")).alias("usr"))
    got = OfflineCompleter("m").complete(df, "sys", "usr", "reply").collect()
    assert [r.reply for r in got] == [_reply("edit", r.sys, r.usr, {"BODY": r.i, "ANSWER": r.a}) for r in got]
    assert sum("BODY" in (r.reply or "") for r in got) > 0


def test_kind_of_a_prompt_is_that_of_its_first_marker(spark):
    suggest = SUGGESTER_USER.format(instruction="q", answer="a", goal="g")
    prompts = {f"{i} text\n\n{INSTRUCTION_TAIL}": "instruct" for i in range(20)}
    prompts |= {f"{i} {suggest}": "suggest" for i in range(20)}
    prompts |= {f"{i} {suggest} \n\n{INSTRUCTION_TAIL}": "suggest" for i in range(20)}
    prompts |= {f"{i} Modified Instruction: {suggest}": "edit" for i in range(20)}
    prompts |= {f"{i} {INSTRUCTION_TAIL} more": "instruct" for i in range(20)}
    prompts |= {f"{i} plain": "content" for i in range(20)}
    df = spark.createDataFrame([(u,) for u in prompts], "usr string").withColumn("sys", F.lit("s"))
    for r in OfflineCompleter("m").complete(df, "sys", "usr", "reply").collect():
        kind, u = prompts[r.usr], r.usr
        body = u.split("\n\nThe provided content")[0] if kind == "instruct" else "q"
        answer = u.split("\n\nOriginal answer:\n")[-1]
        assert r.reply == _reply(kind, "s", u, {"PROMPT": u, "BODY": body, "ANSWER": answer})
    nothing = spark.createDataFrame([(f"s{i}", None) for i in range(40)], "sys string, usr string")
    got = {r.reply for r in OfflineCompleter("m").complete(nothing, "sys", "usr", "reply").collect()}
    assert got <= {None, "IRRELEVANT", "irrelevant", "IRRELEVANT."}
