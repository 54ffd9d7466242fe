"""The job from sources to sinks, with values written out by hand."""
import json
from pathlib import Path

import pandas as pd
import pytest

from seedwright.jobs.run import JobConfig, build_chunks, run
from seedwright.operators.chunking import pack_sources
from seedwright.operators.completion import BatchCompleter
from seedwright.operators.mcq import inspect_rows, mcq_filter
from seedwright.operators.output import write_jsonl, write_samples
from seedwright.operators.refinement import refine
from seedwright.operators.texts import TextStore
from seedwright.sources.catalog import load_catalog
from seedwright.sources.samples import flat_samples, read_samples
from seedwright.sources.tables import TableResolver, TableSource, read_sources, resolve_specs

TASK = "reading_comprehension"


def make_model():
    """A function that travels by value."""
    def model(pdf: pd.DataFrame) -> pd.Series:
        """A stand-in client: edits, suggestions, one pair per content, by prompt."""
        from seedwright.functions.prompts import EDITOR_MARKER, INSTRUCTION_MARKER, SUGGESTER_MARKER
        out = []
        for u in pdf["user_prompt"]:
            if "poison" in u:
                out.append(None)
            elif EDITOR_MARKER in u:
                out.append("Modified Instruction: Better?\nModified Answer: Best.")
            elif SUGGESTER_MARKER in u:
                out.append("Say more.")
            elif INSTRUCTION_MARKER in u:
                out.append("Instruction: Ask?\nAnswer: Tell.")
            else:
                out.append(" IRRELEVANT " if "dull" in u else "the content: " + u[-40:])
        return pd.Series(out)
    return model


MODEL = make_model()


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    rows = [(i, t) for i, t in enumerate(["first text", "dull text", "", None, "poison text", "last text"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(root / "seeds"))
    res = TableResolver(tables={"seeds": TableSource(str(root / "seeds"), order_col="doc_id")})
    comp = BatchCompleter(MODEL, "m", str(root / "store"), attempts=1)
    return spark, root, res, load_catalog(spark, tasks=[TASK]), comp


def lines(folder):
    return [json.loads(x) for p in sorted(Path(folder).glob("run=*/**/*.json")) for x in p.read_text().splitlines()]


def test_run_and_rerun(world):
    spark, root, res, cat, comp = world
    cfg = JobConfig(rounds=1)
    a = run(spark, ["seeds", "nowhere"], res, cat, comp, str(root / "out"), str(root / "progress"), [TASK], cfg)
    assert a["chunks"] == {"processed_chunk": 2, "empty_chunk": 1, "skipped_chunk": 2, "error_chunk": 1}
    assert a["sources"][0] == ("seeds", "train", "ok") and a["sources"][1][2].startswith("error: ")
    out = lines(root / "out")
    # 2 chunks x 3 contents x 3 instructions x 3 goals
    assert len(out) == 54
    assert set(out[0]) == {"messages", "metadata"}
    assert out[0]["messages"] == [{"role": "user", "content": "Better?"}, {"role": "assistant", "content": "Best."}]
    b = run(spark, ["seeds"], res, cat, comp, str(root / "out"), str(root / "progress"), [TASK], cfg)
    assert b["chunks"] == {"error_chunk": 1} and len(lines(root / "out")) == 54  # only the failed one again
    c = run(spark, ["seeds"], res, cat, comp, str(root / "out"), str(root / "progress"), [TASK], JobConfig(rounds=0))
    assert c["chunks"]["processed_chunk"] == 2  # another configuration
    assert len(lines(root / "out")) == 54 + 18


def test_two_limited_runs_equal_one(world):
    spark, root, res, cat, comp = world
    one = run(spark, ["seeds"], res, cat, comp, str(root / "o1"), str(root / "p1"), [TASK], JobConfig(rounds=0))
    run(spark, ["seeds"], res, cat, comp, str(root / "o2"), str(root / "p2"), [TASK], JobConfig(rounds=0, max_chunks=2))
    run(spark, ["seeds"], res, cat, comp, str(root / "o2"), str(root / "p2"), [TASK], JobConfig(rounds=0))
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(lines(root / "o1"), key=key) == sorted(lines(root / "o2"), key=key)
    assert one["chunks"]["processed_chunk"] == 2


def test_sources_report_splits_and_take_any_order(spark, tmp_path):
    spark.createDataFrame([("b", "fr", "y"), ("a", "en", "x")], "name_id string, lang string, text string") \
        .coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(1, "en", "x"), (2, "fr", "y"), (3, "en", None)], "k long, lang string, text string") \
        .write.parquet(str(tmp_path / "u"))
    res = TableResolver(tables={"t": TableSource(str(tmp_path / "t")), "t2": TableSource(str(tmp_path / "t"), order_col="name_id"),
                                "u": TableSource(str(tmp_path / "u"), split_col="lang", order_col="k"),
                                "v": TableSource(str(tmp_path / "u"), order_col="nope")})
    got = read_sources(spark, resolve_specs(["u:text:fr,en,xx:5", "v"]), res)
    assert [s[2] for s in got.status] == ["ok", "ok", "missing", "error: no column nope"]
    rows = sorted((r.split, r.split_ord, r.ord, r.text, r.min_chars) for r in got.frame.collect())
    assert rows == [("en", 1, 1, "x", 5), ("en", 1, 3, None, 5), ("fr", 0, 2, "y", 5)]
    assert got.frame._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    for spec, want in (("t", ["y", "x"]), ("t2", ["x", "y"])):  # by place in the file, by name
        texts = TextStore(spark)
        chunks, report = build_chunks(spark, [spec], res, JobConfig(), texts)
        assert [r.text for r in texts.attach(chunks, "seeds").orderBy("chunk_id").collect()] == want
        assert report["read"] == {"rows": 2, "null_texts": 0, "empty_texts": 0}


@pytest.mark.parametrize("chunking,want", [("pack", ["aa bb", "cc  dd"]), ("slice", ["aa b", "b cc", "  dd"])])
def test_chunking_modes_of_the_job(spark, tmp_path, chunking, want):
    spark.createDataFrame([(1, "aa"), (2, "bb"), (3, None), (4, "cc"), (5, ""), (6, "dd")], "k long, text string") \
        .write.parquet(str(tmp_path / "t"))
    res = TableResolver(tables={"t": TableSource(str(tmp_path / "t"), order_col="k")})
    texts = TextStore(spark)
    chunks, report = build_chunks(spark, ["t"], res, JobConfig(chunking=chunking, min_chars=4, slice_size=4), texts)
    assert [r.text for r in texts.attach(chunks, "seeds").orderBy("chunk_id").collect()] == want
    assert report["read"] == {"rows": 6, "null_texts": 1, "empty_texts": 1}


def test_each_source_packs_to_its_own_minimum(spark):
    rows = spark.createDataFrame([("a", 0, "train", 0, i, "xx", 5) for i in range(4)]
                                 + [("b", 1, "train", 0, i, "yy", None) for i in range(3)],
                                 "source string, source_ord int, split string, split_ord int, ord long, text string, min_chars int")
    got = [(r.source, r.chunk_no, r.text) for r in pack_sources(rows).orderBy("source", "chunk_no").collect()]
    assert got == [("a", 0, "xx xx"), ("a", 1, "xx xx"), ("b", 0, "yy"), ("b", 1, "yy"), ("b", 2, "yy")]


PAIR = ("task string, chunk_id long, source string, text_key binary, content_pos int, instr_pos int, block_pos int, "
        "agent string, instruction_agent string, content_key binary, transformation_type string, instruction string, "
        "answer string, pair_id string")


def test_rounds_fall_back_by_chunk(spark, tmp_path):
    pairs = spark.createDataFrame(
        [("t", 1, "s", b"text one", 0, 0, 0, "ag", "ag", b"content one", "ty", "Q1", "A1", "p1"),
         ("t", 1, "s", b"text one", 0, 1, 0, "ag", "ag", b"content one", "ty", "", "A", "p2"),  # invalid: dropped
         ("t", 2, "s", b"text two", 0, 0, 0, "ag", "ag", b"content two", "ty", "Q poison", "A2", "p3")], PAIR)
    comp = BatchCompleter(MODEL, "m", str(tmp_path / "s"), attempts=1)
    got = sorted((r.chunk_id, r.instruction, r.answer, r.agent, r.round, bytes(r.text_key), bytes(r.content_key), r.done)
                 for r in refine(pairs, comp, max_rounds=1).collect())
    assert got == [(1, "Better?", "Best.", f"Refinement Round 1, Goal {g}", 1, b"text one", b"content one", False) for g in (1, 2, 3)] + \
        [(2, "Q poison", "A2", "ag", 0, b"text two", b"content two", True)]
    assert refine(pairs, comp, max_rounds=0).count() == 2
    assert refine(pairs, comp, max_rounds=1, min_refinements=2).filter("round = 1").count() == 0


def test_rounds_end_with_the_last_active_chunk(spark, tmp_path, monkeypatch):
    from seedwright.operators import refinement
    rounds = []
    plain = refinement.refine_round
    monkeypatch.setattr(refinement, "refine_round", lambda *a, **k: rounds.append(a[2]) or plain(*a, **k))
    row = ("s", b"t", 0, 0, 0, "ag", "ag", b"c", "ty")
    pairs = spark.createDataFrame([("t", 1, *row, "Q poison", "A", "p1"), ("t", 2, *row, "Q poison", "A", "p2")], PAIR)
    comp = BatchCompleter(MODEL, "m", str(tmp_path / "s"), attempts=1)
    got = refinement.refine(pairs, comp, max_rounds=5)
    assert rounds == [1] and sorted((r.chunk_id, r.round, r.done) for r in got.collect()) == [(1, 0, True), (2, 0, True)]
    rounds.clear()
    both = pairs.unionByName(spark.createDataFrame([("t", 3, *row, "Q", "A", "p3")], PAIR))
    got = refinement.refine(both, comp, max_rounds=2)
    assert rounds == [1, 2]
    assert sorted((r.chunk_id, r.round) for r in got.collect()) == [(1, 0), (2, 0)] + [(3, 2)] * 9


def test_sample_files_round_trip(spark, tmp_path):
    chats = spark.createDataFrame([([("user", "Q\nChoices:\nA) x\r\nB) y\t"), ("assistant", "B) y")], ("src", "m"))],
                                  "messages array<struct<role:string,content:string>>, metadata struct<source:string,model:string>")
    write_jsonl(chats, str(tmp_path / "c"))
    flat = flat_samples(read_samples(spark, str(tmp_path / "c")).rows)
    kept = mcq_filter(flat)
    assert [(r.answer, r.source) for r in kept.collect()] == [("B", "src")]
    write_samples(kept, str(tmp_path / "m"))
    assert read_samples(spark, str(tmp_path / "m")).rows.count() == 1
    [row] = inspect_rows(flat).collect()
    assert [c for c in row.choice_lines if c] == ["Choices:", "A) x", "B) y"] or row.choice_lines[-2:] == ["A) x", "B) y"]


def test_lines_that_do_not_parse_are_kept(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.jsonl").write_text('{"instruction": "i", "answer": "a"}\n\n{"instruction": "broken\n{"instruction": "j"}\n')
    (tmp_path / "s" / "b.jsonl").write_text('{"instruction": "k", "answer": "c", "agent": "g"}\nno json\n[1]\n')
    got = read_samples(spark, str(tmp_path / "s"))
    assert set(got.rows.columns) == {"instruction", "answer", "agent"}  # of both files
    assert sorted((r.instruction, r.answer, r.agent) for r in got.rows.collect() if r.instruction) == \
        [("i", "a", None), ("j", None, None), ("k", "c", "g")]
    bad = sorted((r.path[-7:], r.line, r.text) for r in got.errors.collect())
    assert ("a.jsonl", 3, '{"instruction": "broken') in bad and ("b.jsonl", 2, "no json") in bad
    assert got.rows.count() + got.errors.count() == 6  # every line that is not blank is one or the other
    with pytest.raises(ValueError, match="a.jsonl, line 3"):
        read_samples(spark, str(tmp_path / "s"), strict=True)
    chats = tmp_path / "c.jsonl"
    chats.write_text('{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "metadata": {"source": "s"}}\n{"messages": \n')
    got = read_samples(spark, str(chats))
    assert [(r.instruction, r.answer, r.source) for r in flat_samples(got.rows).collect()] == [("q", "a", "s")]
    assert [r.line for r in got.errors.collect()] == [2]


def test_whole_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"instruction": "i",\n "answer": "a"}, {"instruction": "j", "answer": "b"}]')
    (tmp_path / "b.json").write_text('{"instruction": "one",\n "answer": "x"}')
    (tmp_path / "c.json").write_text('[{"instruction": "i"')
    assert read_samples(spark, str(tmp_path / "a.json")).rows.count() == 2
    assert [r.answer for r in read_samples(spark, str(tmp_path / "b.json")).rows.collect()] == ["x"]
    got = read_samples(spark, str(tmp_path / "c.json"))
    assert got.rows.count() == 0 and [(r.line, r.text[:5]) for r in got.errors.collect()] == [(None, '[{"in')]
