"""Texts by content: what is written, hot keys; replies by bucket; calls in
flight."""
import os
import re
import threading
import time
from pathlib import Path

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from seedwright.jobs.run import JobConfig, PageInput, build_page_chunks, run
from seedwright.operators.agents import agent_prompts, drawn_agents
from seedwright.operators.completion import BatchCompleter, CallCompleter, ColumnCompleter, calls_in_flight
from seedwright.operators.responses import ResponseStore
from seedwright.operators.texts import TextStore, text_key
from seedwright.session import checkpoint_dir, scratch_scope
from seedwright.sources.catalog import load_catalog
from seedwright.sources.tables import TableResolver, TableSource


def files(folder):
    return {p for p in Path(folder).rglob("*.parquet")}


def strings(path):
    """All strings of a parquet file, by column."""
    t = pq.read_table(path)
    return {c: "\n".join(str(x) for x in t.column(c).to_pylist()) for c in t.column_names}


def test_only_the_store_holds_texts(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from seedwright.jobs import run as jobs
    rows = [(i, f"seedmark{i} " + os.urandom(15_000).hex()) for i in range(12)]
    spark.createDataFrame(rows, "k long, text string").coalesce(2).write.parquet(str(tmp_path / "seeds"))
    size = sum(f.stat().st_size for f in files(tmp_path / "seeds"))
    res = TableResolver(tables={"seeds": TableSource(str(tmp_path / "seeds"), order_col="k")})
    shown = F.when(F.col("user_prompt").contains("Modified Instruction:"), "Modified Instruction: Q\nModified Answer: A") \
        .when(F.col("user_prompt").contains("numbered list"), "1. more") \
        .when(F.col("user_prompt").contains("conciseness"), "Instruction: Q\nAnswer: A") \
        .otherwise(F.concat(F.lit("contentmark "), F.regexp_extract("user_prompt", "seedmark[0-9]+", 0), F.repeat(F.lit(" body"), 500)))
    comp = ColumnCompleter(lambda s, u: shown, "m")
    monkeypatch.setattr("seedwright.session.remove", lambda *a: None)  # keep what the run wrote
    before = files(checkpoint_dir(spark).removeprefix("file:"))
    got = jobs.run(spark, ["seeds"], res, load_catalog(spark), comp, str(tmp_path / "out"), str(tmp_path / "progress"),
                   cfg=JobConfig(rounds=1))
    assert got["chunks"] == {"processed_chunk": 12 * 17}
    assert got["replies"] == {"replies": 12 * 17 * 9, "replies_without_blocks": 0, "blocks_parsed": 12 * 17 * 9,
                              "blocks_without_marker": 0, "blocks_empty": 0}
    new = files(checkpoint_dir(spark).removeprefix("file:")) - before
    store = {f for f in new if "/texts-" in str(f)}
    assert store and all("/contents/" in str(f) for f in store)  # the seeds stay in their source
    for f in new - store:
        for column, text in strings(f).items():
            assert "seedmark" not in text and "contentmark" not in text, (f, column)
    # 17 tasks with 3 contents, 9 replies and 27 pairs a chunk: keys and pairs, a small part of a copy for each task
    assert sum(f.stat().st_size for f in new - store) < 17 * size / 3


def test_texts_beside_hot_keys_move_once(spark):
    """They were made equal by key, and then moved again by key and part."""
    texts = TextStore(spark, key_rows=3)
    rows = spark.range(200).select("id", F.when(F.col("id") < 20, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    lean = texts.keep(rows, "seeds")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = texts.attach(lean, "seeds")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Exchange hashpartitioning\([^)]*_part[^)]*\)[^\n]*\n[^\n]*SortAggregate", plan)
        assert sorted((r.id, r.text) for r in got.collect()) == sorted((i, "hot" if i < 20 else str(i)) for i in range(200))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key_rows", [20_000, 3])
def test_attach_deals_frequent_texts_over_parts(spark, key_rows):
    texts = TextStore(spark, key_rows=key_rows)
    rows = spark.createDataFrame([(i, "same") for i in range(50)] + [(50, "other"), (51, None), (52, "")], "n long, text string")
    for lean in (texts.keep(rows, "kept"), texts.refer(rows, "seeds")):
        assert lean.columns == ["n", "text_key"]
    got = texts.attach(lean, "seeds", out="t")
    assert sorted(map(tuple, got.select("n", "t").collect())) == [(i, "same") for i in range(50)] + [(50, "other"), (51, None), (52, None)]
    assert (texts.kinds["seeds"].hot is not None) == (key_rows == 3)
    if key_rows == 3:
        [h] = texts.kinds["seeds"].hot.collect()
        assert h._parts == 17 and texts.texts("seeds").count() == 2
    a, b = spark.createDataFrame([("x", "y")], "a string, b string").select(text_key(rows_col("a")), text_key(rows_col("b"))).first()
    assert len(a) == 16 and a != b


def test_few_wanted_texts_are_picked_in_the_scan(spark, monkeypatch):
    for most, joins in ((1_000_000, 1), (1, 0)):
        monkeypatch.setattr("seedwright.operators.texts.WANTED_KEYS", most)
        texts = TextStore(spark)
        lean = texts.keep(spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)], "n long, text string"), "seeds")
        texts.narrow("seeds", lean.filter("n in (1, 2, 8)"))
        assert texts.texts("seeds")._jdf.queryExecution().executedPlan().toString().count("LeftSemi") >= joins
        got = texts.attach(lean.filter("n in (1, 2, 8)"), "seeds").select("n", "text").collect()
        assert sorted(map(tuple, got)) == [(1, "text 1"), (2, "text 2"), (8, "text 1")]
        assert texts.texts("seeds").count() == (2 if joins else 7)


def rows_col(name):
    from pyspark.sql import functions as F
    return F.col(name)


def test_scope_removes_its_tables(spark):
    from seedwright.session import written
    with scratch_scope(spark, "t") as path:
        written(spark.range(3), "x")
        assert files(path.removeprefix("file:"))
    assert not Path(path.removeprefix("file:")).exists()
    with pytest.raises(RuntimeError), scratch_scope(spark, "t") as path:
        written(spark.range(3), "x")
        raise RuntimeError
    assert files(path.removeprefix("file:"))


def test_large_catalogue_is_not_broadcast(spark, monkeypatch):
    cat = load_catalog(spark, tasks=["reading_comprehension", "brain_teaser"])
    chunks = spark.createDataFrame([("reading_comprehension", i) for i in range(20)] + [("brain_teaser", 7)], "task string, chunk_id long")

    def draw():
        d = agent_prompts(drawn_agents(chunks, cat, "instruction", 3, 1, False, "pos", "name"), cat, "instruction")
        return sorted((r.task, r.chunk_id, r.pos, r.name, r.system_prompt, r.shot_answer or "") for r in d.collect())

    one = draw()
    assert len(one) == 63
    monkeypatch.setattr("seedwright.operators.agents.MAX_AGENTS", 1)
    assert draw() == one


# ------------------------------------------------------------------ reply store

def replies(spark, rows):
    return spark.createDataFrame([(i, c, e, a, c is not None) for i, c, e, a in rows],
                                 "request_id string, content string, error string, attempt int, answered boolean")


def test_store_side_does_not_move(spark, tmp_path):
    def model(pdf: pd.DataFrame) -> pd.Series:
        return pdf["user_prompt"].str.upper()

    comp = BatchCompleter(model, "m", str(tmp_path / "s"), buckets=4)
    df = spark.createDataFrame([(i, "sys", f"p{i % 30}") for i in range(60)], "id int, s string, u string")
    assert comp.complete(df, "s", "u", "reply", wave="w").filter("reply = upper(u)").count() == 60
    again = comp.complete(df, "s", "u", "reply", wave="w")
    again.collect()
    plan = again._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    join = plan[plan.index("SortMergeJoin"):]
    tree = [ln for ln in join.splitlines() if ln.strip()]
    scan = next(i for i, ln in enumerate(tree) if "Bucketed: true" in ln)
    # from the store's scan up to the join there is no exchange
    depth = len(tree[scan]) - len(tree[scan].lstrip(" :+-|"))
    for ln in reversed(tree[:scan]):
        d = len(ln) - len(ln.lstrip(" :+-|"))
        if d < depth:
            depth = d
            assert "Exchange" not in ln and "ShuffleQueryStage" not in ln, plan
    assert "Bucketed: true" in plan


def test_compaction_keeps_replies_and_errors(spark, tmp_path):
    store = ResponseStore(spark, str(tmp_path / "w"), 3)
    store.append(replies(spark, [("a", None, "first", 1), ("b", "B", None, 1), ("c", None, "e1", 1)]))
    store.append(replies(spark, [("a", "A", None, 2), ("c", None, "e2", 2), ("b", "late", None, 3)]))
    want = [("a", "A"), ("b", "B"), ("c", None)]
    for _ in range(2):
        got = sorted((r.request_id, r.content, r.error) for r in ResponseStore(spark, str(tmp_path / "w"), 3).latest().collect())
        assert [g[:2] for g in got] == want and got[2][2] == "e2"
        store.compact()
    assert store.generation == 2 and store.read().count() == 3
    store.append(replies(spark, [("d", "D", None, 1)]))
    assert ResponseStore(spark, str(tmp_path / "w"), 3).latest().count() == 4
    assert not (tmp_path / "w" / "gen=0").exists()
    other = ResponseStore(spark, str(tmp_path / "w"), 64)  # the folder's number holds
    assert other.buckets == 3 and sorted(r.request_id for r in other.latest().collect()) == ["a", "b", "c", "d"]
    (tmp_path / "v" / "gen=0").mkdir(parents=True)
    with pytest.raises(ValueError, match="number of buckets"):
        ResponseStore(spark, str(tmp_path / "v"), 3)


# --------------------------------------------------------------- calls in flight

def test_window_speed_and_retries():
    lock, now, most = threading.Lock(), [0], [0]

    def call(system, user):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.03)
        with lock:
            now[0] -= 1
        return user.upper()

    pulled = []

    def source():
        for i in range(60):
            pulled.append(i)
            yield (f"r{i}", "s", f"p{i}")

    t = time.monotonic()
    it = calls_in_flight(source(), call, window=10, tries=3, first_wait=0.1, jitter=0.1)
    first = next(it)
    assert len(pulled) <= 21  # the window bounds what is held
    got = [first, *it]
    assert time.monotonic() - t < 60 * 0.03 / 3  # ten at once, with room for a slow machine
    assert most[0] <= 10 and sorted(g[0] for g in got) == sorted(f"r{i}" for i in range(60))
    assert {g[1:] for g in got} == {(f"P{i}", None, 1) for i in range(60)}


def test_a_failing_request_delays_no_other():
    tried = []

    def call(system, user):
        if user == "bad":
            tried.append(time.monotonic())
            raise ValueError("no")
        if user == "none":
            return None
        time.sleep(0.01)
        return user

    requests = [("x", "s", "bad"), ("y", "s", "none")] + [(str(i), "s", "ok") for i in range(20)]
    t = time.monotonic()
    done = [(r, time.monotonic() - t) for r in calls_in_flight(requests, call, window=2, tries=3, first_wait=0.3, jitter=0.0)]
    when = {r[0]: s for r, s in done}
    assert max(when[str(i)] for i in range(20)) < 0.8 and when["x"] >= 0.85  # 0.3 s and 0.6 s of waiting
    res = {r[0]: r[1:] for r, _ in done}
    assert res["x"] == (None, repr(ValueError("no")), 3) and res["y"] == (None, "no reply", 3)
    assert 0.28 < tried[1] - tried[0] < 0.5 and 0.58 < tried[2] - tried[1] < 0.9


def test_call_completer(spark, tmp_path):
    def call(system, user):
        if user == "bad":
            raise ValueError("no")
        return f"  re: {user} "

    comp = CallCompleter(call, "m", str(tmp_path / "s"), in_flight=4, first_wait=0.01, requests_per_task=8, buckets=2)
    df = spark.createDataFrame([(i, "sys", "bad" if i == 3 else f"p{i}") for i in range(30)], "id int, s string, u string")
    out = comp.complete(df, "s", "u", "reply").orderBy("id").collect()
    assert [r.reply for r in out] == [None if i == 3 else f"re: p{i}" for i in range(30)]
    assert out[3].reply_error == repr(ValueError("no")) and out[4].reply_error is None


# --------------------------------------------------------------- paged documents

def stub():
    def extractor(content: bytes):
        """Pages are parted by a form feed; a page "!" fails."""
        for page in content.decode().split("\f"):
            if page == "!":
                raise ValueError("bad page")
            yield page
    return extractor


def test_pages_are_a_job_source(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "b.pdf").write_bytes("b  one\n\f \t\f b three ".encode())
    (docs / "a.pdf").write_bytes("a one\f!\fa three".encode())
    (docs / "c.pdf").write_bytes(b"\xff")
    (docs / "note.txt").write_bytes(b"no page")
    (docs / "sub").mkdir()
    (docs / "sub" / "d.pdf").write_bytes(b"not reached")
    texts = TextStore(spark)
    chunks, report = build_page_chunks(spark, PageInput(str(docs), stub()), texts)
    got = [(r.chunk_id, r.source, r.text) for r in texts.attach(chunks, "seeds").orderBy("chunk_id").collect()]
    assert got == [(0, "a.pdf", "a one"), (1, "b.pdf", "b one"), (2, "b.pdf", "b three")]
    assert [(s[0], s[2][:14]) for s in report["sources"]] == [("a.pdf", "error: page 2:"), ("c.pdf", "error: page 1:")]
    texts = TextStore(spark)
    chunks, _ = build_page_chunks(spark, PageInput(str(docs), stub(), pages=[3]), texts)
    assert [r.text for r in texts.attach(chunks, "seeds").collect()] == ["b three"]
    for empty in (docs / "sub" / "none", tmp_path):  # missing; without such files
        texts = TextStore(spark)
        assert build_page_chunks(spark, PageInput(str(empty), stub()), texts)[0].count() == 0
    cat = load_catalog(spark, tasks=["reading_comprehension"])
    comp = BatchCompleter(lambda pdf: pd.Series(["Instruction: Q\nAnswer: A"] * len(pdf)), "m", str(tmp_path / "s"), buckets=2)
    res = run(spark, [], None, cat, comp, str(tmp_path / "out"), str(tmp_path / "p"), cfg=JobConfig(rounds=0),
              pages=PageInput(str(docs), stub()))
    assert res["chunks"] == {"processed_chunk": 3} and len(res["sources"]) == 2 == res["failed_files"]


def test_a_large_file_leaves_in_parts():
    from seedwright.sources.pages import extracted_pages
    made = []

    def extractor(content):
        for i in range(10):
            made.append(i)
            yield "x" * 100

    it = iter(extracted_pages([("f", b"")], extractor, rows=4, chars=10_000))
    assert len(next(it)) == 4 and made == [0, 1, 2, 3]
    assert [len(x) for x in it] == [4, 2]
    assert [len(x) for x in extracted_pages([("f", b"")], extractor, rows=100, chars=250)] == [3, 3, 3, 1]
