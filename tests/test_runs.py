"""Committed runs, the progress log, files that cannot be read."""
import json
import shutil

import pandas as pd
import pytest

from seedwright.jobs import run as jobs
from seedwright.jobs.run import JobConfig, run
from seedwright.operators.completion import BatchCompleter
from seedwright.operators.output import commits, read_records
from seedwright.operators.selection import compact_progress, due_chunks, fold_states, read_states, run_states
from seedwright.sources.catalog import load_catalog
from seedwright.sources.files import file_status
from seedwright.sources.tables import TableResolver, TableSource, read_sources, resolve_specs

TASK = "reading_comprehension"


def make_model():
    def model(pdf: pd.DataFrame) -> pd.Series:
        return pd.Series([None if "poison" in u else "Instruction: Ask?\nAnswer: Tell." for u in pdf["user_prompt"]])
    return model


def job(spark, root, texts, **options):
    seeds = root / "seeds"
    if not seeds.exists():
        spark.createDataFrame(list(enumerate(texts)), "k long, text string").write.parquet(str(seeds))
    res = TableResolver(tables={"seeds": TableSource(str(seeds), order_col="k")})
    comp = BatchCompleter(make_model(), "m", str(root / "store"), attempts=1, buckets=2)
    return run(spark, ["seeds"], res, load_catalog(spark, tasks=[TASK]), comp, str(root / "out"), str(root / "progress"),
               [TASK], JobConfig(rounds=0, agents=1, **options))


def test_a_run_that_breaks_off_counts_for_nothing(spark, tmp_path, monkeypatch):
    assert read_records(spark, str(tmp_path / "out")) is None
    plain = jobs.run_states

    def broken(*a, **k):
        raise RuntimeError("between records and progress")

    monkeypatch.setattr(jobs, "run_states", broken)
    with pytest.raises(RuntimeError):
        job(spark, tmp_path, ["one", "two"])
    assert len(list((tmp_path / "out").glob("run=*"))) == 1  # its records stand there
    assert read_records(spark, str(tmp_path / "out")) is None and commits(spark, str(tmp_path / "out")) == []
    monkeypatch.setattr(jobs, "run_states", plain)
    monkeypatch.setattr(jobs, "commit", broken)
    with pytest.raises(RuntimeError):
        job(spark, tmp_path, ["one", "two"])
    monkeypatch.undo()
    a = job(spark, tmp_path, ["one", "two"])
    assert a["chunks"] == {"processed_chunk": 2} and len(list((tmp_path / "out").glob("run=*"))) == 3
    assert read_records(spark, str(tmp_path / "out")).count() == 2  # each record once
    b = job(spark, tmp_path, ["one", "two"])
    assert b["chunks"] == {} and read_records(spark, str(tmp_path / "out")).count() == 2
    assert [c["seq"] for c in commits(spark, str(tmp_path / "out"))] == [1, 2]


def test_three_attempts(spark, tmp_path):
    texts = ["one", "poison"]
    for k in range(3):
        got = job(spark, tmp_path, texts, max_attempts=3)
        assert got["chunks"] == ({"processed_chunk": 1, "error_chunk": 1} if k == 0 else {"error_chunk": 1})
        if k == 1:
            compact_progress(spark, str(tmp_path / "out"), str(tmp_path / "progress"))
            # the snapshot stands for the runs before it
            for p in (tmp_path / "progress").glob("run=*"):
                shutil.rmtree(p)
    states = sorted((r.status, r.attempts) for r in read_states(spark, str(tmp_path / "out"), str(tmp_path / "progress")).collect())
    assert states == [("error_chunk", 3), ("processed_chunk", 1)]
    assert job(spark, tmp_path, texts, max_attempts=3)["chunks"] == {}
    assert job(spark, tmp_path, texts, max_attempts=0)["chunks"] == {"error_chunk": 1}  # no limit


def test_states_fold_in_any_grouping(spark):
    rows = [("t", f"k{i % 4}", "c", ("error_chunk", "empty_chunk", "processed_chunk")[i % 3], i % 5, 1, i) for i in range(30)]
    log = spark.createDataFrame(rows, "task string, chunk_key string, config string, status string, n_pairs long, attempts long, at long")
    want = sorted(map(tuple, fold_states(log).collect()))
    for cut in (0, 7, 29):
        parts = fold_states(log.filter(f"at <= {cut}")).unionByName(log.filter(f"at > {cut}"))
        assert sorted(map(tuple, fold_states(parts).collect())) == want
    last = {k: max((r for r in rows if r[1] == k), key=lambda r: r[6]) for k in ("k0", "k1", "k2", "k3")}
    assert [(w[1], w[3], w[4]) for w in want] == [(k, r[3], r[4]) for k, r in sorted(last.items())]
    chunks = spark.createDataFrame([("t", f"k{i}", i) for i in range(6)], "task string, chunk_key string, n long")
    got = {r.chunk_key for r in due_chunks(chunks, fold_states(log), "c").collect()}
    assert got == {"k4", "k5"} | {k for k, r in last.items() if r[3] == "error_chunk"}
    assert due_chunks(chunks, fold_states(log), "other").count() == 6
    twice = spark.createDataFrame([("t", "k", "error_chunk", 0), ("t", "k", "processed_chunk", 4), ("t", "j", "empty_chunk", 0)],
                                  "task string, chunk_key string, status string, n_pairs long")
    assert sorted((r.chunk_key, r.status, r.n_pairs, r.attempts) for r in run_states(twice, "c", 9).collect()) == \
        [("j", "empty_chunk", 0, 1), ("k", "processed_chunk", 4, 1)]


def test_damaged_files_are_set_aside(spark, tmp_path):
    for i in range(5):
        rows = [(i * 1000 + j, f"text {i} {j} " + chr(97 + j % 26) * (j % 50)) for j in range(1000)]
        spark.createDataFrame(rows, "k long, text string").coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        (tmp_path / "t").mkdir(exist_ok=True)
        [part] = (tmp_path / f"p{i}").glob("*.parquet")
        shutil.copy(part, tmp_path / "t" / f"{i}.parquet")
    spark.createDataFrame([], "k long, text string").coalesce(1).write.parquet(str(tmp_path / "none"))
    for part in (tmp_path / "none").glob("*.parquet"):
        shutil.copy(part, tmp_path / "t" / "5.parquet")
    (tmp_path / "t" / "1.parquet").write_bytes(b"PAR1 nothing that follows is a footer")
    data = bytearray((tmp_path / "t" / "3.parquet").read_bytes())
    end = int.from_bytes(data[-8:-4], "little") + 8
    data[40:-end] = bytes(len(data) - end - 40)  # the pages of both columns; the footer is whole
    (tmp_path / "t" / "3.parquet").write_bytes(bytes(data))
    got = {r.path[-9:]: (r.rows, r.status) for r in file_status(spark, str(tmp_path / "t"), "parquet", ["text", "k"]).collect()}
    assert {p for p, (_, s) in got.items() if s != "ok"} == {"1.parquet", "3.parquet"}
    assert got["0.parquet"] == (1000, "ok") and got["1.parquet"][1] == "error: no footer"
    for order in ("k", None):
        res = TableResolver(tables={"t": TableSource(str(tmp_path / "t"), order_col=order, check_files=True)})
        read = read_sources(spark, resolve_specs(["t"]), res)
        assert read.status == [("t", "train", "ok")] and read.files.filter("status <> 'ok'").count() == 2
        assert read.frame.count() == 3000
        assert {r.text.split()[1] for r in read.frame.select("text").collect()} == {"0", "2", "4"}


def test_job_reports_damaged_files(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([(i, f"text {i}")], "k long, text string").coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        (tmp_path / "t").mkdir(exist_ok=True)
        [part] = (tmp_path / f"p{i}").glob("*.parquet")
        shutil.copy(part, tmp_path / "t" / f"{i}.parquet")
    (tmp_path / "t" / "0.parquet").write_bytes(b"x" * 100)
    res = TableResolver(tables={"t": TableSource(str(tmp_path / "t"), order_col="k", check_files=True)})
    comp = BatchCompleter(make_model(), "m", str(tmp_path / "store"), attempts=1, buckets=2)
    got = run(spark, ["t"], res, load_catalog(spark, tasks=[TASK]), comp, str(tmp_path / "out"), str(tmp_path / "p"), [TASK],
              JobConfig(rounds=0, agents=1))
    assert got["chunks"] == {"processed_chunk": 1}
    assert [(x[0], x[1][-9:], x[2]) for x in got["unreadable_files"]] == [("t", "0.parquet", "error: no footer")]
    [record] = [json.loads(x) for p in (tmp_path / "out").glob("run=*/**/*.json") for x in p.read_text().splitlines()]
    assert record["messages"][0]["content"] == "Ask?"
