"""Streaming driver: file batches through the whole job."""
import pandas as pd

from seedwright.jobs.run import JobConfig
from seedwright.operators.completion import BatchCompleter
from seedwright.operators.output import commits, read_records
from seedwright.operators.selection import read_states
from seedwright.sources.catalog import load_catalog
from seedwright.streaming.seed_stream import start_seed_stream

TASK = "reading_comprehension"


def make_model(calls):
    def model(pdf: pd.DataFrame) -> pd.Series:
        calls.add(len(pdf))
        return pd.Series([None if "poison" in u else "Instruction: Ask?\nAnswer: Tell." for u in pdf["user_prompt"]])
    return model


def test_stream_runs_the_whole_job_once_for_each_text(spark, tmp_path):
    def put(name, texts):
        spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "seeds" / name))

    calls = spark.sparkContext.accumulator(0)
    seeds, out, progress = (str(tmp_path / x) for x in ("seeds", "out", "progress"))
    args = dict(spark=spark, seed_dir=f"{seeds}/*", schema="text string", catalog=load_catalog(spark, tasks=[TASK]),
                completer=BatchCompleter(make_model(calls), "m", str(tmp_path / "store"), attempts=1, buckets=2), out_dir=out,
                progress_dir=progress, tasks=[TASK], cfg=JobConfig(rounds=0, agents=1), files_per_trigger=1, trigger_once=True)

    def statuses():
        return sorted((r.status, r.attempts) for r in read_states(spark, out, progress).collect())

    put("a", ["one", "two", "one", "", "poison"])
    start_seed_stream(checkpoint=str(tmp_path / "ck"), **args).awaitTermination(240)
    assert statuses() == [("error_chunk", 1), ("processed_chunk", 1), ("processed_chunk", 1), ("skipped_chunk", 1)]
    assert read_records(spark, out).count() == 2
    put("b", ["two", "three"])  # one text again, in another file
    start_seed_stream(checkpoint=str(tmp_path / "ck"), **args).awaitTermination(240)
    assert statuses() == [("error_chunk", 1)] + [("processed_chunk", 1)] * 3 + [("skipped_chunk", 1)]
    assert read_records(spark, out).count() == 3
    log = commits(spark, out)
    assert [c["batch"] for c in log] == [0, 1] and len({c["run"] for c in log}) == 2
    # a batch that was committed and is played again does nothing
    n = calls.value
    last = max((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for crc in (tmp_path / "ck" / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    start_seed_stream(checkpoint=str(tmp_path / "ck"), **args).awaitTermination(240)
    assert len(commits(spark, out)) == 2 and calls.value == n and read_records(spark, out).count() == 3
    # another stream over the same files: what is done stays done, what failed is tried again
    start_seed_stream(checkpoint=str(tmp_path / "ck2"), **{**args, "files_per_trigger": 10}).awaitTermination(240)
    assert statuses() == [("error_chunk", 2)] + [("processed_chunk", 1)] * 3 + [("skipped_chunk", 1)]
    assert read_records(spark, out).count() == 3
