"""BatchCompleter: de-dup, store, strip, row failures, retries, empty waves."""
import os

import pandas as pd
import pytest

from seedwright.operators.completion import BatchCompleter, offline_reply

REQ = "id int, s string, u string"


def ask(spark, comp, prompts, wave="w"):
    df = spark.createDataFrame([(i, "sys", p) for i, p in enumerate(prompts)], REQ)
    return comp.complete(df, "s", "u", "reply", wave=wave).orderBy("id").collect()


def test_retries_strips_and_reuses(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    flag = str(tmp_path / "flaky")

    def model(pdf: pd.DataFrame) -> pd.Series:
        calls.add(len(pdf))
        out = []
        for u in pdf["user_prompt"]:
            if u.startswith("flaky") and not os.path.exists(flag):
                open(flag, "w").close()
                out.append(None)  # first try fails
            else:
                out.append(f"  re: {u} \n\u00a0")
        return pd.Series(out)

    comp = BatchCompleter(model, "m1", str(tmp_path / "store"), requests_per_task=2)
    out = ask(spark, comp, ["a", "b", "a", "flaky x", "c"])
    assert [r["reply"] for r in out] == ["re: a", "re: b", "re: a", "re: flaky x", "re: c"]
    assert {r["reply_error"] for r in out} == {None}
    n = calls.value
    assert n == 5  # 4 distinct requests + 1 retry
    assert len(ask(spark, comp, ["a", "b", "a", "flaky x", "c"])) == 5
    assert calls.value == n  # answered requests are not sent again


def test_a_bad_row_costs_only_itself(spark, tmp_path):
    def model(pdf):
        if any(u == "bad" for u in pdf["user_prompt"]):
            raise ValueError("no " + "x" * 900)
        return pdf["user_prompt"]

    out = ask(spark, BatchCompleter(model, "m", str(tmp_path / "s"), attempts=2), [f"p{i}" for i in range(60)] + ["bad"])
    assert [r["reply"] for r in out[:60]] == [f"p{i}" for i in range(60)]
    assert out[60]["reply"] is None and out[60]["reply_error"] == repr(ValueError("no " + "x" * 900))


def test_empty_wave_and_wrong_length(spark, tmp_path):
    comp = BatchCompleter(lambda pdf: pdf["user_prompt"].head(1), "m", str(tmp_path / "s"))
    assert ask(spark, comp, []) == []
    assert [r["reply"] for r in ask(spark, comp, ["a", "b"])] == ["a", "b"]  # row by row


def test_damaged_store_is_not_taken_for_an_empty_one(spark, tmp_path):
    os.makedirs(tmp_path / "s" / "w" / "gen=0")
    (tmp_path / "s" / "w" / "buckets=16").write_bytes(b"")
    (tmp_path / "s" / "w" / "gen=0" / "part-0_00000.c000.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet|magic|footer"):
        ask(spark, BatchCompleter(lambda pdf: pdf["user_prompt"], "m", str(tmp_path / "s")), ["a"])


def test_offline_reply_carries_the_whole_prompt(spark):
    from pyspark.sql import functions as F
    text = "word " * 2000
    df = spark.createDataFrame([(str(i), text + str(i)) for i in range(40)], "s string, u string")
    got = [r[0] for r in df.select(offline_reply(F.col("s"), F.col("u"))).collect() if r[0] and "rewritten" in r[0]]
    assert got and all("word word" in g and len(g) > 10_000 and g == g.strip() for g in got)
