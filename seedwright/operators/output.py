"""Sinks and run accounting.

A run's records stand in a folder of their own, ``run=<id>``.  They count once
the run is in the commit log, ``_commits`` beside them: one small file, put there
by a rename after the records and the progress are whole.  ``read_records`` and
the progress reader see committed runs only, so a run that breaks off leaves
nothing that a reader or a rerun would count.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing

COMMITS = "_commits"


def output_records(pairs: DataFrame, model: str, include_content: bool = False) -> DataFrame:
    """O1/O2: instruction, answer, source, model [+ original_text,
    transformed_content (only when it differs from the text), agent]."""
    cols = [F.coalesce(F.col("instruction"), F.lit("")).alias("instruction"),
            F.coalesce(F.col("answer"), F.lit("")).alias("answer"),
            F.col("source"), F.lit(model).alias("model")]
    if include_content:
        tc, text = F.col("transformed_content"), F.col("original_text")
        cols += [text.alias("original_text"),
                 F.when(tc.isNull() | (tc != text), tc).alias("transformed_content"),
                 F.col("agent")]
    keep = [c for c in ("task", "chunk_id", "pair_id") if c in pairs.columns]
    return pairs.select(*keep, *cols)


def chat_records(records: DataFrame) -> DataFrame:
    """O3: messages = [user: instruction, assistant: answer], metadata = the
    other output keys."""
    meta_cols = [c for c in ("source", "model", "original_text", "transformed_content", "agent")
                 if c in records.columns]
    keep = [c for c in records.columns if c not in meta_cols + ["instruction", "answer"]]
    return records.select(
        *keep,
        F.array(F.struct(F.lit("user").alias("role"), F.col("instruction").alias("content")),
                F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")))
        .alias("messages"),
        F.struct(*[F.col(c) for c in meta_cols]).alias("metadata"))


def flatten_chat(chats: DataFrame) -> DataFrame:
    """M4: chat records back to flat samples (instruction, answer, metadata.*)."""
    meta = [f.name for f in chats.schema["metadata"].dataType.fields]
    keep = [c for c in chats.columns if c not in ("messages", "metadata")]
    return chats.select(*keep,
                        F.col("messages")[0]["content"].alias("instruction"),
                        F.col("messages")[1]["content"].alias("answer"),
                        *[F.col(f"metadata.{m}").alias(m) for m in meta])


def write_jsonl(chats: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines of ``messages`` and ``metadata`` only, in one folder per
    task where there is a task; null fields kept as null."""
    keys = ["task"] if "task" in chats.columns else []
    (chats.select(*keys, "messages", "metadata").write.mode(mode)
     .option("ignoreNullFields", "false").partitionBy(*keys).json(path))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def commits(spark: SparkSession, out_dir: str) -> list[dict]:
    """The commit log, oldest first: {"run", "seq", ...} of each run (one entry
    a run, however many records it has)."""
    fs, p = _fs(spark, f"{out_dir}/{COMMITS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    if not any(n.endswith(".json") for n in names):
        return []
    log = spark.read.text(f"{out_dir}/{COMMITS}/*.json", wholetext=True)
    return sorted((json.loads(r.value) for r in log.collect()), key=lambda c: (c["seq"], c["run"]))


def commit(spark: SparkSession, out_dir: str, run_id: str, **facts) -> None:
    """Make a run count; one that already does stays as it is."""
    log = commits(spark, out_dir)
    if any(c["run"] == run_id for c in log):
        return
    entry = {"run": run_id, "seq": max([0, *(c["seq"] for c in log)]) + 1, **facts}
    fs, temporary = _fs(spark, f"{out_dir}/{COMMITS}/.{run_id}")
    _, final = _fs(spark, f"{out_dir}/{COMMITS}/{run_id}.json")
    stream = fs.create(temporary, True)
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    if not fs.rename(temporary, final):
        raise OSError(f"run {run_id} could not be committed to {out_dir}")


def read_records(spark: SparkSession, out_dir: str, schema: str | None = None) -> DataFrame | None:
    """Chat records of the committed runs; None where there are none."""
    paths = [f"{out_dir}/run={c['run']}" for c in commits(spark, out_dir) if c.get("records", 1)]
    if not paths:
        return None
    r = spark.read.option("basePath", out_dir)
    return (r.schema(schema) if schema else r).json(paths)


def write_samples(samples: DataFrame, path: str, mode: str = "append") -> None:
    """Flat samples (the cleaned multiple-choice set) as JSON lines."""
    samples.write.mode(mode).option("ignoreNullFields", "false").json(path)


def chunk_status(chunks: DataFrame, outputs: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per chunk - skipped (empty text), error (a request of it failed for
    good and it has no pair; ``errors(task, chunk_id)``), empty (no output pair)
    or processed."""
    n = outputs.groupBy("task", "chunk_id").agg(F.count(F.lit(1)).alias("n_pairs"))
    j = chunks.join(n, ["task", "chunk_id"], "left")
    failed = F.lit(False)
    if errors is not None:
        j = j.join(errors.select("task", "chunk_id").distinct().withColumn("_failed", F.lit(True)),
                   ["task", "chunk_id"], "left")
        failed = F.coalesce(F.col("_failed"), F.lit(False))
    missing = F.col("text_key").isNull() if "text_key" in chunks.columns else is_missing(F.col("text"))
    status = (F.when(missing, F.lit("skipped_chunk"))
              .when(failed & F.col("n_pairs").isNull(), F.lit("error_chunk"))
              .when(F.coalesce(F.col("n_pairs"), F.lit(0)) == 0, F.lit("empty_chunk"))
              .otherwise(F.lit("processed_chunk")))
    return j.select("task", "chunk_id", status.alias("status"),
                    F.coalesce(F.col("n_pairs"), F.lit(0)).cast("long").alias("n_pairs"))


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("task", "status").agg(F.count(F.lit(1)).cast("long").alias("n"))
