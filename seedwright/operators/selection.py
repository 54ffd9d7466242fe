"""Chunk selection and resume.

Order as in the reference: index -> optional shuffle -> limit -> resume
filter.  The limit never gathers rows into one task: without a shuffle the
dense ``chunk_id`` is itself the position (``chunk_id < n``); with a shuffle
the position is a dense index over the md5 shuffle key, computed with the
same partition-offset scan as the chunk index.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing, py_strip
from .output import commits


def skip_empty(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped) - falsy text is skipped.  Chunks that carry the key
    of their text have none where the text is missing."""
    empty = F.col("text_key").isNull() if "text_key" in chunks.columns else is_missing(F.col("text"))
    return chunks.filter(~empty), chunks.filter(empty)


def shuffle_key(seed, task: Column, chunk_id: Column) -> Column:
    """Deterministic stand-in for the per-task random permutation."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), task, chunk_id.cast("string")))


def order_chunks(chunks: DataFrame, shuffle: bool = False, seed=0) -> DataFrame:
    """Adds ``pos``: the processing position of each chunk within its task.
    ``chunks`` hold keys, not texts."""
    if not shuffle:
        return chunks.withColumn("pos", F.col("chunk_id"))
    keyed = chunks.withColumn("_sk", shuffle_key(seed, F.col("task"), F.col("chunk_id")))
    # per-task positions: the order key starts with task, offsets per task
    from .chunking import grouped_prefix
    ranked = grouped_prefix(keyed.withColumn("_one", F.lit(1).cast("long")), ["task"],
                            ["task", "_sk", "chunk_id"], "_one", "pos", lean=True)
    return ranked.drop("_one", "_sk")


def limit_chunks(ordered: DataFrame, max_chunks: int = 0, debug: bool = False) -> DataFrame:
    """Debug -> first 10; ``max_chunks > 0`` -> first n; else all."""
    n = 10 if debug else max_chunks
    return ordered.filter(F.col("pos") < n) if n and n > 0 else ordered


def source_id(first_source: str) -> str:
    """Progress key suffix from the first source name."""
    return first_source.replace("/", "_")


def parse_progress(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One integer per line; lines that do not parse are skipped."""
    v = py_strip(F.col(value_col)).try_cast("bigint")
    return lines.select(v.alias("chunk_id")).filter(F.col("chunk_id").isNotNull()).distinct()


def resume_filter(chunks: DataFrame, done: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drop chunks already recorded as processed (anti join, below any
    model call so no request is built for them)."""
    keys = keys or [k for k in ("task", "source_id", "chunk_id") if k in done.columns]
    return chunks.join(done.select(*keys).distinct(), keys, "left_anti")


def progress_rows(outputs: DataFrame, sid: str) -> DataFrame:
    """P5: chunks with at least one output pair -> progress rows."""
    return (outputs.select("task", "chunk_id").distinct()
            .withColumn("source_id", F.lit(sid)).select("task", "source_id", "chunk_id"))


def append_progress(progress: DataFrame, path: str) -> None:
    progress.write.mode("append").partitionBy("task").parquet(path)


# ---------------------------------------------------------------------------
# The job's progress: a log of states by content
# ---------------------------------------------------------------------------
# Each committed run adds a row per task and chunk text that it handled:
# (task, chunk_key, config, status, n_pairs, attempts = 1, at).  ``fold_states``
# makes one row of each key's rows; snapshots are folded logs, so that a reader
# takes the newest one and the runs after it.

STATE_KEY = ["task", "chunk_key", "config"]
STATE = [*STATE_KEY, "status", "n_pairs", "attempts", "at"]
STATE_SCHEMA = ("task string, chunk_key string, config string, status string, n_pairs long, "
                "attempts long, at long")


def fold_states(log: DataFrame) -> DataFrame:
    """The latest state of each key and the number of attempts so far."""
    latest = F.max(F.struct("at", "status", "n_pairs"))
    return (log.groupBy(*STATE_KEY).agg(latest.alias("_l"), F.sum("attempts").alias("attempts"))
            .select(*STATE_KEY, "_l.status", "_l.n_pairs", "attempts", "_l.at"))


def run_states(states: DataFrame, config: str, at: int) -> DataFrame:
    """Log rows of one run from (task, chunk_key, status, n_pairs) by chunk.
    Chunks with one text are one row: its best state, counted as one attempt."""
    order = {"error_chunk": 0, "empty_chunk": 1, "skipped_chunk": 2, "processed_chunk": 3}
    rank = F.lit(-1)
    for name, k in order.items():
        rank = F.when(F.col("status") == name, k).otherwise(rank)
    best = states.groupBy("task", "chunk_key").agg(F.max(F.struct(rank.alias("r"), "status", "n_pairs")).alias("_b"))
    return best.select("task", "chunk_key", F.lit(config).alias("config"), "_b.status", "_b.n_pairs",
                       F.lit(1).cast("long").alias("attempts"), F.lit(at).cast("long").alias("at"))


def _snapshots(spark: SparkSession, progress_dir: str) -> list[int]:
    """Commit numbers up to which whole snapshots reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{progress_dir}/snapshots")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[4:]) for n in names if n.startswith("upto")
                  and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{progress_dir}/snapshots/{n}/_SUCCESS")))


def read_states(spark: SparkSession, out_dir: str, progress_dir: str) -> DataFrame | None:
    """States of the committed runs: the newest snapshot and the logs after it;
    None where nothing was committed."""
    log = commits(spark, out_dir)
    if not log:
        return None
    upto = max([0, *_snapshots(spark, progress_dir)])
    paths = [f"{progress_dir}/run={c['run']}" for c in log if c["seq"] > upto]
    if upto:
        paths.append(f"{progress_dir}/snapshots/upto{upto}")
    return fold_states(spark.read.schema(STATE_SCHEMA).parquet(*paths))


def compact_progress(spark: SparkSession, out_dir: str, progress_dir: str) -> None:
    """Write a snapshot up to the last commit."""
    states = read_states(spark, out_dir, progress_dir)
    last = max([0, *(c["seq"] for c in commits(spark, out_dir))])
    if states is not None and last not in _snapshots(spark, progress_dir):
        states.write.mode("overwrite").parquet(f"{progress_dir}/snapshots/upto{last}")


def due_chunks(chunks: DataFrame, states: DataFrame, config: str, retry_empty: bool = False,
               max_attempts: int = 0) -> DataFrame:
    """Chunks (task, chunk_key, ...) that are still to be done under ``config``:
    new ones, failed ones (up to ``max_attempts`` attempts, if given) and, with
    ``retry_empty``, those that gave nothing."""
    failed = F.col("status") == "error_chunk"
    if retry_empty:
        failed = failed | (F.col("status") == "empty_chunk")
    again = failed & (F.col("attempts") < max_attempts) if max_attempts else failed
    settled = states.filter((F.col("config") == config) & ~again).select("task", "chunk_key")
    return chunks.join(settled, ["task", "chunk_key"], "left_anti")


def read_progress_table(spark, path: str) -> DataFrame | None:
    """The positional progress table, or None where none was written; any other
    failure to read is raised, so a damaged table never counts as "nothing done"."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
