"""Structured Streaming driver: new seed files -> the whole job per micro-batch.

The reference writes results as each chunk finishes and resumes from a progress
file.  Here a file-source stream plays that role: each micro-batch (a set of new
seed files) goes through the job's own functions, is committed under its batch id
and leaves its states in the job's progress.  A replayed batch finds its id in the
commit log and does nothing; a text that was done in an earlier batch, or stands
twice in one, is not paid for again, whatever its id; failed texts are tried again
when they come in again.  Packing and the dense index need whole batches, so the
unit of work is a file batch (``maxFilesPerTrigger``), not a row.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..jobs.run import JobConfig, run_chunks
from ..operators.texts import TextStore
from ..session import scratch_scope, written
from ..sources.catalog import Catalog


def start_seed_stream(spark: SparkSession, seed_dir: str, schema: str, catalog: Catalog,
                      completer, out_dir: str, progress_dir: str, checkpoint: str,
                      tasks: list[str], text_col: str = "text", cfg: JobConfig | None = None,
                      source: str = "stream", files_per_trigger: int = 16, trigger_once: bool = False):
    """Start the stream; returns the ``StreamingQuery``.  A chunk's id is a hash
    of its text, the same in every batch."""
    cfg = cfg or JobConfig()
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(seed_dir))
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def run_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        with scratch_scope(session, f"batch-{epoch}"):
            texts = TextStore(session)
            seeds = texts.keep(batch.select(F.lit(source).alias("source"), F.col(text_col).alias("text")), "seeds")
            # one chunk a text; texts that are missing are one skipped chunk
            once = written(seeds.dropDuplicates(["text_key"]), "seeds-once")
            chunks = once.select(F.xxhash64(F.coalesce("text_key", F.lit(b""))).alias("chunk_id"), "source", "text_key")
            run_chunks(session, chunks, texts, catalog, completer, out_dir, progress_dir, tasks, cfg,
                       run_id=f"{name}-{epoch}", batch=epoch)

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
