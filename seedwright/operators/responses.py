"""The store of model replies: a table bucketed by request id.

Both joins of a wave, the one that leaves out answered requests and the one that
brings replies back, find the store laid out by request id, so its bytes do not
move; the wave's keys do.  The table lives in a folder of the user's and is
registered under a name made from it whenever it is opened.

The number of buckets is fixed when the folder is made; a store that is opened
with another one keeps it.  A folder holds generations.  Replies are appended to the newest; ``compact``
writes the next one with one row per request (its first reply, else its last
error) and removes the older ones once it is whole.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove

REPLY_SCHEMA = "request_id string, content string, error string, attempt int, answered boolean"


class ResponseStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = self._bucket_count(buckets)
        self.generation = max([0, *(g for g, whole in self._generations() if whole)])
        self._register()

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self) -> list[str]:
        fs, p = self._fs(self.path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _bucket_count(self, wanted: int) -> int:
        """The folder's number of buckets; files of another would be read wrongly."""
        names = self._names()
        found = [int(n[8:]) for n in names if n.startswith("buckets=")]
        if found:
            return found[0]
        if any(n.startswith("gen=") for n in names):
            raise ValueError(f"{self.path} holds replies but not their number of buckets")
        fs, p = self._fs(f"{self.path}/buckets={wanted}")
        fs.create(p, True).close()
        return wanted

    def _generations(self) -> list[tuple[int, bool]]:
        """(number, written whole) of the generations in the folder; the first
        one needs no mark, as replies are appended to it."""
        names = self._names()
        found = [int(n[4:]) for n in names if n.startswith("gen=")]
        return [(g, g == 0 or f"whole={g}" in names) for g in sorted(found)]

    @property
    def folder(self) -> str:
        return f"{self.path}/gen={self.generation}"

    def _register(self) -> None:
        tag = hashlib.md5(f"{self.folder}|{self.buckets}".encode()).hexdigest()
        self.name = f"seedwright_replies_{tag}"
        where = self.folder.replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({REPLY_SCHEMA}) USING parquet "
                       f"CLUSTERED BY (request_id) SORTED BY (request_id) INTO {self.buckets} BUCKETS LOCATION '{where}'")
        self.spark.catalog.refreshTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, replies: DataFrame) -> None:
        """Add replies; each bucket gets one file."""
        self._write(replies.repartition(self.buckets, "request_id"))

    def _write(self, rows: DataFrame) -> None:
        (rows.select("request_id", "content", "error", "attempt", "answered").write.format("parquet")
         .bucketBy(self.buckets, "request_id").sortBy("request_id").mode("append")
         .option("path", self.folder).saveAsTable(self.name))

    def latest(self) -> DataFrame:
        """(request_id, content, error): the first reply, else the last error."""
        first = F.when(F.col("answered"), F.col("attempt"))
        return self.read().groupBy("request_id").agg(
            F.min_by("content", first).alias("content"), F.max_by("error", "attempt").alias("error"))

    def compact(self) -> None:
        """One row per request, in a generation of its own."""
        rows = self.latest().select("request_id", "content", "error", F.lit(1).alias("attempt"),
                                    F.col("content").isNotNull().alias("answered"))
        rows = rows.withColumn("error", F.when(~F.col("answered"), F.col("error")))
        old, old_folder = self.name, self.folder
        stale = [g for g, _ in self._generations()]
        self.generation = max(stale, default=0) + 1
        fs, p = self._fs(self.folder)
        fs.delete(p, True)  # what a broken compaction left
        self._register()
        self._write(rows)
        fs, p = self._fs(f"{self.path}/whole={self.generation}")
        fs.create(p, True).close()
        self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        remove(self.spark, old_folder)
