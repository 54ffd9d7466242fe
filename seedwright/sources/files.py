"""Files that cannot be read are set aside, the rest is read (S3).

``readable_files`` lists a source's files without their bytes, lets tasks decode
the wanted columns of each with Spark's own reader, which gives up a damaged file
and goes on, and compares the rows that came out with the rows that the files'
footers promise.  A file with fewer is left out as a whole, so no later action
fails on it and none of its rows is used.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

#: Most unreadable files that a source may have; their table is broadcast.
MAX_BAD_FILES = 100_000


def manifest(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """(path, length) of a source's files; no file is opened."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if fmt == "parquet":
        r = r.option("pathGlobFilter", "*.parquet")
    return r.load(path).select("path", "length")


def _footer_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that a parquet file's footer promises; -1 if it has none."""
    import pyarrow.parquet as pq
    for pdf in batches:
        rows = []
        for content in pdf["content"]:
            try:
                rows.append(pq.ParquetFile(io.BytesIO(content)).metadata.num_rows)
            except Exception:  # noqa: BLE001 - whatever is wrong with the file
                rows.append(-1)
        yield pd.DataFrame({"path": pdf["path"], "promised": rows})


def _sound(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The rows up to a damaged place of each file; columns of all files."""
    return (spark.read.format(fmt).option("ignoreCorruptFiles", "true").option("mergeSchema", "true").load(path))


def file_status(spark: SparkSession, path: str, fmt: str, columns: list[str | None]) -> DataFrame:
    """(path, length, rows, status) of each file: ``ok`` or what is wrong."""
    files = manifest(spark, path, fmt)
    sound = _sound(spark, path, fmt)
    used = [F.col(c) for c in dict.fromkeys(columns) if c and c in sound.columns]
    name = F.col("_metadata.file_path").alias("path")
    # footers only
    promised = sound.select(name).groupBy("path").agg(F.count(F.lit(1)).alias("promised"))
    # the columns themselves, decoded to the last row
    got = (sound.select(name, F.xxhash64(F.lit(0), *used).alias("_h")).groupBy("path")
           .agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("_h").alias("_h")))
    out = files.join(promised, "path", "left").join(got, "path", "left")
    # written with the digest, which makes Spark decode the columns
    out = written(out.select("path", "length", "promised", F.coalesce("rows", F.lit(0)).alias("rows"), "_h"), "files")
    if fmt == "parquet":
        # files without a single row: empty ones, or such without a footer
        none = out.filter("promised is null")
        bytes_ = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .option("pathGlobFilter", "*.parquet").load(path).select("path", "content")
        opened = (none.select("path").join(bytes_, "path").mapInPandas(_footer_rows, "path string, promised long")
                  .withColumnRenamed("promised", "_footer"))
        out = out.join(opened, "path", "left").withColumn("promised", F.coalesce("promised", "_footer")).drop("_footer")
    status = (F.when(F.coalesce("promised", F.lit(0)) < 0, F.lit("error: no footer"))
              .when(F.col("rows") < F.col("promised"),
                    F.concat(F.lit("error: "), F.col("rows"), F.lit(" of "), F.col("promised"), F.lit(" rows")))
              .otherwise(F.lit("ok")))
    return out.select("path", "length", "rows", status.alias("status"))


def readable_files(spark: SparkSession, path: str, fmt: str, columns: list[str | None]) -> tuple[DataFrame, DataFrame]:
    """(rows of the sound files with ``_path`` and, for parquet, ``_row``, their
    place in it; status of all files)."""
    status = written(file_status(spark, path, fmt, columns), "file-status")
    bad = status.filter("status <> 'ok'").select(F.col("path").alias("_bad"))
    n = bad.count()
    place = [F.col("_metadata.row_index").alias("_row")] if fmt == "parquet" else []
    df = _sound(spark, path, fmt).select("*", F.col("_metadata.file_path").alias("_path"), *place)
    if n == 0:
        return df, status
    if n > MAX_BAD_FILES:
        raise LookupError(f"{n} unreadable files")
    return df.join(F.broadcast(bad), F.col("_path") == F.col("_bad"), "left_anti"), status
