"""Readers of sample files for the inspector and the multiple-choice filter (S9,
S10): JSON lines, or one JSON array per file.

Nothing is lost in silence: what does not parse comes back as errors, with the
file, the line and the text.  The reference stops at such a line; ``strict``
does that.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

_BAD = "_bad_text"


class Samples(NamedTuple):
    rows: DataFrame
    errors: DataFrame  # path, line (null for a whole document), text


def _fields(spark: SparkSession, path: str, whole: bool, schema: str | None) -> list[T.StructField]:
    """The given columns, or those of all files together."""
    if schema:
        return T.StructType.fromDDL(schema).fields
    found = spark.read.option("columnNameOfCorruptRecord", _BAD).option("multiLine", str(whole).lower()).json(path)
    return [f for f in found.schema.fields if f.name != _BAD] or T.StructType.fromDDL("instruction string, answer string").fields


def read_samples(spark: SparkSession, path: str, schema: str | None = None, strict: bool = False) -> Samples:
    """Flat or chat samples and the places that did not parse.  ``*.json`` files
    are whole documents (an object or an array of them); everything else is read
    line by line, blank lines apart."""
    whole = path.endswith(".json")
    lines = spark.read.text(path, wholetext=whole).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"))
    # one layout for the passes below
    lines = written(lines, "sample-lines")
    full = lines.filter(F.trim("value") != "")
    fields = _fields(spark, path, whole, schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    if whole:  # an object counts as an array of one
        parsed = full.withColumn("_a", F.from_json("value", T.ArrayType(T.StructType(fields)), options))
        parsed = parsed.select("value", "path", "_block", "_at", F.col("_a").isNotNull().alias("_ok"),
                               F.explode_outer("_a").alias("_s"))
        parsed = parsed.filter("not _ok or _s is not null")
    else:
        marked = T.StructType([*fields, T.StructField(_BAD, T.StringType())])
        parsed = full.withColumn("_s", F.from_json("value", marked, options))
        parsed = parsed.withColumn("_ok", F.col("_s").isNotNull() & F.col(f"_s.{_BAD}").isNull())
    rows = parsed.filter("_ok").select(*[F.col(f"_s.`{f.name}`").alias(f.name) for f in fields])
    bad = parsed.filter("not _ok").select("path", "_block", "_at", "value").distinct()
    # lines of a file that stand before each of its blocks: a row per file and block
    blocks = lines.groupBy("path", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("_before", F.coalesce(before, F.lit(0)))
    line = F.lit(None).cast("long") if whole else F.col("_before") + F.col("_at") - F.col("_first") + 1
    errors = bad.join(blocks, ["path", "_block"]).select("path", line.alias("line"), F.col("value").alias("text"))
    if strict:
        first = errors.orderBy("path", "line").first()
        if first is not None:
            raise ValueError(f"{first.path}, line {first.line}: not a JSON sample")
    return Samples(rows, errors)


def flat_samples(samples: DataFrame) -> DataFrame:
    """Chat samples as flat ones; flat ones as they are."""
    from ..operators.output import flatten_chat
    return flatten_chat(samples) if "messages" in samples.columns else samples
