"""Texts by content: waves and pairs carry 16-byte keys instead of texts.

A text is joined to its key only where a prompt is made or a record is written,
so no table but the store holds a seed text or a content, however many tasks,
agents, pairs and rounds stand on it.  A store has a table per kind of text:

* ``refer`` keeps the rows' own source as the table: nothing is copied;
* ``keep`` writes the rows with their text (model replies, packed chunks).

Equal texts share a key, so a key may hold a third of all rows.  ``attach``
deals the rows of such keys over several parts, and repeats the text for each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing
from ..session import scratch_path, written

#: Rows of one key that a join takes in one part; their prompts, replies and pairs are
#: made there, for each of a job's tasks.
KEY_ROWS = 1_000
#: Most keys that are dealt over parts (their table is broadcast).
HOT_KEYS = 100_000
#: Most keys that a store is narrowed to (they are broadcast).
WANTED_KEYS = 1_000_000


def text_key(text: Column) -> Column:
    """16 bytes of the text's SHA-256; null where the text is missing."""
    return F.when(~is_missing(text), F.unhex(F.substring(F.sha2(text, 256), 1, 32)))


#: What ``refer`` and ``keep`` count on their way.
TEXT_COUNTS = {
    "rows": lambda c: F.count(F.lit(1)),
    "null_texts": lambda c: F.count_if(c.isNull()),
    "empty_texts": lambda c: F.count_if(c == ""),
}


def _counted(rows: DataFrame, text: str, counts: Observation | None) -> DataFrame:
    if counts is None:
        return rows
    return rows.observe(counts, *[f(F.col(text)).alias(n) for n, f in TEXT_COUNTS.items()])


@dataclass
class _Kind:
    rows: DataFrame  # holds key and text
    key: str
    text: str
    hot: DataFrame | None  # (_key, _parts) of keys with many rows


class TextStore:
    """The texts of one job, by kind ("seeds", "contents")."""

    def __init__(self, spark: SparkSession, key_rows: int = KEY_ROWS):
        self.spark = spark
        self.key_rows = key_rows
        self.root = scratch_path(spark, "texts")
        self.kinds: dict[str, _Kind] = {}

    def keep(self, rows: DataFrame, kind: str, text: str = "text", key: str = "text_key",
             counts: Observation | None = None) -> DataFrame:
        """Write the rows with their text; returns them with the key instead.
        ``counts`` observes ``TEXT_COUNTS`` as they are written."""
        rows = rows.withColumn(key, text_key(F.col(text)))
        _counted(rows, text, counts).write.parquet(f"{self.root}/{kind}")
        table = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{kind}")
        return self._named(kind, table, table.drop(text), key, text)

    def refer(self, rows: DataFrame, kind: str, text: str = "text", key: str = "text_key",
              counts: Observation | None = None) -> DataFrame:
        """The rows with the key instead of the text, written; the text stays
        where it is, in tables that must not change while the job runs."""
        rows = rows.withColumn(key, text_key(F.col(text)))
        lean = written(_counted(rows, text, counts).drop(text), f"{kind}-keys")
        return self._named(kind, rows, lean, key, text)

    def _named(self, kind: str, rows: DataFrame, lean: DataFrame, key: str, text: str) -> DataFrame:
        sizes = lean.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).count()
        limit = max(self.key_rows, lean.count() // HOT_KEYS)
        hot = written(sizes.filter(F.col("count") > limit)
                      .select("_key", F.ceil(F.col("count") / limit).cast("int").alias("_parts")), f"{kind}-hot")
        self.kinds[kind] = _Kind(rows, key, text, hot if hot.take(1) else None)
        return lean

    def texts(self, kind: str) -> DataFrame:
        """(key, text), each text once."""
        k = self.kinds[kind]
        return k.rows.select(k.key, k.text).filter(F.col(k.key).isNotNull()).dropDuplicates([k.key])

    def narrow(self, kind: str, rows: DataFrame) -> None:
        """From now on only the texts of these rows' keys are wanted.  Where
        they are few, the others are left out as the table is scanned, so that a
        limited or resumed run does not move the corpus."""
        k = self.kinds[kind]
        keys = written(rows.select(k.key).filter(F.col(k.key).isNotNull()).distinct(), f"{kind}-wanted")
        if keys.count() <= WANTED_KEYS:
            k.rows = k.rows.join(F.broadcast(keys), k.key, "left_semi")

    def attach(self, rows: DataFrame, kind: str, key: str | None = None, out: str | None = None) -> DataFrame:
        """Rows with the text of their key in column ``out``."""
        k = self.kinds[kind]
        key, out = key or k.key, out or k.text
        if k.hot is None:
            texts = self.texts(kind).select(F.col(k.key).alias(key), F.col(k.text).alias(out))
            return rows.join(texts, key, "left").select(*rows.columns, out)
        hot = F.broadcast(k.hot.withColumnRenamed("_key", key))  # HOT_KEYS rows at most
        spot = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.col("_parts"))).otherwise(0)
        spread = rows.join(hot, key, "left").withColumn("_part", spot.cast("int")).drop("_parts")
        return spread.join(self._copies(k, hot, key, out), [key, "_part"], "left").select(*rows.columns, out)

    def _copies(self, k: _Kind, hot: DataFrame, key: str, out: str) -> DataFrame:
        """(key, _part, text), each once: the texts of hot keys for each of their
        parts, the others for part 0.  Made equal before they are repeated, and
        told apart by key and part in the one shuffle that the join needs too."""
        found = k.rows.select(F.col(k.key).alias(key), F.col(k.text).alias(out)).filter(F.col(key).isNotNull())
        many = (found.join(hot, key).dropDuplicates([key])
                .select(key, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), out))
        few = found.join(hot, key, "left_anti").select(key, F.lit(0).alias("_part"), out)
        return few.unionByName(many).dropDuplicates([key, "_part"])
