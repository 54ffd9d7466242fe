"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwright.llm.common import is_empty, saved


def _are_stars(e: DataFrame) -> bool:
    """Whether each u has one row and no u is another row's v."""
    ends = (e.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in"))
            .unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in"))))
    odd = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return is_empty(odd.filter("out > 1 or (out > 0 and in > 0)"))


def components(links: DataFrame) -> DataFrame:
    """(u, v) links to (u, v) stars: v is the least node of u's component, and
    least nodes themselves have no row.  Every step is a group minimum, which
    combines before the shuffle, and a join back; each round is written, so the
    lineage stays short."""
    e = saved(links.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                            F.least("u", "v").alias("v")).distinct(), "links")
    while not _are_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        e = saved(small, "stars")
    return e
