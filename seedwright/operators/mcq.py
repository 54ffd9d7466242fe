"""Multiple-choice clean-up and the sample inspector as DataFrame steps
(M3, V1, V2, V4, V5).  Both run as narrow stages; the inspector's sample is
an ordered top-n on an md5 key (``TakeOrderedAndProject``) plus a total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.mcq import (INSPECT_DEFAULTS, answer_letter, choices_part, has_choices,
                             question_part)
from ..functions.text import is_missing, py_strip


def mcq_filter(samples: DataFrame) -> DataFrame:
    """M3: keep rows whose instruction has a choice label; answer := its
    letter when it starts with one.  Other columns pass through."""
    kept = samples.filter(has_choices(F.col("instruction")))
    return kept.withColumn("answer", F.coalesce(answer_letter(F.col("answer")), F.col("answer")))


def complete_samples(samples: DataFrame) -> DataFrame:
    """V1: answer truthy and "Choices" in the instruction."""
    return samples.filter(~is_missing(F.col("answer"))
                          & F.coalesce(F.col("instruction"), F.lit("")).contains("Choices"))


def inspect_rows(samples: DataFrame) -> DataFrame:
    """V4/V5: question/choices split and defaults for missing keys."""
    out = samples
    for k, v in INSPECT_DEFAULTS.items():
        if k in out.columns:
            out = out.withColumn(k, F.coalesce(F.col(k), F.lit(v)))
        else:
            out = out.withColumn(k, F.lit(v))
    return (out.withColumn("question", question_part(F.col("instruction")))
            .withColumn("choices", choices_part(F.col("instruction")))
            .withColumn("choice_lines", F.transform(F.split(F.col("choices"), "\n"),
                                                    lambda c: py_strip(c))))


def sample_n(samples: DataFrame, n: int = 5, seed=0, key_col: str = "pair_id") -> DataFrame:
    """V2: ``min(n, total)`` rows, uniform without replacement, stable per
    seed; ``total`` is the size of the population."""
    total = samples.groupBy().agg(F.count(F.lit(1)).cast("long").alias("total")) \
        .withColumn("_k", F.lit(1))
    picked = (samples.withColumn("_sk", F.md5(F.concat_ws("|", F.lit(str(seed)),
                                                          F.col(key_col).cast("string"))))
              .orderBy("_sk").limit(n))
    picked = picked.withColumn("_k", F.lit(1))
    return picked.join(F.broadcast(total), "_k").drop("_k")
