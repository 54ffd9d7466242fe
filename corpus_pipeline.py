"""From raw documents to packed sequences.

Each stage calls one operator and takes (spark, docs, sf_dir); what it returns
is written as Parquet and read again as the next one's ``docs``.  All stages but
the last return the columns of ``documents``.

1. ``toxicity``: rows that the lexicon scores at 0.7 or more go.
2. ``near_duplicates``: five-word shingles, similarity 0.8; the least doc_id of
   each group stays.
3. ``decontamination``: documents that hold a copy of a benchmark item, within a
   fifth of its words, go.
4. ``pii``: spans of personal data are replaced by their kind in brackets.
5. ``packing``: the rest is packed into sequences of 2048 tokens; one row per
   piece, with its ids.

A stage is judged on its own input: models are fitted on the documents that the
stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seedwright.llm import cgk_decontam, hilbert_pack, minmax_dedup, pii_spans, toxic_lexicon
from seedwright.llm.common import documents_like, saved, table

#: SQL expresses neither the lexicon's fit nor the walks or the curve.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxic_lexicon.fit(docs, table(spark, sf_dir, "labels"))
    return toxic_lexicon.without_toxic(documents_like(docs), model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = minmax_dedup.near_duplicates(docs, shingle_words=5, percent=80)
    gone = classes.filter("not kept").select("doc_id")
    return documents_like(docs).join(gone, "doc_id", "left_anti").select(*documents_like(docs).columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cgk_decontam.decontaminated(documents_like(docs), table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_spans.redact(docs, pii_spans.fit(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return hilbert_pack.pack(docs, public_tokenizers.path(hilbert_pack.DEFAULT_TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
