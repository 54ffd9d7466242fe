"""Pairs of a completer whose reply is an expression are made in their chunk's row: no
content, reply or pair is written, and a text is moved once."""
import os

import pytest
from pyspark.sql import functions as F

from seedwright import session
from seedwright.operators import texts as texts_module
from seedwright.operators.completion import OfflineCompleter
from seedwright.operators.generation import TEXTS, content_wave, generate_pairs, instruction_replies, pairs_from_replies, with_texts
from seedwright.operators.refinement import refine
from seedwright.operators.texts import TextStore
from seedwright.plans import queries as Q

COMP = OfflineCompleter("offline")


@pytest.fixture
def written_to(monkeypatch):
    """The folders that are asked for."""
    paths, plain = [], session.scratch_path

    def noted(s, name):
        paths.append(plain(s, name))
        return paths[-1]

    monkeypatch.setattr(session, "scratch_path", noted)
    monkeypatch.setattr(texts_module, "scratch_path", noted)
    return paths


def _written(paths):
    return sum(os.path.getsize(f"{d}/{f}") for p in paths for d, _, names in os.walk(p.removeprefix("file:")) for f in names)


def _chunks(spark, n=90, key_rows=20_000):
    docs = [(i, "s", None if i % 11 == 1 else "" if i % 11 == 2 else "one text" if i % 3 == 0 else
             f"text {i} with *marks*, `ticks` and Answer: no\n\n" * 4) for i in range(n)]
    store = TextStore(spark, key_rows)
    keys = store.refer(spark.createDataFrame(docs, "chunk_id long, source string, text string"), "seeds")
    return keys.filter("text_key is not null").withColumn("task", F.lit(Q.TASK)), store


def _rows(df):
    return sorted(map(str, df.collect()))


def _apart(spark, chunks, store):
    """The pairs with each wave written, as for a model that is called."""
    cat = Q.catalog(spark)
    contents = content_wave(chunks, cat, COMP, store, 7)
    return pairs_from_replies(instruction_replies(contents, cat, COMP, store, 7))


@pytest.mark.parametrize("key_rows", [20_000, 4])
def test_pairs_are_those_of_written_waves(spark, key_rows):
    chunks, store = _chunks(spark, key_rows=key_rows)
    got = generate_pairs(chunks, Q.catalog(spark), COMP, store, 7)
    apart = _apart(spark, chunks, store)
    both = with_texts(apart, store)
    assert _rows(got.select(apart.columns)) == _rows(apart) and apart.count() > 100
    assert _rows(with_texts(got, store).select(both.columns)) == _rows(both)


@pytest.mark.parametrize("rounds,least,fallback", [(0, 1, "full"), (1, 1, "parity"), (1, 3, "off"), (2, 1, "full"), (3, 6, "parity")])
def test_rounds_in_a_row_are_those_over_rows(spark, rounds, least, fallback):
    chunks, store = _chunks(spark)
    apart = refine(generate_pairs(chunks, Q.catalog(spark), COMP, store, 7), COMP, rounds, least, mcq_fallback=fallback)
    nested = refine(generate_pairs(chunks, Q.catalog(spark), COMP, store, 7, nested=True), COMP, rounds, least,
                    mcq_fallback=fallback)
    assert set(TEXTS) <= set(nested.columns)
    assert _rows(nested.select(apart.columns)) == _rows(apart) and apart.count() > 0


#: Queries that write keys only.
NOTHING = {"generate_pairs", "all_tasks", "refine_round", "refine_fallback", "refine_two_rounds", "output_with_content",
           "chat_records", "mcq_filter", "inspect_complete"}


@pytest.mark.parametrize("name", sorted(NOTHING))
def test_only_keys_are_written(spark, sf_dir, written_to, name):
    df = Q.QUERIES[name](spark, sf_dir)
    assert not [p for p in written_to if any(os.path.basename(p).startswith(x) for x in ("instruction", "pairs", "round", "stopped"))]
    assert df.write.format("noop").mode("overwrite").save() is None
    assert _written(written_to) < 0.3 * os.path.getsize(f"{sf_dir}/documents.parquet")


def test_a_sample_is_made_once(spark, sf_dir, written_to):
    df = Q.QUERIES["inspect_sample"](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and len(df.collect()) == 5
    assert _written(written_to) < 6 * os.path.getsize(f"{sf_dir}/documents.parquet")
