"""Per-chunk agent sampling (G1, G2, I1) without a shuffle.

Each task's usable agents become one small array, joined on ``task``.  Per chunk
row, positions in the array are ordered by ``md5(seed|task|chunk_id|salt|name)``
and the first ``k`` kept: a uniform draw without replacement that is the same on
every rerun and every retried task.  Debug mode keeps the first agent of the
file.  Rows carry an agent's position and key; its prompts are joined where a
request is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Catalog

#: Most agents of a catalogue that is broadcast; a larger one is dealt over
#: ``SALTS`` parts of the chunks.
MAX_AGENTS = 20_000
SALTS = 64


def join_catalog(rows: DataFrame, small: DataFrame, on: list[str], catalog: Catalog) -> DataFrame:
    """Inner join with a table made from the catalogue.  It is broadcast up to
    ``MAX_AGENTS`` agents; beyond, its rows are repeated for each part of
    ``rows``, so one task's chunks do not meet in one place."""
    if catalog.n_agents <= MAX_AGENTS:
        return rows.join(F.broadcast(small), on)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    return (salted.join(small.withColumn("_salt", F.explode(F.sequence(F.expr("0L"), F.expr(f"{SALTS - 1}L")))),
                        [*on, "_salt"]).drop("_salt"))


def usable_agents(catalog: Catalog, stage: str) -> DataFrame:
    """(task, agent_pos, name, agent_key, system_prompt, template[, one-shot]) of
    the agents that can be drawn.  ``agent_key`` stands for all that an agent
    puts into a prompt."""
    a = catalog.agents.filter((F.col("stage") == stage) & (F.size("unresolved") == 0) & ~F.col("escaped_braces"))
    a = a.select("task", "agent_pos", "name", "system_prompt", "template")
    parts = ["system_prompt", "template"]
    if stage == "instruction":
        shots = catalog.one_shots.select("task", F.col("instruction").alias("shot_instruction"),
                                         F.col("answer").alias("shot_answer"))
        a = a.join(shots, "task", "left")
        parts += ["shot_instruction", "shot_answer"]
    whole = F.concat_ws("\u0001", *[F.coalesce(F.col(c), F.lit("\u0002")) for c in parts])
    return a.withColumn("agent_key", F.md5(whole))


def agent_arrays(catalog: Catalog, stage: str, prompts: bool = False) -> DataFrame:
    """task -> array of usable agents, in file order (one row per task), each
    with its end of the draw's key and, for ``prompts``, what it asks."""
    tail = F.concat(F.lit("|"), F.concat_ws("|", F.lit(stage), F.col("name"))).alias("tail")
    agents = usable_agents(catalog, stage)
    asks = [c for c in agents.columns if c not in ("task", "agent_pos", "name", "agent_key")] if prompts else []
    return agents.groupBy("task").agg(
        F.array_sort(F.collect_list(F.struct("agent_pos", "name", "agent_key", tail, *asks))).alias("_agents"))


def draw_head(seed: int | str, task: Column, chunk_id: Column) -> Column:
    """What the keys of a chunk's draws begin with."""
    return F.concat_ws("|", F.lit(str(seed)), task, chunk_id.cast("string"))


def sample_agents(chunks: DataFrame, catalog: Catalog, stage: str, k: int = 3,
                  seed: int | str = 0, debug: bool = False, out: str = "sampled",
                  prompts: bool = False) -> DataFrame:
    """Adds ``out``: array<struct<agent_pos,name,agent_key>> with min(k, n) agents
    in draw order, with their ``prompts`` if asked for.  Chunks need ``task`` and
    ``chunk_id``."""
    joined = join_catalog(chunks, agent_arrays(catalog, stage, prompts), ["task"], catalog)
    if debug:
        pick = F.slice(F.col("_agents"), 1, 1)  # file order
    else:
        # the head as a column of its own: the keys of all agents start with it
        joined = joined.withColumn("_head", draw_head(seed, F.col("task"), F.col("chunk_id")))
        keyed = F.transform(F.col("_agents"), lambda a, i: F.struct(
            F.md5(F.concat(F.col("_head"), a["tail"])).alias("k"), i.alias("i")))
        pick = F.transform(F.slice(F.sort_array(keyed), 1, k), lambda s: F.get("_agents", s["i"]))
    return joined.withColumn(out, pick).drop("_agents", "_head")


def dealt(chunks: DataFrame) -> DataFrame:
    """Chunks over as many tasks as the session asks for.  Their keys are few
    bytes, but the draws are work: a given number of partitions is not coalesced
    by size, which left the draws of all tasks to one."""
    spark = chunks.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return chunks.repartition(n, "chunk_id")


def drawn_agents(chunks: DataFrame, catalog: Catalog, stage: str, k: int, seed: int | str,
                 debug: bool, pos: str, name: str) -> DataFrame:
    """One row per chunk row and drawn agent: ``pos`` (order of the draw),
    ``name``, ``agent_pos`` and ``agent_key``."""
    s = sample_agents(chunks, catalog, stage, k, seed, debug, "_drawn")
    return (s.select(*chunks.columns, F.posexplode("_drawn").alias("_p", "_a"))
            .select(*chunks.columns, F.col("_p").cast("int").alias(pos), F.col("_a.name").alias(name),
                    F.col("_a.agent_pos").alias("agent_pos"), F.col("_a.agent_key").alias("agent_key")))


def agent_prompts(rows: DataFrame, catalog: Catalog, stage: str) -> DataFrame:
    """Rows with their agent's prompts: system_prompt, template and, for
    instructions, the task's one-shot example."""
    return join_catalog(rows, usable_agents(catalog, stage).drop("name", "agent_key"), ["task", "agent_pos"], catalog)


def sql_sample(chunks_sql: str, agents_sql: str, stage: str, k: int, seed, pos: str,
               per_row: list[str] | None = None) -> str:
    """DuckDB twin: join + row_number over the same md5 key, top k per input
    row (``per_row`` names the columns that make an input row unique beyond
    task and chunk_id)."""
    part = ", ".join(["c.task", "c.chunk_id"] + [f"c.{x}" for x in (per_row or [])])
    key = (f"md5(concat_ws('|', '{seed}', c.task, cast(c.chunk_id AS VARCHAR), "
           f"'{stage}', a.name))")
    return (f"SELECT c.*, a.agent_pos AS {pos}_agent_pos, a.name AS {pos}_name, "
            f"a.system_prompt AS {pos}_system, a.template AS {pos}_template, "
            f"row_number() OVER (PARTITION BY {part} ORDER BY {key}) - 1 AS {pos} "
            f"FROM ({chunks_sql}) c JOIN ({agents_sql}) a ON a.task = c.task AND a.stage = '{stage}' "
            f"QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY {key}) <= {k}")
