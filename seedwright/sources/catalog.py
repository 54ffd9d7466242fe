"""Agent catalogue: per task, content agents, instruction agents and an
optional one-shot example, read from ``{root}/content_generation/{task}_content.json``
and ``{root}/instruction_generation/{task}_instruction.json``.

Both file shapes are accepted: a bare array of agents, or an object
``{one_shot_example, agents}``.  Templates are checked for placeholders other
than ``{text}``; those named in ``params`` are filled (a value of ``TEXT``
means "the chunk text"), the rest mark the agent unresolved and it is left
out before sampling.  The catalogue is configuration with a fixed size (357
agents in the bundled one).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUNDLED = os.path.join(os.path.dirname(os.path.dirname(__file__)), "data", "agents")
TEXT = object()  # params value meaning "the chunk text"
DEFAULT_PARAMS = {"topic": TEXT, "question": TEXT}
SLOT_RE = r"\{([A-Za-z_]+)\}"

_AGENT_SCHEMA = "name string, system_prompt string, user_prompt_template string"
_ARRAY_SCHEMA = f"array<struct<{_AGENT_SCHEMA.replace(' string', ':string')}>>"
_OBJECT_SCHEMA = (f"struct<one_shot_example:struct<instruction:string,answer:string>,"
                  f"agents:{_ARRAY_SCHEMA}>")


@dataclass
class Catalog:
    agents: DataFrame      # task, stage, agent_pos, name, system_prompt, template, unresolved
    one_shots: DataFrame   # task, instruction, answer
    tasks: list[str]
    n_agents: int


def _raw_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) per JSON file.  The bundled catalogue is read on the
    driver (it ships inside the package, not on shared storage)."""
    if os.path.isdir(root):
        rows = []
        for stage_dir in ("content_generation", "instruction_generation"):
            d = os.path.join(root, stage_dir)
            if not os.path.isdir(d):
                continue
            for fn in sorted(os.listdir(d)):
                if fn.endswith(".json"):
                    with open(os.path.join(d, fn), encoding="utf-8") as f:
                        rows.append((f"{stage_dir}/{fn}", f.read()))
        return spark.createDataFrame(rows, "path string, content string")
    return (spark.read.text(f"{root}/*/*.json", wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("content")))


def load_catalog(spark: SparkSession, root: str = BUNDLED, params: dict | None = None,
                 tasks: list[str] | None = None) -> Catalog:
    params = DEFAULT_PARAMS if params is None else params
    raw = _raw_files(spark, root)
    meta = raw.select(
        F.regexp_extract("path", r"(content_generation|instruction_generation)/", 1).alias("stage_dir"),
        F.regexp_extract("path", r"/(\w+?)_(content|instruction)\.json$", 1).alias("task"),
        "content")
    meta = meta.filter(F.col("task") != "")
    if tasks:
        meta = meta.filter(F.col("task").isin(tasks))
    is_array = F.ltrim(F.col("content")).startswith("[")
    obj = F.from_json("content", _OBJECT_SCHEMA)
    agents_arr = F.when(is_array, F.from_json("content", _ARRAY_SCHEMA)).otherwise(obj["agents"])
    stage = F.when(F.col("stage_dir") == "content_generation", "content").otherwise("instruction")
    parsed = meta.select("task", stage.alias("stage"),
                         F.coalesce(agents_arr, F.array().cast(_ARRAY_SCHEMA)).alias("agents"),
                         F.when(~is_array, obj["one_shot_example"]).alias("shot"))
    agents = parsed.select("task", "stage", F.posexplode("agents").alias("agent_pos", "a")) \
        .select("task", "stage", F.col("agent_pos").cast("int"),
                F.col("a.name").alias("name"), F.col("a.system_prompt").alias("system_prompt"),
                F.col("a.user_prompt_template").alias("raw_template"))
    # placeholder resolution (single pass over the template)
    tpl = F.col("raw_template")
    known = ["text"] + sorted(params)
    slots = F.array_distinct(F.regexp_extract_all(tpl, F.lit(SLOT_RE), 1))
    unresolved = F.array_except(slots, F.array(*[F.lit(k) for k in known]))
    resolved = tpl
    for k in sorted(params):
        v = params[k]
        resolved = F.replace(resolved, F.lit("{" + k + "}"), F.lit("{text}" if v is TEXT else str(v)))
    agents = agents.withColumn("unresolved", unresolved).withColumn("template", resolved) \
        .withColumn("escaped_braces", tpl.contains("{{") | tpl.contains("}}"))
    # One-shot examples come from the instruction files only.
    shots = parsed.filter((F.col("stage") == "instruction") & F.col("shot").isNotNull()) \
        .select("task", F.col("shot.instruction").alias("instruction"),
                F.col("shot.answer").alias("answer"))
    agents = agents.cache()
    n = agents.count()
    task_list = sorted(r["task"] for r in agents.select("task").distinct().collect())
    return Catalog(agents, shots.cache(), task_list, n)


def template_check(catalog: Catalog) -> DataFrame:
    """V3: agents whose template has placeholders we cannot fill."""
    return catalog.agents.select(
        "task", "stage", "agent_pos", "name", "unresolved", "escaped_braces",
        ((F.size("unresolved") > 0) | F.col("escaped_braces")).alias("flagged"))

