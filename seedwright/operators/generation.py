"""Content transformation and instruction generation as request waves.

``content_wave``: chunk x (<=3 sampled content agents) -> content prompt ->
completion -> IRRELEVANT/empty filter.
``instruction_replies``: content x (<=3 instruction agents drawn once per
chunk) -> instruction prompt (with the task's one-shot when it has one) ->
completion -> blank/IRRELEVANT filter -> reply parsed into pairs natively.

Rows carry keys of texts (``operators.texts``): a chunk has ``text_key``, a
content ``content_key``.  The store gets each content as the wave is written;
nothing else that is written holds a seed text or a content.

``chunk_pairs`` is both waves and the parser for a completer whose reply is an
expression: each seed text is joined to its chunk once, and contents, replies
and pairs are made in that one stage, a row per chunk, so that none of them is
written or moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.parse import pair_blocks, parsed_pairs
from ..functions.prompts import content_prompt, instruction_prompt
from ..functions.text import keep_content_reply, keep_instruction_reply, let, slug
from ..session import written
from ..sources.catalog import Catalog
from .agents import agent_prompts, dealt, drawn_agents, sample_agents
from .completion import Prompt
from .texts import TextStore, text_key


def content_requests(chunks: DataFrame, catalog: Catalog, texts: TextStore, seed=0, k: int = 3,
                     debug: bool = False) -> tuple[DataFrame, Prompt]:
    """Chunks (task, chunk_id, source, text_key) x drawn agents, and their prompt."""
    rows = drawn_agents(dealt(chunks), catalog, "content", k, seed, debug, "content_pos", "content_agent")

    def render(r: DataFrame) -> DataFrame:
        r = agent_prompts(texts.attach(r, "seeds", "text_key", "text"), catalog, "content")
        return (r.withColumn("user_prompt", content_prompt(F.col("template"), F.col("text")))
                .drop("template", "text"))

    return rows, Prompt([F.lit("content"), F.col("agent_key"), F.hex("text_key")], render)


def content_wave(chunks: DataFrame, catalog: Catalog, completer, texts: TextStore, seed=0, k: int = 3,
                 debug: bool = False, keep_rejected: bool = False) -> DataFrame:
    """Rows: chunk columns + content_pos, content_agent, transformation_type,
    content_key.  ``keep_rejected`` keeps dropped replies with ``kept=false``."""
    rows, prompt = content_requests(chunks, catalog, texts, seed, k, debug)
    rep = completer.ask(rows, prompt, "content", wave="content").drop("agent_pos", "agent_key")
    rep = (rep.withColumn("transformation_type", slug(F.col("content_agent")))
           .withColumn("kept", keep_content_reply(F.col("content"))))
    rep = texts.keep(rep, "contents", "content", "content_key")
    return rep if keep_rejected else rep.filter("kept").drop("kept")


def instruction_requests(contents: DataFrame, catalog: Catalog, texts: TextStore, seed=0, k: int = 3,
                         debug: bool = False) -> tuple[DataFrame, Prompt]:
    rows = drawn_agents(contents, catalog, "instruction", k, seed, debug, "instr_pos", "instruction_agent")

    def render(r: DataFrame) -> DataFrame:
        r = agent_prompts(texts.attach(r, "contents", "content_key", "content"), catalog, "instruction")
        return (r.withColumn("user_prompt", instruction_prompt(F.col("template"), F.col("content"),
                                                               F.col("shot_instruction"), F.col("shot_answer")))
                .drop("template", "content", "shot_instruction", "shot_answer"))

    return rows, Prompt([F.lit("instruction"), F.col("agent_key"), F.hex("content_key")], render)


def instruction_replies(contents: DataFrame, catalog: Catalog, completer, texts: TextStore, seed=0,
                        k: int = 3, debug: bool = False) -> DataFrame:
    rows, prompt = instruction_requests(contents, catalog, texts, seed, k, debug)
    rep = completer.ask(rows, prompt, "reply", wave="instruction")
    return written(rep.drop("agent_pos", "agent_key"), "instruction-wave")


def _blocks_with(status: str):
    return F.sum(F.size(F.filter("_blocks", lambda b: b["status"] == status))).cast("long")


#: What ``pairs_from_replies`` counts on its way.
PARSE_COUNTS = {
    "replies": lambda: F.count(F.lit(1)),
    "replies_without_blocks": lambda: F.count_if(F.size("_blocks") == 0),
    "blocks_parsed": lambda: _blocks_with("parsed"),
    "blocks_without_marker": lambda: _blocks_with("missing_marker"),
    "blocks_empty": lambda: _blocks_with("empty"),
}


def pairs_from_replies(replies: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Filter replies, parse blocks, keep valid pairs with lineage; seed
    text and content by key.  ``counts`` observes ``PARSE_COUNTS`` of the
    replies that were not filtered, in the pass that reads the pairs."""
    kept = replies.filter(keep_instruction_reply(F.col("reply"))).withColumn("_blocks", pair_blocks(F.col("reply")))
    if counts is not None:
        kept = kept.observe(counts, *[F.coalesce(f(), F.lit(0)).alias(n) for n, f in PARSE_COUNTS.items()])
    # filtered inside: for an exploded column Spark infers filters on its size,
    # and they would parse every reply again
    parsed = F.filter("_blocks", lambda b: b["status"] == "parsed")
    ex = kept.select("*", F.explode(parsed).alias("_b")).drop("_blocks")
    return (ex.select(
        "task", "chunk_id", "source", "text_key",
        "content_pos", "instr_pos", F.col("_b.block_pos").alias("block_pos"),
        F.col("instruction_agent").alias("agent"), "instruction_agent",
        "content_key", "transformation_type",
        F.col("_b.instruction").alias("instruction"), F.col("_b.answer").alias("answer"))
        .withColumn("pair_id", F.md5(F.concat_ws(
            "|", "task", F.col("chunk_id").cast("string"), F.col("content_pos").cast("string"),
            F.col("instr_pos").cast("string"), F.col("block_pos").cast("string")))))


#: The texts of pairs that were made where their texts are.
TEXTS = ["original_text", "transformed_content"]


def with_texts(pairs: DataFrame, texts: TextStore) -> DataFrame:
    """Pairs with ``original_text`` and ``transformed_content`` for their keys."""
    if set(TEXTS) <= set(pairs.columns):
        return pairs.drop("text_key", "content_key")
    p = texts.attach(pairs, "contents", "content_key", "transformed_content")
    return texts.attach(p, "seeds", "text_key", "original_text").drop("text_key", "content_key")


def parse_report(replies: DataFrame) -> DataFrame:
    """One row per reply block with its parse status and, where it did not
    parse, its text; replies with no block at all get status ``no_blocks``;
    filtered replies ``filtered``."""
    kept = keep_instruction_reply(F.col("reply"))
    blocks = F.when(kept, pair_blocks(F.col("reply")))
    ex = replies.select("task", "chunk_id", "content_pos", "instr_pos", "instruction_agent", "reply",
                        F.when(~kept, F.lit("filtered")).alias("_pre"),
                        blocks.alias("_blocks"))
    with_rows = ex.select("*", F.explode_outer("_blocks").alias("_b"))
    status = F.coalesce(F.col("_pre"), F.col("_b.status"), F.lit("no_blocks"))
    failed = F.when(status != "parsed", F.coalesce(F.col("_b.failed_text"), F.col("reply")))
    return with_rows.select("task", "chunk_id", "content_pos", "instr_pos", "instruction_agent",
                            F.col("_b.block_pos").alias("block_pos"), status.alias("status"),
                            failed.alias("failed_text"))


def chunk_pairs(chunks: DataFrame, catalog: Catalog, completer, texts: TextStore, seed=0, k: int = 3,
                debug: bool = False) -> DataFrame:
    """Both waves and the parser for a reply that is an expression.  Rows: chunk
    columns, their ``text``, ``contents`` (array of content_pos,
    transformation_type, content) and ``pairs`` (array of content_no - the place
    of its content -, instr_pos, block_pos, agent, instruction_agent,
    instruction, answer, pair_id)."""
    rows = texts.attach(dealt(chunks), "seeds", "text_key", "text")
    for stage in ("content", "instruction"):
        rows = sample_agents(rows, catalog, stage, k, seed, debug, f"_{stage}", prompts=True)

    def content(a, i):
        reply = completer.reply(a["system_prompt"], content_prompt(a["template"], F.col("text")))
        return F.struct(i.cast("int").alias("content_pos"), slug(a["name"]).alias("transformation_type"),
                        reply.alias("content"))

    def pairs_of(c, no):
        def replied(a, i):
            reply = completer.reply(a["system_prompt"], instruction_prompt(
                a["template"], c["content"], a["shot_instruction"], a["shot_answer"]))
            return let(reply, lambda r: F.when(keep_instruction_reply(r), F.transform(
                parsed_pairs(r), lambda b: pair(a, i.cast("int"), b))))

        def pair(a, i, b):
            place = F.concat_ws("|", "task", F.col("chunk_id").cast("string"), c["content_pos"].cast("string"),
                                i.cast("string"), b["block_pos"].cast("string"))
            return F.struct(no.cast("int").alias("content_no"), i.alias("instr_pos"), b["block_pos"].alias("block_pos"),
                            a["name"].alias("agent"), a["name"].alias("instruction_agent"),
                            b["instruction"].alias("instruction"), b["answer"].alias("answer"),
                            F.md5(place).alias("pair_id"))

        return F.flatten(F.filter(F.transform("_instruction", replied), lambda p: p.isNotNull()))

    kept = F.filter(F.transform("_content", content), lambda c: keep_content_reply(c["content"]))
    rows = rows.select(*chunks.columns, "text", "_instruction", kept.alias("contents"))
    return rows.select(*chunks.columns, "text", "contents", F.flatten(F.transform("contents", pairs_of)).alias("pairs"))


def pair_rows(chunks: DataFrame, pairs: Column, names: list[str]) -> DataFrame:
    """A row per element of ``pairs`` of the chunks of ``chunk_pairs``, with the
    columns ``names`` of the pair, its chunk or its content, and ``TEXTS``.
    ``pairs`` is no plain column, as Spark would make a column that is exploded
    once more to ask for its size."""
    c = F.get("contents", F.col("_p.content_no"))
    found = {"content_key": text_key(c["content"]), "content_pos": c["content_pos"],
             "transformation_type": c["transformation_type"]}
    own = [n for n in chunks.columns if n in names]
    rows = chunks.select(*own, "text", "contents", F.explode(pairs).alias("_p"))
    return rows.select(*[F.col(n) if n in own else found.get(n, F.col(f"_p.{n}")).alias(n) for n in names],
                       F.col("text").alias(TEXTS[0]), c["content"].alias(TEXTS[1]))


#: Columns of a pair with keys of its texts.
PAIR = ["task", "chunk_id", "source", "text_key", "content_pos", "instr_pos", "block_pos", "agent", "instruction_agent",
        "content_key", "transformation_type", "instruction", "answer", "pair_id"]


def generate_pairs(chunks: DataFrame, catalog: Catalog, completer, texts: TextStore, seed=0, k: int = 3,
                   debug: bool = False, nested: bool = False) -> DataFrame:
    """Chunks (task, chunk_id, source, text_key) whose texts are the store's
    ``seeds`` -> pairs with keys; with their texts as well where the reply is an
    expression.  There, ``nested`` leaves the pairs of a chunk in its row, for
    ``refine``."""
    if completer.inline:
        rows = chunk_pairs(chunks, catalog, completer, texts, seed, k, debug)
        return rows if nested else pair_rows(rows, F.filter("pairs", lambda p: p["pair_id"].isNotNull()), PAIR)
    contents = content_wave(chunks, catalog, completer, texts, seed, k, debug)
    replies = instruction_replies(contents, catalog, completer, texts, seed, k, debug)
    return pairs_from_replies(replies)
