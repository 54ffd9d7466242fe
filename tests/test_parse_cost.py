"""The parsers search each text once, and give what the patterns give."""
import random
import re
import time

from pyspark.sql import functions as F

from seedwright.functions.parse import modified_pair, pair_blocks
from seedwright.functions.text import WS_CHARS, keep_instruction_reply, py_strip, strip_fences, strip_long, strip_markdown
from seedwright.operators.agents import drawn_agents
from seedwright.operators.generation import pairs_from_replies
from seedwright.sources.catalog import load_catalog

TOKENS = ["Instruction:", "Answer:", "instruction:", "ANSWER:", "Modified Instruction:", "Modified Answer:", "Choices:",
          "A)", "D)", "E)", "x", "two words", "\n", "\r\n", "\n\n", "  ", "\t", " ", "\u0085", "　", "*", "_",
          "```", "```text\n", "\U0001f600", "Inst*ruction:"]


def _texts(n=4000):
    rnd = random.Random(5)
    return ["".join(rnd.choice(TOKENS) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def _col(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "id int, raw string")
    return [r[0] for r in df.select("id", fn(F.col("raw")).alias("v")).orderBy("id").select("v").collect()]


def _markdown(t):
    return re.sub(r"[*_]", "", t).strip()


def _blocks(t):
    t = re.sub(r"```[^\n]*\n?", "", _markdown(t)).strip()
    out = []
    for i, b in enumerate(b for b in re.split(r"(?=Instruction:)", t) if b.strip()):
        ins = re.search(r"(?is)Instruction:\s*(.*?)(?=Answer:|$)", b)
        ans = re.search(r"(?is)Answer:\s*(.*?)(?=Instruction:|$)", b)
        got = (ins.group(1).strip() if ins else "", ans.group(1).strip() if ans else "")
        status = "missing_marker" if not (ins and ans) else "parsed" if all(got) else "empty"
        out.append((i, *got, status, None if status == "parsed" else b))
    return out


def _modified(t):
    t = re.sub(r"\n+", "\n", _markdown(t).replace("\r\n", "\n")).strip()
    ins = re.search(r"(?s)Modified Instruction:\s*(.*?)(?=Modified Answer:|$)", t)
    ans = re.search(r"(?s)Modified Answer:\s*(.*?)(?=Modified Instruction:|$)", t)
    if ins and ans and ins.group(1).strip() and ans.group(1).strip():
        return ins.group(1).strip(), ans.group(1).strip()
    q = re.search(r"(?s)Modified Instruction:\s*(.*?)(?:Choices:|(?=\s*[A-D]\)))", t)
    ch = re.search(r"(?s)(?:Choices:\s*|\n\s*)((?:[A-D]\).*?\n?)+)", t)
    if q and ch and q.group(1).strip() and ch.group(1).strip():
        return f"{q.group(1).strip()}\nChoices:\n{ch.group(1).strip()}", ch.group(1).strip()
    return None


def test_parsers_give_what_the_patterns_give(spark):
    texts = _texts()
    assert _col(spark, texts, py_strip) == [t.strip() for t in texts]
    assert [[tuple(b) for b in r] for r in _col(spark, texts, pair_blocks)] == [_blocks(t) for t in texts]
    got = _col(spark, texts, lambda c: modified_pair(c, "parity"))
    assert [r and tuple(r) for r in got] == [_modified(t) for t in texts]
    assert sum(r is not None for r in got) > 50


def test_long_runs_of_blanks_cost_one_pass(spark):
    """The end's pattern was tried again at each blank of a run."""
    text = "Instruction: a" + " " * 120_000 + "b\nAnswer: " + "\n" * 3 + "c"
    t0 = time.time()
    for fn in (py_strip, strip_markdown, strip_fences):
        assert _col(spark, [text], fn) == [text]
    assert len(_col(spark, [text], pair_blocks)[0][0]["instruction"]) == 120_002
    assert time.time() - t0 < 20


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_reply_is_parsed_once(spark):
    """Filters on the exploded column's size, and on the status, had it parsed three times."""
    rows = spark.createDataFrame([("t", 1, "s", b"k", 0, 0, "a", b"c", "tt", "Instruction: q\nAnswer: a")],
                                 "task string, chunk_id long, source string, text_key binary, content_pos int, "
                                 "instr_pos int, instruction_agent string, content_key binary, "
                                 "transformation_type string, reply string")
    pairs = pairs_from_replies(rows.repartition(2))
    plan = _plan(pairs)
    assert len(re.findall(r"Instruction:\)?, -1\)", plan)) == 1
    assert [(r.instruction, r.answer) for r in pairs.collect()] == [("q", "a")]


def test_draws_keep_their_keys(spark):
    """md5(seed|task|chunk|stage|name), the part of the chunk made once a row and sorted by value."""
    import hashlib
    cat = load_catalog(spark, tasks=["reading_comprehension"])
    chunks = spark.range(40).select(F.lit("reading_comprehension").alias("task"), F.col("id").alias("chunk_id"))
    d = drawn_agents(chunks, cat, "content", 3, 42, False, "pos", "agent")
    assert "array_sort(transform(" not in _plan(d)
    names = [r.name for r in cat.agents.filter("stage = 'content' and size(unresolved) = 0 and not escaped_braces").collect()]
    got = {}
    for r in d.orderBy("chunk_id", "pos").collect():
        got.setdefault(r.chunk_id, []).append(r.agent)
    for c in range(40):
        want = sorted(names, key=lambda n: hashlib.md5(f"42|reading_comprehension|{c}|content|{n}".encode()).hexdigest())[:3]
        assert got[c] == want


def test_draws_for_all_tasks_are_dealt_out(spark, sf_dir):
    """By size, the keys of all chunks were one partition, drawn for in one task."""
    from seedwright.plans.queries import QUERIES
    d = QUERIES["sample_content_agents"](spark, sf_dir)
    parts = d.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1


def test_strips_of_long_texts_look_at_the_ends(spark):
    """Every strip listed all characters of its text, several times a reply."""
    edges = ["", "a", "é", "界", "\U0001f600", *WS_CHARS, "\u0085 ", "x　", "​", "\u0085" * 2, "\t  "]
    texts = [a + m + b for m in ("", "x\n" * 150 + "x") for a in edges for b in edges]
    assert _col(spark, texts, strip_long) == [t.strip() for t in texts]
    words = ["IRRELEVANT", "irreleVant", "IRRELEVANT.", "ırrelevant", "relevant", ""]
    replies = [a + w + b for w in words for a in ("", " \n", " " * 300) for b in ("", " ", "\t" * 300)]
    assert _col(spark, replies, keep_instruction_reply) == [
        bool(r.strip()) and not re.fullmatch("(?ai)irrelevant", r.strip()) for r in replies]

    long = spark.range(1500).select(F.concat(F.repeat(F.lit("some words "), 10_000), F.col("id").cast("string")).alias("t"))
    long = long.repartition(4).persist()
    long.count()

    def seconds(expr):
        took = []
        for _ in range(3):
            t0 = time.time()
            long.select(F.count_if(expr)).collect()
            took.append(time.time() - t0)
        return min(took)

    assert seconds(keep_instruction_reply(F.col("t"))) < 0.5 * seconds(py_strip(F.col("t")) != "")
    long.unpersist()


def test_requests_for_all_tasks_are_dealt_out(spark, sf_dir):
    """The draws of the content wave were made where the keys of all chunks lay: in one partition."""
    from seedwright.operators.generation import content_requests
    from seedwright.plans.queries import catalog, doc_chunks, for_tasks
    cat = catalog(spark)
    chunks, texts = doc_chunks(spark, sf_dir)
    rows, _ = content_requests(for_tasks(chunks, cat), cat, texts, 42)
    assert len(rows.groupBy(F.spark_partition_id()).count().collect()) > 1
