"""Completion as a table operation.

A stage hands its rows and their ``Prompt`` to a *completer* and gets a reply
column back.  Rows are keys and small columns; a prompt's texts are joined only
where it is made.

* ``ColumnCompleter`` - the reply is a Column expression.  Stays inside the
  same lazy plan (whole-stage codegen, no Python).  ``OfflineCompleter`` is
  the deterministic one used by tests, the SQL oracle and the benchmark.
* ``BatchCompleter`` - the user's own model client as a pandas function, and
  ``CallCompleter`` - as a function of one prompt, with a window of calls in
  flight in each task.  Requests are de-duplicated by ``request_id``, a digest
  of the model and of what the prompt depends on; the ones without an answer in
  the response store (``operators.responses``) are rendered, spread over as many
  tasks as their number asks for and sent through ``mapInPandas``; replies are
  appended to the store that the user names and joined back.  A rerun with that
  store never calls the model twice for an answered request.
"""

from __future__ import annotations

import heapq
import json
import random
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import (EDITOR_MARKER, INSTRUCTION_MARKER, INSTRUCTION_TAIL, ONE_SHOT_BLOCK,
                                 SELF_CONTAINED, SUGGESTER_MARKER, SUGGESTER_USER)
from ..functions.text import let, py_strip, sql_str, sql_strip, strip_long
from ..session import written
from .responses import REPLY_SCHEMA, ResponseStore


@dataclass
class Prompt:
    """How the prompts of a wave are made.  ``identity``: string columns of its
    rows that a prompt depends on, with keys for texts.  ``render``: rows with
    ``system_prompt`` and ``user_prompt`` in the place of nothing else."""
    identity: list[Column]
    render: Callable[[DataFrame], DataFrame]


def request_id(model: str, *identity: Column) -> Column:
    """Digest of the model and what a prompt depends on; nulls count."""
    parts = [F.coalesce(c, F.lit("\u0002")) for c in identity]
    return F.md5(F.concat_ws("\u0001", F.lit(model), *parts))


class ColumnCompleter:
    """Reply = ``fn(system, user)`` as a native expression."""
    inline = True  # replies need not be written to be kept

    def __init__(self, fn: Callable[[Column, Column], Column], model: str = "offline"):
        self.fn = fn
        self.model = model

    def complete(self, df: DataFrame, system: str, user: str, out: str,
                 wave: str = "wave") -> DataFrame:
        return df.withColumn(out, self.fn(F.col(system), F.col(user)))

    def reply(self, system: Column, user: Column) -> Column:
        """The reply as an expression, for prompts that are elements of an array;
        the user prompt is made once."""
        return let(user, lambda u: self.fn(system, u))

    def ask(self, rows: DataFrame, prompt: Prompt, out: str, wave: str = "wave") -> DataFrame:
        """Rows with the reply to their prompt in column ``out``."""
        r = self.complete(prompt.render(rows), "system_prompt", "user_prompt", out, wave)
        return r.drop("system_prompt", "user_prompt")


# ---------------------------------------------------------------------------
# Offline completer: a stand-in model whose reply depends only on the prompt.
# It reads the prompt kind from fixed markers, as a model would, and picks a
# reply shape from the first hex digit of md5(system \x01 user).  The shapes
# cover every branch of the filters and parsers; some carry the prompt's own
# text, so that parsers and later prompts meet whole documents:
#   PROMPT  the whole prompt
#   BODY    what the prompt is about: the agent's text with the content, or the
#           instruction that is to be refined
#   ANSWER  the answer that is to be refined
# ---------------------------------------------------------------------------

def _reply_spec():
    """(kind, digit set, parts) where parts are literals, (start, len) of h or
    a name of a part of the prompt."""
    return {
        "edit": [
            ("0", None),
            ("1", ["I cannot modify this pair."]),
            ("2", ["Modified Instruction: Pick the label for ", (3, 6), "\nA) ", (9, 3),
                   "\nB) ", (12, 3), "\nNo answer section."]),
            ("3", ["modified instruction: lower-case ", (3, 6), "\nmodified answer: none"]),
            ("4", ["Modified Answer: Refined answer ", (3, 8),
                   "\nModified Instruction: Refined question ", (11, 8)]),
            ("5", ["**Modified Instruction:**\r\n\r\n", "BODY", "\r\n\r\n\r\n**Modified Answer:**\n",
                   "ANSWER"]),
            ("6", ["Modified Instruction: ", "BODY", "\nA) ", (9, 3), "\nB) ", (12, 3),
                   "\nNo answer section."]),
            ("*", ["**Modified Instruction:**\r\n\r\nRefined question ", (3, 8),
                   " with more_detail.\r\n\r\n\r\n**Modified Answer:**\nRefined answer ",
                   (11, 8), "."]),
        ],
        "suggest": [
            ("0", None),
            ("12", ["1. Sharpen this: ", "BODY", "\n2. Add constraint ", (2, 6), "."]),
            ("*", ["1. Sharpen point ", (2, 6), ".\n2. Add one constraint."]),
        ],
        "instruct": [
            ("0", ["IRRELEVANT"]),
            ("1", ["   \n"]),
            ("2", ["IRRELEVANT."]),
            ("3", None),
            ("456", ["Sure, here is one.\nInstruction: Describe passage ", (5, 6),
                     " in one sentence.\nAnswer: It reads: ", "BODY"]),
            ("7", ["**Instruction:** Which code names passage ", (5, 4), "?\nA) ", (9, 4),
                   "\nB) ", (13, 4), "\nC) ", (17, 4), "\nD) ", (21, 4),
                   "\n**Answer:** B) ", (13, 4)]),
            ("8", ["Instruction: Choose the tag of this item.\n", "BODY", "\nChoices:\nA) ", (9, 4),
                   "\nB) ", (13, 4), "\nC) ", (17, 4), "\nAnswer: C) ", (17, 4)]),
            ("9a", ["```text\nInstruction: Summarise: ", "BODY", "\nanswer: Item ",
                    (11, 6), " in brief.\n```"]),
            ("b", ["Instruction: What is the answer: ", (5, 4), "?\nAnswer: ", (9, 4)]),
            ("c", ["Instruction: First task use_snake_case ", (5, 6), "\nAnswer: First result ",
                   (11, 6), "\n\nInstruction: Second task ", (17, 6), "\nAnswer: Second result ",
                   (23, 6)]),
            ("d", ["Instruction: First task ", (5, 6), "\r\nAnswer: First result ", (11, 6),
                   "\r\n\r\nInstruction: Second task ", (17, 6), "\r\nAnswer: "]),
            ("ef", ["Instruction: First task ", (5, 6), "\nAnswer: First result ", (11, 6),
                    "\nInstruction: Dangling task ", (17, 6)]),
        ],
        "content": [
            ("0", ["IRRELEVANT"]),
            ("1", [" irrelevant\n"]),
            ("2", None),
            ("3", ["IRRELEVANT."]),
            ("*", ["Passage ", (2, 8), " rewritten for the task.\n", "PROMPT"]),
        ],
    }


#: Where the parts of a prompt stand: by kind, (text before, text after) in turn.
_BODY_AT = {
    "edit": [("Original instruction:\n", "\n\nOriginal answer:\n")],
    "suggest": [("Original instruction:\n", "\n\nOriginal answer:\n")],
    "instruct": [(None, "\n\n" + SELF_CONTAINED), (None, "\n\n" + ONE_SHOT_BLOCK.split("{", 1)[0])],
}
_ANSWER_AT = [("\n\nOriginal answer:\n", "\n\nSuggestions:\n")]
_TEXT_PARTS = ("PROMPT", "BODY", "ANSWER")


def _between(user: Column, cuts) -> Column:
    for before, after in cuts:
        if before is not None:
            user = F.split_part(user, F.lit(before), F.lit(2))
        user = F.split_part(user, F.lit(after), F.lit(1))
    return user


def _sql_between(user: str, cuts) -> str:
    for before, after in cuts:
        if before is not None:
            user = f"split_part({user}, {sql_str(before)}, 2)"
        user = f"split_part({user}, {sql_str(after)}, 1)"
    return user


def _text_part(name: str, user: Column, kind: Column) -> Column:
    if name == "PROMPT":
        return user
    if name == "ANSWER":
        return _between(user, _ANSWER_AT)
    out = F.lit("")
    for k, cuts in _BODY_AT.items():
        out = F.when(kind == k, _between(user, cuts)).otherwise(out)
    return out


def _sql_parts(kind: str, parts, h: str, user: str) -> str:
    out = []
    for p in parts:
        if isinstance(p, tuple):
            out.append(f"substr({h}, {p[0]}, {p[1]})")
        elif p == "PROMPT":
            out.append(user)
        elif p == "BODY":
            out.append(_sql_between(user, _BODY_AT[kind]))
        elif p == "ANSWER":
            out.append(_sql_between(user, _ANSWER_AT))
        else:
            out.append(sql_str(p))
    return "(" + " || ".join(out) + ")"


def _kind_spark(user: Column) -> Column:
    # most prompts end with the tail of their kind, which is a look instead of a search
    return (F.when(user.contains(EDITOR_MARKER), "edit")
            .when(user.endswith(_SUGGESTER_END) | user.contains(SUGGESTER_MARKER), "suggest")
            .when(user.endswith(_INSTRUCTION_END) | user.contains(INSTRUCTION_MARKER), "instruct")
            .otherwise("content"))


def _from_marker(text: str, marker: str) -> str:
    return text[text.index(marker):]


_SUGGESTER_END = _from_marker(SUGGESTER_USER, SUGGESTER_MARKER)
_INSTRUCTION_END = _from_marker(INSTRUCTION_TAIL, INSTRUCTION_MARKER)


def _kind_sql(user: str) -> str:
    return (f"(CASE WHEN contains({user}, {sql_str(EDITOR_MARKER)}) THEN 'edit' "
            f"WHEN contains({user}, {sql_str(SUGGESTER_MARKER)}) THEN 'suggest' "
            f"WHEN contains({user}, {sql_str(INSTRUCTION_MARKER)}) THEN 'instruct' "
            f"ELSE 'content' END)")


_PIECES = "map<string,array<struct<lit:string,start:int,len:int,text:string>>>"


def _pieces(parts) -> list[dict] | None:
    """A reply's parts as pieces: what stands before a slice of h or a text, and
    which; None for no reply."""
    if parts is None:
        return None
    out, lit = [], ""
    for p in [*parts, (1, 0)]:
        if isinstance(p, str) and p not in _TEXT_PARTS:
            lit += p
            continue
        start, size = p if isinstance(p, tuple) else (1, 0)
        out.append({"lit": lit, "start": start, "len": size, "text": p if isinstance(p, str) else ""})
        lit = ""
    return out


def _reply_table() -> Column:
    """Kind and first digit of h -> pieces, as one constant that Spark folds
    (small plans and generated code)."""
    table = {}
    for kind, cases in _reply_spec().items():
        for digit in "0123456789abcdef":
            table[kind + digit] = _pieces(next(parts for digits, parts in cases if digit in digits or digits == "*"))
    return F.from_json(F.lit(json.dumps(table)), _PIECES)


def offline_reply(system: Column, user: Column) -> Column:
    known = F.struct(F.md5(F.concat_ws("\u0001", system, user)).alias("h"), _kind_spark(user).alias("kind"))
    return let(let(known, lambda k: _raw_reply(user, k["h"], k["kind"])), strip_long)


def _raw_reply(user: Column, h: Column, kind: Column) -> Column:
    """The pieces of the reply looked up, then filled in and joined; a text is
    copied to its place, where a replacement in the reply would look through it
    and ask for room for sixteen of it.  The reply is still to be stripped."""
    pieces = F.try_element_at(_reply_table(), F.concat(kind, F.substring(h, 1, 1)))

    def filled(p):
        text = F.when(p["text"] == "", F.lit(""))
        for name in _TEXT_PARTS:
            text = text.when(p["text"] == name, _text_part(name, user, kind))
        return F.concat(p["lit"], F.substring(h, p["start"], p["len"]), text)

    # no prompt, no text of it
    lacking = user.isNull() & F.exists(pieces, lambda p: p["text"] != "")
    return F.when(~lacking, F.array_join(F.transform(pieces, filled), ""))


def sql_offline_reply_h(h: str, user: str) -> str:
    d = f"substr({h}, 1, 1)"
    whens = []
    for k, cases in _reply_spec().items():
        inner = []
        default = "NULL"
        for digits, parts in cases:
            val = "NULL" if parts is None else _sql_parts(k, parts, h, user)
            if digits == "*":
                default = val
            else:
                ds = ", ".join(f"'{c}'" for c in digits)
                inner.append(f"WHEN {d} IN ({ds}) THEN {val}")
        whens.append(f"WHEN {_kind_sql(user)} = '{k}' THEN (CASE {' '.join(inner)} ELSE {default} END)")
    return sql_strip(f"(CASE {' '.join(whens)} ELSE NULL END)")


class OfflineCompleter(ColumnCompleter):
    def __init__(self, model: str = "offline"):
        super().__init__(offline_reply, model)

    def complete(self, df: DataFrame, system: str, user: str, out: str,
                 wave: str = "wave") -> DataFrame:
        # hash, kind and raw reply as columns of their own; callers write the wave
        # before they filter or parse it, so none is inlined into later steps
        s, u = F.col(system), F.col(user)
        return (df.withColumn("_oh", F.md5(F.concat_ws("\u0001", s, u)))
                .withColumn("_ok", _kind_spark(u))
                .withColumn("_raw", _raw_reply(u, F.col("_oh"), F.col("_ok")))
                .withColumn(out, strip_long("_raw"))
                .drop("_oh", "_ok", "_raw"))


# ---------------------------------------------------------------------------
# Completers with a store: the user's model client, called in tasks.
# ---------------------------------------------------------------------------

#: Requests per task of a wave.
REQUESTS_PER_TASK = 512


def _answers(fn, pdf: pd.DataFrame) -> tuple[list, list]:
    """(replies, errors) of a batch; if it raises, of each row by itself."""
    try:
        got = list(fn(pdf))
        if len(got) != len(pdf):
            raise ValueError(f"{len(got)} replies for {len(pdf)} requests")
        return got, [None] * len(pdf)
    except Exception as e:  # noqa: BLE001 - recorded per row
        if len(pdf) == 1:
            return [None], [repr(e)]
        out = [_answers(fn, pdf.iloc[i:i + 1].reset_index(drop=True)) for i in range(len(pdf))]
        return [r for x, _ in out for r in x], [r for _, x in out for r in x]


def _reply_frame(ids, content, error, attempt) -> pd.DataFrame:
    content = [None if c is None or c != c else str(c) for c in content]
    return pd.DataFrame({"request_id": list(ids), "content": pd.Series(content, dtype=object),
                         "error": pd.Series(list(error), dtype=object), "attempt": attempt,
                         "answered": [c is not None for c in content]})


class _StoreCompleter:
    """What completers with a response store share.

    Replies are stripped.  A request without a reply keeps its last error, which
    ends up in ``<out>_error``.  ``store`` is the folder of answered requests: a
    rerun that names the same one never pays twice."""

    attempts = 1
    backoff_seconds = 0.0

    inline = False

    def __init__(self, model: str, store: str, requests_per_task: int, buckets: int):
        self.model = model
        self.store = store.rstrip("/")
        self.requests_per_task = requests_per_task
        self.buckets = buckets

    def _sender(self, attempt: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        """Task function: rendered requests in, replies out."""
        raise NotImplementedError

    def responses(self, spark, wave: str) -> ResponseStore:
        return ResponseStore(spark, f"{self.store}/{wave}", self.buckets)

    def complete(self, df: DataFrame, system: str, user: str, out: str,
                 wave: str = "wave") -> DataFrame:
        """As ``ask``, for rows that hold their prompts."""
        rows = written(df, f"{wave}-prompts")
        prompt = Prompt([F.col(system), F.col(user)],
                        lambda r: r.withColumn("system_prompt", F.col(system)).withColumn("user_prompt", F.col(user)))
        return self.ask(rows, prompt, out, wave)

    def ask(self, rows: DataFrame, prompt: Prompt, out: str, wave: str = "wave") -> DataFrame:
        """Rows with the reply to their prompt in column ``out``; the rows and
        the ones of them that are sent are written without their prompts."""
        store = self.responses(rows.sparkSession, wave)
        keyed = written(rows.withColumn("_rid", request_id(self.model, *prompt.identity)), f"{wave}-rows")
        # laid out as the store is, so that only this side moves
        requests = keyed.repartition(store.buckets, "_rid").dropDuplicates(["_rid"])
        for attempt in range(1, self.attempts + 1):
            known = store.read().filter("answered").select(F.col("request_id").alias("_rid"))
            pending = written(requests.join(known.hint("merge"), "_rid", "left_anti"), f"{wave}-pending")
            n = pending.count()
            if n == 0:
                break
            if attempt > 1 and self.backoff_seconds:
                time.sleep(self.backoff_seconds * 2 ** (attempt - 2))
            ready = prompt.render(pending).select(F.col("_rid").alias("request_id"), "system_prompt", "user_prompt")
            width = -(-n // self.requests_per_task)
            store.append(ready.repartition(width).mapInPandas(self._sender(attempt), REPLY_SCHEMA)
                         .withColumn("content", py_strip(F.col("content"))))
        got = store.latest().select(F.col("request_id").alias("_rid"), F.col("content").alias(out),
                                    F.col("error").alias("_error"))
        joined = keyed.join(got.hint("merge"), "_rid", "left")
        error = F.when(F.col(out).isNull(), F.coalesce("_error", F.lit("no reply")))
        return joined.withColumn(f"{out}_error", error).drop("_rid", "_error")


class BatchCompleter(_StoreCompleter):
    """``fn(pdf[system_prompt, user_prompt]) -> Series[str | None]``.

    A batch that raises is sent again row by row, so a failing row costs only
    itself; rows without a reply are sent again in the next round, up to
    ``attempts`` rounds, ``backoff_seconds`` (doubling) apart.
    """

    def __init__(self, fn: Callable[[pd.DataFrame], pd.Series], model: str, store: str,
                 requests_per_task: int = REQUESTS_PER_TASK, attempts: int = 3,
                 backoff_seconds: float = 0.0, buckets: int = 16):
        super().__init__(model, store, requests_per_task, buckets)
        self.fn = fn
        self.attempts = attempts
        self.backoff_seconds = backoff_seconds

    def _sender(self, attempt: int):
        fn = self.fn

        def send(batches):
            for pdf in batches:
                content, err = _answers(fn, pdf[["system_prompt", "user_prompt"]])
                yield _reply_frame(pdf["request_id"], content, err, attempt)

        return send


def calls_in_flight(requests: Iterable[tuple[str, str, str]], call: Callable[[str, str], str | None],
                    window: int, tries: int, first_wait: float, jitter: float,
                    ) -> Iterator[tuple[str, str | None, str | None, int]]:
    """(id, reply, error, tries used) of requests (id, system, user), in the
    order in which they are done.

    At most ``window`` calls run at once.  A request without a reply waits on
    its own, ``first_wait`` seconds doubling with each try, up to ``jitter`` of
    that longer, while others run; when four times ``window`` wait, no new ones
    are taken, so no more than five times ``window`` requests are held."""
    source = iter(requests)
    more, order = True, 0
    running: dict = {}
    waiting: list = []  # (when due, order, request, try)

    with ThreadPoolExecutor(max_workers=window) as pool:
        def start(request, attempt):
            running[pool.submit(call, request[1], request[2])] = (request, attempt)

        while more or running or waiting:
            while waiting and len(running) < window and waiting[0][0] <= time.monotonic():
                start(*heapq.heappop(waiting)[2:])
            while more and len(running) < window and len(waiting) < 4 * window:
                request = next(source, None)
                if request is None:
                    more = False
                else:
                    start(request, 1)
            pause = max(0.0, waiting[0][0] - time.monotonic()) if waiting and len(running) < window else None
            if not running:
                if pause:
                    time.sleep(pause)
                continue
            done, _ = wait(running, timeout=pause, return_when=FIRST_COMPLETED)
            for f in done:
                request, attempt = running.pop(f)
                problem = f.exception()
                reply = None if problem else f.result()
                if reply is not None:
                    yield request[0], reply, None, attempt
                elif attempt >= tries:
                    yield request[0], None, repr(problem) if problem else "no reply", attempt
                else:
                    order += 1
                    due = first_wait * 2 ** (attempt - 1) * (1 + jitter * random.random())
                    heapq.heappush(waiting, (time.monotonic() + due, order, request, attempt + 1))


class CallCompleter(_StoreCompleter):
    """``call(system_prompt, user_prompt) -> str | None``, for clients that wait
    on a server: each task keeps ``in_flight`` calls running, and tries each
    request up to ``tries`` times with a wait of its own."""

    def __init__(self, call: Callable[[str, str], str | None], model: str, store: str, in_flight: int = 10,
                 tries: int = 3, first_wait: float = 1.0, jitter: float = 0.1,
                 requests_per_task: int = REQUESTS_PER_TASK, buckets: int = 16):
        super().__init__(model, store, requests_per_task, buckets)
        self.call = call
        self.options = {"window": in_flight, "tries": tries, "first_wait": first_wait, "jitter": jitter}

    def _sender(self, attempt: int):
        call, options = self.call, self.options

        def send(batches):
            rows = (r for pdf in batches
                    for r in zip(pdf["request_id"], pdf["system_prompt"], pdf["user_prompt"], strict=True))
            held = []
            for got in calls_in_flight(rows, call, **options):
                held.append(got)
                if len(held) >= 64:
                    yield _reply_frame(*zip(*held, strict=True))
                    held = []
            if held:
                yield _reply_frame(*zip(*held, strict=True))

        return send
