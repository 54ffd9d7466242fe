"""Operator 4: personal data by weak supervision, in SQL expressions only.

Spans come from patterns: the base kinds (email, ip, card, phone), whose valid
matches always stay, and wider ones (secrets, national phone numbers, social
security numbers) that the method may add.  Labelers vote on each span: second
patterns, gazetteers and the words around it.  Expectation-maximisation over the
counts of vote patterns estimates how reliable each labeler is, and the spans'
posteriors train a final logistic span classifier, which decides on the added
spans.  What reaches the driver is one row per vote and feature pattern (at most
7 kinds x 3^5 votes x 108 features, whatever the input); scoring is an
expression over each row's spans.

Matches and the pieces between them come from one pattern, so positions are sums
of lengths, in code points.  Patterns never backtrack over a run twice, so a
long run of digits or letters costs linear time.

Defined cases: null and empty texts have no spans and the digest of the empty
string; an added span never overlaps a base span; rows that repeat or lack a
doc_id are handled one by one; without any span the classifier accepts what its
pattern accepts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import documents_like, table, text_or_empty

_LOCAL = "A-Za-z0-9._%+-"
_SECRET_NAMES = "password|passwd|secret|token|api_?key|access_?key"
# Patterns by kind.
BASE_PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED_PATTERNS = {
    "secret": rf"(?i)(?<![a-z0-9_])(?:(?:{_SECRET_NAMES})\x20?[=:]\x20?[\"']?[^\x20\x09-\x0D\"',;]{{6,}}+"
              r"|AKIA[0-9A-Z]{16}(?![0-9A-Z]))",
    "local_phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Cheap tests that a text must pass before a pattern is tried.
_MAY_HOLD = {"email": "contains(_t, '@')", "phone": "contains(_t, '+')",
             "secret": "contains(_t, '=') or contains(_t, ':') or contains(_t, 'AKIA') or contains(_t, 'akia')"}
_DIGITS = "_digits"

# Gazetteers.
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "it", "nl", "ch")
PLACEHOLDERS = r"(?i)change_?me|your_?|xxxx|\*\*\*\*|<|dummy|placeholder"
NEAR_WORDS = (r"(?i)\b(e-?mail|mail|contact|write|reach|call|tel|phone|mobile|fax|ip|host|server|address|card|visa"
              r"|credit|account|payment|password|secret|key|token|login|ssn|social)\b")
FAR_WORDS = r"(?i)\b(version|section|chapter|figure|page|isbn|issn|equation|table|release)\b"

_BLOCK = 256


class Model(NamedTuple):
    bias: float
    weights: dict[str, float]
    reliability: dict[str, float]


NEUTRAL = Model(1.0, {}, {})


# ----------------------------------------------------------------------- spans

def _matches(d: DataFrame, kinds: dict[str, str], text: str = "_t") -> DataFrame:
    """For each kind, matches _m_kind and the pieces around them _p_kind."""
    ok = {k: F.expr(_MAY_HOLD[k].replace("_t", text)) if k in _MAY_HOLD else F.col(_DIGITS) for k in kinds}
    none = F.array().cast("array<string>")
    d = d.withColumns({f"_m_{k}": F.when(ok[k], F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none)
                       for k, p in kinds.items()})
    return d.withColumns({f"_p_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(text, p, -1)).otherwise(none)
                          for k, p in kinds.items()})


def _spans(kind: str) -> Column:
    """Spans of a kind with their positions and surroundings.  Running sums go
    by blocks of 256, so many matches in one text cost little more than linear."""
    m, p, size = F.col(f"_m_{kind}"), F.col(f"_p_{kind}"), F.col(f"_l_{kind}")
    blocks = F.col(f"_b_{kind}")

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def span(text: Column, k: Column) -> Column:
        b = F.floor(k / _BLOCK).cast("int")
        start = (total(F.slice(blocks, 1, b)) + total(F.slice(size, b * _BLOCK + 1, k - b * _BLOCK))
                 + F.char_length(F.get(p, k)))
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.char_length(text)).alias("end"),
                        text.alias("text"), F.right(F.get(p, k), F.lit(40)).alias("left"),
                        F.left(F.get(p, k + 1), F.lit(12)).alias("right"))

    return F.transform(m, span)


def _lengths(kind: str) -> Column:
    """Characters of each match and the piece before it."""
    return F.transform(f"_m_{kind}", lambda m, i: F.char_length(m) + F.char_length(F.get(f"_p_{kind}", i)))


def _block_sums(kind: str) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.floor(F.size(f"_l_{kind}") / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(f"_l_{kind}", b * _BLOCK + 1, _BLOCK), F.lit(0), lambda x, y: x + y))


def _valid(kind: str) -> Column:
    return F.filter(f"_s_{kind}", lambda s: is_valid(kind, s["text"]))


def _with_spans(d: DataFrame, kinds: dict[str, str]) -> DataFrame:
    d = _matches(d, kinds)
    d = d.withColumns({f"_l_{k}": _lengths(k) for k in kinds})
    d = d.withColumns({f"_b_{k}": _block_sums(k) for k in kinds})
    d = d.withColumns({f"_s_{k}": _spans(k) for k in kinds})
    return d.drop(*(f"_{x}_{k}" for x in "mplb" for k in kinds))


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    worth = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, F.try_to_number(c, F.lit("9")).cast("int")).otherwise(
        F.try_to_number(c, F.lit("9")).cast("int") * 2
        - F.when(c >= "5", F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(worth, F.lit(0), lambda x, y: x + F.coalesce(y, F.lit(0))) % 10 == 0


def is_valid(kind: str, text: Column) -> Column:
    """Whether a match of a base kind counts."""
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda part: F.length(F.ltrim(part, F.lit("0"))).between(0, 2)
                        | ((F.length(F.ltrim(part, F.lit("0"))) == 3) & (F.ltrim(part, F.lit("0")) <= "255")))
    if kind == "card":
        n = F.length(_only_digits(text))
        return F.when(n.between(16, 19), _luhn(_only_digits(text))).otherwise(False)
    if kind == "phone":
        return F.length(_only_digits(text)).between(8, 15)
    return F.lit(True)


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with _t, _base (valid base spans) and _more (candidates to add)."""
    d = docs.withColumn("_t", text_or_empty()).withColumn(_DIGITS, F.col("_t").rlike("[0-9]"))
    d = _with_spans(d, BASE_PATTERNS | ADDED_PATTERNS)
    d = d.withColumn("_base", F.concat(*(_valid(k) for k in BASE_PATTERNS)))
    more = F.filter(F.concat(*(F.col(f"_s_{k}") for k in ADDED_PATTERNS)), lambda s: ~F.exists(
        "_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return d.withColumn("_more", more).drop(_DIGITS, *(f"_s_{k}" for k in BASE_PATTERNS | ADDED_PATTERNS))


# -------------------------------------------------------------------- labelers

def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def labelers(s: Column) -> dict[str, Column]:
    """Votes on a span: 1 personal, -1 not, 0 no opinion."""
    kind, text = s["kind"], s["text"]
    never = F.lit(False)
    second = F.when(kind == "email", _vote(text.rlike(r"^[A-Za-z0-9]+([._+-][A-Za-z0-9]+)*@"), text.rlike(r"\.\.|^[.%+-]"))) \
        .when(kind == "ip", _vote(~text.rlike(r"(^|\.)0[0-9]"), text.rlike(r"(^|\.)0[0-9]"))) \
        .when(kind == "card", _vote(text.rlike(r"^[0-9]{16,19}$|^[0-9]{4}([ -][0-9]{4}){3}$"), never)) \
        .when(kind.isin("phone", "local_phone"), _vote(text.rlike(r"[0-9]{3}[ .)-]+[0-9]{3,4}"), text.rlike("[.-]{2}"))) \
        .when(kind == "ssn", _vote(~text.rlike("^(000|666|9)|-00-|-0000$"), text.rlike("^(000|666|9)|-00-|-0000$"))) \
        .otherwise(_vote(text.rlike(r"[0-9a-fA-F]{16}|[A-Za-z0-9+/]{20}|AKIA[0-9A-Z]{16}"), never))
    known = F.when(kind == "email", _vote(F.lower(F.regexp_extract(text, r"\.([A-Za-z0-9-]+)$", 1)).isin(*TOP_DOMAINS), never)) \
        .when(kind == "ip", _vote(never, text.rlike(r"^(0|127|255|10|192\.168)\."))) \
        .when(kind == "card", _vote(text.rlike("^[3-6]"), text.rlike("^0"))) \
        .when(kind == "secret", _vote(text.rlike(rf"(?i)^({_SECRET_NAMES})|^AKIA"), text.rlike(PLACEHOLDERS))) \
        .otherwise(F.lit(0))
    around = _vote(s["left"].rlike(NEAR_WORDS) | s["right"].rlike(NEAR_WORDS), s["left"].rlike(FAR_WORDS))
    edge = _vote(s["left"].rlike(r"(^|[\x20\x09-\x0D(<\"'\[:;,])$") & s["right"].rlike(r"^([\x20\x09-\x0D.,;:)>\"'\]!?]|$)"),
                 s["left"].rlike(r"[A-Za-z0-9]$") | s["right"].rlike(r"^[A-Za-z0-9]"))
    distinct = F.size(F.array_distinct(F.split(text, "")))
    varied = _vote(distinct >= 6, distinct <= 3)
    return {"second_pattern": second, "gazetteer": known, "context": around, "edge": edge, "variety": varied}


LABELERS = ("second_pattern", "gazetteer", "context", "edge", "variety")


def features(s: Column) -> list[Column]:
    """Discrete features of a span: 4 x 3 x 3 x 3 values by kind."""
    n = F.char_length(s["text"])
    share = F.length(_only_digits(s["text"])) / F.greatest(n, F.lit(1))
    size = F.when(n < 10, "s").when(n < 16, "m").when(n < 24, "l").otherwise("x")
    digits = F.when(share < 0.3, "few").when(share < 0.8, "some").otherwise("most")

    def side(c: Column, last: bool) -> Column:
        anchor = "[A-Za-z0-9]$" if last else "^[A-Za-z0-9]"
        blank = r"(^|[\x20\x09-\x0D])$" if last else r"^([\x20\x09-\x0D]|$)"
        return F.when(c.rlike(anchor), "word").when(c.rlike(blank), "blank").otherwise("mark")

    return [F.concat(F.lit("kind="), s["kind"]), F.concat(F.lit("size="), s["kind"], F.lit("/"), size),
            F.concat(F.lit("digits="), s["kind"], F.lit("/"), digits),
            F.concat(F.lit("left="), side(s["left"], True)), F.concat(F.lit("right="), side(s["right"], False))]


def _estimate(rows: list[tuple[str, tuple[int, ...], tuple[str, ...], int]]) -> tuple[list[float], dict[str, float]]:
    """EM over vote patterns: each row's posterior, and labelers' reliabilities."""
    z = [1 / (1 + math.exp(-1.0 - sum(v))) for _, v, _, _ in rows]
    table_: list[dict] = []
    for _ in range(50):
        prior: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
        table_ = [{(y, v): 1.0 for y in (0, 1) for v in (-1, 0, 1)} for _ in LABELERS]
        for t in table_:  # a labeler is taken to be right more often than not
            t[1, 1] = t[0, -1] = 2.0
        for (kind, votes, _, n), p in zip(rows, z, strict=True):
            for y, w in ((1, p * n), (0, (1 - p) * n)):
                prior[kind][y] += w
                for t, v in zip(table_, votes, strict=True):
                    t[y, v] += w
        share = [{(y, v): t[y, v] / sum(t[y, u] for u in (-1, 0, 1)) for y, v in t} for t in table_]
        new = []
        for kind, votes, _, _ in rows:
            odds = math.log(prior[kind][1] / prior[kind][0])
            odds += sum(math.log(t[1, v] / t[0, v]) for t, v in zip(share, votes, strict=True))
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        moved = max((abs(a - b) for a, b in zip(z, new, strict=True)), default=0.0)
        z = new
        if moved < 1e-6:
            break
    right = {name: (t[1, 1] + t[0, -1]) / max(1e-9, t[1, 1] + t[0, -1] + t[1, -1] + t[0, 1])
             for name, t in zip(LABELERS, table_, strict=True)}
    return z, right


def _train(rows: list[tuple[tuple[str, ...], float, float]]) -> tuple[float, dict[str, float]]:
    """Ridge logistic regression on grouped features with soft targets."""
    bias, w = 0.0, {f: 0.0 for r in rows for f in r[0]}
    total = sum(n for _, _, n in rows) or 1.0
    for _ in range(400):
        g0, g = 0.0, dict.fromkeys(w, 0.0)
        for feats, hits, n in rows:
            p = 1 / (1 + math.exp(-bias - sum(w[f] for f in feats)))
            d = (hits - n * p) / total
            g0 += d
            for f in feats:
                g[f] += d
        bias += 2.0 * g0
        for f in w:
            w[f] += 2.0 * (g[f] - 1e-4 * w[f])
    return round(bias, 6), {f: round(x, 6) for f, x in w.items()}


def fit(docs: DataFrame) -> Model:
    """The span classifier, learned from all documents' spans."""
    s = with_spans(docs.select("text")).select(F.explode(F.concat("_base", "_more")).alias("s"))
    votes = labelers(F.col("s"))
    counted = (s.select(F.col("s")["kind"].alias("kind"), F.array(*(votes[n] for n in LABELERS)).alias("votes"),
                        F.array(*features(F.col("s"))).alias("features"))
               .groupBy("kind", "votes", "features").agg(F.count("*").alias("n")))
    rows = sorted((r["kind"], tuple(r["votes"]), tuple(r["features"]), r["n"]) for r in counted.collect())
    if not rows:
        return NEUTRAL
    z, right = _estimate(rows)
    grouped: dict[tuple[str, ...], list[float]] = defaultdict(lambda: [0.0, 0.0])
    for (_, _, feats, n), p in zip(rows, z, strict=True):
        grouped[feats][0] += p * n
        grouped[feats][1] += n
    bias, weights = _train([(f, h, n) for f, (h, n) in sorted(grouped.items())])
    return Model(bias, weights, right)


def accepts(s: Column, model: Model) -> Column:
    """The classifier's decision on a span."""
    if not model.weights:
        return F.lit(model.bias > 0)
    look = F.create_map(*(F.lit(x) for kv in sorted(model.weights.items()) for x in kv))
    score = F.lit(model.bias)
    for f in features(s):
        score = score + F.coalesce(F.try_element_at(look, f), F.lit(0.0))
    return score > 0


# --------------------------------------------------------------------- results

def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Counts, digest and span list for each row."""
    d = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

    def n(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    added = F.filter("_more", lambda s: accepts(s, model))
    return d.select("doc_id", *(n(k) for k in BASE_PATTERNS), F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
                    _listed(F.concat("_base", added)).alias("spans"))


def _redacted(kind: str, model: Model) -> Column:
    """Each match, replaced or not, after the piece before it."""
    p = f"_p_{kind}"

    def shown(m: Column, i: Column) -> Column:
        if kind in BASE_PATTERNS:
            ok = is_valid(kind, m)
        else:
            ok = accepts(F.struct(F.lit(kind).alias("kind"), m.alias("text"),
                                  F.right(F.get(p, i), F.lit(40)).alias("left"),
                                  F.left(F.get(p, i + 1), F.lit(12)).alias("right")), model)
        return F.concat(F.get(p, i), F.when(ok, f"[{kind.upper()}]").otherwise(m))

    return F.transform(f"_m_{kind}", shown)


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``documents`` with each span replaced by its kind in brackets, kind after
    kind, and ``n_chars`` counted anew where the text changed."""
    d = documents_like(docs).withColumn("_t", text_or_empty())
    for kind, pattern in (BASE_PATTERNS | ADDED_PATTERNS).items():
        d = _matches(d.withColumn(_DIGITS, F.col("_t").rlike("[0-9]")), {kind: pattern})

        parts = F.concat(_redacted(kind, model), F.array(F.element_at(f"_p_{kind}", -1)))
        d = (d.withColumn("_t", F.when(F.size(f"_m_{kind}") > 0, F.array_join(parts, "")).otherwise(F.col("_t")))
             .drop(f"_m_{kind}", f"_p_{kind}"))
    changed = F.col("_t") != text_or_empty()
    return d.select("doc_id", F.when(changed, F.col("_t")).otherwise(F.col("text")).alias("text"), "lang", "source",
                    F.when(changed, F.char_length("_t").cast("long")).otherwise(F.col("n_chars").cast("long")).alias("n_chars"))


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return find(docs, fit(docs))
