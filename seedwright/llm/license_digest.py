"""Operator 10: licence scan by canonical digest.

A text is made canonical: A-Z lower, equivalent spellings, copyright lines and
"all rights reserved" dropped, punctuation and blanks folded to one blank.  Its
units, the whole text and each paragraph and line of it, are compared with the
known texts by the SHA-256 of the canonical form: an equi-join on digests.  A
bitmap of fixed size leaves out units that can match nothing before digests are
made.  It is all SQL expressions; any table of known texts can be given, of any
size, and any table of digests of whole texts.

Defined cases: null and empty texts, and texts of punctuation only, have the
digest of the empty string and match nothing; rows that repeat or lack a doc_id
are scanned one by one; a unit that several known texts equal has all their
identifiers; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwright.llm.common import bitmap, maybe_in, saved, table, text_or_empty
from seedwright.llm.license_texts import EQUIVALENT, KNOWN, KNOWN_DIGESTS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Patterns that Java and RE2 read alike.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
RESERVED = r"all rights reserved\.?"
PUNCTUATION = r"[^\n0-9a-z\x{80}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """The canonical form, with line ends kept."""
    c = F.translate(F.replace(text, F.lit("\r"), F.lit("")), UPPER, LOWER)
    c = F.regexp_replace(c, COPYRIGHT_LINE, "")
    c = F.regexp_replace(c, RESERVED, "")
    for a, b in EQUIVALENT:
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.regexp_replace(c, PUNCTUATION, " ")
    return F.trim(F.regexp_replace(c, " ?\n ?", "\n"))


def _joined(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "\n+", " "))


def known_texts(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """(license, text): the built-in ones and those of a table ``licenses`` of
    the input folder, where there is one."""
    known = spark.createDataFrame(list(KNOWN), "license string, kind string, text string").select("license", "text")
    if sf_dir is None:
        return known
    try:
        return known.unionByName(table(spark, sf_dir, "licenses").select("license", "text"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return known


def known_digests(spark: SparkSession) -> DataFrame:
    """(license, sha) of whole texts."""
    return spark.createDataFrame(list(KNOWN_DIGESTS), "license string, sha string")


def scan(docs: DataFrame, known: DataFrame, whole_digests: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_sha256, license, licenses, n_matches) for each row:
    ``license`` equals the whole text; ``licenses`` are those of all units.
    ``whole_digests`` (license, sha) adds texts known by their digest alone."""
    texts = (known.select("license", _joined(canonical(text_or_empty())).alias("unit")).filter("unit <> ''")
             .select("license", F.xxhash64("unit").alias("key"), F.sha2("unit", 256).alias("sha")))
    texts = saved(texts.distinct(), "known-texts")
    all_known = texts.select("license", "sha")
    if whole_digests is not None:
        all_known = all_known.unionByName(whole_digests.select("license", "sha"))
    digests = saved(all_known.groupBy("sha").agg(
        F.array_join(F.sort_array(F.collect_set("license")), " or ").alias("known")), "known-licenses")
    d = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical(text_or_empty()).alias("_c"))
         .withColumn("row", F.monotonically_increasing_id()))
    whole = _joined(F.col("_c"))
    parts = F.array_union(F.split("_c", "\n"), F.transform(F.split("_c", "\n\n+"), _joined))
    units = d.select("row", "doc_id", F.posexplode(F.concat(F.array(whole), parts)).alias("at", "unit"))
    units = units.withColumn("key", F.xxhash64("unit"))
    bits = saved(bitmap(texts, "key"), "license-bits")
    units = (maybe_in(units.filter("at = 0 or unit <> ''"), "key", bits, always="at = 0")
             .withColumn("sha", F.sha2("unit", 256)).join(digests, "sha", "left"))
    return (units.groupBy("row", "doc_id").agg(
        F.max(F.when(F.col("at") == 0, F.col("sha"))).alias("text_sha256"),
        F.max(F.when(F.col("at") == 0, F.col("known"))).alias("license"),
        F.array_join(F.sort_array(F.collect_set("known")), ",").alias("licenses"),
        F.count(F.when(F.col("at") > 0, F.col("known"))).alias("n_matches")).drop("row"))


def op10_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known licences in all of ``documents``."""
    return scan(table(spark, sf_dir, "documents"), known_texts(spark, sf_dir), known_digests(spark))


def _sql_canonical(text: str) -> str:
    c = f"translate(replace({text}, chr(13), ''), '{UPPER}', '{LOWER}')"
    c = f"regexp_replace({c}, '{COPYRIGHT_LINE}', '', 'g')"
    c = f"regexp_replace({c}, '{RESERVED}', '', 'g')"
    for a, b in EQUIVALENT:
        c = f"replace({c}, '{a}', '{b}')"
    c = f"regexp_replace({c}, '{PUNCTUATION}', ' ', 'g')"
    return rf"trim(regexp_replace({c}, ' ?\n ?', chr(10), 'g'))"


def _sql_joined(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\n+', ' ', 'g'))"


def op10_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, _, t in KNOWN)
    shas = ", ".join(f"('{i}', '{sha}')" for i, sha in KNOWN_DIGESTS)
    return rf"""
with k as (select distinct license, {_sql_joined(_sql_canonical('text'))} as unit from (values {rows}) as v(license, text)),
known as (select sha, string_agg(license, ' or ' order by license) as known from (
        select license, sha256(unit) as sha from k where unit <> '' union select license, sha from (values {shas}) as v(license, sha)) group by sha),
d as (select doc_id, {_sql_canonical("coalesce(text, '')")} as c from documents),
w as (select doc_id, sha256({_sql_joined('c')}) as sha from d),
p as (select doc_id, unnest(list_distinct(list_concat(string_split(c, chr(10)),
        list_transform(regexp_split_to_array(c, '\n\n+'), lambda x: {_sql_joined('x')})))) as unit from d),
m as (select doc_id, known from p join known on sha256(p.unit) = known.sha where unit <> ''),
a as (select doc_id, count(*) as n from m group by doc_id),
b as (select doc_id, known from m union select w.doc_id, known.known from w join known on w.sha = known.sha),
l as (select doc_id, string_agg(known, ',' order by known) as licenses from b group by doc_id)
select w.doc_id, w.sha as text_sha256, known.known as license, coalesce(l.licenses, '') as licenses, coalesce(a.n, 0) as n_matches
from w left join known on w.sha = known.sha left join l on w.doc_id = l.doc_id left join a on w.doc_id = a.doc_id
"""
