"""Text primitives shared by every stage, each with its DuckDB (RE2) twin.

Java regex, Python ``re`` and RE2 disagree on ``\\s``, ``$`` and lookahead, so
the whitespace class is spelled out once and used by both engines.  The
``sql_*`` helpers take a SQL expression string and return one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace()/strip() treat as
# whitespace, written so that Java regex and RE2 read them the same way.
WS = (r"[\t\n\x{0B}\x{0C}\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}"
      r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

#: The same characters as a string, for ``trim``.
WS_CHARS = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")

STRIP_RE = rf"^{WS}+|{WS}+\z"
IRRELEVANT_RE = rf"(?i)^{WS}*IRRELEVANT{WS}*\z"
MARKDOWN_MARKS = "*_"
FENCE_RE = r"```[^\n]*\n?"
WS_RUN_RE = rf"{WS}+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(s: str) -> str:
    """A DuckDB string literal for ``s``; control characters other than
    newline and tab go through ``chr`` so the SQL text stays printable."""
    out, buf = [], []
    for ch in s:
        if ord(ch) < 32 and ch not in "\n\t":
            if buf:
                out.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            out.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf or not out:
        out.append("'" + "".join(buf).replace("'", "''") + "'")
    return out[0] if len(out) == 1 else "(" + " || ".join(out) + ")"


# --- strip ---------------------------------------------------------------

def py_strip(c) -> Column:
    """Python ``str.strip()`` (Unicode whitespace, incl. U+001C-1F).  It looks at
    the ends only; a pattern would test the class at every character."""
    return F.trim(_c(c), F.lit(WS_CHARS))


#: First and last three bytes, in hex: begins or ends with one of ``WS_CHARS``.
EDGE_RE = "^(?:{0})|(?:{0})$".format("|".join(c.encode().hex().upper() for c in WS_CHARS))
#: Bytes up to which a strip is cheaper than a look at the ends.
SHORT = 200


def strip_long(c) -> Column:
    """``py_strip`` of a text that may be long.  ``trim`` lists all characters of
    a text before it looks at its end; here only texts that begin or end with
    white space pay for that.  ``c`` is a column or the variable of a lambda, as
    it is named more than once."""
    b = _c(c).cast("binary")
    edges = F.concat(F.hex(F.substring(b, 1, 3)), F.lit("|"), F.hex(F.substring(b, -3, 3)))
    return F.when((F.octet_length(_c(c)) <= SHORT) | edges.rlike(EDGE_RE), py_strip(c)).otherwise(_c(c))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def where_found(value: Column, part: str, change) -> Column:
    """``change`` of the texts that contain ``part``; the others as they are."""
    return let(value, lambda t: F.when(t.contains(part), change(t)).otherwise(t))


def with_long(c: Column, mark: str, text: Column) -> Column:
    """``replace`` of a mark by a text that may be long.  ``replace`` asks for room
    for sixteen more of them; a join of what stands between has the right size."""
    return F.when(c.isNotNull(), F.call_function("concat_ws", text, F.split(c, rf"\Q{mark}\E")))


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, {sql_str(STRIP_RE)}, '', 'g')"


def is_missing(c) -> Column:
    """Python falsiness of a string: null or empty."""
    return F.coalesce(_c(c), F.lit("")) == ""


def sql_is_missing(e: str) -> str:
    return f"(coalesce({e}, '') = '')"


def is_blank(c) -> Column:
    """Null, empty, or whitespace only; of a column."""
    return F.coalesce(strip_long(c), F.lit("")) == ""


def sql_is_blank(e: str) -> str:
    return f"(coalesce({sql_strip(e)}, '') = '')"


# --- IRRELEVANT replies -------------------------------------------------

def is_irrelevant(c) -> Column:
    """The word alone, in any case; of a column.  The pattern is tried on texts
    that are as long as the word without the white space around them."""
    t = strip_long(c)
    return F.coalesce((F.octet_length(t) == len("IRRELEVANT")) & t.rlike(IRRELEVANT_RE), F.lit(False))


def sql_is_irrelevant(e: str) -> str:
    return f"coalesce(regexp_matches({e}, {sql_str(IRRELEVANT_RE)}), false)"


def keep_content_reply(c) -> Column:
    """Content stage: drop null/empty and exact IRRELEVANT replies."""
    return ~is_missing(c) & ~is_irrelevant(c)


def sql_keep_content_reply(e: str) -> str:
    return f"(NOT {sql_is_missing(e)} AND NOT {sql_is_irrelevant(e)})"


def keep_instruction_reply(c) -> Column:
    """Instruction stage: also drop whitespace-only replies."""
    return ~is_blank(c) & ~is_irrelevant(c)


def sql_keep_instruction_reply(e: str) -> str:
    return f"(NOT {sql_is_blank(e)} AND NOT {sql_is_irrelevant(e)})"


# --- markdown and fences ------------------------------------------------

def drop_markdown(c) -> Column:
    out = _c(c)
    for mark in MARKDOWN_MARKS:
        out = where_found(out, mark, lambda t, m=mark: F.replace(t, F.lit(m), F.lit("")))
    return out


def strip_markdown(c) -> Column:
    """Delete every ``*`` and ``_`` then strip (keeps snake_case loss)."""
    return let(drop_markdown(c), strip_long)


def sql_strip_markdown(e: str) -> str:
    return sql_strip(f"regexp_replace({e}, '[*_]', '', 'g')")


def strip_fences(c) -> Column:
    """Delete each triple-backtick marker with the rest of its line."""
    return let(where_found(_c(c), "```", lambda t: F.regexp_replace(t, FENCE_RE, "")), strip_long)


def sql_strip_fences(e: str) -> str:
    return sql_strip(f"regexp_replace({e}, {sql_str(FENCE_RE)}, '', 'g')")


def collapse_ws(c) -> Column:
    """``re.sub(r'\\s+', ' ', t).strip()``."""
    return py_strip(F.regexp_replace(_c(c), WS_RUN_RE, " "))


def sql_collapse_ws(e: str) -> str:
    return sql_strip(f"regexp_replace({e}, {sql_str(WS_RUN_RE)}, ' ', 'g')")


def slug(c) -> Column:
    """Agent name -> transformation type: lower case, spaces to ``_``."""
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_"))


def sql_slug(e: str) -> str:
    return f"replace(lower({e}), ' ', '_')"
