"""Parse model replies: three sections, decision records, placeholders."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import PLACEHOLDERS, SECTION_DEFAULTS, SECTION_HEADERS, WS_CLASS
from ..functions.text import strip

SECTIONS = [name for name, _ in SECTION_HEADERS]

# Tolerant headers also accept a list number before the header and eat the
# closing stars that follow the colon (``1. **Synopsis:** text``).
_TOLERANT_PREFIX = f"^(?:[0-9]+\\.{WS_CLASS}*)?"


def _header_regex(pattern: str, tolerant: bool) -> str:
    if not tolerant:
        return "(?i)" + pattern
    return "(?i)" + _TOLERANT_PREFIX + pattern[1:] + "\\**"


def _labelled(line, tolerant: bool):
    """A stripped line as (header, text): its section if it opens one, and its text (null if blank)."""
    header = rest = F.lit(None).cast("string")
    for name, pattern in reversed(SECTION_HEADERS):
        rx = _header_regex(pattern, tolerant)
        hit = line.rlike(rx)
        header = F.when(hit, F.lit(name)).otherwise(header)
        rest = F.when(hit, F.regexp_replace(line, rx + f"{WS_CLASS}*", "")).otherwise(line if name == SECTIONS[-1] else rest)
    return F.struct(header.alias("header"), F.nullif(rest, F.lit("")).alias("text"))


def parse_sections(df: DataFrame, doc: str = "doc", content: str = "content",
                   tolerant: bool = False) -> DataFrame:
    """Split a reply into synopsis, summary and key notes.

    Lines are stripped; a line starting with a header switches the section
    and its remaining text opens it (a repeated header with text replaces
    the section, without text keeps it); other non-blank lines are appended
    with one blank; text before any header is dropped; missing sections get
    their default.

    All of it happens inside the row, without a shuffle: lines are labelled, each
    header takes the lines up to the next one, and a section joins its headers'
    lines.  One row per reply, so replies that share a key stay apart; a null
    reply gets the defaults.
    """
    rows = df.select(doc, F.transform(F.split(F.col(content), "\n", -1), lambda raw: _labelled(strip(raw), tolerant)).alias("_rows"))
    numbered = F.transform("_rows", lambda r, i: F.struct(i.alias("at"), r["header"].alias("header"), r["text"].alias("text")))
    rows = rows.select(doc, "_rows", F.filter(numbered, lambda h: h["header"].isNotNull()).alias("_heads"))

    def lines_under(h, j):
        until = F.coalesce(F.try_element_at("_heads", j + 2)["at"], F.size("_rows"))
        texts = F.transform(F.slice("_rows", h["at"] + 1, until - h["at"]), lambda r: r["text"])
        return F.struct(h["header"].alias("header"), h["text"].isNotNull().alias("opens"), F.filter(texts, lambda t: t.isNotNull()).alias("texts"))
    rows = rows.select(doc, F.transform("_heads", lines_under).alias("_blocks"))

    def section(name: str):
        mine = F.filter("_blocks", lambda b: b["header"] == name)
        opened = F.coalesce(F.array_max(F.transform(mine, lambda b, i: F.when(b["opens"], i))), F.lit(0))
        kept = F.slice(mine, opened + 1, F.size(mine))
        return F.array_join(F.flatten(F.transform(kept, lambda b: b["texts"])), " ")
    return rows.select(doc, *[F.coalesce(F.nullif(strip(section(s)), F.lit("")), F.lit(SECTION_DEFAULTS[s])).alias(s)
                              for s in SECTIONS])


DECISION_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("motion", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("yes", T.IntegerType()),
    T.StructField("no", T.IntegerType()),
]))


def parse_decisions(df: DataFrame, doc: str = "doc", content: str = "content") -> DataFrame:
    """R2: one row per record of a JSON array reply.  Invalid JSON, a fenced
    reply, single quotes, text after the array or anything that is not an
    array gives no row: ``from_json`` alone would wrap a bare object into a
    one-element array and stop reading at the closing bracket."""
    whole = F.col(content).rlike(f"(?s)^{WS_CLASS}*\\[.*\\]{WS_CLASS}*$")
    arr = F.when(whole, F.from_json(content, DECISION_SCHEMA, {"allowSingleQuotes": "false"}))
    return df.select(doc, F.posexplode(arr).alias("idx", "d")).select(
        doc, "idx", "d.motion", "d.result", "d.yes", "d.no")


def placeholder(status: str = "status", error: str = "error"):
    """Fixed (synopsis, summary, key_notes) record for a failed call."""
    st, err = F.col(status), F.coalesce(F.col(error), F.lit(""))
    cols = []
    for i, name in enumerate(SECTIONS):
        expr = None
        for s, texts in PLACEHOLDERS.items():
            t = texts[i]
            val = F.concat(F.lit(t.split("{e}")[0]), err) if "{e}" in t else F.lit(t)
            expr = F.when(st == s, val) if expr is None else expr.when(st == s, val)
        cols.append(expr.alias(name))
    return cols
