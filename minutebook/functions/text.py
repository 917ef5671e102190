"""Scalar text columns: upper-casing, clean-up, truncation, counts."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import (KEPT_PUNCTUATION, MARKER_LENGTH, MARKER_LONGER, MAX_CHARS,
                       MAX_PROMPT_CHARS, OCR_FIXES, WS, WS_CLASS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_text(text) -> Column:
    """Page text is upper-cased before any matching."""
    return F.upper(_col(text))


def strip(text) -> Column:
    """Python ``str.strip()``: Spark's ``trim`` leaves newlines and tabs."""
    return F.regexp_replace(_col(text), f"^{WS_CLASS}+|{WS_CLASS}+\\z", "")


def clean_text(text, fixes=OCR_FIXES) -> Column:
    """OCR clean-up, in order: three or more line breaks with blanks between
    become two; runs of blanks/tabs become one blank; characters other than
    word characters, whitespace and the kept punctuation become a blank; the
    literal fixes; strip."""
    t = _col(text)
    t = F.regexp_replace(t, f"\\n{WS_CLASS}*\\n{WS_CLASS}*\\n", "\n\n")
    t = F.regexp_replace(t, "[ \\t]+", " ")
    t = F.regexp_replace(t, f"[^\\p{{L}}\\p{{N}}_{WS}{KEPT_PUNCTUATION}]", " ")
    t = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), fixes, t)
    return strip(t)


def truncate_text(text, n: int, marker: str) -> Column:
    """Cut to ``n`` characters and add the marker when longer than ``n``."""
    t = _col(text)
    return F.when(F.length(t) > n, F.concat(F.left(t, F.lit(n)), F.lit(marker))).otherwise(t)


def truncate_for_prompt(text) -> Column:
    """Both cuts: 20,000 with its marker at extraction, then 15,000 with the
    second marker before the prompt.  A text over 20,000 therefore always
    goes through both cuts and keeps the second marker only."""
    return truncate_text(truncate_text(text, MAX_CHARS, MARKER_LENGTH),
                         MAX_PROMPT_CHARS, MARKER_LONGER)


def words(text) -> Column:
    """Whitespace-separated non-empty tokens (``str.split()``)."""
    return F.filter(F.split(_col(text), f"{WS_CLASS}+"), lambda w: w != "")


def word_count(text) -> Column:
    return F.size(words(text)).cast("bigint")


def minutes(seconds) -> Column:
    """Seconds to minutes, two decimals, ties to even."""
    return F.bround(_col(seconds) / 60.0, 2)
