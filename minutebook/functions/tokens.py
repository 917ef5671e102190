"""Word tokens: one token = one word with the whitespace before it, plus one
token for trailing whitespace.  Joining the tokens gives the text back, so
chunks built from them are lossless.  This stands in for byte-pair tokens
(whose tables need a download); every limit is a parameter."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import NON_WS_CLASS, WS_CLASS

TOKEN_PATTERN = f"{WS_CLASS}*{NON_WS_CLASS}+|{WS_CLASS}+\\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(TOKEN_PATTERN), 0)


def token_count(text) -> Column:
    return F.size(tokens(text)).cast("bigint")


def tokens_up_to(text, limit: int) -> Column:
    """``token_count`` where that is ``limit`` or less, else some number above ``limit``: the beginning of a text
    never has more tokens than the text, so a very long one is seldom read to its end."""
    t = _col(text)
    chars = F.lit(64 * limit)
    enough = (F.octet_length(t) > chars) & (token_count(F.left(t, chars)) > limit)  # bytes need no counting
    return F.when(enough, F.lit(limit + 1).cast("bigint")).otherwise(token_count(t))
