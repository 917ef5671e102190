from pyspark.sql import functions as F

from minutebook.functions.patterns import MARKER_LENGTH, MARKER_LONGER
from minutebook.functions.text import clean_text, strip, truncate_for_prompt, word_count
from minutebook.functions.tokens import token_count, tokens


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


def test_clean_text_replacements_do_not_overlap(spark):
    assert one(spark, clean_text, "we saw tho tho cat") == "we saw the tho cat"


def test_clean_text_steps(spark):
    raw = "A.\n \n\nB,  \tC é² ☃ “q”  "
    # three line breaks -> two; blanks/tabs -> one; symbols -> blank; strip
    assert one(spark, clean_text, raw) == "A.\n\nB, C é²    q"


def test_strip_removes_newlines(spark):
    assert one(spark, strip, "\n\t x \n") == "x"


def test_truncation_keeps_second_marker_only(spark):
    out = one(spark, truncate_for_prompt, "a" * 20001)
    assert out == "a" * 15000 + MARKER_LONGER
    assert MARKER_LENGTH not in out
    assert one(spark, truncate_for_prompt, "a" * 15000) == "a" * 15000


def test_word_count_ignores_edges(spark):
    assert one(spark, word_count, "  a b ") == 2
    assert one(spark, word_count, "") == 0


def test_tokens_are_lossless(spark):
    text = "  Hello  world,\nthis is\ta test.  "
    toks = one(spark, tokens, text)
    assert "".join(toks) == text
    assert one(spark, token_count, text) == len(toks) == 7
