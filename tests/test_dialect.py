"""The Spark-side character classes must equal Python's, code point by code
point (the archive tools are Python; the oracle spells the same sets for RE2)."""
import re

from pyspark.sql import functions as F

from minutebook.functions.patterns import WS_CLASS


def _bmp(spark):
    cps = [c for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    return cps, spark.createDataFrame([(c, chr(c)) for c in cps], "cp int, ch string")


def test_whitespace_class_equals_python_isspace(spark):
    cps, df = _bmp(spark)
    got = {r.cp for r in df.where(F.col("ch").rlike("^" + WS_CLASS + "$")).collect()}
    want = {c for c in cps if chr(c).isspace()}
    assert got == want


def test_word_class_close_to_python_w(spark):
    cps, df = _bmp(spark)
    got = {r.cp for r in df.where(F.col("ch").rlike("^[\\p{L}\\p{N}_]$")).collect()}
    want = {c for c in cps if re.match(r"\w", chr(c))}
    # Python's \w follows str.isalnum(); the categories agree except for
    # letters added in recent Unicode versions that the JVM's tables lack
    # (56 code points such as U+0870-U+088E with Python 3.13).
    diff = got ^ want
    assert len(diff) < 100, sorted(diff)[:20]
