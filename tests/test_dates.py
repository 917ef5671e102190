import datetime as dt

import pytest
from pyspark.sql import functions as F

from minutebook.functions.dates import file_date_key, folder_year, parse_date, part_no, recording_date
from minutebook.functions.text import upper_text


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("MEETING OF JANUARY 5, 1971", dt.date(1971, 1, 5)),
    ("1971-01-05", None),                                   # year first is never read
    ("ROOM 12, 1234 THEN JANUARY 5, 1971", None),           # first match only, no rescue phrase
    ("ROOM 12, 1234 MEETING HELD JANUARY 5, 1971", dt.date(1971, 1, 5)),  # pattern 6
    ("FEBRUARY 30, 1971", None),
    ("SEPT 3, 1974", dt.date(1974, 9, 3)),
    ("13/1/1971", None),                                    # month 13
    ("BOARD OF EDUCATION 3/14/1972", dt.date(1972, 3, 14)),
    ("meeting of january 5, 1971", None),                   # parse_date expects upper case
])
def test_parse_date_goldens(spark, text, expected):
    assert one(spark, parse_date, text) == expected


def test_parse_date_after_upper(spark):
    assert one(spark, lambda c: parse_date(upper_text(c)), "Meeting of January 5, 1971") == dt.date(1971, 1, 5)


def test_file_date_key(spark):
    df = spark.createDataFrame([
        ("1973_01_15_OCR.pdf", "box"), ("scan.pdf", "1970-01-05"), ("scan.pdf", "x1970-01-05"),
        ("1970-13-01_x.pdf", "1970-01-05"), ("1970-02-30.pdf", "box")], "name string, parent string")
    got = [r[0] for r in df.select(file_date_key("name", "parent")).collect()]
    assert got == [dt.date(1973, 1, 15), dt.date(1970, 1, 5), None, dt.date(1970, 1, 5), None]


def test_recording_date(spark):
    assert one(spark, recording_date, "board_1975-06-05") == "June 05, 1975"
    assert one(spark, recording_date, "board_19750605") == "an unknown date"
    assert one(spark, recording_date, "x_1975-02-30_1975-03-01") == "March 01, 1975"


def test_part_no_and_folder_year(spark):
    assert one(spark, part_no, "a_PART_010") == 10
    assert one(spark, part_no, "a") == 0
    assert one(spark, folder_year, "boe_meeting_1972-01-05_x") == "1972"
    assert one(spark, folder_year, "boe_meeting_1972-01-05_x_y") is None
    assert one(spark, folder_year, "a_b_-x_c") is None      # empty year: no roster header


def test_with_page_date_equals_parse_date(spark):
    from minutebook.functions.dates import with_page_date
    from minutebook.plans import views as V
    from tests.conftest import SF_SMALL
    golden = ["MEETING OF JANUARY 5, 1971", "1971-01-05", "ROOM 12, 1234 THEN JANUARY 5, 1971",
              "ROOM 12, 1234 MEETING HELD JANUARY 5, 1971", "FEBRUARY 30, 1971", "SEPT 3, 1974", "13/1/1971",
              "XJANUARY 5, 1971 AND MAY 2, 1970", "BOARD X EDUCATION Y JUNE 3, 1975"]
    df = spark.createDataFrame([(g,) for g in golden], "text string").unionByName(
        V.v_pages(spark, SF_SMALL).select(F.upper("text").alias("text")))
    out = with_page_date(df.withColumn("ref", parse_date(F.col("text"))), "text")
    assert out.where("NOT (ref <=> page_date)").count() == 0
