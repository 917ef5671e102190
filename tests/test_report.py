import datetime as dt
import json

from minutebook.operators import report

ATT = "Date string, Category_1 string, Category_2 string, Name_1 string, Name_2 string, `Title/Role` string, row_no long"


def test_attendees_keep_nulls_and_drop_bad_dates(spark):
    att = spark.createDataFrame([
        ("1973-01-15", "A", "B", "n1", None, "t1", 2),
        ("01/15/1973", "C", "D", "n0", "m0", "t0", 1),
        ("n/a", "E", "F", "n9", None, "t9", 3),
    ], ATT)
    rows = report.attendees_by_date(att).collect()
    assert len(rows) == 1 and rows[0]["Date"] == dt.date(1973, 1, 15)
    summ = spark.createDataFrame([("1973-01-15", "f.pdf", "s", "u", "k"), ("1963-01-15", "g.pdf", "s", "u", "k")],
                                 "Date string, PDF_File string, Synopsis string, Summary string, `Key Notes` string")
    merged = {r["PDF_File"]: r["Attendees"] for r in report.merge_report(summ, att).collect()}
    assert merged["g.pdf"] is None
    recs = json.loads(merged["f.pdf"])
    assert [r["Name_1"] for r in recs] == ["n0", "n1"]          # input order
    assert "Name_2" in recs[1] and recs[1]["Name_2"] is None    # nulls kept


def test_run_stats_average_only_when_processed(spark):
    df = spark.createDataFrame([("already_ocr", 2.0), ("failed", 1.0)], "status string, seconds double")
    r = report.run_stats(df).first()
    assert (r.found, r.already_ocr, r.processed, r.failed, r.avg_seconds) == (2, 1, 0, 1, None)
    df = spark.createDataFrame([("already_ocr", 2.0), ("processed", 4.0), ("failed", 3.0)],
                               "status string, seconds double")
    assert report.run_stats(df).first().avg_seconds == 4.5


def test_merge_report_long_has_one_row_per_attendee(spark):
    att = spark.createDataFrame([
        ("1973-01-15", "A", "B", "n1", None, "t1", 2), ("01/15/1973", "C", "D", "n0", "m0", "t0", 1),
        ("n/a", "E", "F", "n9", None, "t9", 3)], ATT)
    summ = spark.createDataFrame([("1973-01-15", "f.pdf", "s", "u", "k"), ("1963-01-15", "g.pdf", "s", "u", "k")],
                                 "Date string, PDF_File string, Synopsis string, Summary string, `Key Notes` string")
    rows = report.merge_report_long(summ, att).collect()
    assert sorted((r.PDF_File, r.Name_1) for r in rows) == [("f.pdf", "n0"), ("f.pdf", "n1"), ("g.pdf", None)]
