"""The distributed scan and paged lists against windows and plain Python."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from minutebook.operators import report, scan


def _rows():
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else None if i % 5 == 0 else "g%d" % (i % 7), i * 7919 % 1009, rnd.choice([None, i]), rnd.randint(0, 9))
            for i in range(800)]
    return rows


@pytest.mark.parametrize("rows_per_range, fanout", [(10 ** 6, 4096), (20, 4096), (10, 3)])
def test_running_equals_a_window(spark, rows_per_range, fanout):
    df = spark.createDataFrame(_rows(), "g string, o int, v int, n int").repartition(6)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"seen": F.last("v", ignorenulls=True).over(w), "sum": F.sum("n").over(w).cast("long")}).collect()
    got = scan.running(df, ["g"], ["o"], last={"seen": "v"}, total={"sum": F.col("n").cast("long")},
                       rows_per_range=rows_per_range, fanout=fanout)
    assert got.columns == ["g", "o", "v", "n", "seen", "sum"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want))
    assert scan.running(df.limit(0), ["g"], ["o"], total={"sum": F.col("n")}).count() == 0


def test_a_hot_group_is_spread(spark):
    df = spark.range(5000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    per = scan.ranges(df, ["g"], ["o"], rows_per_range=250).groupBy("_range").count().collect()
    assert len(per) >= 15 and max(r["count"] for r in per) < 1000


def test_pages_hold_every_value_in_order_within_bounds(spark):
    rnd = random.Random(4)
    rows = [("a" if i % 4 else "b", i, "x" * rnd.randint(0, 30) if i % 9 else None) for i in range(500)]
    rows += [("c", 0, "é" * 100), ("c", 1, "z")]
    pages = scan.paged(spark.createDataFrame(rows, "g string, o int, v string").repartition(4), ["g"], ["o"], "v", 64, rows_per_range=30).collect()
    for g in "abc":
        mine = sorted((p for p in pages if p.g == g), key=lambda p: p.page_no)
        assert [v for p in mine for v in p["values"]] == [v or "" for k, _, v in sorted(rows, key=lambda r: r[1]) if k == g]
        assert [p.n_before for p in mine] == [sum(q.n_values for q in mine[:i]) for i in range(len(mine))]
        assert all(sum(len(v.encode()) + 1 for v in p["values"][:-1]) < 64 for p in mine)
    assert [(p.page_no, p.n_before) for p in sorted(pages, key=lambda p: p.page_no) if p.g == "c"] == [(0, 0), (3, 1)]


def test_paged_report_has_the_rows_of_the_list(spark):
    att = spark.createDataFrame([("1971-01-05", "c", "d", f"n{i}", None, "t", i) for i in range(40)] + [("n/a", "c", "d", "lost", None, "t", 99)],
                                "Date string, Category_1 string, Category_2 string, Name_1 string, Name_2 string, `Title/Role` string, row_no int")
    summaries = spark.createDataFrame([("1971-01-05", "p"), ("1972-02-02", "q")], "Date string, PDF_File string")
    whole = {r.PDF_File: r.Attendees for r in report.merge_report(summaries, att).collect()}
    pages = report.merge_report_paged(summaries, att, page_bytes=300).orderBy("PDF_File", "page_no").collect()
    parts = [r.Attendees[1:-1] for r in pages if r.PDF_File == "p"]
    assert len(parts) > 5 and "[" + ",".join(parts) + "]" == whole["p"]
    assert [(r.page_no, r.n_values, r.Attendees) for r in pages if r.PDF_File == "q"] == [(0, 0, None)]
    assert report.merge_report_long(summaries, att).count() == 41
