import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from minutebook.operators import segment


def test_is_start_goldens(spark):
    df = spark.createDataFrame([("THE BOARD OF EDUCATION",), ("MEETING OF",), ("MEETING OF JANUARY 5, 1971",)],
                               "text string")
    got = [r[0] for r in df.select(segment.is_start(F.col("text"))).collect()]
    assert got == [True, False, True]


PAGES = [
    ("p1", "NOTHING HERE"),                                  # before any meeting: unassigned
    ("p2", "MEETING OF JANUARY 5, 1971"),                    # start + date: opens d1
    ("p3", "THE BOARD OF EDUCATION"),                        # start without date: stays d1
    ("p4", "JANUARY 9, 1971"),                               # date without phrase: stays d1
    ("p5", "MEETING OF FEBRUARY 2, 1971"),                   # start + date2: opens d2
    ("p6", "NOTHING"),                                       # stays d2
]


def _pages(spark, n_parts=1):
    return spark.createDataFrame([("c", n, t, i) for i, (n, t) in enumerate(PAGES)],
                                 "collection string, page_name string, text string, page_no int").repartition(n_parts)


def test_assign_meetings_golden(spark):
    got = {r.page_name: r.meeting_date for r in segment.assign_meetings(_pages(spark)).collect()}
    d1, d2 = dt.date(1971, 1, 5), dt.date(1971, 2, 2)
    assert [got[f"p{i}"] for i in range(1, 7)] == [None, d1, d1, d1, d2, d2]


def test_bucketed_equals_plain_and_ignores_partitioning(spark):
    rows = []
    for i in range(400):
        k = i % 23
        text = ("MEETING OF MARCH %d, 1972" % (1 + i % 27)) if k == 3 else (
            "THE BOARD OF EDUCATION" if k == 7 else "PAGE %d" % i)
        rows.append(("c%d" % (i % 2), "%05d" % i, text, i))
    df = spark.createDataFrame(rows, "collection string, page_name string, text string, page_no int")
    plain = {(r.collection, r.page_name): r.meeting_date for r in segment.assign_meetings(df).collect()}
    for parts in (1, 7):
        b = df.repartition(parts).withColumn("bucket", F.expr("page_no div 37"))
        got = {(r.collection, r.page_name): r.meeting_date
               for r in segment.assign_meetings_bucketed(b, bucket="bucket").collect()}
        assert got == plain
    assert any(v is None for v in plain.values()) and any(v is not None for v in plain.values())


def test_number_pages_case_insensitive(spark):
    df = spark.createDataFrame([("c", "k", "B.jpg"), ("c", "k", "a.jpg"), ("c", "k", "C.jpg")],
                               "collection string, meeting_key string, page_name string")
    got = {r.page_name: r.page_in_meeting for r in segment.number_pages(df).collect()}
    assert got == {"a.jpg": 1, "B.jpg": 2, "C.jpg": 3}


def test_number_pages_over_many_ranges_equals_a_window(spark):
    rows = [("c%d" % (i % 3), "m%d" % (i % 5), "%s%04d.jpg" % ("AB"[i % 2], (i * 37) % 1000)) for i in range(600)]
    rows += [("c0", "m0", "big%05d.jpg" % i) for i in range(900)]  # one meeting with most of the pages
    df = spark.createDataFrame(rows, "collection string, meeting_key string, page_name string")
    w = Window.partitionBy("collection", "meeting_key").orderBy(F.lower("page_name"), "page_name")
    plain = {tuple(r) for r in df.withColumn("n", F.row_number().over(w)).collect()}
    assert {tuple(r) for r in segment.number_pages(df, rows_per_range=50).collect()} == plain


def test_assign_meetings_over_many_ranges_equals_a_window(spark):
    rows = [("c%d" % (i % 2) if i % 3 else "big", "%05d" % i, "MEETING OF MARCH %d, 1972" % (1 + i % 27) if i % 23 == 3 else "PAGE", i)
            for i in range(700)]
    df = spark.createDataFrame(rows, "collection string, page_name string, text string, page_no int").repartition(5)
    w = Window.partitionBy("collection").orderBy("page_name").rowsBetween(Window.unboundedPreceding, 0)
    c = segment.classify_pages(df).withColumn("d", F.last("start_date", ignorenulls=True).over(w))
    plain = {(r.collection, r.page_name): r.d for r in c.collect()}
    got = {(r.collection, r.page_name): r.meeting_date for r in segment.assign_meetings(df, rows_per_range=20).collect()}
    assert got == plain and any(v is None for v in plain.values())

