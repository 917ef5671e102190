"""Meetings with the members of their year: rows, tasks and counts."""
import random

from pyspark.sql import functions as F

from minutebook.operators import assemble, qc

TEXTS = "meeting string, year string, transcript string"


def test_members_of_one_year_are_dealt_over_tasks(spark, monkeypatch):
    meetings = spark.range(3000).select(F.concat(F.lit("m"), "id").alias("meeting"), F.lit("1972").alias("year"))
    roster = spark.range(20).select(F.concat(F.lit("n"), "id").alias("name"), F.lit("1970-1972").alias("year_range"))
    for mode in ("contains", "range"):
        out = assemble.roster_for(meetings, roster, mode=mode)
        per = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(per) == 60000 and len(per) >= 4 and max(per) < 40000, (mode, per)


def test_roster_with_repeated_and_null_rows(spark):
    rng = random.Random(5)
    years = ["1970", "1971", "1975", "x", "7", None, ""]
    meetings = [(f"m{i % 500}" if i % 50 else None, rng.choice(years)) for i in range(900)]
    roster = [(rng.choice(["a", "b", None]), rng.choice(["1970-1975", "1971", "x", None, "", "1975-1970", "1969-1971"]), i % 3) for i in range(40)]
    m, r = spark.createDataFrame(meetings, "meeting string, year string"), spark.createDataFrame(roster, "name string, year_range string, row_no int")

    def want(fits):
        out = []
        for k, y in meetings:
            hits = [x for x in roster if y is not None and x[1] is not None and fits(y, x[1])]
            out += [(k, y, *h) for h in hits] or [(k, y, None, None, None)]
        return sorted(out, key=str)

    def between(y, text):
        return len(text) == 9 and y.isdigit() and len(y) == 4 and text[:4] <= y <= text[5:]
    cols = ["meeting", "year", "name", "year_range", "row_no"]
    got = assemble.roster_for(m, r).select(*cols).collect()
    # an empty year meets the empty range only
    assert sorted(map(tuple, got), key=str) == want(lambda y, t: y in t if y else not t)
    got = assemble.roster_for(m, r, mode="range").select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == want(between)


def test_missing_names_counted_as_listed(spark):
    rng = random.Random(4)
    pieces = ["ann", "lee", "O'Neil", "Jo", "x", "Mary-Jane"]
    names = [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 2))) for _ in range(30)] + [None, "Ann Lee", "ann lee"]
    members = spark.createDataFrame([(str(1970 + rng.randint(0, 2)), n) for n in names], "year string, name string")
    texts = [(f"m{i // 2}" if i != 9 else None, str(1970 + i % 4) if i % 7 else None,
              " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    texts = spark.createDataFrame(texts, TEXTS)
    listed = qc.check_names(texts, members, by="year")
    files = texts.select(F.col("meeting").alias("file"))
    counted = qc.check_names(texts, members, by="year", listed=False)
    assert listed.groupBy("file").count().exceptAll(counted.groupBy("file").agg(F.sum("n"))).count() == 0
    a, b = (qc.qc_report([x], files).collect() for x in (listed, counted))
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str) and len([x for x in a if x.status == "fail"]) > 10


def test_counted_names_make_no_row_for_each_member(spark):
    texts = spark.range(200).select(F.concat(F.lit("m"), "id").alias("meeting"), F.lit("1970").alias("year"), F.lit("nobody").alias("transcript"))
    members = spark.range(5000).select(F.lit("1970").alias("year"), F.concat(F.lit("A "), "id").alias("name"))
    got = qc.check_names(texts, members, by="year", listed=False).collect()
    assert len(got) == 200 and {r.n for r in got} == {5000}
