"""Expected rows reasoned by hand, and laws that hold on random inputs."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from minutebook.functions.dates import parse_date, with_page_date
from minutebook.functions.text import clean_text
from minutebook.operators import catalog, chunk, model, parse, qc, report, segment
from minutebook.sources import io

DATES = [
    ("MEETING OF JANUARY 5, 1971", dt.date(1971, 1, 5)),
    ("MEETING 3/14/1972", dt.date(1972, 3, 14)),
    ("MEETING 13/1/1971", None),            # no 13th month
    ("MEETING 2/30/1971", None),            # no such day
    ("MEETING OF MAY 2, 1899", None),       # before the archive's years
    ("OKLAHOMA CITY 1971-01-05", None),     # year first is an option
    ("nothing here", None),
]


def test_dates_by_hand(spark):
    df = spark.createDataFrame(DATES, "t string, want date")
    got = with_page_date(df.withColumn("a", parse_date(F.col("t"))), "t", "b").collect()
    assert [(r.t, r.a, r.b) for r in got] == [(t, d, d) for t, d in DATES]


def test_clean_text_laws(spark):
    rnd = random.Random(11)
    parts = ["moon", "lamp", "x", ".", "\n", " \n ", "\t", "€", "☃", "é²", "$5", "(a)", " ", "—", "_"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", clean_text("t").alias("c"))
    for r in df.collect():
        assert r.c == r.c.strip() and "\t" not in r.c and not set("€☃—") & set(r.c)
        assert r.c.replace(" ", "").replace("\n", "") == "".join(x for x in r.t if x not in "€☃— \t\n")   # nothing else is lost


SECTIONS = [
    ("Synopsis: a\nSummary: b\nKey Notes: c", ("a", "b", "c")),
    ("Synopsis: a\nmore\n\nSummary:\nb\nKey Notes: c", ("a more", "b", "c")),
    ("lead\nSynopsis: a\nSynopsis: z\nSummary: b\nKey Notes: c", ("z", "b", "c")),
]


def test_sections_by_hand(spark):
    rows = [(i, c) for i, (c, _) in enumerate(SECTIONS)]
    got = {r.doc: (r.synopsis, r.summary, r.key_notes) for r in parse.parse_sections(
        spark.createDataFrame(rows, "doc int, content string")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(SECTIONS)}


def test_chunk_starts_laws(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.randint(1, 12) for _ in range(rnd.randint(1, 30))]) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, c array<bigint>")
    for r in df.select("c", chunk.pack_starts(F.col("c"), 10).alias("s")).collect():
        ends = [*r.s[1:], len(r.c)]
        assert r.s[0] == 0 and r.s == sorted(set(r.s))
        for a, b in zip(r.s, ends):
            assert sum(r.c[a:b]) <= 10 or b - a == 1                   # within the limit, or one long item
            assert b == len(r.c) or sum(r.c[a:b + 1]) > 10             # and no item more would fit


def test_blank_candidates_give_an_empty_text(spark):
    df = spark.createDataFrame([("p", 0, " \n "), ("p", 1, ""), ("q", 0, " "), ("q", 1, "x")],
                               "path string, config_rank int, text string")
    assert {r.path: r.text for r in catalog.best_candidate(df).collect()} == {"p": "", "q": "x"}


DECISIONS = [("[{\"motion\": \"m\", \"yes\": 3}] ", 1), ("[{\"motion\": \"m\"}] as asked", 0), ("[{'motion': 'm'}]", 0),
             ("{\"motion\": \"m\"}", 0), ("\n[{\"motion\": \"a\"}, {\"motion\": \"b\"}]\n", 2)]


def test_strict_decision_replies(spark):
    rows = [(i, c) for i, (c, _) in enumerate(DECISIONS)]
    got = parse.parse_decisions(spark.createDataFrame(rows, "doc int, content string")).groupBy("doc").count().collect()
    assert {r.doc: r["count"] for r in got} == {i: n for i, (_, n) in enumerate(DECISIONS) if n}


def test_fuse_withholds_an_incomplete_text(spark):
    df = spark.createDataFrame([(1, 0, "one"), (1, 1, None), (1, 2, "three"), (2, 1, "b"), (2, 0, "a")],
                               "doc int, chunk_no int, content string")
    assert {r.doc: (r.fused, r.n_failed) for r in model.fuse(df, sep="|").collect()} == {1: (None, 1), 2: ("a|b", 0)}


def test_equal_dates_of_two_collections_are_two_meetings(spark):
    day = dt.date(1971, 1, 5)
    df = spark.createDataFrame([("a", "1971-01-05", day), ("a", "1971-01-05", None), ("b", "1971-01-05", day), ("b", "unassigned", None)],
                               "collection string, meeting_key string, start_date date")
    total = report.organization_report(df).where("level = 3").first()
    assert (total.n_files, total.n_starts, total.n_meetings, total.n_unassigned) == (4, 2, 2, 1)


def test_index_takes_one_row_per_file_of_a_batch(spark, tmpdir_path):
    df = spark.createDataFrame([("f", 1), ("f", 2), ("g", 1)], "file string, n int")
    io.append_index(df, tmpdir_path + "/index")
    io.append_index(df, tmpdir_path + "/index")
    assert sorted((r.file, r.n) for r in spark.read.parquet(tmpdir_path + "/index").collect()) == [("f", 1), ("g", 1)]


def test_any_number_of_terms(spark):
    docs = spark.createDataFrame([(1, "a B")], "doc_id int, text string")
    terms = spark.range(12000).select(F.concat(F.lit("t"), "id").alias("term")).unionByName(
        spark.createDataFrame([("a",), ("b",)], "term string"))
    (row,) = qc.check_terms(docs, terms).collect()
    assert len(row.detail.split(",")) == 12000


@pytest.mark.parametrize("text", ["1971-01-05", "1/5/1971", "01/05/1971", "January 5, 1971", "Jan 5, 1971", "1971-01-05 00:00:00"])
def test_attendee_date_formats(spark, text):
    df = spark.createDataFrame([(text,)], "d string").select(report.lenient_date("d").alias("d"))
    assert df.first().d == dt.date(1971, 1, 5)


def test_only_a_start_page_has_a_date(spark):
    pages = spark.createDataFrame([("c", "1.jpg", "nothing said on 3/14/1972")], "collection string, page_name string, text string")
    assert {(r.is_start, r.page_date) for r in segment.page_evidence(pages).collect()} <= {(False, None), (True, dt.date(1972, 3, 14))}


def test_request_settings_reach_the_client(spark):
    df = spark.createDataFrame([(1, "p", None, "s", "m1", 0.2)],
                               "doc int, prompt string, user_text string, source_text string, model string, temperature double")
    out = model.run_model(df, lambda: (lambda p, u, model, temperature: f"{p}:{model}:{temperature}"), keys=["doc"],
                          settings=("model", "temperature"))
    assert out.first().content == "p:m1:0.2"
