"""Option paths that the registered queries do not take."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from minutebook.functions.dates import parse_date
from minutebook.operators import catalog, chunk, model, qc, segment
from minutebook.sources import io
from minutebook.streaming.index import stream_index


def test_parse_date_iso_option(spark):
    df = spark.createDataFrame([("OKLAHOMA CITY 1971-01-05",), ("1971-13-05",)], "t string")
    got = [r[0] for r in df.select(parse_date(F.col("t"), iso=True)).collect()]
    assert got == [dt.date(1971, 1, 5), None]
    assert df.select(parse_date(F.col("t"))).first()[0] is None


def test_assign_meetings_with_key_list(spark):
    df = spark.createDataFrame([("a", "x", "p1", "MEETING OF MAY 2, 1972"), ("a", "y", "p2", "NOTHING"),
                                ("a", "x", "p3", "NOTHING")], "c1 string, c2 string, page_name string, text string")
    got = {r.page_name: r.meeting_key for r in segment.assign_meetings(df, part_by=["c1", "c2"]).collect()}
    assert got == {"p1": "1972-05-02", "p2": "unassigned", "p3": "1972-05-02"}


def test_list_files_recursive(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "1970-01-05"))
    for rel in ("a.pdf", "1970-01-05/b_ocr.pdf", "1970-01-05/c.txt"):
        with open(os.path.join(tmpdir_path, rel), "wb") as f:
            f.write(b"%PDF")
    files = io.list_files(spark, tmpdir_path, exts=[".pdf"], recursive=True)
    got = {(r.name, r.parent) for r in files.collect()}
    assert ("b_ocr.pdf", "1970-01-05") in got and len(got) == 2
    assert [r.name for r in catalog.best_version(files).collect()] == ["b_ocr.pdf"]


def test_run_model_bounded_partitions(spark):
    df = spark.range(20).select(F.col("id").alias("doc"), F.lit("p").alias("prompt"),
                                F.lit(None).cast("string").alias("user_text"), F.lit("x").alias("source_text"))
    out = model.run_model(df, lambda: (lambda p, u: p + "!"), keys=["doc"], partitions=3)
    assert out.rdd.getNumPartitions() == 3 and out.where("content = 'p!'").count() == 20


def test_stream_in_bounded_batches(spark, tmpdir_path):
    rows = spark.createDataFrame([("f%d.wav" % i, "s_1970-01-0%d" % (i + 1), 60.0 * i, "a b c") for i in range(4)],
                                 "file string, stem string, duration_s double, transcript string")
    inp = os.path.join(tmpdir_path, "in")
    rows.repartition(4).write.parquet(inp)
    out = stream_index(spark, inp, os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck"),
                       max_files_per_trigger=1)
    assert sorted(r.file for r in out.collect()) == ["f0.wav", "f1.wav", "f2.wav", "f3.wav"]


def test_token_chunks_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "x", "a b c")], "id int, tag string, body string")
    row = chunk.token_chunks(df, 2, text="body").orderBy("chunk_no").first()
    assert (row.id, row.tag, row.text, row.n_tokens) == (1, "x", "a b", 2)


def test_with_page_date_iso_matches_column_form(spark):
    from minutebook.functions.dates import with_page_date
    df = spark.createDataFrame([("OKLAHOMA CITY 1971-01-05",), ("MEETING OF MAY 2, 1972 1971-01-05",), ("X",)],
                               "t string")
    out = with_page_date(df.withColumn("ref", parse_date(F.col("t"), iso=True)), "t", iso=True)
    assert out.where("NOT (ref <=> page_date)").count() == 0
    assert out.where("page_date IS NOT NULL").count() == 2
