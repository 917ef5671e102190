"""Rows of whole transcripts: what a reader, a writer and a Python worker hold at once."""
import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from minutebook.functions.tokens import token_count, tokens_up_to
from minutebook.operators import model
from minutebook.plans.registry import QUERIES, WIDE_BYTES
from minutebook.session import WIDE_ROWS, stored
from minutebook.sources import io


def _wide(spark):
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(1600)), lambda i: F.sha2(F.concat("id", i).cast("binary"), 256)))
    return spark.range(0, 500, 1, 1).select(F.col("id").alias("doc"), F.lit("transcript").alias("doc_kind"), text.alias("body"))


def _row_groups(files):
    metas = [pq.ParquetFile(f).metadata for f in files]
    return [m.row_group(i).total_byte_size for m in metas for i in range(m.num_row_groups)]


def test_row_groups_of_wide_rows_are_bounded(spark, tmpdir_path):
    rows = stored(_wide(spark), "wide")
    groups = _row_groups([f.removeprefix("file://") for f in rows.inputFiles()])
    assert rows.count() == 500 and sum(groups) > 48e6 and max(groups) < 24e6
    io.write_documents(rows, os.path.join(tmpdir_path, "docs"), heading=None)
    groups = _row_groups(glob.glob(os.path.join(tmpdir_path, "docs", "*", "*.parquet")))
    assert sum(groups) > 48e6 and max(groups) < 24e6


def test_few_requests_are_python_objects_at_a_time(spark, monkeypatch):
    calls, taken = [], {}
    df = spark.createDataFrame([(1, "p", None, "s", "d")], "doc int, prompt string, user_text string, source_text string, date string")
    frame = type(df)
    monkeypatch.setattr(frame, "mapInArrow", lambda self, call, schema, *a: taken.update(call=call, columns=self.columns), raising=False)
    model.run_model(df, lambda: lambda p, u: calls.append(p) or p, keys=["doc"], retry_template="{text}", date="date", retry_chars=3)
    rows = [pa.array(range(1000), pa.int32())] + [pa.array([v] * 1000, t) for v, t in (
        ("p", pa.string()), (None, pa.string()), (False, pa.bool_()), ("s", pa.string()), ("d", pa.string()))]
    out = taken["call"](iter([pa.RecordBatch.from_arrays(rows, names=taken["columns"])]))
    first = next(out)
    assert len(calls) == first.num_rows <= 100
    assert first.num_rows + sum(b.num_rows for b in out) == len(calls) == 1000


def test_wide_rows_after_many_short_ones(spark):
    wide = _wide(spark).select("doc", "body")
    short = spark.range(0, 2500, 1, 1).select(F.col("id").alias("doc"), F.concat(F.lit("short "), "id").alias("body"))
    rows = stored(short.unionByName(wide).coalesce(1), "short-then-wide")
    groups = _row_groups([f.removeprefix("file://") for f in rows.inputFiles()])
    assert rows.count() == 3000 and sum(groups) > 48e6 and max(groups) < 24e6


def test_row_groups_hold_few_texts_however_well_they_pack(spark):
    same = spark.range(0, 500, 1, 1).select(F.col("id").alias("doc"), F.repeat(F.lit("Ann Lee, "), 12000).alias("body"))
    rows = stored(same, "same", WIDE_ROWS)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in rows.inputFiles()]
    counts = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(counts) == 500 and max(counts) <= 64
    assert rows.where(F.length("body") == 108000).count() == 500


def test_tokens_are_counted_as_far_as_asked(spark):
    texts = [None, "", " ", "a", "a ", " a b", "a\u2003b \n", "a b c " * 100, " " * 500, " " * 500 + "a", "x" * 999, "x" * 99 + " y z w v " + "u " * 9, "é\x1c" * 70]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for limit in (0, 1, 2, 3, 50):
        for r in df.select(token_count("t").alias("n"), tokens_up_to("t", limit).alias("m")).collect():
            assert r.m == r.n or (r.n > limit and r.m > limit), (limit, r)
    far = "a b " * 1000 + " c" * 5_000_000
    got = spark.createDataFrame([(far,)], "t string").select(tokens_up_to("t", 40)).first()[0]
    assert got == 41  # not read to its end


def test_even_kinds_are_written_where_they_lie(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "docs")
    rows = [("m1", "transcript", "one"), ("m2", "transcript", "two"), ("m1", "summary", "s"), ("m1", "summary", "s"), ("m3", None, "n"), (None, "transcript", None)]
    df = spark.createDataFrame(rows, "doc string, doc_kind string, body string")

    def read():
        back = spark.read.parquet(path).select("doc", F.col("doc_kind").cast("string"), "body", "markdown")
        return sorted(map(tuple, back.collect()), key=str)
    for _ in range(2):  # a repeated write replaces its kinds
        io.write_documents(df.repartition(3), path, heading=None, even=("transcript",))
        assert read() == sorted([(*r, r[2]) for r in rows], key=str)
    io.write_documents(df.where("doc_kind = 'summary'"), path, heading="doc")
    assert ("m1", "summary", "s", "# m1\n\ns") in read() and len(read()) == 6


def test_wide_transcripts_share_no_task_with_short_ones(spark, tmpdir_path):
    spark.range(30000).select(F.col("id").alias("s_suppkey"), F.format_string("Supplier#%09d", "id").alias("s_name")).write.parquet(f"{tmpdir_path}/supplier.parquet")
    spark.range(48).select("id", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("turn")).select(
        F.col("id").alias("conv_id"), "turn", F.concat(F.lit("words of "), "id").alias("text")).write.parquet(f"{tmpdir_path}/conversations.parquet")
    out = QUERIES["s7_write_documents"](spark, tmpdir_path).where("doc_kind <> 'decision'")
    n = F.octet_length("markdown")
    tasks = out.groupBy(F.spark_partition_id().alias("task")).agg(F.min(n).alias("least"), F.max(n).alias("most")).collect()
    assert max(t.most for t in tasks) > WIDE_BYTES > min(t.least for t in tasks)
    assert all(t.most <= WIDE_BYTES or t.least > WIDE_BYTES for t in tasks), tasks
    got = {r.doc_kind: r.n for r in out.groupBy("doc_kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got["transcript"] == 48
