import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutebook.sources import io


def test_list_files_any_case_no_content(spark, tmpdir_path):
    for name in ("b.JPG", "a.jpg", "c.txt", "d.png"):
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(b"x")
    df = io.list_files(spark, tmpdir_path)
    assert sorted(r.name for r in df.collect()) == ["a.jpg", "b.JPG", "d.png"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[-1].split("\n")[0]


def test_read_table_missing_ok(spark, tmpdir_path):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("year_range", T.StringType())])
    assert io.read_table(spark, os.path.join(tmpdir_path, "nope.csv"), schema, missing_ok=True).count() == 0


def test_write_csv_json_arrays_and_append_index(spark, tmpdir_path):
    df = spark.createDataFrame([("d", [("x", None)])], "Date string, Attendees array<struct<a:string,b:string>>")
    out = os.path.join(tmpdir_path, "merged")
    io.write_csv(df, out)
    schema = T.StructType([T.StructField("Date", T.StringType()), T.StructField("Attendees", T.StringType())])
    back = io.read_table(spark, out, schema).first()
    assert back.Attendees == '[{"a":"x","b":null}]'
    idx = os.path.join(tmpdir_path, "index")
    rows = spark.createDataFrame([("f1", 1), ("f2", 2)], "file string, word_count int")
    io.append_index(rows, idx)
    io.append_index(rows, idx)                      # a re-run adds nothing
    assert io.read_index(spark, idx).count() == 2


def test_append_reads_only_the_buckets_of_its_keys(spark, tmpdir_path):
    idx = os.path.join(tmpdir_path, "index")
    schema = "file string, word_count int"
    io.append_index(spark.createDataFrame([(f"f{i}", i) for i in range(200)] + [(None, 0)], schema), idx)
    late = io.append_index(spark.createDataFrame([("f7", 70), ("new", 2), ("new", 1), (None, 5)], schema), idx)
    plan = late._jdf.queryExecution().executedPlan().toString()
    wanted = {r[0] for r in spark.createDataFrame([("f7",), ("new",), (None,)], "file string").select(F.pmod(F.hash("file"), F.lit(io.INDEX_BUCKETS))).collect()}
    scan = plan[plan.rindex("PartitionFilters"):].split("\n")[0]
    assert all(str(b) in scan for b in wanted)
    got = {r.file: r.word_count for r in io.read_index(spark, idx).collect()}
    assert len(got) == 202 and got["f7"] == 7 and got["new"] == 1 and got[None] == 0
    io.append_index(spark.createDataFrame([], schema), idx)
    assert io.read_index(spark, idx).count() == 202 and io.read_index(spark, idx).columns == ["file", "word_count"]


def test_write_by_meeting_and_documents(spark, tmpdir_path):
    pages = spark.createDataFrame([("p1", "1971-01-05"), ("p2", "unassigned")], "page_name string, meeting_key string")
    io.write_by_meeting(pages, os.path.join(tmpdir_path, "pages"))
    folders = {d for d in os.listdir(os.path.join(tmpdir_path, "pages")) if d.startswith("meeting_key=")}
    assert folders == {"meeting_key=1971-01-05", "meeting_key=unassigned"}
    docs = spark.createDataFrame([("m", "summary", "Summary", "body")], "meeting string, doc_kind string, heading string, body string")
    io.write_documents(docs, os.path.join(tmpdir_path, "docs"))
    assert spark.read.parquet(os.path.join(tmpdir_path, "docs")).first().markdown == "# Summary\n\nbody"
