"""Resumable model calls: counted."""
import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from minutebook.operators import ledger, model, qc
from minutebook.sources import io


def _run(spark, folder, calls, fails=()):
    """A model run whose client notes every call in a shared folder."""
    def factory():
        def call(prompt, user):
            with open(os.path.join(calls, uuid.uuid4().hex), "w") as f:
                f.write(prompt)
            if prompt in fails:
                raise RuntimeError("service unavailable")
            return prompt.upper()
        return call
    return lambda rows, keys: model.run_model(rows, factory, keys=keys)


def _sent(calls):
    return sorted(open(os.path.join(calls, f)).read() for f in os.listdir(calls))


def _requests(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, prompt string")
    return df.select("doc", "prompt", F.lit(None).cast("string").alias("user_text"), F.col("prompt").alias("source_text"))


def test_a_broken_run_sends_every_request_once(spark, tmpdir_path):
    calls = os.path.join(tmpdir_path, "calls")
    os.mkdir(calls)
    texts = [f"t{i}" for i in range(40)] + ["t0", "t1", "  "]
    requests, go = _requests(spark, texts), _run(spark, tmpdir_path, calls)
    args = (go, tmpdir_path, ["doc"], ["prompt", "user_text"])
    with pytest.raises(StreamingQueryException):
        ledger.run_resumable(requests, *args, per_batch=6, stop_after=3)
    half = _sent(calls)
    assert 0 < len(half) < 40 and len(set(half)) == len(half)
    got = {r.doc: (r.status, r.content) for r in ledger.run_resumable(requests, *args, per_batch=6).collect()}
    assert _sent(calls) == sorted(f"t{i}" for i in range(40))
    assert got == {i: ("blank", None) if t == "  " else ("ok", t.upper()) for i, t in enumerate(texts)}
    # another run: what is answered is not sent again
    more = ledger.run_resumable(_requests(spark, ["t3", "new"]), *args, run="second")
    assert sorted(r.content for r in more.collect()) == ["NEW", "T3"] and len(_sent(calls)) == 41


def test_failures_are_sent_again_by_the_next_run(spark, tmpdir_path):
    calls = os.path.join(tmpdir_path, "calls")
    os.mkdir(calls)
    requests = _requests(spark, ["a", "b"])
    args = (tmpdir_path, ["doc"], ["prompt", "user_text"])
    first = ledger.run_resumable(requests, _run(spark, tmpdir_path, calls, fails=("b",)), *args)
    assert {r.doc: r.status for r in first.collect()} == {0: "ok", 1: "error"}
    again = ledger.run_resumable(requests, _run(spark, tmpdir_path, calls), *args, run="again")
    assert {r.doc: r.status for r in again.collect()} == {0: "ok", 1: "ok"} and _sent(calls) == ["a", "b", "b"]
    sent = {r.n_sent for r in ledger.times_sent(spark, f"{tmpdir_path}/ledger").collect()}
    assert sent == {1, 2}


def test_request_keys_tell_parts_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), ("abc", None), ("abc", ""), (None, "abc")]
    df = spark.createDataFrame(rows, "p string, u string")
    assert df.select(ledger.request_key(["p", "u"])).distinct().count() == len(rows)


def _client():
    def call(prompt, user):
        if "bad" in prompt.split("chunks.")[-1]:
            raise RuntimeError("service unavailable")
        return f"[{len(prompt.split())}]"
    return call


def test_chunked_run_reads_whole_texts(spark):
    docs = spark.createDataFrame([(1, "w " * 700), (2, "few words"), (3, "x " * 300 + "bad " + "y " * 300), (4, None), (5, " ")], "doc int, text string")
    got = {r.doc: r for r in model.run_chunked(docs, lambda rows, keys: model.run_model(rows, _client, keys=keys), max_tokens=250).collect()}
    assert {d: (r.n_chunks, r.n_failed, r.status) for d, r in got.items()} == {
        1: (3, 0, "ok"), 2: (1, 0, "ok"), 3: (3, 1, "incomplete"), 4: (0, 0, "blank"), 5: (1, 0, "blank")}
    assert got[3].content is None


def test_large_partition_is_written_by_several_tasks(spark, tmpdir_path):
    pages = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 512).alias("page_name"),
                                        F.when(F.col("id") % 3 == 0, F.concat(F.lit("m"), F.col("id") % 50)).otherwise("big").alias("meeting_key"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        io.write_by_meeting(pages, tmpdir_path + "/p")
        io.write_by_meeting(pages.where("meeting_key = 'm0'").limit(5), tmpdir_path + "/p")  # replaces that meeting only
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = [f for f in os.listdir(tmpdir_path + "/p/meeting_key=big") if f.endswith(".parquet")]
    back = spark.read.parquet(tmpdir_path + "/p")
    assert len(files) > 3 and back.where("meeting_key = 'm0'").count() == 5
    assert back.count() == 200_000 - pages.where("meeting_key = 'm0'").count() + 5


def test_missing_terms_by_complement(spark):
    docs = spark.createDataFrame([(1, "the Board MET\tat noon"), (2, ""), (3, None), (1, "and left")], "doc_id int, text string")
    terms = spark.createDataFrame([("board  met",), ("Board Left",), ("noon",), ("NOON",), (" ",), (None,), ("left",)], "term string")
    got = sorted((r.doc_id, r.term) for r in qc.missing_terms(docs, terms).collect())
    every = ["board left", "board met", "left", "noon"]
    assert got == [(1, "board left")] + [(d, t) for d in (2, 3) for t in every]
    assert {r.file: r.detail for r in qc.check_terms(docs, terms, listed=False).collect()} == {"1": "1 of 4", "2": "4 of 4", "3": "4 of 4"}
    assert qc.check_terms(docs, terms.limit(0)).count() == 0 and qc.check_terms(docs, terms.limit(0), listed=False).count() == 0
