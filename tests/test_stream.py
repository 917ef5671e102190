import os

from minutebook.operators import report
from minutebook.plans import views as V
from minutebook.streaming.index import stream_index

from .conftest import SF_SMALL


def test_stream_index_equals_batch_and_is_incremental(spark, tmpdir_path):
    wav = V.v_recordings(spark, SF_SMALL).where("kind = 'wav'").select("file", "stem", "duration_s")
    rows = wav.join(V.v_transcripts(spark, SF_SMALL), "stem", "left")
    inp, out, ck = (os.path.join(tmpdir_path, x) for x in ("in", "out", "ck"))
    first = rows.where("file < 'boe_1971'")
    rest = rows.where("file >= 'boe_1971'")
    first.write.mode("append").parquet(inp)
    n1 = stream_index(spark, inp, out, ck).count()
    rest.write.mode("append").parquet(inp)
    got = stream_index(spark, inp, out, ck)
    want = report.recording_index(V.v_recordings(spark, SF_SMALL), V.v_transcripts(spark, SF_SMALL))
    assert n1 == first.count() and got.count() == want.count()
    assert sorted(got.collect()) == sorted(want.collect())


def test_a_recording_delivered_again_is_indexed_once(spark, tmpdir_path):
    inp, out, ck = (os.path.join(tmpdir_path, x) for x in ("in", "out", "ck"))
    rows = spark.createDataFrame([(f"boe_1971-01-0{i}.wav", f"boe_1971-01-0{i}", 60.0, "a b") for i in range(1, 5)],
                                 "file string, stem string, duration_s double, transcript string")
    rows.limit(3).union(rows.limit(2)).write.parquet(inp)          # twice in one batch
    assert stream_index(spark, inp, out, ck).count() == 3
    rows.write.mode("append").parquet(inp)                         # again after a restart, with one more
    assert stream_index(spark, inp, out, ck, max_files_per_trigger=1).count() == 4
    assert stream_index(spark, inp, out, ck).select("file").distinct().count() == 4
