import random

import pytest
from pyspark.sql import functions as F

from minutebook.operators import chunk


def test_token_chunks_lossless_and_empty(spark):
    df = spark.createDataFrame([(1, " a b  c d e\n"), (2, ""), (3, "x")], "doc int, text string")
    rows = chunk.token_chunks(df, 2).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc, []).append((r.chunk_no, r.text))
    assert 2 not in by                                  # empty text: no chunk
    assert "".join(t for _, t in sorted(by[1])) == " a b  c d e\n"
    assert [t for _, t in sorted(by[1])] == [" a b", "  c d", " e\n"]
    assert by[3] == [(0, "x")]


def test_pack_starts_golden(spark):
    df = spark.createDataFrame([([3, 3, 3, 9, 1],)], "c array<bigint>")
    assert df.select(chunk.pack_starts(F.col("c"), 6)).first()[0] == [0, 2, 3, 4]


def test_paragraph_chunks_rejoin(spark):
    text = "\n".join(["w " * n for n in (3, 2, 9, 1, 4)])
    df = spark.createDataFrame([(1, text), (2, "short")], "doc int, text string")
    rows = chunk.paragraph_chunks(df, whole_below=5, max_tokens=6).collect()
    parts = [r.text for r in sorted(rows, key=lambda r: r.chunk_no) if r.doc == 1]
    assert "\n".join(parts) == text and len(parts) > 1
    assert [r.text for r in rows if r.doc == 2] == ["short"]


def _texts():
    rnd = random.Random(8)
    word = ["", "w", "w w", " ", "w " * 5, " w w w", "w\t", "w " * 30, "w " * 14]
    texts = ["", "w", " ", "\n", "\n\n", "w\n", "w " * 40, "w " * 40 + "\n", "w\n" + "w " * 40, None]
    texts += ["\n".join(rnd.choice(word) for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    return list(enumerate(texts)) + [(1000, "\n".join(rnd.choice(word) for _ in range(2500)))]


@pytest.mark.parametrize("rows_per_range, max_tokens", [(10 ** 6, 12), (300, 3)])
def test_paragraph_rows_give_the_same_chunks_as_the_fold(spark, rows_per_range, max_tokens):
    df = spark.createDataFrame(_texts(), "doc int, text string")
    paras = df.select("doc", F.posexplode(F.split("text", "\n", -1)).alias("para_no", "text"))
    want = chunk.paragraph_chunks(df, whole_below=8, max_tokens=max_tokens)
    got = chunk.paragraph_row_chunks(paras.repartition(5), "doc", 8, max_tokens, rows_per_range=rows_per_range)
    assert got.columns == ["doc", "chunk_no", "text"]
    as_rows = lambda d: sorted((r.doc, r.chunk_no, r.text) for r in d.select("doc", "chunk_no", "text").collect())
    assert as_rows(got) == as_rows(want)


def test_paragraph_rows_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc int, para_no int, text string")
    assert chunk.paragraph_row_chunks(none, "doc").count() == 0


def test_segment_plan(spark):
    df = spark.createDataFrame([("a", 3600.0), ("b", 3601.0), ("c", 0.0), ("d", None)], "stem string, duration_s double")
    rows = chunk.segment_plan(df, 1800).collect()
    count = {}
    for r in rows:
        count[r.stem] = count.get(r.stem, 0) + 1
    assert count == {"a": 2, "b": 3}
    assert sorted(r.part_file for r in rows if r.stem == "a")[0] == "a_part_000.wav"
    assert max(r.end_s for r in rows if r.stem == "b") == 3601.0
