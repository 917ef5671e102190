from minutebook.operators import parse


def sections(spark, replies, tolerant=False):
    df = spark.createDataFrame(list(enumerate(replies)), "doc int, content string")
    out = {r.doc: (r.synopsis, r.summary, r.key_notes) for r in parse.parse_sections(df, tolerant=tolerant).collect()}
    return [out[i] for i in range(len(replies))]


def test_sections_goldens(spark):
    got = sections(spark, [
        "**Synopsis:** A",
        "1. **Synopsis:** A",
        "Synopsis: A\nb\nSynopsis: C",
        "intro dropped\nSynopsis: A\n  b  \n\nSynopsis:\nc\n**Summary** S\nKey Notes: K\nmore",
        "",
    ])
    assert got[0][0] == "** A"
    assert got[1][0] == "No synopsis provided"
    assert got[2][0] == "C"
    assert got[3] == ("A b c", "S", "K more")
    assert got[4] == ("No synopsis provided", "No summary provided", "No key notes provided")


def test_sections_tolerant(spark):
    got = sections(spark, ["**Synopsis:** A", "1. **Synopsis:** A\n2. **Summary:** B"], tolerant=True)
    assert got[0][0] == "A"
    assert got[1][:2] == ("A", "B")


def test_sections_of_replies_that_share_a_key(spark):
    df = spark.createDataFrame([(1, "Synopsis: A"), (1, "Synopsis: B\nx"), (None, "Summary: C"), (2, None)], "doc int, content string")
    got = parse.parse_sections(df)
    rows = {(r.doc, r.synopsis, r.summary) for r in got.collect()}
    no, nothing = "No synopsis provided", "No summary provided"
    assert rows == {(1, "A", nothing), (1, "B x", nothing), (None, no, "C"), (2, no, nothing)}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_decisions(spark):
    df = spark.createDataFrame([
        ("a", "[]"), ("b", '{"motion":"m"}'), ("c", "nope"), ("d", '```json\n[{"motion":"m"}]\n```'),
        ("e", '[{"motion":"m","result":"r","yes":5,"no":null}]'), ("f", '[{"motion":"m","res'),
    ], "doc string, content string")
    rows = parse.parse_decisions(df).collect()
    assert [(r.doc, r.motion, r.result, r.yes, r.no) for r in rows] == [("e", "m", "r", 5, None)]
