from pyspark.sql import functions as F

from minutebook.functions.templates import SHORT_SUMMARY
from minutebook.operators import model


def client_factory():
    def call(prompt, user):
        full = prompt + (user or "")
        if len(full) > 50:
            raise RuntimeError("context_length_exceeded")
        if "boom" in full:
            raise RuntimeError("boom")
        return "ok:" + str(len(full))
    return call


def test_run_model_statuses(spark):
    df = spark.createDataFrame([(1, "hi"), (2, "  "), (3, "x" * 60), (4, "boom")], "doc int, text string")
    req = df.select("doc", F.col("text").alias("prompt"), F.lit(None).cast("string").alias("user_text"),
                    F.col("text").alias("source_text"), F.lit("d").alias("date"))
    out = {r.doc: (r.status, r.content) for r in model.run_model(
        req, client_factory, keys=["doc"], retry_template="{text}", date="date", retry_chars=20).collect()}
    assert out[1] == ("ok", "ok:2")
    assert out[2] == ("blank", None)
    assert out[3] == ("shortened", "ok:20")   # retried with the first 20 characters, and marked so
    assert out[4][0] == "error"
    assert "{date}" in SHORT_SUMMARY


def test_build_requests_and_plan(spark):
    df = spark.createDataFrame([(1, "a b c", "1970-01-05")], "doc int, text string, date string")
    r = model.build_requests(df, "structured_summary", date="date", keys=["doc"]).first()
    assert "This is a meeting from 1970-01-05." in r.prompt and r.prompt.endswith("a b c")
    assert r.temperature == 0.2
    plan = model.plan_stages(spark.createDataFrame([(1, "a\nb\nc"), (2, "x")], "doc int, text string"),
                             whole_below=3, max_tokens=2)
    stages = sorted((r.doc, r.stage, r.chunk_no, r.depends_on) for r in plan.collect())
    assert (2, "summary", 0, None) in stages and (1, "fuse", 0, "summary") in stages
    assert len([s for s in stages if s[0] == 1 and s[1] == "summary"]) == 3


def test_fuse_and_attach(spark):
    resp = spark.createDataFrame([(1, 1, "b"), (1, 0, "a")], "doc int, chunk_no int, content string")
    assert model.fuse(resp, sep="|").first().fused == "a|b"
    req = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "doc int, chunk_no int")
    r2 = resp.withColumn("status", F.lit("ok"))
    got = {r.chunk_no: r.status for r in model.attach_responses(req, r2, ["doc", "chunk_no"]).collect()}
    assert got == {0: "ok", 1: "ok", 2: "missing"}


def test_checkpointed_replies_call_the_model_once(spark):
    from minutebook.session import checkpoint_dir
    checkpoint_dir(spark)
    acc = spark.sparkContext.accumulator(0)

    def factory():
        def call(p, u):
            acc.add(1)
            return "x"
        return call
    df = spark.range(50).select(F.col("id").alias("doc"), F.lit("p").alias("prompt"),
                                F.lit(None).cast("string").alias("user_text"), F.lit("s").alias("source_text"))
    out = model.run_model(df, factory, keys=["doc"]).checkpoint(eager=True)
    out.count()
    out.collect()
    assert acc.value == 50


def test_staged_run_fuses_long_texts(spark):
    long = "\n".join(f"part {i} " + "word " * 6 for i in range(3)).rstrip()
    df = spark.createDataFrame([(1, "short text"), (2, long), (3, long.replace("part 1", "boom 1"))], "doc int, text string")

    def factory():
        def call(prompt, user):
            if "boom" in user:
                raise RuntimeError("boom")
            return f"<{user[:6]}>"
        return call
    plan = model.plan_stages(df, whole_below=9, max_tokens=9)
    replies = model.run_stages(plan, lambda req, keys: model.run_model(req, factory, keys=keys))
    out = model.attach_responses(plan.select("doc", "stage", "chunk_no"), replies, ["doc", "stage", "chunk_no"]).collect()
    got = {(r.doc, r.stage, r.chunk_no): (r.status, r.content) for r in out}
    assert [got[2, "summary", i] for i in range(3)] == [("ok", f"<part {i}>") for i in range(3)]
    assert got[2, "fuse", 0] == ("ok", "<<part >")  # begins as the first summary does
    assert got[2, "outline", 0] == got[2, "decisions", 0] == ("ok", "<<<part>")
    assert got[3, "summary", 1][0] == "error" and {got[3, s, 0][0] for s in ("fuse", "outline", "decisions")} == {"missing"}
    assert len(got) == len(out) == 15 and got[1, "outline", 0] == ("ok", "<short >")
