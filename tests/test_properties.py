"""Properties over the driver data (sf0.001)."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from minutebook.operators import chunk
from minutebook.plans import views as V

from .conftest import SF_SMALL


def _rejoined(chunks, sep):
    return chunks.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("chunk_no", "text"))), lambda x: x["text"]), sep).alias("joined"))


def test_token_chunks_rejoin_to_every_document(spark):
    docs = V.v_texts(spark, SF_SMALL)
    j = docs.join(_rejoined(chunk.token_chunks(docs, 50), ""), "doc_id", "left")
    assert j.where("NOT (coalesce(joined, '') <=> text)").count() == 0


def test_paragraph_chunks_rejoin_and_respect_limit(spark):
    docs = V.v_texts(spark, SF_SMALL)
    ch = chunk.paragraph_chunks(docs, whole_below=100, max_tokens=80)
    j = docs.join(_rejoined(ch, "\n"), "doc_id")
    assert j.where("NOT (joined <=> text)").count() == 0
    from minutebook.functions.tokens import token_count
    costs = ch.select("doc_id", "text", F.aggregate(F.transform(F.split("text", "\n", -1), lambda p: token_count(p) + 1),
                                                    F.lit(0).cast("bigint"), lambda a, b: a + b).alias("cost"),
                      F.size(F.split("text", "\n", -1)).alias("paras"))
    # a chunk over the limit is a single paragraph (or a text kept whole)
    over = costs.where("cost > 80 AND paras > 1").join(
        docs.select("doc_id", token_count("text").alias("n")), "doc_id").where("n >= 100")
    assert over.count() == 0


def test_qc_report_one_verdict_per_file(spark):
    rep = E.queries()["q10_qc_report"](spark, SF_SMALL)
    assert rep.count() == rep.select("file").distinct().count()
    assert rep.where("status NOT IN ('pass', 'fail')").count() == 0
