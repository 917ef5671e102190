"""N-gram join: the prefix length comes from every candidate link."""
from pyspark.sql import functions as F

from minutebook.llm import op1_ngram_join


def test_every_candidate_link_counts_for_the_prefix(spark):
    # one link at the threshold among many of equal signatures, wherever its hash falls
    values = op1_ngram_join.TREES * op1_ngram_join.DEPTH
    same, far = bytes(2 * values), bytes(2 * values * 4 // 5) + b"\x01" * (2 * values // 5)
    links = spark.range(1, 20001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    for odd in range(1, 5):
        sigs = spark.range(20001).select("id", F.when(F.col("id") == odd, F.lit(far)).otherwise(F.lit(same)).alias("sig"))
        assert op1_ngram_join._least_similarity(sigs, links) == 0.8
