"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words (its weight's share of all words,
at most ``most`` times its own; what exceeds that is reshared by weight).
Every document is taken ``floor(target / source words)`` whole times; the
rest of the target is a sample without replacement, of that many words.

Inclusion probabilities grow with the square root of a document's size (its
leading eight bits), by a factor per source for which the expected words are
the rest of the target.  Where that would exceed 1 the document is certain: it
is taken, and the factor is that of the others for the words still wanted.
The others are ranked by random odds divided by inclusion odds and taken in
that order until their words reach the rest, so that every sample has the same
size up to half a document.  The factor comes from words added up by source and
size class (at most 128 classes for each doubling of the size).

Random odds come from a hash of the id, so reruns agree.  The running sums
use buckets of the rank (by the rank's distribution at a source's mean odds;
certain documents need no rank and are dealt by their ids), so no source,
however large, meets in one task.

Defined results: a null text has size 0 (its document is never sampled, and
whole copies of it count 0 words); a null source is a source of its own,
ordered last; repeated rows are documents of their own (``mix``) or share
their fate (``mixed_documents``); a source without words has target 0; an
empty table gives an empty result.  Extra columns are ignored or passed on.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from minutebook.llm.common import read, saved, uniform

#: fixed: a word is a run of anything but these white-space characters
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
#: documents that one rank bucket holds about
DOCS_PER_BUCKET = 1000


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: leading bits of a size that its inclusion odds follow, and what a square root is multiplied by to make it whole
SIZE_BITS, ROOT_SCALE = 8, 16


def odds_class(size: Column) -> Column:
    """What a document's inclusion probability is proportional to: the root of its size's leading bits, as a whole number."""
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(size)) - SIZE_BITS, F.lit(0)))
    return F.floor(F.lit(ROOT_SCALE) * F.sqrt((size - size % step).cast("double"))).cast("long")


def probability(cls: Column, factor: Column, certain_above: Column) -> Column:
    return F.when(cls > certain_above, F.lit(1.0)).otherwise(F.least(F.lit(1.0), factor * cls))


def rank_key(doc_id: Column, p: Column, salt: str = "mix") -> Column:
    """Random odds divided by inclusion odds."""
    u = uniform(doc_id, salt=salt)
    return (u / (1 - u)) * F.when(p > 0, (1 - p) / p).otherwise(F.lit(1.0))


def inclusion(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with the factor of its inclusion probabilities, the class above which documents are certain
    (certain_above), the words of those (certain_words) and the mean odds of the others (mean_odds).

    From the largest class down, the first class at which no probability exceeds 1 separates the two."""
    s = sources.select(F.col("source").alias("s"), "source_no", "rest")
    classes = saved(sizes.where("size > 0").groupBy("source", odds_class(F.col("size")).alias("cls"))
                    .agg(F.sum("size").alias("n_words"), F.count(F.lit(1)).alias("n_docs"))
                    .join(s, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source"), "mix-classes")
    by = Window.partitionBy("source_no").orderBy(F.desc("cls"))
    larger, others = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    tried = (classes.withColumn("certain_words", F.coalesce(F.sum("n_words").over(larger), F.lit(0)))
             .withColumn("load", F.sum(F.col("cls") * F.col("n_words")).over(others).cast("double"))
             .withColumn("factor", (F.col("rest") - F.col("certain_words")) / F.col("load")))
    border = F.max(F.when(F.col("factor") * F.col("cls") <= 1, F.struct(F.col("cls").alias("certain_above"), "factor", "certain_words")))
    chosen = tried.groupBy("source_no").agg(border.alias("b"), F.sum("n_words").alias("n")).select(
        "source_no", F.coalesce("b.certain_above", F.lit(0)).alias("certain_above"), F.coalesce("b.factor", F.lit(0.0)).alias("factor"),
        F.coalesce("b.certain_words", "n").alias("certain_words"))
    p = probability(F.col("cls"), F.col("factor"), F.col("certain_above"))
    ranked = F.col("cls") <= F.col("certain_above")
    mean = (classes.join(chosen, "source_no").groupBy("source_no")
            .agg(F.sum(F.when(ranked, p * F.col("n_docs"))).alias("e"), F.sum(F.when(ranked, F.col("n_docs"))).alias("n"))
            .withColumn("m", F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.coalesce(F.col("e") / F.col("n"), F.lit(0.5)))))
            .select("source_no", (F.col("m") / (1 - F.col("m"))).alias("mean_odds")))
    out = sources.join(chosen.join(mean, "source_no"), "source_no", "left")
    return out.fillna({"certain_above": 0, "factor": 0.0, "certain_words": 0, "mean_odds": 1.0})


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source, source_no, source_size, target, whole, rest.

    Sources ordered by words allowed per weight: those up to the first that
    stays below its limit are full, the others share the remainder by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: these windows run over that small table only
    numbered = per.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("source_no") - 1) % len(weights) + 1)
    rows = numbered.withColumn("w", w).withColumn("allowed", F.lit(most) * F.col("source_size"))
    by = Window.orderBy(F.col("allowed") / F.col("w"), "source_no")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("allowed").over(before), F.lit(0))).cast("double")
             / F.sum("w").over(after))
    rows = rows.withColumn("level", level).withColumn("open", F.col("allowed") / F.col("w") > F.col("level"))
    share = F.min(F.when(F.col("open"), F.struct(F.col("allowed") / F.col("w"), "source_no", "level"))).over(everything)
    rows = rows.withColumn("share", share["level"])
    target = F.least(F.col("allowed").cast("double"), F.coalesce(F.col("w") * F.col("share"), F.col("allowed").cast("double")))
    rows = rows.withColumn("target", target)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = rows.withColumn("whole", whole.cast("long"))
    return rows.select("source", "source_no", "source_size", "target", "whole",
                       (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"))


def mix(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, salt: str = "mix") -> DataFrame:
    """``sizes`` (written rows of doc_id, source, size) plus source_no, source_size, target, copies, taken and probability
    (of one copy beyond the whole ones)."""
    sources = saved(inclusion(sizes, saved(targets(sizes, weights, most), "mix-targets")), "mix-sources")
    s = sources.withColumnRenamed("source", "s")
    n = sizes.count()
    buckets = max(1, min(1 << 16, n // DOCS_PER_BUCKET))
    cls = odds_class(F.col("size"))
    certain = cls > F.col("certain_above")
    spread = F.col("q") * F.col("mean_odds")
    ranked = (sizes.join(s, F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("certain", certain).withColumn("probability", probability(cls, F.col("factor"), F.col("certain_above")))
              .withColumn("q", F.when(F.col("certain"), F.lit(0.0)).otherwise(rank_key(F.col("doc_id"), F.col("probability"), salt)))
              .withColumn("counted", F.when(F.col("certain"), F.lit(0)).otherwise(F.col("size")))
              .withColumn("b", F.when(F.col("certain"), F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)))
                          .otherwise(F.floor(spread / (1 + spread) * buckets))))
    before = (ranked.groupBy("source_no", "b").agg(F.sum("counted").alias("n"))
              .withColumn("b_before", F.coalesce(F.sum("n").over(
                  Window.partitionBy("source_no").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("n"))
    order = (Window.partitionBy("source_no", "b").orderBy("q", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    summed = (ranked.withColumn("inside", F.coalesce(F.sum("counted").over(order), F.lit(0)))
              .join(before, ["source_no", "b"]))
    # the document that crosses the border is taken if that ends nearer to the target
    reached = F.col("b_before") + F.col("inside") + F.col("size") / 2.0 <= F.col("rest") - F.col("certain_words")
    copies = F.col("whole") + F.when((F.col("certain") | reached) & (F.col("size") > 0), 1).otherwise(0)
    return (summed.withColumn("copies", copies).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
            .select("doc_id", "source", "size", "source_no", "source_size", "target", "whole", "copies", "taken", "q",
                    "probability", "certain", "factor", "certain_above"))


def sizes_of(docs: DataFrame) -> DataFrame:
    return saved(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "mix-sizes")


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is taken, columns as they are.

    The last taken document of each source is its border; rows are compared
    with that border in one more pass, so no join moves texts.
    """
    taken = mix(sizes_of(docs), weights, most)
    place = F.struct("q", "doc_id", "size")
    border = (taken.groupBy("source").agg(
        F.first("whole").alias("__whole"), F.first("factor").alias("__factor"), F.first("certain_above").alias("__above"),
        F.max(F.when((F.col("copies") > F.col("whole")) & ~F.col("certain"), place)).alias("__border"))
        .withColumnRenamed("source", "__s"))
    joined = (docs.withColumn("__size", words(F.col("text"))).withColumn("__cls", odds_class(F.col("__size")))
              .join(saved(border, "mix-border"), F.col("source").eqNullSafe(F.col("__s"))))
    p = probability(F.col("__cls"), F.col("__factor"), F.col("__above"))
    here = F.struct(rank_key(F.col("doc_id"), p).alias("q"), F.col("doc_id"), F.col("__size").alias("size"))
    reached = F.coalesce(F.col("__border").isNotNull() & (here <= F.col("__border")), F.lit(False))
    extra = F.when((F.col("__size") > 0) & ((F.col("__cls") > F.col("__above")) | reached), 1).otherwise(0)
    joined = joined.withColumn("__copies", (F.col("__whole") + extra).cast("int"))
    repeated = joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, size, source_size, target, taken, probability."""
    return mix(sizes_of(read(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken", "probability")


ORACLE = r"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
           FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS no
      FROM s GROUP BY source),
w AS (SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS allowed FROM p),
l AS (SELECT *, allowed / w AS per,
             CAST(sum(source_size) OVER () - coalesce(sum(allowed) OVER (ORDER BY allowed / w, no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             / CAST(sum(w) OVER (ORDER BY allowed / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
      FROM w),
h AS (SELECT arg_min(level, (per, no)) AS share FROM l WHERE per > level),
t AS (SELECT source, no, source_size, least(CAST(allowed AS DOUBLE), coalesce(w * share, CAST(allowed AS DOUBLE))) AS target
      FROM l LEFT JOIN h ON TRUE),
c AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
d AS (SELECT s.doc_id, s.size, c.no, c.source_size, c.target, c.whole, c.target - c.whole * c.source_size AS rest,
             CAST(floor(16 * sqrt(CAST(size - size % (1::BIGINT << greatest(length(bin(size)) - 8, 0)) AS DOUBLE))) AS BIGINT) AS cls
      FROM s JOIN c ON s.source IS NOT DISTINCT FROM c.source),
k AS (SELECT no, cls, any_value(rest) AS rest, CAST(sum(size) AS BIGINT) AS n_words FROM d WHERE size > 0 GROUP BY no, cls),
e AS (SELECT *, CAST(coalesce(sum(n_words) OVER (PARTITION BY no ORDER BY cls DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                     AS BIGINT) AS sure,
             CAST(sum(cls * n_words) OVER (PARTITION BY no ORDER BY cls DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                  AS DOUBLE) AS load FROM k),
f AS (SELECT no, coalesce(max(cls) FILTER (WHERE ok), 0) AS above, coalesce(arg_max(factor, cls) FILTER (WHERE ok), 0) AS factor,
             coalesce(arg_max(sure, cls) FILTER (WHERE ok), CAST(sum(n_words) AS BIGINT)) AS sure
      FROM (SELECT *, (rest - sure) / load AS factor, (rest - sure) / load * cls <= 1 AS ok FROM e) GROUP BY no),
u AS (SELECT d.*, f.sure, cls > above AS certain,
             CASE WHEN size = 0 THEN 0.0::DOUBLE WHEN cls > above THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, factor * cls) END AS probability,
             (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '~') || '|mix'), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
             / 4503599627370496.0::DOUBLE AS u
      FROM d LEFT JOIN f USING (no)),
q AS (SELECT *, CASE WHEN certain THEN 0 ELSE (u / (1 - u)) * CASE WHEN probability > 0 THEN (1 - probability) / probability ELSE 1 END END AS q
      FROM u),
b AS (SELECT *, coalesce(sum(CASE WHEN certain THEN 0 ELSE size END) OVER (PARTITION BY no ORDER BY q, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q)
SELECT doc_id, size, source_size, target, probability,
       CAST((whole + CASE WHEN size > 0 AND (certain OR before + size / 2.0::DOUBLE <= rest - sure) THEN 1 ELSE 0 END) * size AS BIGINT)
         AS taken
FROM b
"""
