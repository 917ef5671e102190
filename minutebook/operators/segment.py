"""Ordered segmentation: which meeting does each page belong to.

Pages come in name order.  A start page with a date opens that meeting;
every other page (a start without a date, a dated non-start, a failed
page) stays in the current meeting; pages before the first opened meeting
are unassigned.  That is a forward fill over the page order, which Spark
expresses as ``last(..., ignorenulls)`` over a running window.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import meeting_key, parse_date, with_page_date
from ..functions.patterns import EVIDENCE_INDICATORS, START_PHRASES
from ..functions.text import upper_text
from ..session import checkpoint_dir
from .scan import ROWS_PER_RANGE, running


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def phrase_hits(text, phrases=START_PHRASES) -> Column:
    """How many of the phrases the (upper-cased) text contains."""
    t = _col(text)
    return reduce(lambda a, b: a + b, [F.instr(t, p).__gt__(0).cast("int") for p in phrases])


def is_start(text, phrases=START_PHRASES, min_hits: int = 2, date: Column | None = None) -> Column:
    """Meeting-start predicate: ``min_hits`` phrases, or one phrase and a date."""
    t = _col(text)
    hits = phrase_hits(t, phrases)
    d = parse_date(t) if date is None else date
    return (hits >= min_hits) | ((hits >= 1) & d.isNotNull())


def classify_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``page_date`` (P2 on upper-cased text), ``is_start`` (P4) and
    ``start_date`` (the date a page opens a meeting with, else null)."""
    out = with_page_date(pages.withColumn("_up", upper_text(text)), "_up")
    out = out.withColumn("is_start", is_start(F.col("_up"), date=F.col("page_date"))).drop("_up")
    return out.withColumn("start_date", F.when(F.col("is_start"), F.col("page_date")))


def assign_meetings(pages: DataFrame, part_by="collection", order_by="page_name",
                    text: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Forward fill of ``start_date`` within each collection.

    A distributed scan (``scan.running``): pages are classified once, the
    classified rows without their text go into ranges of the page order, and
    no window holds a whole collection, so one collection with most of the
    pages is spread over all tasks.  The page text is not part of the result.
    """
    parts = [part_by] if isinstance(part_by, str) else list(part_by)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    out = running(classify_pages(pages, text).drop(text), parts, order, last={"meeting_date": "start_date"}, rows_per_range=rows_per_range)
    return out.withColumn("meeting_key", meeting_key("meeting_date"))


def assign_meetings_bucketed(pages: DataFrame, part_by="collection", bucket="bucket",
                             order_by="page_name", text: str = "text", materialize: bool = True) -> DataFrame:
    """The same answer as ``assign_meetings`` where the pages carry a
    bucket column of the page order already (one scan level, no range sort).

    ``bucket`` must grow with the page order (e.g. page number / 10,000).
    Step 1 fills inside each (collection, bucket) window, which spreads one
    huge collection over many tasks.  Step 2 takes the last opened meeting of
    every bucket into a table with one row per bucket, and a running
    ``last(ignorenulls)`` over the earlier buckets gives each bucket its
    carry-in.  Step 3 joins the carry back (a small table: one row per
    bucket) and fills the leading pages of a bucket with it.  No partition
    ids are used, so re-execution or AQE cannot change the answer.

    Both steps need the page classification (the costly regex scans), so the
    classified pages, without their text, are written once with
    ``checkpoint()`` to the shared checkpoint folder; lineage is cut there and
    a lost executor does not repeat the scans.  The page text is not part of
    the result.
    """
    parts = [part_by] if isinstance(part_by, str) else list(part_by)
    keys = parts + [bucket]
    c = classify_pages(pages, text).drop(text)
    if materialize:
        checkpoint_dir(c.sparkSession)
        c = c.checkpoint(eager=True)
    run = (Window.partitionBy(*keys).orderBy(order_by)
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = c.withColumn("_local", F.last("start_date", ignorenulls=True).over(run))
    per_bucket = c.groupBy(*keys).agg(
        F.max_by("start_date", F.when(F.col("start_date").isNotNull(), F.col(order_by))).alias("_bucket_last"))
    earlier = (Window.partitionBy(*parts).orderBy(bucket)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_bucket.select(*keys, F.last("_bucket_last", ignorenulls=True).over(earlier).alias("_carry"))
    out = out.join(carry, keys, "left")
    out = out.withColumn("meeting_date", F.coalesce("_local", "_carry")).drop("_local", "_carry")
    return out.withColumn("meeting_key", meeting_key("meeting_date"))


def page_evidence(pages: DataFrame, part_by="collection", order_by="page_name",
                  first_n: int = 10, indicators=EVIDENCE_INDICATORS, text: str = "text") -> DataFrame:
    """P5: for the first ``first_n`` pages of each collection, the start flag,
    the parsed date of a start (a page that is none has no date) and one row
    per indicator with its presence."""
    w = Window.partitionBy(part_by).orderBy(order_by)
    first = (pages.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= first_n)
             .drop("_rn"))
    c = classify_pages(first, text)
    ind = F.explode(F.array(*[F.lit(i) for i in indicators])).alias("indicator")
    c = c.select(part_by, order_by, "is_start", F.col("start_date").alias("page_date"), upper_text(text).alias("_up"), ind)
    return c.select(part_by, order_by, "is_start", "page_date", "indicator",
                    (F.instr("_up", F.col("indicator")) > 0).alias("present"))


def number_pages(assigned: DataFrame, part_by=("collection", "meeting_key"), name: str = "page_name",
                 rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Page numbers inside a meeting by lower-cased name, from 1: a running count by the
    distributed scan, so one meeting with most of the pages is numbered by many tasks."""
    out = running(assigned.withColumn("_low", F.lower(name)), list(part_by), ["_low", name], total={"_n": F.lit(1).cast("long")},
                  rows_per_range=rows_per_range)
    return out.withColumn("page_in_meeting", F.col("_n").cast("int")).drop("_n", "_low")


def first_files(files: DataFrame, n: int, order_by: str = "path") -> DataFrame:
    """The first ``n`` files of a trial run (top-k, not a full sort)."""
    return files.orderBy(order_by).limit(n)
