"""Running values over a total order, without a window that holds a whole group.

``running`` gives every row the last non-null value, or the running total, of
columns over its group's rows up to and including itself, as a window over
the group would, however large the group is:

1. the rows are range-partitioned by group and order (Spark samples the
   borders) and written, so each row's range is fixed for good: a lost
   executor or a re-planned stage cannot move it;
2. one aggregate gives a summary per group and range (last value, total);
3. the summaries are summed up in levels of ``fanout``, and carried down
   again: a tree scan, so no window holds more than ``fanout`` summaries;
4. each range is scanned by itself and takes over its carry.

``paged`` cuts ordered lists of any length into numbered pages of bounded
size with the same scan.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

ROWS_PER_RANGE = 100_000
FANOUT = 4096
PAGE_BYTES = 1 << 20


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def ranges(df: DataFrame, part_by: Sequence[str], order_by: Sequence[str | Column], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``df``, written, with ``_range``: numbers that ascend with (``part_by``, ``order_by``)."""
    n = max(1, -(-df.count() // rows_per_range))
    by = [F.col(c) if isinstance(c, str) else c for c in [*part_by, *order_by]]
    return stored(df.repartitionByRange(n, *by).withColumn("_range", F.spark_partition_id().cast("long")), "ranges")


def _carried(summaries: DataFrame, part_by: Sequence[str], last: Sequence[str], total: Sequence[str], fanout: int, n: int) -> DataFrame:
    """For each (group, ``_range``) the last values and totals of all earlier ranges of the group (columns named ``_in_…``)."""
    def local(w) -> list[Column]:
        return ([F.last(c, ignorenulls=True).over(_before(w)).alias(f"_in_{c}") for c in last]
                + [F.coalesce(F.sum(c).over(_before(w)), F.lit(0)).alias(f"_in_{c}") for c in total])

    if n <= fanout:  # range numbers below n: a group has no more summaries than that
        return summaries.select(*part_by, "_range", *local(Window.partitionBy(*part_by).orderBy("_range")))
    up = F.floor(F.col("_range") / fanout).cast("long")
    above = summaries.withColumn("_up", up).groupBy(*part_by, "_up").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_range"))).alias(c) for c in last], *[F.sum(c).alias(c) for c in total])
    top = _carried(above.withColumnRenamed("_up", "_range"), part_by, last, total, fanout, -(-n // fanout))
    top = top.select(*[F.col(c).alias(f"_top_{c}") for c in part_by], F.col("_range").alias("_up"),
                     *[F.col(f"_in_{c}").alias(f"_top_in_{c}") for c in (*last, *total)])
    here = summaries.withColumn("_up", up)
    here = here.select(*part_by, "_range", "_up", *local(Window.partitionBy(*part_by, "_up").orderBy("_range")))
    same = here["_up"] == top["_up"]
    for c in part_by:
        same = same & here[c].eqNullSafe(top[f"_top_{c}"])
    met = here.join(top, same, "left")
    return met.select(*part_by, "_range", *[F.coalesce(f"_in_{c}", f"_top_in_{c}").alias(f"_in_{c}") for c in last],
                      *[(F.col(f"_in_{c}") + F.coalesce(f"_top_in_{c}", F.lit(0))).alias(f"_in_{c}") for c in total])


def running(df: DataFrame, part_by: Sequence[str], order_by: Sequence[str | Column], last: dict[str, str] | None = None,
            total: dict[str, Column] | None = None, rows_per_range: int = ROWS_PER_RANGE, fanout: int = FANOUT) -> DataFrame:
    """``df`` with a column for each entry of ``last`` (name -> column: its last non-null value so far) and of ``total``
    (name -> number: its running total), by ``order_by`` within ``part_by``; written on the way.

    Rows of equal order are taken in any order, as by a window; null groups are a group.
    """
    last, total = last or {}, total or {}
    lasts, totals = {f"_l{i}": c for i, c in enumerate(last.values())}, {f"_t{i}": c for i, c in enumerate(total.values())}
    rows = ranges(df.withColumns({**{k: F.col(c) for k, c in lasts.items()}, **totals}), part_by, order_by, rows_per_range)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    place = F.struct(*order)
    summaries = stored(rows.groupBy(*part_by, "_range").agg(
        *[F.max_by(k, F.when(F.col(k).isNotNull(), place)).alias(k) for k in lasts], *[F.sum(k).alias(k) for k in totals]), "summaries")
    n = (summaries.agg(F.max("_range")).first()[0] or 0) + 1
    carry = _carried(summaries, part_by, list(lasts), list(totals), fanout, n)
    carry = carry.select(*[F.col(c).alias(f"_of_{c}") for c in part_by], F.col("_range").alias("_of"), *[f"_in_{k}" for k in (*lasts, *totals)])
    w = Window.partitionBy(*part_by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows.withColumns({**{f"_so_{k}": F.last(k, ignorenulls=True).over(w) for k in lasts},
                             **{f"_so_{k}": F.sum(k).over(w) for k in totals}})
    same = F.col("_range") == F.col("_of")
    for c in part_by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    met = here.join(carry, same, "left")
    new = {name: F.coalesce(f"_so_{k}", f"_in_{k}") for name, k in zip(last, lasts)}
    new |= {name: F.col(f"_so_{k}") + F.coalesce(f"_in_{k}", F.lit(0)) for name, k in zip(total, totals)}
    return met.select(*[c for c in df.columns if c not in new], *[v.alias(k) for k, v in new.items()])


def paged(df: DataFrame, part_by: Sequence[str], order_by: Sequence[str | Column], value: str, page_bytes: int = PAGE_BYTES,
          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The ordered ``value`` texts of each group as pages: ``part_by``, page_no (from 0), n_before, n_values, values (a list).

    A value is on the page in which it begins, counted in bytes from the group's first value, each
    with one byte between; so a page holds less than ``page_bytes`` before its last value.  A value
    longer than a page leaves the numbers of the pages that it covers out.  Null values count as empty.
    """
    text = F.coalesce(F.col(value).cast("string"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    rows = running(df.withColumn("_v", text), part_by, order_by, total={"_end": size, "_no": F.lit(1).cast("long")},
                   rows_per_range=rows_per_range)
    begun = F.col("_end") - F.octet_length("_v") - 1
    rows = rows.withColumn("page_no", F.floor(begun / page_bytes).cast("int"))
    pages = rows.groupBy(*part_by, "page_no").agg(
        (F.min("_no") - 1).alias("n_before"), F.count(F.lit(1)).alias("n_values"),
        F.sort_array(F.collect_list(F.struct("_no", "_v"))).alias("_l"))
    return pages.select(*part_by, "page_no", "n_before", "n_values", F.transform("_l", lambda x: x["_v"]).alias("values"))
