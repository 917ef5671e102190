"""Assemble documents and transcripts from ordered rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import folder_year, part_no
from ..functions.patterns import MARKER_LENGTH, PAGE_MARKER, ROSTER_PREFIX, ROSTER_SEP
from ..functions.text import clean_text, strip, truncate_text


def _ordered_join(key_col: str, order_cols: list[str], value: str, sep: str) -> F.Column:
    """Values of a group joined in the order of ``order_cols``.

    Collects (order, value) structs, sorts them inside the group and joins;
    the sort key travels with the value, so shuffle order never matters.
    """
    st = F.struct(*[F.col(c) for c in order_cols], F.col(value).alias("_v"))
    return F.array_join(F.transform(F.sort_array(F.collect_list(st)), lambda x: x["_v"]), sep)


def assemble_text(pdf_pages: DataFrame, path: str = "path", clean: bool = True,
                  max_chars: int | None = None) -> DataFrame:
    """A2 (with P17): the text of a PDF from its page rows.

    Non-blank pages become ``\\n--- Page n ---\\n`` + text + ``\\n`` (n counts
    all pages from 1), in page order; then clean-up (P10) and, if ``max_chars``
    is given, the first cut (P11).  A file whose pages are all blank gives ``""``.
    """
    marker_pre, marker_post = PAGE_MARKER.split("{n}")
    piece = F.when(strip("text") != "", F.concat(
        F.lit(marker_pre), F.col("page_no").cast("string"), F.lit(marker_post), F.col("text"), F.lit("\n")))
    g = pdf_pages.select(path, "page_no", piece.alias("_piece")).groupBy(path).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(
            F.col("_piece").isNotNull(), F.struct("page_no", "_piece")))), lambda x: x["_piece"]), "").alias("text"))
    t = F.col("text")
    if clean:
        t = clean_text(t)
    if max_chars:
        t = truncate_text(t, max_chars, MARKER_LENGTH)
    return g.select(path, t.alias("text"))


#: meetings of a year that one task pairs with the year's members
PER_SLICE = 256


def _substrings(s: F.Column) -> F.Column:
    """All distinct non-empty substrings of a (short) string."""
    n = F.length(s)
    return F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.transform(F.sequence(F.lit(1), F.greatest(n - i + 1, F.lit(1))),
                              lambda L: F.substring(s, i, L)))))


def roster_for(meetings: DataFrame, roster: DataFrame, year: str = "year", mode: str = "contains",
               range_col: str = "year_range") -> DataFrame:
    """Roster rows for each meeting year (left join, so meetings without
    members keep one row with null roster columns).

    ``contains`` (the archive's rule) keeps roster rows whose range *text*
    contains the year: 1970-1975 matches 1970 and 1975 but not 1972.  It is
    run as an equi join on the substrings of the short range text, so no
    nested loop and no broadcast of the roster is needed, whatever its size.
    ``range`` reads both ends and matches every year between them, again as
    an equi join (one row per year of the range).

    Only the different ranges are spelled out, and only years that are asked
    for are kept.  The result has every member once for each meeting of a
    year, so a year's meetings are dealt over tasks ``PER_SLICE`` at a time.
    """
    keys = roster.select(F.col(range_col).alias("_range")).where("_range IS NOT NULL").distinct()
    if mode == "contains":
        keys = keys.withColumn("_y", F.explode(_substrings(F.col("_range").cast("string"))))
    elif mode == "range":
        lo = F.regexp_extract("_range", "^([0-9]{4})-([0-9]{4})$", 1).try_cast("int")
        hi = F.regexp_extract("_range", "^([0-9]{4})-([0-9]{4})$", 2).try_cast("int")
        keys = (keys.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo IS NOT NULL AND _hi >= _lo")
                .withColumn("_y", F.explode(F.transform(F.sequence("_lo", "_hi"), lambda y: y.cast("string"))))
                .drop("_lo", "_hi"))
    else:
        raise ValueError(mode)
    asked = meetings.groupBy(F.col(year).cast("string").alias("_y")).agg(
        F.ceil(F.count(F.lit(1)) / PER_SLICE).cast("int").alias("_slices"))
    held = keys.join(asked, "_y")
    r = (roster.join(held, roster[range_col] == held["_range"]).drop("_range")
         .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices"))
    m = meetings.withColumn("_y", F.col(year).cast("string")).join(asked, "_y", "left")
    # the year may be null, and any column may tell meetings apart
    m = m.withColumn("_slice", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in meetings.columns]), F.coalesce("_slices", F.lit(1))).cast("int"))
    return spread(m.drop("_slices"), "_y", "_slice").join(r, ["_y", "_slice"], "left").drop("_y", "_slice")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` over all shuffle partitions, by ``by``: few rows that a join makes very many of are not merged into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def assemble_transcript(parts: DataFrame, roster: DataFrame | None, meeting: str = "meeting",
                        part_name: str = "part_name", text: str = "text", mode: str = "contains") -> DataFrame:
    """A3: a meeting transcript: ``Board Members: a, b`` when the roster has
    members for the meeting year (roster order; null names skipped), then the
    parts in part-number order joined by newlines (empty parts stay as empty
    lines)."""
    p = parts.select(meeting, part_no(part_name).alias("_no"), part_name, F.coalesce(text, F.lit("")).alias("_t"))
    body = p.groupBy(meeting).agg(_ordered_join(meeting, ["_no", part_name], "_t", "\n").alias("_body"))
    if roster is None:
        return body.select(meeting, F.col("_body").alias("transcript"))
    # The member line depends on the year only: build it once per distinct
    # meeting year and join it to the meetings many-to-one, instead of
    # pairing every meeting with every roster row of its year.
    body = body.withColumn("_year", folder_year(meeting))
    years = body.select(F.col("_year").alias("year")).where("year IS NOT NULL").distinct()
    lines = (roster_for(years, roster.where(F.col("name").isNotNull()), mode=mode)
             .where(F.col("name").isNotNull())
             .groupBy(F.col("year").alias("_year"))
             .agg(_ordered_join("year", ["row_no"], "name", ROSTER_SEP).alias("_names")))
    out = body.join(lines, "_year", "left")
    header = F.when(F.col("_names").isNotNull(), F.concat(F.lit(ROSTER_PREFIX), F.col("_names")))
    return out.select(meeting, F.concat_ws("\n", header, F.col("_body")).alias("transcript"))
