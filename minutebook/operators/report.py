"""Reports: attendee merge, organisation report, manifest, run statistics,
recording index."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import recording_date
from ..functions.patterns import MEETING_PDF_SUFFIX, UNASSIGNED
from ..functions.text import minutes, word_count
from .scan import PAGE_BYTES, paged

ATTENDEE_FIELDS = ["Category_1", "Category_2", "Name_1", "Name_2", "Title/Role"]
# accepted attendee date formats, each with the shape a string must have to
# be tried with it (a failed parse is costly, and strict formats of another
# shape can never succeed)
ACCEPTED_DATE_FORMATS = (("yyyy-MM-dd", "^[0-9]{4}-[0-9-]*$"), ("M/d/yyyy", "^[0-9]{1,2}/[0-9/]*$"),
                         ("yyyy-MM-dd HH:mm:ss", "^[0-9]{4}-[0-9-]+ "), ("MMMM d, yyyy", "^[A-Z][a-z]{3,} [0-9]"),
                         ("MMM d, yyyy", "^[A-Z][a-z]{2} [0-9]"))
JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def lenient_date(col, formats=ACCEPTED_DATE_FORMATS):
    """Date from text in any accepted format; null when none fits."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.when(c.rlike(shape), F.try_to_date(c, f)) for f, shape in formats])


def attendees_by_date(att: DataFrame, order_by: str = "row_no",
                      fields=ATTENDEE_FIELDS) -> DataFrame:
    """One ordered list of attendee records per date (rows whose date does
    not parse are dropped, as a group-by on a missing date would).

    The list is built by a partial + final hash aggregate; sorting happens
    per group after the shuffle, on the order column carried in the struct.
    """
    rec = F.struct(F.col(order_by).alias("_o"), *[F.col(f"`{f}`") for f in fields])
    g = (att.select(lenient_date("Date").alias("Date"), rec.alias("r"))
         .where(F.col("Date").isNotNull())
         .groupBy("Date").agg(F.sort_array(F.collect_list("r")).alias("_a")))
    keep = F.transform("_a", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return g.select("Date", keep.alias("Attendees"))


def merge_report(summaries: DataFrame, attendees: DataFrame, as_json: bool = True) -> DataFrame:
    """Summaries left-joined with the attendee list of their date.

    A summary date that is not a date raises (ANSI cast), as in the source
    tools; attendee dates are lenient.  ``as_json`` renders the list for a
    CSV sink, keeping null fields.
    """
    s = summaries.withColumn("Date", F.to_date("Date", "yyyy-MM-dd"))
    a = attendees_by_date(attendees)
    out = s.join(a, "Date", "left")
    if as_json:
        out = out.withColumn("Attendees", F.to_json("Attendees", JSON_KEEP_NULLS))
    return out


def merge_report_long(summaries: DataFrame, attendees: DataFrame, order_by: str = "row_no") -> DataFrame:
    """Same merge without building lists: one row per (summary, attendee).
    Use it when a single date can hold a very large share of attendees."""
    s = summaries.withColumn("Date", F.to_date("Date", "yyyy-MM-dd"))
    a = (attendees.withColumn("Date", lenient_date("Date")).where(F.col("Date").isNotNull())
         .select("Date", order_by, *[F.col(f"`{f}`") for f in ATTENDEE_FIELDS]))
    return s.join(a, "Date", "left")


def attendees_paged(att: DataFrame, order_by: str = "row_no", fields=ATTENDEE_FIELDS, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """A1 for dates of any size: the ordered attendee records (JSON, nulls kept) of a date as numbered
    pages of bounded size: Date, page_no, n_before, n_values, Attendees (a JSON list)."""
    rec = F.to_json(F.struct(*[F.col(f"`{f}`") for f in fields]), JSON_KEEP_NULLS)
    rows = att.select(lenient_date("Date").alias("Date"), F.col(order_by), rec.alias("_r")).where(F.col("Date").isNotNull())
    pages = paged(rows, ["Date"], [order_by], "_r", page_bytes)
    return pages.select("Date", "page_no", "n_before", "n_values",
                        F.concat(F.lit("["), F.array_join("values", ","), F.lit("]")).alias("Attendees"))


def merge_report_paged(summaries: DataFrame, attendees: DataFrame, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """J1 with paged lists: one row per summary and page of its date's attendees (page_no 0 and a null
    list where there are none), so no row grows with the table."""
    s = summaries.withColumn("Date", F.to_date("Date", "yyyy-MM-dd"))
    out = s.join(attendees_paged(attendees, page_bytes=page_bytes), "Date", "left")
    return out.withColumns({"page_no": F.coalesce("page_no", F.lit(0)), "n_before": F.coalesce("n_before", F.lit(0)),
                            "n_values": F.coalesce("n_values", F.lit(0))})


def manifest_paged(numbered: DataFrame, part_by: str = "collection", name: str = "page_name", page_bytes: int = PAGE_BYTES) -> DataFrame:
    """A6 for meetings of any size: header rows (``kind`` ``meeting``: n_values pages in all, PDF name) and the
    numbered source list as pages (``kind`` ``sources``), each of bounded size."""
    m = numbered.where(F.col("meeting_key") != UNASSIGNED)
    line = F.format_string("%2d. %s", F.col("page_in_meeting"), F.col(name))
    rows = m.select(part_by, "meeting_key", "page_in_meeting", line.alias("_l"))
    pages = paged(rows, [part_by, "meeting_key"], ["page_in_meeting"], "_l", page_bytes).select(
        part_by, "meeting_key", F.lit("sources").alias("kind"), "page_no", "n_before", "n_values",
        F.array_join("values", "\n").alias("text"))
    heads = rows.groupBy(part_by, "meeting_key").agg(F.count(F.lit(1)).alias("n_values")).select(
        part_by, "meeting_key", F.lit("meeting").alias("kind"), F.lit(0).alias("page_no"), F.lit(0).cast("long").alias("n_before"),
        "n_values", F.concat("meeting_key", F.lit(MEETING_PDF_SUFFIX)).alias("text"))
    return heads.unionByName(pages)


def run_stats(outcomes: DataFrame, status: str = "status", seconds: str | None = "seconds",
              statuses=("already_ocr", "processed", "failed")) -> DataFrame:
    """One row of run counters from a status column (no shared
    counters, so parallel work cannot lose updates).  The average seconds per
    file counts processed and already-done files, and is only given when
    something was processed."""
    st = F.col(status)
    aggs = [F.count(F.lit(1)).alias("found")]
    aggs += [F.count_if(st == s).alias(s) for s in statuses]
    if seconds:
        aggs.append(F.sum(seconds).alias("seconds"))
    out = outcomes.agg(*aggs)
    if seconds and "processed" in statuses and "already_ocr" in statuses:
        out = out.withColumn("avg_seconds", F.when(
            F.col("processed") > 0, F.col("seconds") / (F.col("processed") + F.col("already_ocr"))))
    return out


def organization_report(assigned: DataFrame, part_by: str = "collection") -> DataFrame:
    """A4: files per meeting, and per collection and overall: meetings found,
    unassigned files and meeting starts (``level`` 0 = meeting row, 1 =
    collection total, 3 = grand total)."""
    # one row per meeting first, so that only that small table is rolled up; a meeting
    # belongs to its collection, so equal dates of two collections are two meetings
    meetings = assigned.groupBy(part_by, "meeting_key").agg(
        F.count(F.lit(1)).alias("_n"), F.count("start_date").alias("_s")).withColumn("_k", F.col("meeting_key"))
    dated = F.col("_k") != UNASSIGNED
    return meetings.rollup(part_by, "meeting_key").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_n").alias("n_files"),
        F.sum("_s").alias("n_starts"),
        F.count_if(dated).alias("n_meetings"),
        F.coalesce(F.sum(F.when(~dated, F.col("_n"))), F.lit(0)).alias("n_unassigned"))


def meeting_manifest(numbered: DataFrame, part_by: str = "collection", name: str = "page_name") -> DataFrame:
    """Per dated meeting: page total, PDF name and the numbered source
    list (``" 1. name"`` per line, page order).  ``unassigned`` is left out."""
    m = numbered.where(F.col("meeting_key") != UNASSIGNED)
    line = F.format_string("%2d. %s", F.col("page_in_meeting"), F.col(name))
    st = F.struct(F.col("page_in_meeting"), line.alias("_l"))
    return m.groupBy(part_by, "meeting_key").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.array_join(F.transform(F.sort_array(F.collect_list(st)), lambda x: x["_l"]), "\n").alias("sources")
    ).withColumn("pdf_file", F.concat("meeting_key", F.lit(MEETING_PDF_SUFFIX)))


def recording_index(recordings: DataFrame, transcripts: DataFrame) -> DataFrame:
    """One index row per WAV: file, meeting date from the stem, minutes
    (2 decimals) and the transcript word count."""
    wav = recordings.where(F.col("kind") == "wav").select("file", "stem", "duration_s")
    return index_rows(wav.join(transcripts, "stem", "left"))


def index_rows(rows: DataFrame) -> DataFrame:
    """The stateless part of I1 over joined rows (file, stem, duration_s,
    transcript); shared by the batch and the streaming index."""
    return rows.select("file", recording_date("stem").alias("meeting_date"),
                       minutes("duration_s").alias("duration_min"),
                       word_count("transcript").alias("word_count"))
