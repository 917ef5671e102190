"""Input shapes of the archive tools, derived from the driver tables.

The archive works on page text, file listings, recording parts, rosters,
attendee lists and model replies.  These views give those shapes from the
driver tables with key arithmetic only, so the DuckDB oracle can build the
same rows (``oracle_views.py``).  Every ``/`` on keys is floor division.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import words
from ..sources.tables import table

NL = "\n"
# derived dates stay in the years that the date rules accept, however many keys there are
PAGE_DAYS = 47000
MEETING_DAYS = 12000


def day(x: Column) -> Column:
    """D(x) = 1970-01-01 + x days."""
    return F.date_add(F.lit("1970-01-01").cast("date"), x.cast("int"))


def long_date(d: Column) -> Column:
    """Upper-case ``JANUARY 5, 1971``."""
    return F.upper(F.date_format(d, "MMMM d, yyyy"))


def _page_name(doc_id: Column) -> Column:
    return F.concat(F.format_string("%08d", doc_id.cast("long")), F.lit(".jpg"))


def v_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered page images with OCR text; header kind by (doc_id/20 + 1) % 8,
    so every collection opens with three pages before its first meeting
    (no header, a start without a date, a date without a phrase)."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    b = F.expr("(doc_id div 20 + 1) % 8")
    d = long_date(day(F.col("doc_id") % PAGE_DAYS))
    header = (F.when(b == 0, F.concat(F.lit("MEETING OF "), d))
              .when(b == 2, F.lit("THE BOARD OF EDUCATION"))
              .when(b == 3, d)
              .when(b == 4, F.lit("BOARD OF EDUCATION 3/14/1972"))
              .when(b == 5, F.concat(F.lit("ROOM 12, 1234 BOARD OF EDUCATION MEETING HELD "), d))
              .when(b == 6, F.lit("MEETING OF FEBRUARY 30, 1971"))
              .when(b == 7, F.lit("OKLAHOMA CITY 1971-01-05")))
    return docs.select(
        F.col("source").alias("collection"),
        F.concat(F.col("source"), F.lit("/"), _page_name(F.col("doc_id"))).alias("path"),
        _page_name(F.col("doc_id")).alias("page_name"),
        F.concat_ws(NL, header, F.col("text")).alias("text"),
        F.col("doc_id").alias("page_no"),
    )


def v_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Four OCR candidate texts per page (config rank 0-3), each of the whole text: as it is, with a
    word lost, with doubled blanks after sentences, or (every 11th page, two of the settings) unread."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    kind = (F.col("doc_id") + F.col("config_rank")) % 3
    damaged = (F.when((F.col("doc_id") % 11 == 0) & (F.col("config_rank") % 2 == 0), F.lit(" \n"))
               .when(kind == 1, F.replace(F.col("text"), F.lit(" the "), F.lit(" ")))
               .when(kind == 2, F.replace(F.col("text"), F.lit(". "), F.lit(".  "))).otherwise(F.col("text")))
    return (docs.select("*", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("config_rank"))
            .select(F.concat(F.col("source"), F.lit("/"), _page_name(F.col("doc_id"))).alias("path"), "config_rank",
                    damaged.alias("text")))


def v_files(spark: SparkSession, sf: str) -> DataFrame:
    """PDF catalog (path, dir, parent, name) over the ``pages`` keys."""
    p = table(spark, sf, "pages").select("page_id")
    pid = F.col("page_id")
    d = day(F.expr("page_id div 3"))
    sep = F.when(pid % 2 == 0, F.lit("-")).otherwise(F.lit("_"))
    month = F.when(pid % 13 == 0, F.lit("13")).otherwise(F.date_format(d, "MM"))
    ds = F.concat(F.date_format(d, "yyyy"), sep, month, sep, F.date_format(d, "dd"))
    suffix = (F.when(pid % 11 == 6, F.lit(".backup"))
              .when(pid % 4 == 0, F.lit("_ocr")).when(pid % 4 == 1, F.lit("_OCR"))
              .when(pid % 4 == 2, F.lit("")).otherwise(F.lit("_backup")))
    prefix = F.when(pid % 9 == 4, F.lit("temp_")).otherwise(F.lit(""))
    scan = F.concat(F.lit("scan_"), (pid % 50).cast("string"))
    undated = (pid % 7 == 0) | (pid % 5 == 0)
    stem = F.when(undated, scan).otherwise(F.concat(ds, F.lit("_meeting_minutes")))
    name = F.concat(prefix, stem, suffix, F.lit(".pdf"))
    parent = (F.when((pid % 7 != 0) & (pid % 5 == 0), F.date_format(d, "yyyy-MM-dd"))
              .otherwise(F.concat(F.lit("box"), (pid % 10).cast("string"))))
    out = p.select(pid, name.alias("name"), parent.alias("parent"))
    return out.select(
        "page_id",
        F.concat(F.lit("archive/"), F.col("parent"), F.lit("/"), F.col("name")).alias("path"),
        F.concat(F.lit("archive/"), F.col("parent")).alias("dir"),
        "parent", "name")


def v_file_text(spark: SparkSession, sf: str) -> DataFrame:
    """First-page text per catalog file: a dated heading (one day off for
    page_id % 6 = 1, none for page_id % 8 = 7) over the page html."""
    files = v_files(spark, sf)
    pages = table(spark, sf, "pages").select("page_id", "html")
    pid = F.col("page_id")
    d = day(F.expr("page_id div 3") + F.when(pid % 6 == 1, 1).otherwise(0))
    header = F.when(pid % 8 != 7, F.concat(F.lit("MEETING OF "), long_date(d)))
    return files.join(pages, "page_id").select(
        "path", "parent", "name", F.concat_ws(NL, header, F.col("html")).alias("text"))


def v_pdf_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Extracted PDF page text: one file per conversation, one page per turn."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return c.select(
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("path"),
        (F.col("turn") + 1).cast("int").alias("page_no"),
        F.when((F.col("conv_id") + F.col("turn")) % 9 == 0, F.lit("  ")).otherwise(F.col("text")).alias("text"))


def v_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with OCR damage: broken paragraphs, misread words, blanks."""
    t = F.replace(F.col("text"), F.lit(". "), F.lit(".\n \n\n"))
    t = F.when(F.col("doc_id") % 2 == 0, F.replace(t, F.lit(" the "), F.lit(" tho "))).otherwise(t)
    t = F.replace(t, F.lit(","), F.lit(",  \t"))
    return table(spark, sf, "documents").select("doc_id", t.alias("text"))


def v_attendees(spark: SparkSession, sf: str) -> DataFrame:
    """Attendee lists: one row per order, dated by the order date."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    date = (F.when(k % 50 == 0, F.lit("n/a"))
            .when(k % 3 == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(date.alias("Date"),
                    F.col("c_mktsegment").alias("Category_1"),
                    F.col("o_orderpriority").alias("Category_2"),
                    F.col("c_name").alias("Name_1"),
                    F.when(k % 2 == 0, F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string"))).alias("Name_2"),
                    F.col("n_name").alias("Title/Role"),
                    k.alias("row_no")))


def v_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Summary rows: every order date, plus the same dates ten years
    earlier (which no attendee matches)."""
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    dates = o.distinct()
    dates = dates.union(dates.select(F.add_months("d", -120).alias("d"))).distinct()
    ds = F.date_format("d", "yyyy-MM-dd")
    return dates.select(
        ds.alias("Date"),
        F.concat(ds, F.lit("_meeting_minutes_ocr.pdf")).alias("PDF_File"),
        F.concat(F.lit("Synopsis of the meeting on "), ds).alias("Synopsis"),
        F.concat(F.lit("Summary of the meeting on "), ds).alias("Summary"),
        F.concat(F.lit("Key notes of "), ds).alias("Key Notes"))


def _meeting_folder(conv_id: Column) -> Column:
    return F.concat(F.lit("boe_meeting_"), F.date_format(day(conv_id * 37 % MEETING_DAYS), "yyyy-MM-dd"),
                    F.when(conv_id % 6 == 0, F.lit("_x_y")).otherwise(F.lit("_x")),
                    F.floor(conv_id / MEETING_DAYS).cast("string"))


def v_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Transcribed recording parts, one per conversation turn."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    meeting = _meeting_folder(F.col("conv_id"))
    tag = F.when((F.col("conv_id") + F.col("turn")) % 7 == 3, F.lit("_PART_")).otherwise(F.lit("_part_"))
    return c.select(
        meeting.alias("meeting"),
        F.concat(meeting, tag, F.format_string("%03d", F.col("turn").cast("long"))).alias("part_name"),
        "text")


def v_roster(spark: SparkSession, sf: str) -> DataFrame:
    """Board roster: name and a five-year range as text."""
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    y = F.lit(1970) + F.col("s_suppkey") % 30
    return s.select(F.col("s_name").alias("name"),
                    F.concat(y.cast("string"), F.lit("-"), (y + 4).cast("string")).alias("year_range"),
                    F.col("s_suppkey").alias("row_no"))


def _stem(conv_id: Column) -> Column:
    d = day(conv_id * 37 % MEETING_DAYS)
    return F.when(conv_id % 4 == 0,
                  F.concat(F.lit("boe_"), F.date_format(d, "yyyyMMdd"), F.lit("_"), conv_id.cast("string"))) \
        .otherwise(F.concat(F.lit("boe_"), F.date_format(d, "yyyy-MM-dd"), F.lit("_"), conv_id.cast("string")))


def v_recordings(spark: SparkSession, sf: str) -> DataFrame:
    """Recording files per stem: wav, mp3, transcript and summary, each kind
    missing for some stems; durations from the conversation length."""
    c = table(spark, sf, "conversations").select("conv_id", "text")
    per = c.groupBy("conv_id").agg((F.sum(F.length("text")) * 0.625).alias("base"))
    cid = F.col("conv_id")
    def kind(name, ext, keep, dur):
        return F.struct(F.lit(name).alias("kind"), F.lit(ext).alias("ext"), keep.alias("keep"),
                        dur.cast("double").alias("duration_s"))

    kinds = F.array(
        kind("wav", ".wav", cid % 13 != 5, F.when(cid % 17 == 0, F.lit(0.0)).otherwise(F.col("base"))),
        kind("mp3", ".mp3", cid % 5 != 1, F.col("base") + F.when(cid % 10 == 0, 5.0).otherwise(0.0)),
        kind("transcript", ".txt", cid % 7 != 2, F.lit(None)),
        kind("summary", ".summary.txt", cid % 11 != 3, F.lit(None)),
    )
    rows = per.select(cid, _stem(cid).alias("stem"), F.inline(kinds))
    return rows.where("keep").select(
        F.concat("stem", "ext").alias("file"), "stem", "kind", "duration_s")


def v_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Transcript text per recording stem: the turns in order."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return c.groupBy("conv_id").agg(
        F.expr("listagg(text, '\\n') within group (order by turn)").alias("transcript")
    ).select(_stem(F.col("conv_id")).alias("stem"), "transcript")


def v_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def v_support(spark: SparkSession, sf: str) -> DataFrame:
    """Summary / transcript pairs over whole texts; odd documents claim a
    number not in the text, every third an amount and a date."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id",
                    F.concat("text", F.when(F.col("doc_id") % 2 == 1, F.lit(" 98765")).otherwise(F.lit("")),
                             F.when(F.col("doc_id") % 3 == 0, F.lit(" $1,250.50 on June 12, 1875")).otherwise(F.lit("")))
                    .alias("summary"),
                    F.col("text").alias("transcript"))


def v_altered(spark: SparkSession, sf: str) -> DataFrame:
    """Summary / transcript pairs over whole texts: every third sentence with other vowels."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    altered = F.transform(F.regexp_extract_all("text", F.lit("[^.!?\\n]+"), 0), lambda s, i: F.when(
        (F.col("doc_id") + i) % 3 == 0, F.translate(s, "aeiou", "eioua")).otherwise(s))
    return d.select("doc_id", F.array_join(altered, ". ").alias("summary"), F.col("text").alias("transcript"))


def v_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Model replies with three section headers over the first three lines;
    every 6th numbered ``1. `` (not a header in the faithful parser), every
    8th without the summary header."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    lines = F.split(F.col("text"), "\n", -1)
    num = F.col("doc_id") % 6 == 0
    nohdr = F.col("doc_id") % 8 == 0

    def pre(k):
        return F.when(num, F.lit(f"{k}. ")).otherwise(F.lit(""))

    def line(i):
        return F.coalesce(F.try_element_at(lines, F.lit(i)), F.lit(""))

    rest = F.when(F.size(lines) > 3, F.array_join(F.slice(lines, 4, F.size(lines) - 3), "\n"))
    content = F.concat_ws(
        "\n",
        F.concat(pre(1), F.lit("Synopsis: "), line(1)),
        F.concat(pre(2), F.when(nohdr, F.lit("")).otherwise(F.lit("**Summary** ")), line(2)),
        F.concat(pre(3), F.lit("Key Notes: "), line(3)),
        rest)
    return d.select(F.col("doc_id").alias("doc"), content.alias("content"))


def v_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Decision replies: a JSON array per order; every 7th a bare object,
    every 11th closed by the wrong bracket; plus ``events.props`` objects (never decisions)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    rec = F.struct(F.col("l_returnflag").alias("motion"), F.col("l_linestatus").alias("result"),
                   F.col("l_linenumber").cast("int").alias("yes"), F.lit(None).cast("int").alias("no"))
    g = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("k"), rec.alias("r")))).alias("a"))
    opts = {"ignoreNullFields": "false"}
    arr_json = F.to_json(F.transform("a", lambda x: x["r"]), opts)
    first_json = F.to_json(F.col("a")[0]["r"], opts)
    k = F.col("l_orderkey")
    text = (F.when(k % 7 == 0, first_json)
            .when(k % 11 == 0, F.concat(F.left(arr_json, F.length(arr_json) - 1), F.lit("}")))
            .otherwise(arr_json))
    out = g.select(F.concat(F.lit("o"), k.cast("string")).alias("doc"), text.alias("content"))
    ev = table(spark, sf, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("doc"), F.col("props").alias("content"))
    return out.unionByName(ev)


def v_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Key terms: every word of every whole benchmark passage, and the phrase of its first two words."""
    w = words(F.lower("text"))
    both = F.when(F.size(w) >= 2, F.array_append(w, F.array_join(F.slice(w, 1, 2), " "))).otherwise(w)
    return table(spark, sf, "benchmark").select(F.explode(both).alias("term")).distinct()
