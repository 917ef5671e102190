"""Registered queries: one per operator, each over the derived views of the
driver tables, with its DuckDB oracle (``oracle_sql``) where SQL can say it.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TT
from pyspark.errors import StreamingQueryException

from ..functions import text as T
from ..functions.dates import file_date_key, folder_year, meeting_key, part_no, recording_date, with_page_date
from ..functions.patterns import (MARKER_LENGTH, MARKER_LONGER, MAX_CHARS, MAX_PROMPT_CHARS, SECTION_DEFAULTS,
                                  SECTION_HEADERS)
from ..functions.patterns import WS_CLASS_RE2 as WS_CLASS
from ..functions.templates import CHUNK_SUMMARY, MERGE_SUMMARY, SHORT_SUMMARY, STAGES, STRUCTURED_SUMMARY
from ..functions.text import upper_text
from ..functions.tokens import token_count
from ..operators import assemble, catalog, chunk, ledger, model, parse, qc, report, segment
from ..session import WIDE_ROWS, checkpoint_dir, scratch_path, stored
from ..sources import io
from ..streaming.index import stream_index
from . import oracle_funcs as Q
from . import stub_model
from . import views as V
from .oracle_views import with_views


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ----------------------------------------------------------------- A1 / J1
_ATT_JSON = ("CAST(to_json(list({'Category_1': Category_1, 'Category_2': Category_2, 'Name_1': Name_1, "
             "'Name_2': Name_2, 'Title/Role': \"Title/Role\"} ORDER BY row_no)) AS VARCHAR)")
_ATT_DATE = ("coalesce(CAST(try_strptime(\"Date\", '%Y-%m-%d') AS DATE), "
             "CAST(try_strptime(\"Date\", '%m/%d/%Y') AS DATE))")
_A1_SQL = f"""
SELECT d AS "Date", {_ATT_JSON} AS Attendees
FROM (SELECT {_ATT_DATE} AS d, * FROM v_attendees) WHERE d IS NOT NULL GROUP BY d"""


@register("a1_attendees_by_date", with_views(_A1_SQL, "v_attendees"))
def a1_attendees_by_date(spark, sf):
    a = report.attendees_by_date(V.v_attendees(spark, sf))
    return a.select("Date", F.to_json("Attendees", report.JSON_KEEP_NULLS).alias("Attendees"))


@register("j1_merge_report", with_views(f"""
SELECT CAST(s."Date" AS DATE) AS "Date", s.PDF_File, s.Synopsis, s.Summary, s."Key Notes", a.Attendees
FROM v_summaries s LEFT JOIN ({_A1_SQL}) a ON CAST(s."Date" AS DATE) = a."Date"
""", "v_summaries", "v_attendees"))
def j1_merge_report(spark, sf):
    return report.merge_report(V.v_summaries(spark, sf), V.v_attendees(spark, sf))


# ------------------------------------------------------ P1-P5, W1, W2, W5, W6

_UP = "upper(text)"
_PAGES_CLASSIFIED = f"""
SELECT *, CASE WHEN is_start THEN page_date END AS start_date FROM (
  SELECT *, {Q.is_start('upper(text)', 'page_date')} AS is_start FROM (
    SELECT *, {Q.parse_date(_UP)} AS page_date FROM v_pages))"""


# Python and Java upper-case with the full mapping (sharp s -> SS); DuckDB
# maps it to the capital sharp s, so the oracle spells the mapping out.
@register("p1_upper_text", with_views(
    "SELECT path, upper(replace(text, 'ß', 'ss')) AS text_upper FROM v_pages", "v_pages"))
def p1_upper_text(spark, sf):
    return V.v_pages(spark, sf).select("path", upper_text("text").alias("text_upper"))


@register("p2_parse_date", with_views(f"SELECT path, {Q.parse_date(_UP)} AS page_date FROM v_pages", "v_pages"))
def p2_parse_date(spark, sf):
    return with_page_date(V.v_pages(spark, sf).select("path", upper_text("text").alias("_up")), "_up").select("path", "page_date")


@register("p3_meeting_key", with_views(
    f"SELECT path, {Q.meeting_key(Q.parse_date(_UP))} AS meeting_key FROM v_pages", "v_pages"))
def p3_meeting_key(spark, sf):
    dated = with_page_date(V.v_pages(spark, sf).select("path", upper_text("text").alias("_up")), "_up")
    return dated.select("path", meeting_key("page_date").alias("meeting_key"))


@register("p4_is_start", with_views(f"""
SELECT path, CAST({Q.phrase_hits(_UP)} AS INTEGER) AS phrase_hits, is_start FROM ({_PAGES_CLASSIFIED})""", "v_pages"))
def p4_is_start(spark, sf):
    c = segment.classify_pages(V.v_pages(spark, sf))
    return c.select("path", segment.phrase_hits(upper_text("text")).alias("phrase_hits"), "is_start")


_IND = ", ".join(Q.lit(i) for i in segment.EVIDENCE_INDICATORS)


@register("p5_page_evidence", with_views(f"""
SELECT collection, page_name, is_start, start_date AS page_date, indicator, contains(upper(text), indicator) AS present
FROM (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY page_name) AS rn FROM ({_PAGES_CLASSIFIED})),
     (SELECT unnest([{_IND}]) AS indicator) i
WHERE rn <= 10""", "v_pages"))
def p5_page_evidence(spark, sf):
    return segment.page_evidence(V.v_pages(spark, sf))


_W1_SQL = f"""
SELECT collection, path, page_name, is_start, page_date, meeting_date, {Q.meeting_key('meeting_date')} AS meeting_key
FROM (SELECT *, last_value(start_date IGNORE NULLS) OVER (PARTITION BY collection ORDER BY page_name
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS meeting_date FROM ({_PAGES_CLASSIFIED}))"""
_W_COLS = ["collection", "path", "page_name", "is_start", "page_date", "meeting_date", "meeting_key"]


@register("w1_assign_meetings", with_views(_W1_SQL, "v_pages"))
def w1_assign_meetings(spark, sf):
    return segment.assign_meetings(V.v_pages(spark, sf)).select(*_W_COLS)


@register("w2_assign_meetings_bucketed", with_views(_W1_SQL, "v_pages"))
def w2_assign_meetings_bucketed(spark, sf):
    """The scan over ranges of few pages, so that carries cross many of them."""
    return segment.assign_meetings(V.v_pages(spark, sf), rows_per_range=PAGES_PER_RANGE).select(*_W_COLS)


# far below the default: the small test tables then have many ranges too
PAGES_PER_RANGE = 500


def _assigned(spark, sf, **more):
    """Meeting assignment for the consumers, with ``more`` columns of the pages."""
    return segment.assign_meetings(V.v_pages(spark, sf).withColumns(more) if more else V.v_pages(spark, sf))


@register("w5_number_pages", with_views(f"""
SELECT collection, meeting_key, page_name,
       CAST(row_number() OVER (PARTITION BY collection, meeting_key ORDER BY lower(page_name), page_name) AS INTEGER)
         AS page_in_meeting
FROM ({_W1_SQL})""", "v_pages"))
def w5_number_pages(spark, sf):
    return segment.number_pages(_assigned(spark, sf)).select("collection", "meeting_key", "page_name", "page_in_meeting")


@register("w6_first_files", with_views(
    "SELECT path, page_name FROM v_pages ORDER BY path LIMIT 25", "v_pages"))
def w6_first_files(spark, sf):
    return segment.first_files(V.v_pages(spark, sf).select("path", "page_name"), 25)


# ------------------------------------------- S2, S3, P6, P12, P15, P16, W3, W4, J3


@register("s2_pending_pdfs", with_views("""
SELECT path, name FROM v_files
WHERE name LIKE '%.pdf' AND NOT (name LIKE '%\\_backup.pdf' ESCAPE '\\' OR name LIKE '%\\_ocr.pdf' ESCAPE '\\'
      OR starts_with(name, 'temp_') OR contains(name, '.backup'))""", "v_files"))
def s2_pending_pdfs(spark, sf):
    return catalog.pending_pdfs(V.v_files(spark, sf)).select("path", "name")


def _part_files(spark, sf):
    p = V.v_parts(spark, sf)
    return p.select(F.concat("part_name", F.lit(".wav")).alias("name"), F.col("meeting").alias("parent"))


@register("s3_meeting_folders", with_views("""
SELECT DISTINCT meeting AS folder FROM v_parts WHERE regexp_matches(part_name || '.wav', '^.*_part_.*\\.wav$')""",
                                          "v_parts"))
def s3_meeting_folders(spark, sf):
    return catalog.meeting_folders(_part_files(spark, sf))


@register("p6_file_date_key", with_views(
    f"SELECT path, {Q.file_date_key('name', 'parent')} AS date_key FROM v_files", "v_files"))
def p6_file_date_key(spark, sf):
    return V.v_files(spark, sf).select("path", file_date_key("name", "parent").alias("date_key"))


_P12_SQL = f"""
SELECT c.path, coalesce(p.chars > 100, false) AS has_text
FROM (SELECT DISTINCT path FROM v_pdf_pages) c
LEFT JOIN (SELECT path, sum(length({Q.strip('text')})) AS chars FROM v_pdf_pages WHERE page_no <= 3 GROUP BY path) p
  ON c.path = p.path"""


@register("p12_has_text", with_views(_P12_SQL, "v_pdf_pages"))
def p12_has_text(spark, sf):
    return catalog.has_text(V.v_pdf_pages(spark, sf))


@register("p15_plan_moves", with_views("""
SELECT path AS source, 'flat/' || name AS target, count(*) OVER (PARTITION BY 'flat/' || name) > 1 AS conflict
FROM v_files WHERE lower(name) LIKE '%.pdf' AND NOT contains(lower(name), '_ocr')""", "v_files"))
def p15_plan_moves(spark, sf):
    return catalog.plan_moves(V.v_files(spark, sf), "flat")


@register("p16_derived_names", with_views("""
SELECT path, regexp_replace(name, '\\.pdf$', '') || '_ocr.pdf' AS ocr_name,
       regexp_replace(name, '\\.pdf$', '') || '.pdf.backup' AS backup_name, 'temp_' || name AS temp_name
FROM v_files""", "v_files"))
def p16_derived_names(spark, sf):
    return catalog.derived_names(V.v_files(spark, sf)).select("path", "ocr_name", "backup_name", "temp_name")


@register("p16_output_names", with_views("""
SELECT DISTINCT meeting_key AS source, meeting_key || '_meeting_minutes.pdf' AS output FROM (""" + _W1_SQL + """)
UNION ALL
SELECT stem, stem || e FROM (SELECT DISTINCT stem FROM v_recordings), (SELECT unnest(['.mp3', '.txt', '.summary.txt']) AS e)""",
                                         "v_pages", "v_recordings"))
def p16_output_names(spark, sf):
    """The PDF that each meeting is bound into, and the files that each recording gives rise to."""
    meetings = _assigned(spark, sf).select(F.col("meeting_key").alias("source")).distinct()
    stems = V.v_recordings(spark, sf).select("stem").distinct().select("stem", catalog.recording_names("stem").alias("n"))
    files = stems.select(F.col("stem").alias("source"), F.explode(F.array("n.mp3", "n.transcript", "n.summary")).alias("output"))
    return meetings.select("source", catalog.meeting_pdf_name("source").alias("output")).unionByName(files)


@register("w3_best_version", with_views(f"""
SELECT date_key, path, name FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key ORDER BY contains(name, '_ocr') DESC, path) AS rn
  FROM (SELECT path, name, {Q.file_date_key('name', 'parent')} AS date_key FROM v_files
        WHERE NOT contains(lower(name), 'backup'))
  WHERE date_key IS NOT NULL) WHERE rn = 1""", "v_files"))
def w3_best_version(spark, sf):
    return catalog.best_version(V.v_files(spark, sf)).select("date_key", "path", "name")


@register("w4_best_candidate", with_views(f"""
SELECT path, config_rank, CASE WHEN length({Q.strip('text')}) = 0 THEN '' ELSE text END AS text FROM (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY length({Q.strip('text')}) DESC, config_rank) AS rn
  FROM v_candidates) WHERE rn = 1""", "v_candidates"))
def w4_best_candidate(spark, sf):
    return catalog.best_candidate(V.v_candidates(spark, sf))


@register("j3_pending", with_views("""
SELECT w.file, w.stem FROM v_recordings w
WHERE w.kind = 'wav' AND NOT EXISTS (SELECT 1 FROM v_recordings m WHERE m.kind = 'mp3' AND m.stem = w.stem)""",
                                   "v_recordings"))
def j3_pending(spark, sf):
    r = V.v_recordings(spark, sf)
    wav = r.where("kind = 'wav'").select("file", "stem")
    mp3 = r.where("kind = 'mp3'").select("stem")
    return catalog.pending(wav, mp3, "stem")


# ------------------------------------------------------------- A7, A9 stats
_A7_SQL = f"""
SELECT CAST(count(*) AS BIGINT) AS found,
       CAST(count_if(status = 'already_ocr') AS BIGINT) AS already_ocr,
       CAST(count_if(status = 'processed') AS BIGINT) AS processed,
       CAST(count_if(status = 'failed') AS BIGINT) AS failed,
       sum(seconds) AS seconds,
       CASE WHEN count_if(status = 'processed') > 0
            THEN sum(seconds) / (count_if(status = 'processed') + count_if(status = 'already_ocr')) END AS avg_seconds
FROM (
  SELECT h.path, CASE WHEN h.has_text THEN 'already_ocr' WHEN t.chars > 0 THEN 'processed' ELSE 'failed' END AS status,
         CAST(t.pages * 2.5 AS DOUBLE) AS seconds
  FROM ({_P12_SQL}) h
  JOIN (SELECT path, sum(length({Q.strip('text')})) AS chars, count(*) AS pages FROM v_pdf_pages GROUP BY path) t
    ON h.path = t.path)"""


@register("a7_ocr_run_stats", with_views(_A7_SQL, "v_pdf_pages"))
def a7_ocr_run_stats(spark, sf):
    outcomes = catalog.page_totals(V.v_pdf_pages(spark, sf)).select(
        "path",
        F.when(F.col("has_text"), "already_ocr").when(F.col("chars") > 0, "processed").otherwise("failed").alias("status"),
        (F.col("pages") * 2.5).alias("seconds"))
    return report.run_stats(outcomes)


# ------------------------------------------ P10, P11, P13, P14, A2, A3, J2


@register("p10_clean_text", with_views(f"SELECT doc_id, {Q.clean_text('text')} AS text FROM v_dirty", "v_dirty"))
def p10_clean_text(spark, sf):
    return V.v_dirty(spark, sf).select("doc_id", T.clean_text("text").alias("text"))


@register("p11_truncate_text", with_views(f"""
SELECT doc_id, {Q.truncate('text', MAX_CHARS, MARKER_LENGTH)} AS text_extracted,
       {Q.truncate_for_prompt('text')} AS text_prompt FROM v_texts""", "v_texts"))
def p11_truncate_text(spark, sf):
    return V.v_texts(spark, sf).select(
        "doc_id", T.truncate_text("text", MAX_CHARS, MARKER_LENGTH).alias("text_extracted"),
        T.truncate_for_prompt("text").alias("text_prompt"))


@register("p13_word_count", with_views(f"SELECT doc_id, {Q.word_count('text')} AS word_count FROM v_texts",
                                       "v_texts"))
def p13_word_count(spark, sf):
    return V.v_texts(spark, sf).select("doc_id", T.word_count("text").alias("word_count"))


@register("p14_minutes", with_views(f"""
SELECT file, {Q.minutes('duration_s')} AS duration_min FROM v_recordings WHERE duration_s IS NOT NULL""",
                                    "v_recordings"))
def p14_minutes(spark, sf):
    r = V.v_recordings(spark, sf).where("duration_s IS NOT NULL")
    return r.select("file", T.minutes("duration_s").alias("duration_min"))


_PIECE = (f"CASE WHEN {Q.strip('text')} <> '' THEN chr(10) || '--- Page ' || CAST(page_no AS VARCHAR) || ' ---' "
          "|| chr(10) || text || chr(10) END")
_A2_SQL = f"""
SELECT path, {Q.clean_text('raw')} AS text FROM (
  SELECT path, coalesce(string_agg({_PIECE}, '' ORDER BY page_no), '') AS raw FROM v_pdf_pages GROUP BY path)"""


@register("a2_assemble_text", with_views(_A2_SQL, "v_pdf_pages"))
def a2_assemble_text(spark, sf):
    return assemble.assemble_text(V.v_pdf_pages(spark, sf))


_YEAR = Q.folder_year("meeting")
_A3_SQL = f"""
SELECT b.meeting, concat_ws(chr(10), 'Board Members: ' || m.names, b.body) AS transcript
FROM (SELECT meeting, string_agg(coalesce(text, ''), chr(10) ORDER BY {Q.part_no('part_name')}, part_name) AS body
      FROM v_parts GROUP BY meeting) b
LEFT JOIN (SELECT y.meeting, string_agg(r.name, ', ' ORDER BY r.row_no) AS names
           FROM (SELECT DISTINCT meeting, {_YEAR} AS year FROM v_parts) y
           JOIN v_roster r ON y.year IS NOT NULL AND contains(r.year_range, y.year) AND r.name IS NOT NULL
           GROUP BY y.meeting) m ON b.meeting = m.meeting"""


@register("a3_assemble_transcript", with_views(_A3_SQL, "v_parts", "v_roster"))
def a3_assemble_transcript(spark, sf):
    return assemble.assemble_transcript(V.v_parts(spark, sf), V.v_roster(spark, sf))


@register("j2_roster_for", with_views(f"""
SELECT y.meeting, y.year, r.name, r.year_range, r.row_no
FROM (SELECT DISTINCT meeting, {_YEAR} AS year FROM v_parts) y
LEFT JOIN v_roster r ON contains(r.year_range, y.year)""", "v_parts", "v_roster"))
def j2_roster_for(spark, sf):
    m = V.v_parts(spark, sf).select("meeting").distinct().select("meeting", folder_year("meeting").alias("year"))
    return assemble.roster_for(m, V.v_roster(spark, sf)).select("meeting", "year", "name", "year_range", "row_no")


# ------------------------------------------------------------------ C1-C4
def _c1_body(n: int) -> str:
    sl = f"toks[i * {n} + 1:(i + 1) * {n}]"
    return f"""
SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, CAST(len({sl}) AS BIGINT) AS n_tokens,
       array_to_string({sl}, '') AS text
FROM (SELECT doc_id, toks, unnest(range(0, CAST(ceil(len(toks) / {n}) AS BIGINT))) AS i
      FROM (SELECT doc_id, {Q.tokens('text')} AS toks FROM v_texts))"""


def _c1_sql(n: int) -> str:
    return with_views(_c1_body(n), "v_texts")


@register("c1_token_chunks", _c1_sql(3000))
def c1_token_chunks(spark, sf):
    return chunk.token_chunks(V.v_texts(spark, sf), 3000)


@register("c1_token_chunks_300", _c1_sql(300))
def c1_token_chunks_300(spark, sf):
    return chunk.token_chunks(V.v_texts(spark, sf), 300)


_C2_STEP = ("lambda acc, t: CASE WHEN acc.i > 0 AND acc.c + t > {m} "
            "THEN {{'s': list_append(acc.s, acc.i), 'c': t, 'i': acc.i + 1}} "
            "ELSE {{'s': acc.s, 'c': acc.c + t, 'i': acc.i + 1}} END")


def _c2_sql(whole_below: int, max_tokens: int) -> str:
    costs = f"list_transform(paras, lambda p: {Q.token_count('p')} + 1)"
    fold = (f"list_reduce({costs}, {_C2_STEP.format(m=max_tokens)}, "
            "{'s': [0], 'c': CAST(0 AS BIGINT), 'i': 0}).s")
    return with_views(f"""
SELECT doc_id, CAST(k AS INTEGER) AS chunk_no,
       CASE WHEN n < {whole_below} THEN text
            ELSE array_to_string(paras[s[k + 1] + 1:coalesce(s[k + 2], len(paras))], chr(10)) END AS text
FROM (SELECT *, unnest(range(0, len(s))) AS k FROM (
  SELECT *, CASE WHEN n < {whole_below} THEN [0] ELSE {fold} END AS s FROM (
    SELECT doc_id, text, {Q.token_count('text')} AS n, string_split(text, chr(10)) AS paras FROM v_texts)))""",
                      "v_texts")


@register("c2_paragraph_chunks", _c2_sql(500, 400))
def c2_paragraph_chunks(spark, sf):
    return chunk.paragraph_chunks(V.v_texts(spark, sf), whole_below=500, max_tokens=400)


@register("c2_paragraph_row_chunks", _c2_sql(500, 400))
def c2_paragraph_row_chunks(spark, sf):
    paras = V.v_texts(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("para_no", "text"))
    return chunk.paragraph_row_chunks(paras, "doc_id", whole_below=500, max_tokens=400)


@register("c3_segment_plan", with_views("""
SELECT stem, CAST(i AS INTEGER) AS part_no, CAST(i * 1800 AS DOUBLE) AS start_s,
       least(CAST((i + 1) * 1800 AS DOUBLE), duration_s) AS end_s,
       stem || '_part_' || printf('%03d', i) || '.wav' AS part_file
FROM (SELECT stem, duration_s, unnest(range(0, CAST(ceil(duration_s / 1800.0) AS BIGINT))) AS i
      FROM v_recordings WHERE kind = 'wav' AND duration_s > 0)""", "v_recordings"))
def c3_segment_plan(spark, sf):
    return chunk.segment_plan(V.v_recordings(spark, sf).where("kind = 'wav'"), 1800)


@register("c4_token_count", with_views(f"SELECT doc_id, {Q.token_count('text')} AS n_tokens FROM v_texts",
                                       "v_texts"))
def c4_token_count(spark, sf):
    return V.v_texts(spark, sf).select("doc_id", token_count("text").alias("n_tokens"))


# ---------------------------------------------------------- R1-R3, U1-U3, A5, J4, A8, W7


def sql_fill(template: str, text: str, date: str | None = None) -> str:
    out, rest = [], template
    while rest:
        cands = [(rest.find(k), k) for k in ("{text}", "{date}") if rest.find(k) >= 0]
        if not cands:
            out.append(Q.lit(rest))
            break
        i, k = min(cands)
        if i:
            out.append(Q.lit(rest[:i]))
        out.append(text if k == "{text}" else date)
        rest = rest[i + 6:]
    return "(" + " || ".join(out) + ")"


def _r1_sql(src: str, doc: str, content: str, tolerant: bool = False) -> str:
    hdr, txt = [], []
    for name, pat in SECTION_HEADERS:
        rx = ("(?i)" + pat) if not tolerant else (
            "(?i)^(?:[0-9]+\\." + WS_CLASS + "*)?" + pat[1:] + "\\**")
        hdr.append(f"WHEN regexp_matches(line, '{rx}') THEN '{name}'")
        txt.append(f"WHEN regexp_matches(line, '{rx}') THEN regexp_replace(line, '{rx}{WS_CLASS}*', '')")
    secs = [n for n, _ in SECTION_HEADERS]
    wide = ", ".join(f"max(CASE WHEN section = '{s}' THEN v END) AS {s}" for s in secs)
    final = ", ".join(f"coalesce(nullif({Q.strip(f'w.{s}')}, ''), {Q.lit(SECTION_DEFAULTS[s])}) AS {s}"
                      for s in secs)
    return f"""
SELECT * FROM (WITH replies AS MATERIALIZED (SELECT row_number() OVER () AS reply, * FROM ({src}) s0)
SELECT d.{doc}, {final}
FROM replies d LEFT JOIN (
  SELECT reply, {wide} FROM (
    SELECT reply, section,
           string_agg(piece, ' ' ORDER BY pos) FILTER (WHERE piece IS NOT NULL AND (f IS NULL OR pos >= f)) AS v
    FROM (
      SELECT *, max(CASE WHEN hdr IS NOT NULL AND htext <> '' THEN pos END) OVER (PARTITION BY reply, section) AS f,
             CASE WHEN hdr IS NOT NULL THEN nullif(htext, '') ELSE nullif(line, '') END AS piece
      FROM (
        SELECT *, last_value(hdr IGNORE NULLS) OVER (PARTITION BY reply ORDER BY pos
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
        FROM (
          SELECT *, CASE {' '.join(hdr)} END AS hdr, CASE {' '.join(txt)} END AS htext
          FROM (
            SELECT reply, pos, {Q.strip('raw')} AS line
            FROM (
              SELECT reply, unnest(ls) AS raw, unnest(range(0, len(ls))) AS pos
              FROM (SELECT reply, string_split({content}, chr(10)) AS ls FROM replies) a1
            ) a2
          ) a3
        ) a4
      ) a5
      WHERE section IS NOT NULL
    ) a6
    GROUP BY reply, section
  ) a7
  GROUP BY reply
) w ON d.reply = w.reply)"""


@register("r1_parse_sections", with_views(_r1_sql("SELECT * FROM v_responses", "doc", "content"), "v_responses"))
def r1_parse_sections(spark, sf):
    return parse.parse_sections(V.v_responses(spark, sf))


@register("r1_parse_sections_tolerant",
          with_views(_r1_sql("SELECT * FROM v_responses", "doc", "content", True), "v_responses"))
def r1_parse_sections_tolerant(spark, sf):
    return parse.parse_sections(V.v_responses(spark, sf), tolerant=True)


_DEC_TYPE = '[{"motion":"VARCHAR","result":"VARCHAR","yes":"INTEGER","no":"INTEGER"}]'


@register("r2_parse_decisions", with_views(f"""
SELECT doc, CAST(i - 1 AS INTEGER) AS idx, arr[i].motion AS motion, arr[i].result AS result,
       arr[i].yes AS yes, arr[i].no AS no
FROM (SELECT doc, arr, unnest(range(1, len(arr) + 1)) AS i FROM (
  SELECT doc, from_json(content, '{_DEC_TYPE}') AS arr FROM dec_ok))""", "v_decisions", extra={
    "dec_ok": f"SELECT doc, content FROM v_decisions "
              f"WHERE regexp_matches(content, '^{WS_CLASS}*\\[') AND json_valid(content)"}))
def r2_parse_decisions(spark, sf):
    return parse.parse_decisions(V.v_decisions(spark, sf))


# Summary requests over the documents: text cut for the prompt, dated by doc_id.
def _doc_requests(spark, sf):
    d = V.v_texts(spark, sf).select(
        "doc_id", "text", F.date_format(V.day(F.col("doc_id") % V.PAGE_DAYS), "yyyy-MM-dd").alias("date"))
    return model.build_requests(d, "structured_summary", text="text", date="date", keys=["doc_id", "date"])


_DOC_REQ_SQL = f"""
SELECT doc_id, dt AS date, 'structured_summary' AS stage, 'gpt-3.5-turbo-16k' AS model, CAST(0.2 AS DOUBLE) AS temperature,
       {sql_fill(STRUCTURED_SUMMARY, 't', 'dt')} AS prompt, t AS source_text,
       {sql_fill(SHORT_SUMMARY, 'left(t, 8000)', 'dt')} AS retry_prompt
FROM (SELECT doc_id, text AS t,
             strftime({'(DATE ' + chr(39) + '1970-01-01' + chr(39) + ' + CAST(doc_id % 47000 AS INTEGER))'}, '%Y-%m-%d') AS dt
      FROM v_texts)"""


@register("u1_build_requests", with_views(
    f"SELECT doc_id, stage, model, temperature, prompt FROM ({_DOC_REQ_SQL})", "v_texts"))
def u1_build_requests(spark, sf):
    return _doc_requests(spark, sf).select("doc_id", "stage", "model", "temperature", "prompt")


def _run_stub(req, keys, retry=True, date="date"):
    return model.run_model(req, stub_model.make_stub_client, keys=keys, settings=tuple(c for c in ("model", "temperature") if c in req.columns),
                           retry_template=SHORT_SUMMARY if retry else None, date=date if retry else None)


@register("u3_run_model", with_views(f"""
SELECT doc_id, {stub_model.sql_call('prompt', None, 'source_text', 'retry_prompt')} FROM ({_DOC_REQ_SQL})""",
                                     "v_texts"))
def u3_run_model(spark, sf):
    checkpoint_dir(spark)
    out = _run_stub(_doc_requests(spark, sf), ["doc_id"])
    return out.checkpoint(eager=True)


@register("u3_resumable_run", with_views(f"""
SELECT doc_id, {stub_model.sql_call('prompt', None, 'source_text', 'retry_prompt')}, CAST(1 AS BIGINT) AS n_sent FROM ({_DOC_REQ_SQL})""",
                                         "v_texts"))
def u3_resumable_run(spark, sf):
    """The run broken off after half of its batches, then begun again: each request is sent once."""
    checkpoint_dir(spark)
    folder = scratch_path(spark, f"u3-{uuid.uuid4().hex}")
    requests = _doc_requests(spark, sf)
    batch = -(-requests.count() // 4)

    def go(stop_after):
        return ledger.run_resumable(requests, lambda rows, keys: _run_stub(rows, keys), folder, ["doc_id"],
                                    ["prompt", "user_text", "model", "temperature"], per_batch=batch, stop_after=stop_after)
    try:
        go(2)
    except StreamingQueryException as e:
        if "stopped between two batches" not in str(e):
            raise
    named = requests.select("doc_id", ledger.request_key(["prompt", "user_text", "model", "temperature"]).alias("request_key"))
    replies = go(None)
    sent = named.join(ledger.times_sent(spark, f"{folder}/ledger"), "request_key", "left").select("doc_id", "n_sent")
    return replies.join(sent, "doc_id")


_AUDIO_PARTIAL = f"""
SELECT doc_id, chunk_no, {stub_model.sql_call('prompt', None, 'text', None)}
FROM (SELECT doc_id, chunk_no, text, {sql_fill(CHUNK_SUMMARY, 'text')} AS prompt FROM ({_c1_body(300)}))"""


@register("u3_audio_run", with_views(f"""
SELECT d.doc_id, coalesce(c.n, 0) AS n_chunks, coalesce(j.n_failed, 0) AS n_failed,
       CASE WHEN coalesce(j.n_failed, 0) > 0 THEN 'incomplete' ELSE coalesce(m.status, 'blank') END AS status, m.content, m.error
FROM (SELECT DISTINCT doc_id FROM v_texts) d LEFT JOIN (SELECT doc_id, CAST(count(*) AS INTEGER) AS n FROM partial GROUP BY doc_id) c USING (doc_id)
LEFT JOIN joined j USING (doc_id)
LEFT JOIN (SELECT doc_id, {stub_model.sql_call('prompt', None, 'fused', None)}
           FROM (SELECT doc_id, fused, {sql_fill(MERGE_SUMMARY, 'fused')} AS prompt FROM joined WHERE fused IS NOT NULL)) m USING (doc_id)""",
                                     "v_texts", extra={"partial": _AUDIO_PARTIAL, "joined": """
SELECT doc_id, CASE WHEN count(*) = count(content) THEN string_agg(content, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY chunk_no) END AS fused,
       CAST(count_if(content IS NULL) AS BIGINT) AS n_failed FROM partial WHERE status <> 'blank' GROUP BY doc_id"""}))
def u3_audio_run(spark, sf):
    """Whole texts of any length: a summary of every chunk, joined, and the merge of these."""
    checkpoint_dir(spark)
    return model.run_chunked(V.v_texts(spark, sf), lambda rows, keys: _run_stub(rows, keys, retry=False), doc="doc_id", max_tokens=300)


def _u2_sql(whole_below: int, max_tokens: int) -> str:
    costs = f"list_transform(paras, lambda p: {Q.token_count('p')} + 1)"
    fold = (f"list_reduce({costs}, {_C2_STEP.format(m=max_tokens)}, "
            "{'s': [0], 'c': CAST(0 AS BIGINT), 'i': 0}).s")
    return f"""
SELECT doc_id, stage, CAST(0 AS INTEGER) AS chunk_no, text AS input, CAST(NULL AS VARCHAR) AS depends_on
FROM (SELECT doc_id, text FROM v_texts WHERE {Q.token_count('text')} < {whole_below}),
     (SELECT unnest(['summary', 'outline', 'decisions']) AS stage) s
UNION ALL
SELECT doc_id, 'summary', CAST(k AS INTEGER), array_to_string(paras[s[k + 1] + 1:coalesce(s[k + 2], len(paras))], chr(10)),
       CAST(NULL AS VARCHAR)
FROM (SELECT *, unnest(range(0, len(s))) AS k FROM (
  SELECT *, {fold} AS s FROM (
    SELECT doc_id, string_split(text, chr(10)) AS paras FROM v_texts WHERE {Q.token_count('text')} >= {whole_below})))
UNION ALL
SELECT doc_id, stage, CAST(0 AS INTEGER), CAST(NULL AS VARCHAR), dep
FROM (SELECT doc_id FROM v_texts WHERE {Q.token_count('text')} >= {whole_below}),
     (SELECT unnest(['fuse', 'outline', 'decisions']) AS stage, unnest(['summary', 'fuse', 'fuse']) AS dep) s"""


@register("u2_plan_stages", with_views(_u2_sql(500, 400), "v_texts"))
def u2_plan_stages(spark, sf):
    return model.plan_stages(V.v_texts(spark, sf), doc="doc_id", whole_below=500, max_tokens=400)


def _system_sql(stage_col: str) -> str:
    whens = " ".join(f"WHEN '{s}' THEN {Q.lit(STAGES[s][0])}" for s in ("summary", "outline", "decisions", "fuse"))
    return f"(CASE {stage_col} {whens} END)"


@register("j4_attach_responses", with_views(f"""
SELECT p.doc_id, p.stage, p.chunk_no, coalesce(r.status, 'missing') AS status, r.content
FROM ({_u2_sql(500, 400)}) p
LEFT JOIN (SELECT doc_id, stage, chunk_no, {stub_model.sql_call(_system_sql('stage'), 'input', 'input', None)}
           FROM ({_u2_sql(500, 400)}) WHERE input IS NOT NULL) r
  ON p.doc_id = r.doc_id AND p.stage = r.stage AND p.chunk_no = r.chunk_no""", "v_texts"))
def j4_attach_responses(spark, sf):
    checkpoint_dir(spark)
    plan = model.plan_stages(V.v_texts(spark, sf), doc="doc_id", whole_below=500, max_tokens=400)
    sys_prompt = None
    for s in ("summary", "outline", "decisions", "fuse"):
        v = F.lit(STAGES[s][0])
        sys_prompt = F.when(F.col("stage") == s, v) if sys_prompt is None else sys_prompt.when(F.col("stage") == s, v)
    req = plan.where("input IS NOT NULL").select(
        "doc_id", "stage", "chunk_no", sys_prompt.alias("prompt"), F.col("input").alias("user_text"),
        F.col("input").alias("source_text"))
    resp = _run_stub(req, ["doc_id", "stage", "chunk_no"], retry=False).checkpoint(eager=True)
    return model.attach_responses(plan.select("doc_id", "stage", "chunk_no"), resp, ["doc_id", "stage", "chunk_no"])


def _staged_sql(rows: str) -> str:
    return f"SELECT doc_id, stage, chunk_no, {stub_model.sql_call(_system_sql('stage'), 'input', 'input', None)} FROM ({rows})"


_STAGED_STEPS = {
    "r1": _staged_sql("SELECT * FROM plan WHERE input IS NOT NULL"),
    "r2": _staged_sql("""SELECT doc_id, 'fuse' AS stage, CAST(0 AS INTEGER) AS chunk_no,
  string_agg(content, chr(10) || chr(10) ORDER BY chunk_no) AS input FROM r1
WHERE stage = 'summary' AND status <> 'blank' AND doc_id IN (SELECT doc_id FROM plan WHERE stage = 'fuse')
GROUP BY doc_id HAVING count(*) = count(content)"""),
    "r3": _staged_sql("""SELECT p.doc_id, p.stage, p.chunk_no, r2.content AS input
FROM plan p JOIN r2 ON p.doc_id = r2.doc_id AND p.depends_on = 'fuse' WHERE r2.content IS NOT NULL""")}


@register("j4_staged_responses", with_views("""
SELECT p.doc_id, p.stage, p.chunk_no, coalesce(r.status, 'missing') AS status, r.content
FROM plan p LEFT JOIN (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3) r
  ON p.doc_id = r.doc_id AND p.stage = r.stage AND p.chunk_no = r.chunk_no""", "v_texts", extra={
    "plan": _u2_sql(500, 400), **_STAGED_STEPS}))
def j4_staged_responses(spark, sf):
    checkpoint_dir(spark)
    plan = stored(model.plan_stages(V.v_texts(spark, sf), doc="doc_id", whole_below=500, max_tokens=400), "plan")  # used by each stage
    replies = model.run_stages(plan, lambda req, keys: _run_stub(req, keys, retry=False), doc="doc_id")
    return model.attach_responses(plan.select("doc_id", "stage", "chunk_no"), replies, ["doc_id", "stage", "chunk_no"])


@register("a5_fuse", with_views(f"""
SELECT doc_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY chunk_no) AS fused, CAST(0 AS BIGINT) AS n_failed
FROM ({_c1_body(300)}) GROUP BY doc_id""", "v_texts"))
def a5_fuse(spark, sf):
    chunks = chunk.token_chunks(V.v_texts(spark, sf), 300)
    return model.fuse(chunks, doc="doc_id", content="text", sep="\n\n---\n\n")


# ---------------------------------------------- R3 / A8 / W7: the summary run


def _best_with_text(spark, sf):
    best = catalog.best_version(V.v_files(spark, sf)).select("date_key", "path", "name")
    txt = V.v_file_text(spark, sf).select("path", "text")
    ext = F.coalesce(T.clean_text("text"), F.lit(""))  # a file without text stays and counts as failed
    return best.join(txt, "path", "left").select(
        F.date_format("date_key", "yyyy-MM-dd").alias("date"), "path", "name", ext.alias("text"))


def _summary_run(spark, sf):
    """Best PDF per date -> text -> prompt -> model -> status per file."""
    checkpoint_dir(spark)
    b = _best_with_text(spark, sf)
    req = model.build_requests(
        b.select("date", "path", "name", "text"),
        "structured_summary", text="text", date="date", keys=["path", "name", "date"])
    return _run_stub(req, ["path", "name", "date"]).checkpoint(eager=True)


def summary_records(replies):
    """CSV rows of the summary run: parsed sections for answered files,
    fixed records for failed calls, no row for blank text."""
    ok = replies.where("status IN ('ok', 'shortened')")
    parsed = parse.parse_sections(ok, doc="path", content="content")
    good = ok.select("path", "name", "date").join(parsed, "path").select(
        "date", "name", "synopsis", "summary", "key_notes")
    bad = replies.where(F.col("status").isin("error", "too_long")).select(
        "date", "name", *parse.placeholder("status", "error"))
    recs = good.unionByName(bad)
    return recs.select(F.col("date").alias("Date"), F.col("name").alias("PDF_File"),
                       F.col("synopsis").alias("Synopsis"), F.col("summary").alias("Summary"),
                       F.col("key_notes").alias("Key Notes"))


_BEST_SQL = f"""
SELECT date_key, path, name FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key ORDER BY contains(name, '_ocr') DESC, path) AS rn
  FROM (SELECT path, name, {Q.file_date_key('name', 'parent')} AS date_key FROM v_files
        WHERE NOT contains(lower(name), 'backup'))
  WHERE date_key IS NOT NULL) WHERE rn = 1"""
_RUN_SQL = f"""
SELECT path, name, dt AS date, {stub_model.sql_call('prompt', None, 'src', 'retry_prompt')}
FROM (SELECT path, name, dt, t AS src, {sql_fill(STRUCTURED_SUMMARY, 't', 'dt')} AS prompt,
             {sql_fill(SHORT_SUMMARY, 'left(t, 8000)', 'dt')} AS retry_prompt
      FROM (SELECT b.path, b.name, strftime(b.date_key, '%Y-%m-%d') AS dt,
                   coalesce({Q.clean_text('x.text')}, '') AS t
            FROM ({_BEST_SQL}) b LEFT JOIN v_file_text x ON b.path = x.path))"""
_PH = {k: v for k, v in parse.PLACEHOLDERS.items()}


def _ph_sql(i: int) -> str:
    whens = []
    for s, texts in _PH.items():
        t = texts[i]
        v = (Q.lit(t.split("{e}")[0]) + " || coalesce(error, '')") if "{e}" in t else Q.lit(t)
        whens.append(f"WHEN '{s}' THEN {v}")
    return f"CASE status {' '.join(whens)} END"


_RECORDS_SQL = f"""
SELECT r.date AS "Date", r.name AS PDF_File, p.synopsis AS Synopsis, p.summary AS Summary, p.key_notes AS "Key Notes"
FROM run r JOIN ({_r1_sql("SELECT path, content FROM run WHERE status IN ('ok', 'shortened')", 'path', 'content')}) p
  ON r.path = p.path
WHERE r.status IN ('ok', 'shortened')
UNION ALL
SELECT date, name, {_ph_sql(0)}, {_ph_sql(1)}, {_ph_sql(2)} FROM run WHERE status IN ('error', 'too_long')"""


@register("r3_placeholder", with_views(_RECORDS_SQL, "v_files", "v_file_text", extra={"run": _RUN_SQL}))
def r3_placeholder(spark, sf):
    return summary_records(_summary_run(spark, sf))


@register("w7_sorted_summaries", with_views(_RECORDS_SQL + ' ORDER BY "Date"', "v_files", "v_file_text",
                                            extra={"run": _RUN_SQL}))
def w7_sorted_summaries(spark, sf):
    return summary_records(_summary_run(spark, sf)).orderBy("Date")


@register("a8_summary_run_stats", with_views("""
SELECT CAST(count(*) AS BIGINT) AS found, CAST(count_if(status <> 'blank') AS BIGINT) AS processed,
       CAST(count_if(status = 'blank') AS BIGINT) AS failed FROM run""", "v_files", "v_file_text",
                                             extra={"run": _RUN_SQL}))
def a8_summary_run_stats(spark, sf):
    run = _summary_run(spark, sf)
    out = run.select(F.when(F.col("status") == "blank", "failed").otherwise("processed").alias("status"))
    return report.run_stats(out, seconds=None, statuses=("processed", "failed"))


# --------------------------------------------------------------- A4, A6, A9
_A4_SQL = f"""
SELECT collection, meeting_key, CAST(GROUPING(collection, meeting_key) AS INTEGER) AS level,
       CAST(count(*) AS BIGINT) AS n_files, CAST(count(start_date) AS BIGINT) AS n_starts,
       CAST(count(DISTINCT CASE WHEN meeting_key <> 'unassigned' THEN coll || '/' || meeting_key END) AS BIGINT) AS n_meetings,
       CAST(count_if(meeting_key = 'unassigned') AS BIGINT) AS n_unassigned
FROM (SELECT *, collection AS coll, last_value(start_date IGNORE NULLS) OVER (PARTITION BY collection ORDER BY page_name
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS md FROM ({_PAGES_CLASSIFIED})) x,
     LATERAL (SELECT {Q.meeting_key('md')} AS meeting_key)
GROUP BY ROLLUP (collection, meeting_key)"""


@register("a4_organization_report", with_views(_A4_SQL, "v_pages"))
def a4_organization_report(spark, sf):
    return report.organization_report(_assigned(spark, sf))


_NUMBERED_SQL = f"""
SELECT *, row_number() OVER (PARTITION BY collection, meeting_key ORDER BY lower(page_name), page_name) AS pim
FROM ({_W1_SQL.replace('SELECT collection, path, page_name,', 'SELECT collection, path, page_name, text,', 1)})"""


@register("a6_meeting_manifest", with_views(f"""
SELECT collection, meeting_key, CAST(count(*) AS BIGINT) AS n_pages,
       string_agg(printf('%2d. %s', pim, page_name), chr(10) ORDER BY pim) AS sources,
       meeting_key || '_meeting_minutes.pdf' AS pdf_file
FROM ({_NUMBERED_SQL}) WHERE meeting_key <> 'unassigned' GROUP BY collection, meeting_key""", "v_pages"))
def a6_meeting_manifest(spark, sf):
    return report.meeting_manifest(segment.number_pages(_assigned(spark, sf)))


def _paged_sql(rows: str, keys: str, order: str, value: str, page_bytes: int) -> str:
    """Pages of ordered values: the page is where a value begins in bytes, one byte between values."""
    return f"""
SELECT *, CAST(begun // {page_bytes} AS INTEGER) AS page_no FROM (
  SELECT *, CAST(sum(strlen({value}) + 1) OVER (PARTITION BY {keys} ORDER BY {order}) - strlen({value}) - 1 AS BIGINT) AS begun,
         row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS no FROM ({rows}))"""


PAGE_BYTES = 512  # far below the default: the small test lists then have several pages too


@register("a6_manifest_paged", with_views(f"""
WITH l AS ({_paged_sql(f"SELECT collection, meeting_key, pim, printf('%2d. %s', pim, page_name) AS line FROM ({_NUMBERED_SQL}) WHERE meeting_key <> 'unassigned'",
                       'collection, meeting_key', 'pim', 'line', PAGE_BYTES)})
SELECT collection, meeting_key, 'sources' AS kind, page_no, CAST(min(no) - 1 AS BIGINT) AS n_before, CAST(count(*) AS BIGINT) AS n_values,
       string_agg(line, chr(10) ORDER BY no) AS text FROM l GROUP BY collection, meeting_key, page_no
UNION ALL
SELECT collection, meeting_key, 'meeting', CAST(0 AS INTEGER), CAST(0 AS BIGINT), CAST(count(*) AS BIGINT), meeting_key || '_meeting_minutes.pdf'
FROM l GROUP BY collection, meeting_key""", "v_pages").replace("\nWITH l AS", ", l AS", 1).replace("\n, l AS", ",\nl AS", 1))
def a6_manifest_paged(spark, sf):
    return report.manifest_paged(segment.number_pages(_assigned(spark, sf)), page_bytes=PAGE_BYTES)


_ATT_REC = ("CAST(to_json({'Category_1': Category_1, 'Category_2': Category_2, 'Name_1': Name_1, 'Name_2': Name_2, "
            "'Title/Role': \"Title/Role\"}) AS VARCHAR)")
_A1_PAGED_SQL = f"""
SELECT d AS "Date", page_no, CAST(min(no) - 1 AS BIGINT) AS n_before, CAST(count(*) AS BIGINT) AS n_values,
       '[' || string_agg(rec, ',' ORDER BY no) || ']' AS Attendees
FROM ({_paged_sql(f"SELECT * FROM (SELECT {_ATT_DATE} AS d, row_no, {_ATT_REC} AS rec FROM v_attendees) WHERE d IS NOT NULL", 'd', 'row_no', 'rec', PAGE_BYTES)})
GROUP BY d, page_no"""


@register("a1_attendees_paged", with_views(_A1_PAGED_SQL, "v_attendees"))
def a1_attendees_paged(spark, sf):
    return report.attendees_paged(V.v_attendees(spark, sf), page_bytes=PAGE_BYTES)


@register("j1_merge_report_paged", with_views(f"""
SELECT CAST(s."Date" AS DATE) AS "Date", s.PDF_File, s.Synopsis, s.Summary, s."Key Notes", coalesce(a.page_no, 0) AS page_no,
       coalesce(a.n_before, 0) AS n_before, coalesce(a.n_values, 0) AS n_values, a.Attendees
FROM v_summaries s LEFT JOIN ({_A1_PAGED_SQL}) a ON CAST(s."Date" AS DATE) = a."Date"
""", "v_summaries", "v_attendees"))
def j1_merge_report_paged(spark, sf):
    return report.merge_report_paged(V.v_summaries(spark, sf), V.v_attendees(spark, sf), PAGE_BYTES)


@register("j1_merge_report_long", with_views(f"""
SELECT CAST(s."Date" AS DATE) AS "Date", s.PDF_File, s.Synopsis, s.Summary, s."Key Notes", a.row_no, a.Category_1, a.Category_2,
       a.Name_1, a.Name_2, a."Title/Role"
FROM v_summaries s LEFT JOIN (SELECT {_ATT_DATE} AS d, * EXCLUDE ("Date") FROM v_attendees) a ON CAST(s."Date" AS DATE) = a.d
""", "v_summaries", "v_attendees"))
def j1_merge_report_long(spark, sf):
    return report.merge_report_long(V.v_summaries(spark, sf), V.v_attendees(spark, sf))


@register("a9_folder_stats", with_views(f"""
SELECT CAST(count(*) AS BIGINT) AS found, CAST(count_if(ok) AS BIGINT) AS successful,
       CAST(count_if(NOT ok) AS BIGINT) AS failed
FROM (SELECT collection, meeting_key, bool_or({Q.strip('text')} <> '') AS ok FROM ({_NUMBERED_SQL})
      WHERE meeting_key <> 'unassigned' GROUP BY collection, meeting_key)""", "v_pages"))
def a9_folder_stats(spark, sf):
    a = _assigned(spark, sf, _nb=T.strip("text") != "").where(F.col("meeting_key") != "unassigned")
    folders = a.groupBy("collection", "meeting_key").agg(F.bool_or("_nb").alias("ok"))
    out = folders.select(F.when(F.col("ok"), "successful").otherwise("failed").alias("status"))
    return report.run_stats(out, seconds=None, statuses=("successful", "failed"))


# ---------------------------------------------------------------- I1, ST1


_I1_SQL = f"""
SELECT w.file, {Q.recording_date('w.stem')} AS meeting_date, {Q.minutes('w.duration_s')} AS duration_min,
       {Q.word_count('t.transcript')} AS word_count
FROM (SELECT * FROM v_recordings WHERE kind = 'wav') w LEFT JOIN v_transcripts t ON w.stem = t.stem"""


@register("i1_recording_index", with_views(_I1_SQL, "v_recordings", "v_transcripts"))
def i1_recording_index(spark, sf):
    return report.recording_index(V.v_recordings(spark, sf), V.v_transcripts(spark, sf))


@register("st1_stream_index", with_views(_I1_SQL, "v_recordings", "v_transcripts"))
def st1_stream_index(spark, sf):
    run = scratch_path(spark, f"st1-{uuid.uuid4().hex}")
    wav = V.v_recordings(spark, sf).where("kind = 'wav'").select("file", "stem", "duration_s")
    rows = wav.join(V.v_transcripts(spark, sf), "stem", "left")
    where = [os.path.join(run, d) for d in ("in", "out", "ckpt")]
    rows.write.mode("overwrite").parquet(where[0])
    stream_index(spark, *where)
    # delivered again, and the stream begun again: every recording stays indexed once
    rows.write.mode("append").parquet(where[0])
    return stream_index(spark, *where)


# ------------------------------------------------------------------ Q1-Q10

def _fixed_sql(x: str, places: int) -> str:
    scale = 10 ** places
    n = f"CAST(floor(({x}) * {scale}) AS BIGINT)"
    return (f"((CASE WHEN {n} < 0 THEN '-' ELSE '' END) || CAST(abs({n}) // {scale} AS VARCHAR) || '.' || "
            f"lpad(CAST(abs({n}) % {scale} AS VARCHAR), {places}, '0'))")


_Q1_SQL = """
SELECT wav AS file, 'missing_' || k AS "check", stem AS detail
FROM (SELECT stem, max(CASE WHEN kind = 'wav' THEN file END) AS wav,
             count_if(kind = 'mp3') AS mp3, count_if(kind = 'transcript') AS transcript,
             count_if(kind = 'summary') AS summary
      FROM v_recordings GROUP BY stem) g,
     (SELECT unnest(['mp3', 'transcript', 'summary']) AS k) ks
WHERE wav IS NOT NULL AND CASE k WHEN 'mp3' THEN mp3 WHEN 'transcript' THEN transcript ELSE summary END = 0"""
_Q2_SQL = f"""
SELECT w.file, 'duration_mismatch' AS "check", {_fixed_sql('m.duration_s - w.duration_s', 3)} AS detail
FROM v_recordings w JOIN v_recordings m ON w.stem = m.stem AND w.kind = 'wav' AND m.kind = 'mp3'
WHERE abs(w.duration_s - m.duration_s) > 1.0"""
_Q3_SQL = """
SELECT file, 'unreadable' AS "check", kind AS detail FROM v_recordings
WHERE kind IN ('wav', 'mp3') AND (duration_s IS NULL OR duration_s <= 0)"""
_Q4_SQL = f"""
SELECT file, 'short_transcript' AS "check", {_fixed_sql('word_count / duration_min', 2)} AS detail
FROM ({_I1_SQL}) WHERE duration_min > 0 AND word_count / duration_min < 16"""
_Q8_SQL = f"""
SELECT path AS file, c AS "check", concat_ws(' / ', CAST(fd AS VARCHAR), CAST(td AS VARCHAR)) AS detail FROM (
  SELECT path, fd, td, CASE WHEN fd IS NULL THEN 'no_file_date' WHEN td IS NULL THEN 'no_text_date'
                            WHEN fd <> td THEN 'date_mismatch' END AS c
  FROM (SELECT path, {Q.file_date_key('name', 'parent')} AS fd, {Q.parse_date('upper(text)')} AS td FROM v_file_text))
WHERE c IS NOT NULL"""


def _recs(spark, sf):
    return V.v_recordings(spark, sf)


@register("q1_check_complete", with_views(_Q1_SQL, "v_recordings"))
def q1_check_complete(spark, sf):
    return qc.check_complete(_recs(spark, sf))


@register("q2_check_durations", with_views(_Q2_SQL, "v_recordings"))
def q2_check_durations(spark, sf):
    return qc.check_durations(_recs(spark, sf))


@register("q3_check_readable", with_views(_Q3_SQL, "v_recordings"))
def q3_check_readable(spark, sf):
    return qc.check_readable(_recs(spark, sf))


# The derived recordings run at about 16 words per minute (0.625 s per
# character), so the threshold is set there to give both outcomes.
@register("q4_check_short", with_views(_Q4_SQL, "v_recordings", "v_transcripts"))
def q4_check_short(spark, sf):
    return qc.check_short(report.recording_index(_recs(spark, sf), V.v_transcripts(spark, sf)), min_wpm=16)


_Q5_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS file, 'repeated_words' AS "check", CAST(n AS VARCHAR) AS detail FROM (
  SELECT doc_id, len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n
  FROM (SELECT doc_id, {Q.words('lower(text)')} AS w FROM v_texts)) WHERE n > 0"""


@register("q5_check_repeats", with_views(_Q5_SQL, "v_texts"))
def q5_check_repeats(spark, sf):
    return qc.check_repeats(V.v_texts(spark, sf))


_Q6_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS file, 'missing_terms' AS "check", CAST(n - found AS VARCHAR) || ' of ' || CAST(n AS VARCHAR) AS detail FROM (
  SELECT doc_id, (SELECT count(*) FROM v_terms) AS n, (SELECT count(*) FROM v_terms WHERE list_contains(w, term)) AS found
  FROM (SELECT doc_id, list_distinct(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS w
        FROM (SELECT doc_id, {Q.words('lower(text)')} AS w FROM v_texts))) WHERE n > found"""


@register("q6_check_terms", with_views(_Q6_SQL, "v_texts", "v_terms"))
def q6_check_terms(spark, sf):
    return qc.check_terms(V.v_texts(spark, sf), V.v_terms(spark, sf), listed=False)


_Q7_SQL = f"""
SELECT CAST(doc_id AS VARCHAR) AS file, 'unsupported_claims' AS "check", array_to_string(u, ';') AS detail FROM (
  SELECT doc_id, list_sort(list_distinct(list_filter(regexp_extract_all(lower(summary), '{qc.CLAIM}'),
           lambda x: NOT list_contains(known, x)))) AS u
  FROM (SELECT doc_id, summary, list_concat(regexp_extract_all(lower(transcript), '{qc.CLAIM}'),
               regexp_extract_all(lower(transcript), '{qc.NUMBER}')) AS known FROM v_support))
WHERE len(u) > 0"""


@register("q7_check_support", with_views(_Q7_SQL, "v_support"))
def q7_check_support(spark, sf):
    return qc.check_support(V.v_support(spark, sf))


_EVIDENCE_SQL = rf"""
WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(coalesce(transcript, '')), '{qc.TERM}')) AS held,
                  list_filter(list_transform(regexp_extract_all(summary, '{qc.SENTENCE}'),
                              lambda s: list_distinct(regexp_extract_all(lower(s), '{qc.TERM}'))), lambda w: len(w) > 0) AS said
           FROM v_altered),
n AS (SELECT count(*) AS n FROM t),
o AS (SELECT word, count(*) AS often FROM (SELECT unnest(held) AS word FROM t) GROUP BY word),
s AS (SELECT doc_id, held, unnest(said) AS ws, unnest(range(1, len(said) + 1)) AS no FROM t),
p AS (SELECT doc_id, no, word, list_contains(held, word) AS ok FROM (SELECT doc_id, no, held, unnest(ws) AS word FROM s)),
w AS (SELECT doc_id, no, ok, CAST(floor(1000 * ln((2.0::DOUBLE * n + 2) / (2 * coalesce(often, 0) + 1))) AS BIGINT) AS w
      FROM p CROSS JOIN n LEFT JOIN o USING (word)),
g AS (SELECT doc_id, no, coalesce(sum(w) FILTER (WHERE ok), 0) AS held, sum(w) AS w FROM w GROUP BY doc_id, no)
SELECT CAST(doc_id AS VARCHAR) AS file, 'weak_evidence' AS "check", CAST(no AS VARCHAR) || ': ' || CAST(100 * held // w AS VARCHAR) AS detail
FROM g WHERE 100 * held < 60 * w"""


@register("q7_check_evidence", with_views(f"SELECT * FROM ({_EVIDENCE_SQL})", "v_altered"))
def q7_check_evidence(spark, sf):
    """Q7 over the words of each sentence, on summaries with altered sentences."""
    return qc.check_evidence(V.v_altered(spark, sf))


@register("q8_check_dates", with_views(_Q8_SQL, "v_file_text"))
def q8_check_dates(spark, sf):
    return qc.check_dates(V.v_file_text(spark, sf))


_Q9_SQL = f"""
SELECT y.meeting AS file, 'name_missing' AS "check", r.name AS detail
FROM (SELECT meeting, {_YEAR} AS year, string_agg(coalesce(text, ''), chr(10)) AS body
      FROM v_parts GROUP BY meeting) y
JOIN v_roster r ON y.year IS NOT NULL AND contains(r.year_range, y.year) AND r.name IS NOT NULL
WHERE NOT contains(upper(y.body), upper(r.name))"""


@register("q9_check_names", with_views(_Q9_SQL, "v_parts", "v_roster"))
def q9_check_names(spark, sf):
    return _name_issues(spark, sf)


def _name_issues(spark, sf, listed=True):
    parts = V.v_parts(spark, sf)
    body = assemble.assemble_transcript(parts, None)
    body = body.withColumn("year", folder_year("meeting"))
    years = parts.select(folder_year("meeting").alias("year")).where("year IS NOT NULL").distinct()
    return qc.check_names(body, assemble.roster_for(years, V.v_roster(spark, sf)), by="year", listed=listed)


@register("q10_qc_report", with_views(f"""
SELECT u.file, CAST(coalesce(g.n, 0) AS BIGINT) AS n_issues, g.checks,
       CASE WHEN g.n IS NULL THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT file FROM v_recordings UNION SELECT path FROM v_files
      UNION SELECT CAST(doc_id AS VARCHAR) FROM v_texts UNION SELECT meeting FROM v_parts) u
LEFT JOIN (SELECT file, count(*) AS n, array_to_string(list_sort(list_distinct(list("check"))), ',') AS checks
           FROM ({_Q1_SQL} UNION ALL {_Q2_SQL} UNION ALL {_Q3_SQL} UNION ALL {_Q4_SQL} UNION ALL {_Q5_SQL}
                 UNION ALL {_Q6_SQL} UNION ALL {_Q7_SQL} UNION ALL {_Q8_SQL} UNION ALL {_Q9_SQL})
           GROUP BY file) g ON u.file = g.file""", "v_recordings", "v_transcripts", "v_files", "v_file_text", "v_texts",
                                         "v_terms", "v_support", "v_parts", "v_roster"))
def q10_qc_report(spark, sf):
    r = _recs(spark, sf)
    idx = report.recording_index(r, V.v_transcripts(spark, sf))
    texts = V.v_texts(spark, sf)
    issues = [qc.check_complete(r), qc.check_durations(r), qc.check_readable(r), qc.check_short(idx, min_wpm=16),
              qc.check_repeats(texts), qc.check_terms(texts, V.v_terms(spark, sf), listed=False), qc.check_support(V.v_support(spark, sf)),
              qc.check_dates(V.v_file_text(spark, sf)), _name_issues(spark, sf, listed=False)]
    files = (r.select("file").unionByName(V.v_files(spark, sf).select(F.col("path").alias("file")))
             .unionByName(texts.select(F.col("doc_id").cast("string").alias("file")))
             .unionByName(V.v_parts(spark, sf).select(F.col("meeting").alias("file"))))
    return qc.qc_report(issues, files)


# ------------------------------------------------------------ P7, P8, P9


@register("p7_recording_date", with_views(
    f"SELECT DISTINCT stem, {Q.recording_date('stem')} AS meeting_date FROM v_recordings", "v_recordings"))
def p7_recording_date(spark, sf):
    return V.v_recordings(spark, sf).select("stem").distinct().select(
        "stem", recording_date("stem").alias("meeting_date"))


@register("p8_folder_year", with_views(
    f"SELECT DISTINCT meeting, {Q.folder_year('meeting')} AS year FROM v_parts", "v_parts"))
def p8_folder_year(spark, sf):
    return V.v_parts(spark, sf).select("meeting").distinct().select("meeting", folder_year("meeting").alias("year"))


@register("p9_part_no", with_views(f"SELECT part_name, {Q.part_no('part_name')} AS part_no FROM v_parts", "v_parts"))
def p9_part_no(spark, sf):
    return V.v_parts(spark, sf).select("part_name", part_no("part_name").alias("part_no"))


# ------------------------------------- S4-S8: write, then read back with Spark


_J1_CSV_SCHEMA = TT.StructType([TT.StructField(c, TT.StringType()) for c in
                                ["Date", "PDF_File", "Synopsis", "Summary", "Key Notes", "Attendees"]])


@register("s5_write_csv", with_views(f"""
SELECT CAST(s."Date" AS VARCHAR) AS "Date", s.PDF_File, s.Synopsis, s.Summary, s."Key Notes", a.Attendees
FROM v_summaries s LEFT JOIN ({_A1_SQL}) a ON CAST(s."Date" AS DATE) = a."Date"
""", "v_summaries", "v_attendees"))
def s5_write_csv(spark, sf):
    """S5 then S4: the merged report as CSV (list as JSON), read back with a
    declared schema."""
    path = scratch_path(spark, f"s5-{uuid.uuid4().hex}")
    io.write_csv(report.merge_report(V.v_summaries(spark, sf), V.v_attendees(spark, sf), as_json=False), path)
    return io.read_table(spark, path, _J1_CSV_SCHEMA)


@register("s6_append_index", with_views(_I1_SQL, "v_recordings", "v_transcripts"))
def s6_append_index(spark, sf):
    """The index appended twice; the second run adds nothing."""
    path = scratch_path(spark, f"s6-{uuid.uuid4().hex}")
    idx = report.recording_index(V.v_recordings(spark, sf), V.v_transcripts(spark, sf))
    io.append_index(idx, path)
    io.append_index(idx, path)
    return io.read_index(spark, path)


_S7_STEPS = {
    "s7_t": _A3_SQL,
    "v_texts": "SELECT meeting AS doc_id, transcript AS text FROM s7_t",
    "plan": _u2_sql(500, 400), **_STAGED_STEPS,
    "replies": "SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3",
    "kinds": f"""
SELECT doc_id, doc_kind, {Q.strip('content')} AS body FROM (
  SELECT *, CASE WHEN stage = 'outline' THEN 'outline' WHEN stage = 'fuse' THEN 'summary'
                 WHEN stage = 'summary' AND doc_id NOT IN (SELECT doc_id FROM plan WHERE stage = 'fuse') THEN 'summary' END AS doc_kind
  FROM replies WHERE content IS NOT NULL) WHERE doc_kind IS NOT NULL
UNION ALL SELECT doc_id, 'transcript', text FROM v_texts"""}


WIDE_BYTES = 1 << 15


@register("s7_write_documents", with_views("""
SELECT doc_id AS meeting, doc_kind, CAST(NULL AS INTEGER) AS idx,
       '# ' || upper(left(doc_kind, 1)) || substr(doc_kind, 2) || chr(10) || chr(10) || body AS markdown FROM kinds
UNION ALL
SELECT doc_id, 'decision', 0, json_extract_string(content, '$[0].motion') || ' | ' || json_extract_string(content, '$[0].result') || ' | '
       || coalesce(json_extract_string(content, '$[0].yes'), '') || ' | ' || coalesce(json_extract_string(content, '$[0].no'), '')
FROM replies WHERE stage = 'decisions' AND content LIKE '[{%'""", "v_parts", "v_roster", extra=_S7_STEPS))
def s7_write_documents(spark, sf):
    """The strict run's outputs: transcript, summary and outline of all meetings in one table, and the
    decisions table; both read back."""
    checkpoint_dir(spark)
    path = scratch_path(spark, f"s7-{uuid.uuid4().hex}")
    t = stored(assemble.assemble_transcript(V.v_parts(spark, sf), V.v_roster(spark, sf)), "s7-transcripts", WIDE_ROWS)
    plan = stored(model.plan_stages(t, doc="meeting", text="transcript", whole_below=500, max_tokens=400), "s7-plan", WIDE_ROWS)
    replies = model.run_stages(plan, lambda req, keys: _run_stub(req, keys, retry=False), doc="meeting")
    io.write_documents(model.meeting_documents(t, plan, replies, doc="meeting", text="transcript"), f"{path}/documents", even=("transcript",))
    io.write_decisions(parse.parse_decisions(replies.where("stage = 'decisions'"), doc="meeting"), f"{path}/decisions", doc="meeting")
    written = spark.read.parquet(f"{path}/documents").select(
        "meeting", F.col("doc_kind").cast("string"), F.lit(None).cast("int").alias("idx"), "markdown")
    # Parquet's writer expects rows like those before: wide ones, which a task reads after many short ones, would fill its memory
    transcripts, wide = written.where("doc_kind = 'transcript'"), F.coalesce(F.octet_length("markdown") > WIDE_BYTES, F.lit(False))
    docs = transcripts.where(wide).unionByName(transcripts.where(~wide)).unionByName(written.where("doc_kind <> 'transcript'"))
    votes = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("motion", "result", "yes", "no")]
    decided = spark.read.parquet(f"{path}/decisions").select("meeting", F.lit("decision").alias("doc_kind"), "idx", F.concat_ws(" | ", *votes).alias("markdown"))
    return docs.unionByName(decided)


@register("s8_write_by_meeting", with_views(
    "SELECT collection, path, page_name, meeting_key FROM (" + _W1_SQL + ")", "v_pages"))
def s8_write_by_meeting(spark, sf):
    path = scratch_path(spark, f"s8-{uuid.uuid4().hex}")
    a = _assigned(spark, sf).select("collection", "path", "page_name", "meeting_key")
    io.write_by_meeting(a, path)
    back = spark.read.option("basePath", path).schema(
        "collection string, path string, page_name string, meeting_key string").parquet(path)
    return back.select("collection", "path", "page_name", "meeting_key")


@register("j2_roster_for_range", with_views(f"""
SELECT y.meeting, y.year, r.name, r.year_range, r.row_no
FROM (SELECT DISTINCT meeting, {_YEAR} AS year FROM v_parts) y
LEFT JOIN (SELECT *, CAST(split_part(year_range, '-', 1) AS INTEGER) AS lo,
                  CAST(split_part(year_range, '-', 2) AS INTEGER) AS hi
           FROM v_roster WHERE regexp_matches(year_range, '^[0-9]{{4}}-[0-9]{{4}}$')) r
  ON TRY_CAST(y.year AS INTEGER) BETWEEN r.lo AND r.hi AND CAST(TRY_CAST(y.year AS INTEGER) AS VARCHAR) = y.year""",
                                            "v_parts", "v_roster"))
def j2_roster_for_range(spark, sf):
    """J2 with ``mode="range"``: every year between the two ends matches."""
    m = V.v_parts(spark, sf).select("meeting").distinct().select("meeting", folder_year("meeting").alias("year"))
    return assemble.roster_for(m, V.v_roster(spark, sf), mode="range").select(
        "meeting", "year", "name", "year_range", "row_no")
