"""The derived views of ``views.py`` written for DuckDB (the oracle).

Each entry is a SELECT over the driver tables (registered as views of the
same names by the checker).  ``with_views`` prepends the ones a query uses.
"""
from __future__ import annotations

from .oracle_funcs import words

D = "(DATE '1970-01-01' + CAST({x} AS INTEGER))"


def day(x: str) -> str:
    return D.format(x=x)


def long_date(d: str) -> str:
    return f"upper(strftime({d}, '%B %-d, %Y'))"


PAGE_NAME = "printf('%08d', doc_id) || '.jpg'"

VIEWS: dict[str, str] = {}

VIEWS["v_pages"] = f"""
SELECT source AS collection, source || '/' || {PAGE_NAME} AS path, {PAGE_NAME} AS page_name,
       concat_ws(chr(10), CASE (doc_id // 20 + 1) % 8
           WHEN 0 THEN 'MEETING OF ' || {long_date(day('(doc_id % 47000)'))}
           WHEN 2 THEN 'THE BOARD OF EDUCATION'
           WHEN 3 THEN {long_date(day('(doc_id % 47000)'))}
           WHEN 4 THEN 'BOARD OF EDUCATION 3/14/1972'
           WHEN 5 THEN 'ROOM 12, 1234 BOARD OF EDUCATION MEETING HELD ' || {long_date(day('(doc_id % 47000)'))}
           WHEN 6 THEN 'MEETING OF FEBRUARY 30, 1971'
           WHEN 7 THEN 'OKLAHOMA CITY 1971-01-05' END, text) AS text,
       doc_id AS page_no
FROM documents"""

VIEWS["v_candidates"] = f"""
SELECT source || '/' || {PAGE_NAME} AS path, r AS config_rank,
       CASE WHEN doc_id % 11 = 0 AND r % 2 = 0 THEN ' ' || chr(10) WHEN (doc_id + r) % 3 = 1 THEN replace(text, ' the ', ' ')
            WHEN (doc_id + r) % 3 = 2 THEN replace(text, '. ', '.  ') ELSE text END AS text
FROM documents, (SELECT unnest([0, 1, 2, 3]) AS r) ranks"""

_d3 = day("page_id // 3")
VIEWS["v_files"] = f"""
SELECT page_id, 'archive/' || parent || '/' || name AS path, 'archive/' || parent AS dir, parent, name
FROM (
  SELECT page_id,
    (CASE WHEN page_id % 9 = 4 THEN 'temp_' ELSE '' END)
    || (CASE WHEN page_id % 7 = 0 OR page_id % 5 = 0 THEN 'scan_' || CAST(page_id % 50 AS VARCHAR)
        ELSE strftime({_d3}, '%Y') || sep
             || (CASE WHEN page_id % 13 = 0 THEN '13' ELSE strftime({_d3}, '%m') END)
             || sep || strftime({_d3}, '%d') || '_meeting_minutes' END)
    || (CASE WHEN page_id % 11 = 6 THEN '.backup' WHEN page_id % 4 = 0 THEN '_ocr'
             WHEN page_id % 4 = 1 THEN '_OCR' WHEN page_id % 4 = 2 THEN '' ELSE '_backup' END)
    || '.pdf' AS name,
    CASE WHEN page_id % 7 <> 0 AND page_id % 5 = 0 THEN strftime({_d3}, '%Y-%m-%d')
         ELSE 'box' || CAST(page_id % 10 AS VARCHAR) END AS parent
  FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '-' ELSE '_' END AS sep FROM pages)
)"""

_d3s = day("p.page_id // 3 + CASE WHEN p.page_id % 6 = 1 THEN 1 ELSE 0 END")
VIEWS["v_file_text"] = f"""
SELECT f.path, f.parent, f.name,
       concat_ws(chr(10), CASE WHEN p.page_id % 8 <> 7 THEN 'MEETING OF ' || {long_date(_d3s)} END, p.html) AS text
FROM v_files f JOIN pages p ON f.page_id = p.page_id"""

VIEWS["v_pdf_pages"] = """
SELECT 'conv/' || CAST(conv_id AS VARCHAR) || '.pdf' AS path, CAST(turn + 1 AS INTEGER) AS page_no,
       CASE WHEN (conv_id + turn) % 9 = 0 THEN '  ' ELSE text END AS text
FROM conversations"""

VIEWS["v_dirty"] = """
SELECT doc_id,
       replace(CASE WHEN doc_id % 2 = 0
                    THEN replace(replace(text, '. ', '.' || chr(10) || ' ' || chr(10) || chr(10)), ' the ', ' tho ')
                    ELSE replace(text, '. ', '.' || chr(10) || ' ' || chr(10) || chr(10)) END,
               ',', ',  ' || chr(9)) AS text
FROM documents"""

VIEWS["v_attendees"] = """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'n/a'
            WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%m/%d/%Y')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Date",
       c_mktsegment AS Category_1, o_orderpriority AS Category_2, c_name AS Name_1,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Clerk#' || CAST(o_custkey AS VARCHAR) END AS Name_2,
       n_name AS "Title/Role", o_orderkey AS row_no
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["v_summaries"] = """
SELECT strftime(d, '%Y-%m-%d') AS "Date",
       strftime(d, '%Y-%m-%d') || '_meeting_minutes_ocr.pdf' AS PDF_File,
       'Synopsis of the meeting on ' || strftime(d, '%Y-%m-%d') AS Synopsis,
       'Summary of the meeting on ' || strftime(d, '%Y-%m-%d') AS Summary,
       'Key notes of ' || strftime(d, '%Y-%m-%d') AS "Key Notes"
FROM (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
  UNION
  SELECT CAST(CAST(o_orderdate AS DATE) - INTERVAL 10 YEAR AS DATE) FROM orders
)"""

_meeting = ("'boe_meeting_' || strftime(" + day("(conv_id * 37 % 12000)") + ", '%Y-%m-%d') || "
            "CASE WHEN conv_id % 6 = 0 THEN '_x_y' ELSE '_x' END || CAST(conv_id // 12000 AS VARCHAR)")
VIEWS["v_parts"] = f"""
SELECT {_meeting} AS meeting,
       {_meeting} || CASE WHEN (conv_id + turn) % 7 = 3 THEN '_PART_' ELSE '_part_' END
           || printf('%03d', turn) AS part_name,
       text
FROM conversations"""

VIEWS["v_roster"] = """
SELECT s_name AS name,
       CAST(1970 + s_suppkey % 30 AS VARCHAR) || '-' || CAST(1970 + s_suppkey % 30 + 4 AS VARCHAR) AS year_range,
       s_suppkey AS row_no
FROM supplier"""

_stem = ("CASE WHEN conv_id % 4 = 0 THEN 'boe_' || strftime(" + day("(conv_id * 37 % 12000)") + ", '%Y%m%d') || '_' || "
         "CAST(conv_id AS VARCHAR) ELSE 'boe_' || strftime(" + day("(conv_id * 37 % 12000)") + ", '%Y-%m-%d') || '_' || "
         "CAST(conv_id AS VARCHAR) END")
VIEWS["v_recordings"] = f"""
SELECT stem || ext AS file, stem, kind, duration_s FROM (
  SELECT conv_id, {_stem} AS stem, base FROM (
    SELECT conv_id, sum(length(text)) * 0.625 AS base FROM conversations GROUP BY conv_id)
) r, LATERAL (
  SELECT 'wav' AS kind, '.wav' AS ext, conv_id % 13 <> 5 AS keep,
         CASE WHEN conv_id % 17 = 0 THEN 0.0 ELSE base END::DOUBLE AS duration_s
  UNION ALL SELECT 'mp3', '.mp3', conv_id % 5 <> 1, (base + CASE WHEN conv_id % 10 = 0 THEN 5.0 ELSE 0.0 END)::DOUBLE
  UNION ALL SELECT 'transcript', '.txt', conv_id % 7 <> 2, NULL::DOUBLE
  UNION ALL SELECT 'summary', '.summary.txt', conv_id % 11 <> 3, NULL::DOUBLE
) k
WHERE keep"""

VIEWS["v_transcripts"] = f"""
SELECT {_stem} AS stem, string_agg(text, chr(10) ORDER BY turn) AS transcript
FROM conversations GROUP BY conv_id"""

VIEWS["v_texts"] = "SELECT doc_id, text FROM documents"

VIEWS["v_support"] = """
SELECT doc_id, text || CASE WHEN doc_id % 2 = 1 THEN ' 98765' ELSE '' END
              || CASE WHEN doc_id % 3 = 0 THEN ' $1,250.50 on June 12, 1875' ELSE '' END AS summary,
       text AS transcript
FROM documents"""

VIEWS["v_altered"] = r"""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[^.!?\n]+'), lambda s, i:
         CASE WHEN (doc_id + i - 1) % 3 = 0 THEN translate(s, 'aeiou', 'eioua') ELSE s END), '. ') AS summary,
       text AS transcript
FROM documents"""

VIEWS["v_responses"] = """
SELECT doc, concat_ws(chr(10),
         pre1 || 'Synopsis: ' || coalesce(lines[1], ''),
         pre2 || CASE WHEN doc % 8 = 0 THEN '' ELSE '**Summary** ' END || coalesce(lines[2], ''),
         pre3 || 'Key Notes: ' || coalesce(lines[3], ''),
         CASE WHEN len(lines) > 3 THEN array_to_string(lines[4:], chr(10)) END) AS content
FROM (SELECT doc_id AS doc, string_split(text, chr(10)) AS lines,
             CASE WHEN doc_id % 6 = 0 THEN '1. ' ELSE '' END AS pre1,
             CASE WHEN doc_id % 6 = 0 THEN '2. ' ELSE '' END AS pre2,
             CASE WHEN doc_id % 6 = 0 THEN '3. ' ELSE '' END AS pre3
      FROM documents)"""

VIEWS["v_decisions"] = """
SELECT 'o' || CAST(l_orderkey AS VARCHAR) AS doc,
       CASE WHEN l_orderkey % 7 = 0 THEN CAST(to_json(recs[1]) AS VARCHAR)
            WHEN l_orderkey % 11 = 0
              THEN left(CAST(to_json(recs) AS VARCHAR), length(CAST(to_json(recs) AS VARCHAR)) - 1) || '}'
            ELSE CAST(to_json(recs) AS VARCHAR) END AS content
FROM (SELECT l_orderkey,
             list({'motion': l_returnflag, 'result': l_linestatus, 'yes': CAST(l_linenumber AS INTEGER),
                   'no': CAST(NULL AS INTEGER)} ORDER BY l_linenumber, l_returnflag, l_linestatus) AS recs
      FROM lineitem GROUP BY l_orderkey)
UNION ALL
SELECT 'e' || CAST(event_id AS VARCHAR), props FROM events"""

VIEWS["v_terms"] = f"""
SELECT DISTINCT unnest(w || CASE WHEN len(w) >= 2 THEN [w[1] || ' ' || w[2]] ELSE [] END) AS term
FROM (SELECT {words('lower(text)')} AS w FROM benchmark)"""

DEPENDS = {"v_file_text": ["v_files"]}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding the named views (and what they need), then
    ``extra`` materialized steps of the query itself."""
    order: list[str] = []
    for n in names:
        for dep in DEPENDS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in order]
    ctes += [f"{n} AS MATERIALIZED ({q})" for n, q in (extra or {}).items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body
