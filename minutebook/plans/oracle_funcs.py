"""SQL text (DuckDB dialect) for the column functions, used by the oracle."""
from __future__ import annotations

from ..functions.patterns import (DATE_PATTERNS, KEPT_PUNCTUATION, MONTHS, OCR_FIXES, START_PHRASES,
                                  WS_RE2 as WS, WS_CLASS_RE2 as WS_CLASS, NON_WS_CLASS_RE2 as NON_WS_CLASS,
                                  MARKER_LENGTH, MARKER_LONGER, MAX_CHARS,
                                  MAX_PROMPT_CHARS)
from ..functions.regex import re2


def lit(s: str) -> str:
    """SQL string literal; newlines and tabs through chr()."""
    parts = []
    buf = ""
    for ch in s:
        if ch in "\n\t\r":
            if buf:
                parts.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append("'" + buf.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def iso(s: str) -> str:
    return f"CAST(try_strptime({s}, '%Y-%m-%d') AS DATE)"


def _month(g: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MONTHS.items())
    return f"(CASE {g} {whens} END)"


def _valid(y: str, m: str, d: str) -> str:
    ds = f"{y} || '-' || lpad(CAST({m} AS VARCHAR), 2, '0') || '-' || lpad({d}, 2, '0')"
    return (f"(CASE WHEN TRY_CAST({y} AS INTEGER) BETWEEN 1900 AND 2100 AND length({d}) > 0 "
            f"THEN {iso(ds)} END)")


def date_from_pattern(t: str, i: int) -> str:
    p = re2(DATE_PATTERNS[i]).replace("'", "''")
    g = [f"regexp_extract({t}, '{p}', {k})" for k in (1, 2, 3)]
    if i in (0, 2, 6, 7):
        return _valid(g[2], _month(g[0]), g[1])
    if i == 4:
        m = f"(CASE WHEN TRY_CAST({g[0]} AS INTEGER) BETWEEN 1 AND 12 THEN TRY_CAST({g[0]} AS INTEGER) END)"
        return _valid(g[2], m, g[1])
    raise ValueError(i)


def parse_date(t: str) -> str:
    return "coalesce(" + ", ".join(date_from_pattern(t, i) for i in (0, 2, 4, 6, 7)) + ")"


def phrase_hits(t: str, phrases=START_PHRASES) -> str:
    return "(" + " + ".join(f"CAST(contains({t}, {lit(p)}) AS INTEGER)" for p in phrases) + ")"


def is_start(t: str, d: str) -> str:
    h = phrase_hits(t)
    return f"({h} >= 2 OR ({h} >= 1 AND {d} IS NOT NULL))"


def strip(t: str) -> str:
    return f"regexp_replace({t}, '^{WS_CLASS}+|{WS_CLASS}+\\z', '', 'g')"


def clean_text(t: str) -> str:
    x = f"regexp_replace({t}, '\\n{WS_CLASS}*\\n{WS_CLASS}*\\n', chr(10) || chr(10), 'g')"
    x = f"regexp_replace({x}, '[ \\t]+', ' ', 'g')"
    kept = KEPT_PUNCTUATION.replace("'", "''")
    x = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_{WS}{kept}]', ' ', 'g')"
    for a, b in OCR_FIXES:
        x = f"replace({x}, {lit(a)}, {lit(b)})"
    return strip(x)


def truncate(t: str, n: int, marker: str) -> str:
    return f"(CASE WHEN length({t}) > {n} THEN left({t}, {n}) || {lit(marker)} ELSE {t} END)"


def truncate_for_prompt(t: str) -> str:
    return truncate(truncate(t, MAX_CHARS, MARKER_LENGTH), MAX_PROMPT_CHARS, MARKER_LONGER)


def words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '{WS_CLASS}+'), lambda x: x <> '')"


def word_count(t: str) -> str:
    return f"CAST(len({words(t)}) AS BIGINT)"


TOKEN_PATTERN = f"{WS_CLASS}*{NON_WS_CLASS}+|{WS_CLASS}+\\z"


def tokens(t: str) -> str:
    return f"regexp_extract_all({t}, '{TOKEN_PATTERN}')"


def token_count(t: str) -> str:
    return f"CAST(len({tokens(t)}) AS BIGINT)"


def meeting_key(d: str) -> str:
    return f"coalesce(strftime({d}, '%Y-%m-%d'), 'unassigned')"


def file_date_key(name: str, parent: str) -> str:
    dash = f"regexp_extract({name}, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1)"
    under = f"regexp_extract({name}, '([0-9]{{4}}_[0-9]{{2}}_[0-9]{{2}})', 1)"
    return (f"coalesce(CASE WHEN {dash} <> '' THEN {iso(dash)} END, "
            f"CASE WHEN {under} <> '' THEN {iso(f'replace({under}, {lit("_")}, {lit("-")})')} END, "
            f"CASE WHEN regexp_matches({parent}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN {iso(parent)} END)")


def recording_date(stem: str) -> str:
    first = (f"list_filter(list_transform(string_split({stem}, '_'), lambda t: CASE WHEN length(t) = 10 "
             f"AND substr(t, 5, 1) = '-' AND substr(t, 8, 1) = '-' THEN {iso('t')} END), lambda d: d IS NOT NULL)[1]")
    return f"coalesce(strftime({first}, '%B %d, %Y'), 'an unknown date')"


def folder_year(folder: str) -> str:
    toks = f"string_split({folder}, '_')"
    return f"(CASE WHEN len({toks}) = 4 THEN nullif(string_split({toks}[3], '-')[1], '') END)"


def part_no(name: str) -> str:
    d = f"regexp_extract({name}, '(?i)_part_([0-9]+)', 1)"
    return f"coalesce(TRY_CAST(nullif({d}, '') AS BIGINT), 0)"


def minutes(sec: str) -> str:
    return f"round_even({sec} / 60.0, 2)"
