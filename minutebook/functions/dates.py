"""Date columns: find a date in page text, file-name and recording dates.

All functions take and return ``Column`` objects built from Spark's own
expressions (regexp_extract, try_to_date, ...) so they stay inside
whole-stage code generation.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import DATE_PATTERNS, MONTHS, UNASSIGNED
from .regex import java

# Patterns that can yield a date on upper-cased text: 1 and 3 need lower-case
# month letters that the month table does not hold, 5 reads the year as month.
_NAMED_MONTH_FIRST = (0, 2, 6, 7)
_NUMERIC_MONTH_FIRST = (4,)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _iso(s: Column) -> Column:
    return F.try_to_date(s, "yyyy-MM-dd")


_BUILT: dict = {}


def _once(key, build):
    """A Column that depends only on column names, built once per JVM.

    Column expressions are immutable and unresolved, so one object can serve
    every DataFrame; this saves the driver a few hundred gateway calls per
    query (the big date expressions), which matters for short queries.
    """
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    k = (id(sc._jsc) if sc is not None else None, key)
    if k not in _BUILT:
        _BUILT[k] = build()
    return _BUILT[k]


def _month_map() -> Column:
    def build():
        items = []
        for k, v in MONTHS.items():
            items += [F.lit(k), F.lit(v)]
        return F.create_map(*items)
    return _once(("month_map",), build)


def _valid_date(y: Column, m: Column, d: Column) -> Column:
    """Year 1900-2100 and a real calendar date, else null."""
    yi = y.try_cast("int")
    ds = F.concat_ws("-", y, F.lpad(m.cast("string"), 2, "0"), F.lpad(d, 2, "0"))
    return F.when(yi.between(1900, 2100) & (F.length(d) > 0), _iso(ds))


def _date_from_whole(whole: Column, i: int) -> Column:
    """Date from the whole first match of pattern ``i`` (null if invalid).

    The groups are read from the short match with the anchored pattern: same
    engine, same backtracking order, so the same groups as on the full text.
    """
    p = java(DATE_PATTERNS[i])
    anchored = "^" + p if not p.startswith("(?d)") else "(?d)^" + p[4:]
    g1, g2, g3 = (F.regexp_extract(whole, anchored, k) for k in (1, 2, 3))
    if i in _NAMED_MONTH_FIRST:
        return _valid_date(g3, F.try_element_at(_month_map(), g1), g2)
    if i in _NUMERIC_MONTH_FIRST:
        mi = g1.try_cast("int")
        return _valid_date(g3, F.when(mi.between(1, 12), mi), g2)
    if i == 5:  # year first; only used when iso=True
        mi = g2.try_cast("int")
        return _valid_date(g1, F.when(mi.between(1, 12), mi), g3)
    raise ValueError(f"pattern {i} never yields a date")


def date_from_pattern(text, i: int) -> Column:
    """Date from the first match of pattern ``i`` only (null if invalid)."""
    whole = F.regexp_extract(_col(text), java(DATE_PATTERNS[i]), 0)
    return F.when(whole != "", _date_from_whole(whole, i))


def _order(iso: bool) -> list[int]:
    return [0, 2, 4] + ([5] if iso else []) + [6, 7]


def parse_date(text, iso: bool = False) -> Column:
    """First valid date of patterns 0-7 in order (each: first match only).

    ``text`` should already be upper-cased (``upper_text``).  With
    ``iso=True`` year-first dates (pattern 5) are read as such.
    """
    return F.coalesce(*[date_from_pattern(text, i) for i in _order(iso)])


def meeting_key(d) -> Column:
    """``YYYY-MM-DD`` folder key, or ``unassigned`` for a null date."""
    return F.coalesce(F.date_format(_col(d), "yyyy-MM-dd"), F.lit(UNASSIGNED))


def file_date_key(name, parent) -> Column:
    """Date key of a PDF: ``yyyy-mm-dd`` then ``yyyy_mm_dd`` in the name
    (first match of each, must be a real date), else a parent folder named
    exactly like a date, else null."""
    n, p = _col(name), _col(parent)
    dash = F.regexp_extract(n, "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    under = F.regexp_extract(n, "([0-9]{4}_[0-9]{2}_[0-9]{2})", 1)
    from_parent = F.when(p.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), _iso(p))
    return F.coalesce(
        F.when(dash != "", _iso(dash)),
        F.when(under != "", _iso(F.translate(under, "_", "-"))),
        from_parent,
    )


def recording_date(stem) -> Column:
    """``June 05, 1975`` from the first ``_``-token shaped ``NNNN-NN-NN`` that
    is a real date; ``an unknown date`` otherwise."""
    toks = F.split(_col(stem), "_")
    dates = F.filter(
        F.transform(toks, lambda t: F.when(
            (F.length(t) == 10) & (F.substring(t, 5, 1) == "-") & (F.substring(t, 8, 1) == "-"),
            _iso(t))),
        lambda d: d.isNotNull())
    first = F.try_element_at(dates, F.lit(1))
    return F.coalesce(F.date_format(first, "MMMM dd, yyyy"), F.lit("an unknown date"))


def folder_year(folder) -> Column:
    """Year of a meeting folder ``a_b_<date>_c``: exactly four ``_`` tokens,
    the text of the third before its first ``-``; null otherwise (and for an
    empty year, which would match every roster row)."""
    toks = F.split(_col(folder), "_")
    third = F.try_element_at(toks, F.lit(3))
    year = F.try_element_at(F.split(third, "-"), F.lit(1))
    return F.when(F.size(toks) == 4, F.nullif(year, F.lit("")))


def part_no(name) -> Column:
    """Part number from ``_part_<n>`` (any case), 0 when absent."""
    digits = F.regexp_extract(_col(name), "(?i)_part_([0-9]+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


# Necessary conditions for a pattern to match at all: cheap substring tests
# that let most texts skip the regex scan.  Every date needs a 4-digit year.
_GUARDS = {
    0: ("MEETING",),
    2: (),
    4: ("/",),
    5: ("-",),
    6: ("MEETING",),
    7: ("BOARD", "EDUCATION"),
}

# Spark-side forms of the same patterns that scan faster and match exactly
# the same text: pattern 2 may only start where a letter run starts (a match
# starting inside a run implies one starting at the run's first letter, which
# is further left), and its runs cannot give back characters (the next token
# could never match them), so they are possessive.
_FAST = {
    2: "(?<![A-Z])([A-Z]++)" + "[WS]++([0-9]{1,2}+),?[WS]++([0-9]{4})",
}


def _scan_pattern(i: int) -> str:
    if i in _FAST:
        from .patterns import WS
        return _FAST[i].replace("[WS]", "[" + WS + "]")
    return java(DATE_PATTERNS[i])


def with_page_date(df, text, out: str = "page_date", iso: bool = False):
    """``parse_date`` as a DataFrame step, for large texts.

    Same result as ``parse_date(text)``.  Each pattern's whole first match is
    computed once, in its own column, and only when the pattern's cheap
    necessary condition holds (a 4-digit year; MEETING, BOARD + EDUCATION or
    ``/`` present); the three groups are then read from that short match.
    The pattern columns do not refer to each other, so if a later filter on
    the date is pushed down by the optimizer, the inlined expression grows
    linearly (a chain of "only if no date yet" steps would grow
    exponentially).
    """
    t = _col(text)
    d = df.withColumn("_has_year", t.rlike("[0-9]{4}"))
    wcols = []
    for i in _order(iso):
        guard = F.col("_has_year")
        for s_ in _GUARDS[i]:
            guard = guard & (F.instr(t, s_) > 0)
        d = d.withColumn(f"_w{i}", F.when(guard, F.regexp_extract(t, _scan_pattern(i), 0)))
        wcols.append(f"_w{i}")
    dates = [_once(("page_date", i), lambda i=i: F.when(F.col(f"_w{i}") != "", _date_from_whole(F.col(f"_w{i}"), i)))
             for i in _order(iso)]
    return d.withColumn(out, F.coalesce(*dates)).drop("_has_year", *wcols)
