"""Translate the Python-dialect patterns into the shared Java/RE2 subset.

``\\s`` becomes Python's whitespace set, ``\\d`` becomes ``[0-9]`` and ``.``
stops only at ``\\n`` (Java needs the UNIX_LINES flag for that).
"""
from __future__ import annotations

from .patterns import NON_WS_CLASS, NON_WS_CLASS_RE2, WS, WS_CLASS, WS_CLASS_RE2, WS_RE2


def portable(pattern: str, ws: str = WS, ws_class: str = WS_CLASS, non_ws_class: str = NON_WS_CLASS) -> str:
    """Pattern with explicit classes, valid in both Java regex and RE2."""
    out = []
    i = 0
    in_class = False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt == "s":
                out.append(ws if in_class else ws_class)
            elif nxt == "S":
                out.append(non_ws_class)
            elif nxt == "d":
                out.append("0-9" if in_class else "[0-9]")
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def java(pattern: str) -> str:
    """Spark (java.util.regex) form of a Python-dialect pattern."""
    p = portable(pattern)
    return "(?d)" + p if "." in pattern.replace("\\.", "") else p


def re2(pattern: str) -> str:
    """DuckDB (RE2) form of a Python-dialect pattern."""
    return portable(pattern, WS_RE2, WS_CLASS_RE2, NON_WS_CLASS_RE2)
