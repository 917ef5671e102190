"""A deterministic stand-in for the language-model service, so the model
edge can run (and be checked) without a network.

The reply depends only on the request: a context-length error above
``LIMIT`` characters, a service error when the length is a multiple of 97,
else three sections giving the request length and its word count, or for a
decisions request a JSON list: one record, or none where the length is a
multiple of 3.  The same rule is written in SQL (``sql_*``) for the oracle.
"""
from __future__ import annotations

from ..functions.templates import STRICT_DECISIONS
from . import oracle_funcs as Q

LIMIT = 8200


def make_stub_client():
    def call(prompt: str, user: str | None, **settings) -> str:
        full = prompt + (user or "")
        n = len(full)
        if n > LIMIT:
            raise RuntimeError(f"context_length_exceeded: {n}")
        if n % 97 == 0:
            raise RuntimeError("service unavailable")
        body = user if user is not None else prompt
        if prompt == STRICT_DECISIONS:
            record = f'{{"motion": "request of {n} characters", "result": "{len(body.split())} words", "yes": {n % 10}, "no": null}}'
            return f"[{record}]" if n % 3 else "[]"
        return (f"Synopsis: request of {n} characters\n**Summary** {len(body.split())} words\n"
                "Key Notes: none")
    return call


def sql_reply(full: str, body: str, prompt: str | None = None) -> str:
    if prompt is not None:
        n, w = f"CAST(length({full}) AS VARCHAR)", f"CAST({Q.word_count(body)} AS VARCHAR)"
        record = (f"'[{{\"motion\": \"request of ' || {n} || ' characters\", \"result\": \"' || {w} || ' words\", \"yes\": ' || "
                  f"CAST(length({full}) % 10 AS VARCHAR) || ', \"no\": null}}]'")
        return (f"CASE WHEN {prompt} = {Q.lit(STRICT_DECISIONS)} THEN CASE WHEN length({full}) % 3 = 0 THEN '[]' ELSE {record} END "
                f"ELSE {sql_reply(full, body)} END")
    return ("'Synopsis: request of ' || CAST(length(" + full + ") AS VARCHAR) || ' characters' || chr(10) || "
            "'**Summary** ' || CAST(" + Q.word_count(body) + " AS VARCHAR) || ' words' || chr(10) || "
            "'Key Notes: none'")


def sql_call(prompt: str, user: str | None, source: str, retry: str | None) -> str:
    """(status, content, error) columns of run_model for one request."""
    full = prompt if user is None else f"({prompt} || {user})"
    body = prompt if user is None else user
    n = f"length({full})"
    blank = f"{Q.strip(f'coalesce({source}, {chr(39) * 2})')} = ''"
    if retry is not None:
        nr = f"length({retry})"
        ctx_status = f"CASE WHEN {nr} > {LIMIT} OR {nr} % 97 = 0 THEN 'too_long' ELSE 'shortened' END"
        ctx_content = f"CASE WHEN {nr} > {LIMIT} OR {nr} % 97 = 0 THEN NULL ELSE {sql_reply(retry, retry)} END"
        ctx_error = (f"CASE WHEN {nr} > {LIMIT} THEN 'context_length_exceeded: ' || CAST({nr} AS VARCHAR) "
                     f"WHEN {nr} % 97 = 0 THEN 'service unavailable' END")
    else:
        ctx_status, ctx_content = "'error'", "NULL"
        ctx_error = f"'context_length_exceeded: ' || CAST({n} AS VARCHAR)"
    status = (f"CASE WHEN {blank} THEN 'blank' WHEN {n} > {LIMIT} THEN {ctx_status} "
              f"WHEN {n} % 97 = 0 THEN 'error' ELSE 'ok' END")
    content = (f"CASE WHEN {blank} THEN NULL WHEN {n} > {LIMIT} THEN {ctx_content} "
               f"WHEN {n} % 97 = 0 THEN NULL ELSE {sql_reply(full, body, None if user is None else prompt)} END")
    error = (f"CASE WHEN {blank} THEN NULL WHEN {n} > {LIMIT} THEN {ctx_error} "
             f"WHEN {n} % 97 = 0 THEN 'service unavailable' END")
    return f"{status} AS status, {content} AS content, {error} AS error"
