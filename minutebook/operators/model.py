"""The model edge: request tables, stage planning, the batched call, fusing.

Everything up to the call is plain DataFrame work.  The call itself is the
one place rows leave the JVM: ``run_model`` hands Arrow batches to a user
function with ``mapInArrow`` (a client is built once per partition), and
records a status per row instead of raising.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (NON_WS_CLASS, PACKED_CHUNK_TOKENS, RETRY_CHARS, SEP_AUDIO_FUSE, SEP_STRICT_FUSE,
                                  TOKEN_CHUNK, WHOLE_BELOW_TOKENS)
from ..functions.templates import CONTEXT_ERRORS, STAGES
from ..functions.text import strip
from ..session import ship_package
from .chunk import token_chunks, with_chunks

#: requests of a batch that are Python objects at a time
CALL_ROWS = 64


def fill_template(template: str, text, date=None):
    """``template`` with ``{text}`` / ``{date}`` replaced by column values."""
    parts = []
    rest = template
    while rest:
        i_t, i_d = rest.find("{text}"), rest.find("{date}")
        cands = [(i, k) for i, k in ((i_t, "text"), (i_d, "date")) if i >= 0]
        if not cands:
            parts.append(F.lit(rest))
            break
        i, k = min(cands)
        if i:
            parts.append(F.lit(rest[:i]))
        col = text if k == "text" else date
        parts.append(F.col(col) if isinstance(col, str) else col)
        rest = rest[i + 6:]
    return F.concat(*parts)


def build_requests(df: DataFrame, stage: str, text: str = "text", date=None,
                   keys: list[str] | None = None) -> DataFrame:
    """One request row per input row for ``stage``: the prompt (or the
    system prompt plus the text as user message), model and temperature."""
    template, model, temp, system = STAGES[stage]
    keys = keys or [c for c in df.columns if c not in (text,)]
    if system:
        prompt = F.lit(template)
        user = F.col(text)
    else:
        prompt = fill_template(template, text, date)
        user = F.lit(None).cast("string")
    return df.select(*keys, F.lit(stage).alias("stage"), F.lit(model).alias("model"),
                     F.lit(temp).alias("temperature"), prompt.alias("prompt"), user.alias("user_text"),
                     F.col(text).alias("source_text"))


def plan_stages(df: DataFrame, doc: str = "doc", text: str = "text",
                whole_below: int = WHOLE_BELOW_TOKENS, max_tokens: int = PACKED_CHUNK_TOKENS) -> DataFrame:
    """Stage rows of the strict audio route.  A short text gets summary,
    outline and decisions from the full text; a long one gets one
    ``summary`` row per packed chunk, then a ``fuse`` row and outline /
    decisions that take the fused text (``input`` null, ``depends_on`` set).
    All rows of a text come from one reading of it."""
    def row(stage: str, chunk_no=F.lit(0), text=F.lit(None), depends_on: str | None = None):
        return F.struct(F.lit(stage).alias("stage"), chunk_no.alias("chunk_no"), text.cast("string").alias("input"),
                        F.lit(depends_on).cast("string").alias("depends_on"))
    t = with_chunks(df.select(doc, F.col(text).alias("text")), whole_below, max_tokens)
    whole = F.array(*[row(s, text=F.col("_chunks")[0]["text"]) for s in ("summary", "outline", "decisions")])
    pieces = F.transform("_chunks", lambda c: row("summary", c["chunk_no"], c["text"]))
    later = F.array(row("fuse", depends_on="summary"), row("outline", depends_on="fuse"), row("decisions", depends_on="fuse"))
    rows = F.when(F.col("_n") < whole_below, whole).when(F.col("_n") >= whole_below, F.concat(pieces, later))
    return t.select(doc, F.inline(rows))


def run_model(requests: DataFrame, make_client: Callable[[], Callable[[str, str | None], str]],
              keys: list[str], prompt: str = "prompt", user_text: str = "user_text",
              source_text: str = "source_text",
              retry_template: str | None = None, date: str | None = None,
              retry_chars: int = RETRY_CHARS, partitions: int | None = None,
              pause_s: float = 0.0, settings: tuple[str, ...] = (),
              retry_settings: dict | None = None) -> DataFrame:
    """Call the model once per request row.

    ``make_client()`` runs once per partition and returns ``call(prompt,
    user_text) -> reply``.  A blank source text is not sent (status
    ``blank``).  A context-length error is retried once with
    ``retry_template`` filled with ``source_text[:retry_chars]`` and the
    ``date`` column: status ``shortened``, so that a reply to a part of a text
    never passes for one to the whole (``too_long`` if that fails too; texts
    known to be long go through ``run_chunked``).  Any other error gives
    status ``error``.  ``partitions``
    bounds how many calls run at once and ``pause_s`` spaces the calls of
    one task (a service rate limit: at most ``partitions / pause_s`` calls
    per second overall).  ``settings`` names request columns (model,
    temperature, ...) that go to the client as keyword arguments of the call;
    ``retry_settings`` replaces some of them for the retry.  Persist the result (``checkpoint`` or
    a written table) before using it twice, so no call is repeated.
    """
    ship_package(requests.sparkSession)
    kinds = {f.name: f.dataType for f in requests.schema}
    out_schema = ", ".join([f"`{k}` {kinds[k].simpleString()}" for k in keys]
                           + ["status string", "content string", "error string"])
    # the source is a copy of the text in the prompt: the task gets whether it is blank, and the part a retry sends
    source = F.coalesce(F.col(source_text).cast("string"), F.lit(""))
    again = F.left(source, F.lit(retry_chars)) if retry_template is not None else F.lit(None).cast("string")
    extra = ([F.col(date).cast("string")] if date else []) + [F.col(c) for c in settings]
    # keys may be among the other columns, so those have names of their own
    req = requests.select(*keys, F.col(prompt).alias("_prompt"), F.col(user_text).alias("_user"),
                          (~source.rlike(NON_WS_CLASS)).alias("_blank"), again.alias("_again"),
                          *[c.alias(f"_x{i}") for i, c in enumerate(extra)])
    if partitions:
        req = req.repartition(partitions, *keys)

    def call_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import time
        client = make_client()

        def call(p, u, given):
            if pause_s:
                time.sleep(pause_s)
            return client(p, u, **given)

        def reply(p, u, blank, s, *rest):
            if blank:
                return "blank", None, None
            given = dict(zip(settings, rest[1:] if date else rest))
            try:
                return "ok", call(p, u, given), None
            except Exception as e:  # noqa: BLE001 - any failure becomes a status
                msg = str(e)
                if retry_template is None or not any(k in msg for k in CONTEXT_ERRORS):
                    return "error", None, msg
                retry = retry_template.replace("{date}", str(rest[0] if date else None)).replace("{text}", s)
                try:
                    return "shortened", call(retry, None, {**given, **(retry_settings or {})}), None
                except Exception as e2:  # noqa: BLE001
                    return "too_long", None, str(e2)
        for whole in batches:
            # a few rows at a time become Python objects, however many come in a batch
            for at in range(0, whole.num_rows, CALL_ROWS):
                batch = whole.slice(at, CALL_ROWS)
                replies = [reply(*row) for row in zip(*[c.to_pylist() for c in batch.columns[len(keys):]])]
                answered = [pa.array([r[i] for r in replies], pa.string()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], *answered], names=[*keys, "status", "content", "error"])

    return req.mapInArrow(call_all, out_schema)


def fuse(responses: DataFrame, doc: str = "doc", order: str = "chunk_no", content: str = "content",
         sep: str = SEP_STRICT_FUSE) -> DataFrame:
    """A5: the partial replies of a document in order, joined by ``sep``.

    ``n_failed`` counts partials without a reply; if there is any, ``fused``
    is null, so an incomplete text never passes for a whole one.
    """
    st = F.struct(F.col(order), F.col(content).alias("_v"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(st)), lambda x: x["_v"]), sep)
    failed = F.count_if(F.col(content).isNull())
    return responses.groupBy(doc).agg(F.when(failed == 0, joined).alias("fused"), failed.alias("n_failed"))


def run_stages(plan: DataFrame, call: Callable[[DataFrame, list[str]], DataFrame], doc: str = "doc",
               sep: str = SEP_STRICT_FUSE) -> DataFrame:
    """The staged run of U2's rows: replies (doc, stage, chunk_no, status, content, error) of all stages.

    Rows with an input go first; the summaries of a long text's chunks are
    joined (A5) as the input of its ``fuse`` row, and the reply to that is the
    input of its outline and decisions.  ``call(requests, keys)`` is the model
    run of request rows; each stage's replies are checkpointed, so no call is
    repeated.  A blank chunk adds nothing to the joined text; where a chunk or
    the fuse row got no reply, the rows that depend on it are not sent and have
    no row here.
    """
    keys = [doc, "stage", "chunk_no"]
    system = F.coalesce(*[F.when(F.col("stage") == s, F.lit(STAGES[s][0])) for s in ("summary", "outline", "decisions", "fuse")])

    def replies(rows: DataFrame) -> DataFrame:
        return call(rows.select(*keys, system.alias("prompt"), F.col("input").alias("user_text"),
                                F.col("input").alias("source_text")), keys).checkpoint(eager=True)

    def after(stage: str, inputs: DataFrame) -> DataFrame:
        return replies(plan.where(F.col("depends_on") == stage).select(*keys).join(inputs, doc))
    first = replies(plan.where("input IS NOT NULL"))
    partial = (first.where("stage = 'summary' AND status <> 'blank'")
               .join(plan.where("stage = 'fuse'").select(doc), doc, "left_semi"))
    joined = fuse(partial, doc=doc, sep=sep).where("fused IS NOT NULL")
    fused = after("summary", joined.select(doc, F.col("fused").alias("input")))
    last = after("fuse", fused.where("content IS NOT NULL").select(doc, F.col("content").alias("input")))
    return first.unionByName(fused).unionByName(last)


def meeting_documents(transcripts: DataFrame, plan: DataFrame, replies: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """S7's text outputs: doc, doc_kind (transcript, summary, outline), heading and body.

    The summary of a text that was sent whole is its reply, of a longer one the reply to its
    ``fuse`` row.  A kind without a reply has no row.
    """
    fused = plan.where("stage = 'fuse'").select(doc, F.lit(True).alias("_long"))
    answered = replies.where("content IS NOT NULL").join(fused, doc, "left")
    kind = (F.when(F.col("stage") == "outline", "outline")
            .when((F.col("stage") == "fuse") | ((F.col("stage") == "summary") & F.col("_long").isNull()), "summary"))
    written = answered.select(doc, kind.alias("doc_kind"), strip("content").alias("body")).where("doc_kind IS NOT NULL")
    rows = transcripts.select(doc, F.lit("transcript").alias("doc_kind"), F.col(text).alias("body")).unionByName(written)
    return rows.select(doc, "doc_kind", F.initcap("doc_kind").alias("heading"), "body")


def run_chunked(docs: DataFrame, call: Callable[[DataFrame, list[str]], DataFrame], doc: str = "doc", text: str = "text",
                max_tokens: int = TOKEN_CHUNK, sep: str = SEP_AUDIO_FUSE) -> DataFrame:
    """The audio run: a summary of every token chunk (C1), the summaries joined in order (A5), one merge request of the joined text.

    Returns doc, n_chunks, n_failed, status, content and error of the merge; whole texts of any
    length, no part left out.  Where a chunk got no reply the merge is not sent and the status is
    ``incomplete``; a text without a token has no chunk and the status ``blank``.  Blank chunks
    add nothing.  The replies of both steps are checkpointed, so no call is repeated.
    """
    chunks = token_chunks(docs.select(doc, text), max_tokens, text=text)
    requests = build_requests(chunks, "chunk_summary", text=text, keys=[doc, "chunk_no"])
    partial = call(requests, [doc, "chunk_no"]).checkpoint(eager=True)
    counts = partial.groupBy(doc).agg(F.count(F.lit(1)).cast("int").alias("n_chunks"))
    joined = fuse(partial.where("status <> 'blank'"), doc=doc, sep=sep)
    merged = call(build_requests(joined.where("fused IS NOT NULL"), "merge_summary", text="fused", keys=[doc]), [doc]).checkpoint(eager=True)
    out = docs.select(doc).distinct().join(counts, doc, "left").join(joined.select(doc, "n_failed"), doc, "left").join(merged, doc, "left")
    status = (F.when(F.coalesce("n_failed", F.lit(0)) > 0, F.lit("incomplete"))
              .otherwise(F.coalesce("status", F.lit("blank"))))
    return out.select(doc, F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
                      F.coalesce("n_failed", F.lit(0)).cast("long").alias("n_failed"), status.alias("status"), "content", "error")


def attach_responses(requests: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """Every request with its reply (status ``missing`` when none)."""
    r = responses.select(*keys, "status", "content")
    out = requests.join(r, keys, "left")
    return out.withColumn("status", F.coalesce("status", F.lit("missing")))

