"""Table-valued chunking: token pieces, paragraph packing, audio cut plan."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import NON_WS_CLASS, PACKED_CHUNK_TOKENS, PART_SECONDS, TOKEN_CHUNK, WHOLE_BELOW_TOKENS, WS_CLASS
from ..functions.tokens import token_count, tokens, tokens_up_to
from ..session import stored
from .scan import ROWS_PER_RANGE, running


def token_chunks(df: DataFrame, n: int = TOKEN_CHUNK, text: str = "text") -> DataFrame:
    """Pieces of ``n`` tokens, no overlap; joined they give the text
    back; an empty text gives no piece.  The chunk list is built as an array
    of structs and then inlined, so the token array is not copied into every
    output row."""
    toks = tokens(text)
    keep = [c for c in df.columns if c != text]
    t = df.select(*keep, toks.alias("_toks"))
    k = F.ceil(F.size("_toks") / F.lit(n)).cast("int")
    chunks = F.when(k > 0, F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.struct(
        i.alias("chunk_no"),
        F.size(F.slice("_toks", i * n + 1, n)).cast("bigint").alias("n_tokens"),
        F.array_join(F.slice("_toks", i * n + 1, n), "").alias("text"))))
    return t.select(*keep, F.inline(chunks))


def pack_starts(costs, max_tokens: int):
    """Greedy packing as a fold over paragraph costs: a new chunk starts at
    paragraph i when the running cost would pass ``max_tokens`` and the
    current chunk is not empty.  Only the start positions are stored."""
    init = F.struct(F.array(F.lit(0)).alias("s"), F.lit(0).cast("bigint").alias("c"), F.lit(0).alias("i"))

    def step(acc, t):
        brk = (acc["i"] > 0) & (acc["c"] + t > max_tokens)
        return F.when(brk, F.struct(F.array_append(acc["s"], acc["i"]).alias("s"), t.alias("c"),
                                    (acc["i"] + 1).alias("i"))) \
            .otherwise(F.struct(acc["s"].alias("s"), (acc["c"] + t).alias("c"), (acc["i"] + 1).alias("i")))
    return F.aggregate(costs, init, step, lambda acc: acc["s"])


def paragraph_chunks(df: DataFrame, whole_below: int = WHOLE_BELOW_TOKENS,
                     max_tokens: int = PACKED_CHUNK_TOKENS, text: str = "text") -> DataFrame:
    """Texts of ``whole_below`` tokens or more are split on newlines and
    packed greedily into chunks of at most ``max_tokens`` (a paragraph costs
    its tokens + 1; an over-long paragraph is a chunk of its own); shorter
    texts stay whole."""
    keep = [c for c in df.columns if c != text]
    return with_chunks(df, whole_below, max_tokens, text).select(*keep, F.inline("_chunks"))


def with_chunks(df: DataFrame, whole_below: int, max_tokens: int, text: str = "text") -> DataFrame:
    """The rows with ``_chunks``, the list of their chunks (chunk_no, text), for their text; ``_n`` is the text's
    tokens, counted as far as ``whole_below`` asks."""
    keep = [c for c in df.columns if c != text]
    paras = F.split(F.col(text), "\n", -1)
    t = df.select(*keep, F.col(text).alias("_text"), tokens_up_to(text, whole_below).alias("_n"), paras.alias("_p"))
    # a paragraph above the limit is a chunk of its own, however far above
    costs = F.transform("_p", lambda p: tokens_up_to(p, max_tokens) + 1)
    starts = F.when(F.col("_n") < whole_below, F.array(F.lit(0))).otherwise(pack_starts(costs, max_tokens))
    t = t.withColumn("_s", starts)
    ends = F.concat(F.slice("_s", 2, F.size("_s")), F.array(F.size("_p")))
    chunks = F.transform(F.arrays_zip(F.col("_s").alias("a"), ends.alias("b")), lambda x, i: F.struct(
        i.alias("chunk_no"),
        F.when(F.col("_n") < whole_below, F.col("_text"))
         .otherwise(F.array_join(F.slice("_p", x["a"] + 1, x["b"] - x["a"]), "\n")).alias("text")))
    return t.select(*keep, "_n", chunks.alias("_chunks"))


def next_starts(costs: DataFrame, key: str, max_tokens: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """For each paragraph of ``costs`` (key, para_no from 0, cost of 1 or more): ``nxt``, the paragraph that would open
    the next chunk if this one opened a chunk; null where the text ends first (written).

    With running totals, that is the first later paragraph whose end passes this one's beginning + ``max_tokens``.
    Ends and these limits are put in one order, and a scan from the far side gives each limit the nearest end
    beyond it: a binary search for all paragraphs at once, whichever range they lie in.
    """
    ends = running(costs.select(key, "para_no", "cost"), [key], ["para_no"], total={"_end": F.col("cost").cast("long")},
                   rows_per_range=rows_per_range)
    places = F.array(F.struct((-F.col("_end")).alias("at"), F.lit(1).alias("kind"), F.col("para_no").alias("end_of")),
                     F.struct((F.col("cost") - F.col("_end") - max_tokens).cast("long").alias("at"), F.lit(0).alias("kind"),
                              F.lit(None).cast("int").alias("end_of")))
    # an end equal to a limit does not pass it: the limit comes first
    met = running(ends.select(key, "para_no", F.inline(places)), [key], ["at", "kind", "para_no"], last={"_beyond": "end_of"},
                  rows_per_range=rows_per_range)
    later = F.when(F.col("_beyond").isNotNull(), F.greatest("_beyond", F.col("para_no") + 1))
    # a paragraph longer than a chunk is passed by its own end, though the text may end with it
    last = costs.groupBy(F.col(key).alias("_key")).agg(F.max("para_no").alias("_last"))
    out = met.where("kind = 0").join(last, F.col(key) == F.col("_key")).select(
        key, "para_no", F.when(later <= F.col("_last"), later).alias("nxt"))
    return stored(out, "next-starts")


def chunk_starts(pointers: DataFrame, key: str) -> DataFrame:
    """key and para_no of the paragraphs that open a chunk: those that the pointers ``nxt`` reach from paragraph 0.

    Pointer doubling: with the first 2^k starts known and pointers that skip 2^k starts, one join gives the next
    2^k starts and one the pointers that skip twice as many; a text of n chunks takes log2(n) rounds, and no
    round depends on how many paragraphs one text has.
    """
    found = stored(pointers.where("para_no = 0").select(key, "para_no"), "chunk-starts")
    parts = [found]
    jump = pointers.where("nxt IS NOT NULL")
    while True:
        known = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        new = stored(known.join(jump, [key, "para_no"]).select(key, F.col("nxt").alias("para_no")), "chunk-starts")
        if new.isEmpty():
            return known
        parts = [stored(known, "chunk-starts") if len(parts) > 1 else known, new]
        onward = jump.select(F.col(key).alias("_key"), F.col("para_no").alias("_at"), F.col("nxt").alias("_to"))
        jump = stored(jump.join(onward, (F.col(key) == F.col("_key")) & (F.col("nxt") == F.col("_at")))
                      .select(key, "para_no", F.col("_to").alias("nxt")), "jumps")


def paragraph_row_chunks(paras: DataFrame, key: str, whole_below: int = WHOLE_BELOW_TOKENS, max_tokens: int = PACKED_CHUNK_TOKENS,
                         text: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """C2 for texts that come as paragraph rows (key, para_no from 0, ``text``), of any length: key, chunk_no, text.

    The same chunks as ``paragraph_chunks`` on the joined text, but no row, window or task holds a whole text:
    only one chunk is put together at a time.  Keys must not be null or repeated.  A text below ``whole_below``
    tokens is one chunk.
    """
    t = F.col(text)
    words = F.regexp_count(t, F.lit(NON_WS_CLASS + "+"))
    # the joined text ends in blanks (one more token) if its last paragraph does, or if that is empty after others
    open_end = t.rlike(WS_CLASS + "\\z") | ((t == "") & (F.col("para_no") > 0))
    rows = stored(paras.select(key, F.col("para_no").cast("int").alias("para_no"), (token_count(text) + 1).alias("cost"),
                               words.cast("long").alias("words"), open_end.cast("long").alias("open_end")), "paragraph-costs")
    per = rows.groupBy(key).agg((F.sum("words") + F.max_by("open_end", "para_no")).alias("_n"))
    long = rows.join(per.where(F.col("_n") >= whole_below).select(key), key, "left_semi")
    starts = chunk_starts(next_starts(long, key, max_tokens, rows_per_range), key).withColumn("_start", F.lit(1).cast("long"))
    flagged = rows.select(key, "para_no").join(starts, [key, "para_no"], "left").withColumn("_start", F.coalesce("_start", F.lit(0).cast("long")))
    numbered = running(flagged, [key], ["para_no"], total={"_no": F.col("_start")}, rows_per_range=rows_per_range)
    # texts below the limit have no starts, so their number is 0 throughout
    chunk_no = F.greatest(F.col("_no") - 1, F.lit(0)).cast("int")
    placed = paras.select(key, F.col("para_no").cast("int").alias("para_no"), text).join(
        numbered.select(key, "para_no", chunk_no.alias("chunk_no")), [key, "para_no"])
    lines = F.sort_array(F.collect_list(F.struct("para_no", F.col(text).alias("_t"))))
    return placed.groupBy(key, "chunk_no").agg(lines.alias("_l")).select(
        key, "chunk_no", F.array_join(F.transform("_l", lambda x: x["_t"]), "\n").alias(text))


def segment_plan(recordings: DataFrame, seconds: int = PART_SECONDS, stem: str = "stem",
                 duration: str = "duration_s") -> DataFrame:
    """The cut plan of a recording into ``seconds``-long parts named
    ``<stem>_part_000.wav`` ...; zero or unknown length gives no part."""
    d = F.col(duration)
    k = F.ceil(d / F.lit(float(seconds))).cast("int")
    parts = F.when(d > 0, F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.struct(
        i.alias("part_no"),
        (i * F.lit(float(seconds))).alias("start_s"),
        F.least((i + 1) * F.lit(float(seconds)), d).alias("end_s"),
        F.format_string("%s_part_%03d.wav", F.col(stem), i).alias("part_file"))))
    return recordings.select(stem, F.inline(parts))
