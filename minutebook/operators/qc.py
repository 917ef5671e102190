"""Quality checks: each returns issue rows ``(file, check, detail)``;
``qc_report`` gives every file one pass/fail verdict."""
from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.dates import file_date_key, with_page_date
from ..functions.patterns import MONTHS
from ..functions.text import upper_text, words
from ..session import ship_package, stored
from .assemble import PER_SLICE, spread
from .scan import running

ISSUE_COLS = ["file", "check", "detail"]


def _issue(df: DataFrame, file, check, detail, when=None) -> DataFrame:
    """Issue rows; with ``when`` only rows meeting it.  The condition is
    applied inside a generator, not as a Filter, so Catalyst cannot push it
    below the projection and evaluate an expensive check twice."""
    f = F.col(file) if isinstance(file, str) else file
    c = F.lit(check) if isinstance(check, str) else check
    row = F.struct(f.cast("string").alias("file"), c.alias("check"), detail.cast("string").alias("detail"))
    if when is None:
        return df.select(row.alias("r")).select("r.*")
    return df.select(F.inline(F.filter(F.array(row), lambda r: when)))


def fixed(x, places: int) -> F.Column:
    """A number as text with ``places`` decimals (the value is first floored
    at that precision).

    Built from integer arithmetic, so every engine prints the same digits
    (``%.nf`` rounds half up in Java and half to even elsewhere)."""
    c = F.col(x) if isinstance(x, str) else x
    scale = 10 ** places
    n = F.floor(c * scale).cast("bigint")
    a = F.abs(n)
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit(""))
    whole = (a / scale).cast("bigint").cast("string")
    frac = F.lpad((a % scale).cast("string"), places, "0")
    return F.concat(sign, whole, F.lit("."), frac)


def check_complete(recordings: DataFrame, kinds=("mp3", "transcript", "summary")) -> DataFrame:
    """Q1: every WAV has an MP3, a transcript and a summary."""
    g = recordings.groupBy("stem").agg(
        F.max(F.when(F.col("kind") == "wav", F.col("file"))).alias("wav"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    g = g.where(F.col("wav").isNotNull())
    missing = F.filter(F.array(*[F.when(F.col(k) == 0, F.lit(k)) for k in kinds]), lambda x: x.isNotNull())
    g = g.select("wav", "stem", F.explode(missing).alias("kind"))
    return _issue(g, "wav", F.concat(F.lit("missing_"), F.col("kind")), F.col("stem"))


def check_durations(recordings: DataFrame, tol_s: float = 1.0) -> DataFrame:
    """Q2: WAV and MP3 lengths agree within ``tol_s`` seconds.

    The MP3 side is first reduced to one (shortest, longest) row per stem,
    so the join is many-to-one and never emits all wav x mp3 pairs of a
    stem; a WAV is flagged when some MP3 of its stem is off by more than
    ``tol_s``, and the detail is the signed difference of the farthest one
    (with one MP3 per stem: that MP3's difference)."""
    wav = recordings.where("kind = 'wav'").select("stem", F.col("file").alias("wav"), F.col("duration_s").alias("w"))
    mp3 = (recordings.where("kind = 'mp3'").groupBy("stem")
           .agg(F.min("duration_s").alias("lo"), F.max("duration_s").alias("hi")))
    w, lo, hi = F.col("w"), F.col("lo"), F.col("hi")
    j = wav.join(mp3, "stem").where((hi - w > tol_s) | (w - lo > tol_s))
    far = F.when(hi - w >= w - lo, hi - w).otherwise(lo - w)
    return _issue(j, "wav", "duration_mismatch", fixed(far, 3))


def check_readable(recordings: DataFrame, kinds=("wav", "mp3")) -> DataFrame:
    """Q3: audio files whose length is unknown or not positive."""
    r = recordings.where(F.col("kind").isin(*kinds) &
                         (F.col("duration_s").isNull() | (F.col("duration_s") <= 0)))
    return _issue(r, "file", "unreadable", F.col("kind"))


def check_short(index: DataFrame, min_wpm: float = 60.0) -> DataFrame:
    """Q4: transcripts with fewer than ``min_wpm`` words per minute."""
    wpm = F.col("word_count") / F.col("duration_min")
    r = index.where((F.col("duration_min") > 0) & (wpm < min_wpm))
    return _issue(r, "file", "short_transcript", fixed(wpm, 2))


def repeat_count(text) -> F.Column:
    """How often a word is directly followed by the same word (case folded;
    words are whitespace-separated runs).  One regex pass: each match is a
    word whose next word is equal (look-ahead, so runs of three count two)."""
    from ..functions.patterns import WS
    nws = f"[^{WS}]"
    rx = f"(?<!{nws})({nws}++)(?=[{WS}]++\\1(?!{nws}))"
    t = F.lower(text if not isinstance(text, str) else F.col(text))
    return F.size(F.regexp_extract_all(t, F.lit(rx), 0)).cast("bigint")


def check_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Q5: repeated words (``the the``)."""
    r = df.select(key, repeat_count(text).alias("n"))
    return _issue(r, key, "repeated_words", F.col("n"), when=F.col("n") > 0)


def numbered_terms(terms: DataFrame, term: str = "term") -> DataFrame:
    """Different terms (case folded, blanks as one space; blank ones left out) with dense numbers from 0, in term order."""
    folded = F.array_join(words(F.lower(term)), " ")
    rows = terms.select(folded.alias("term")).where("term <> ''").distinct().withColumn("_all", F.lit(0))
    return running(rows, ["_all"], ["term"], total={"_n": F.lit(1).cast("long")}).select("term", (F.col("_n") - 1).alias("term_no"))


def found_terms(df: DataFrame, numbered: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The terms that each text holds, as bitmaps of 32,768 term numbers: key, bucket, bits.

    Relational division: the different words and phrases of a text (as long as the terms are)
    meet the term table by an equi join, so neither the list nor a text has to fit one row, and
    a term of several words is found as such.  Texts without any term have no row.
    """
    lengths = [r[0] for r in numbered.select(F.size(F.split("term", " ")).alias("n")).distinct().collect()]  # few: words of a term
    w = F.col("_w")

    def phrases(n: int):
        run = w if n == 1 else F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, run).otherwise(F.array().cast("array<string>"))
    runs = [phrases(n) for n in sorted(lengths)]
    every = F.array_distinct(F.concat(*runs)) if runs else F.array().cast("array<string>")
    held = df.select(key, words(F.lower(text)).alias("_w")).select(key, F.explode(every).alias("term"))
    numbers = held.join(numbered, "term")
    return numbers.groupBy(key, F.bitmap_bucket_number(F.col("term_no") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("term_no") + 1)).alias("bits"))


def missing_terms(df: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and term for every term that a text lacks: the complement of its bitmaps, one term a row."""
    numbered = stored(numbered_terms(terms), "terms")
    found = found_terms(df, numbered, key, text)
    place = F.bitmap_bit_position(F.col("term_no") + 1)
    by_bucket = numbered.groupBy(F.bitmap_bucket_number(F.col("term_no") + 1).alias("bucket")).agg(
        F.collect_list(F.struct(place.alias("at"), "term")).alias("t"))
    n = numbered.count()
    asked = df.select(key).distinct().withColumn("bucket", F.explode(F.sequence(F.lit(1), F.lit(-(-n // 32768))).cast("array<bigint>"))) \
        if n else df.select(key, F.lit(0).cast("long").alias("bucket")).limit(0)
    rows = asked.join(by_bucket, "bucket").join(found, [key, "bucket"], "left")

    def has(at):
        byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return rows.select(key, F.inline(F.filter("t", lambda x: ~has(x["at"])))).select(key, "term")


def check_terms(df: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", listed: bool = True) -> DataFrame:
    """Q6: texts that lack key terms (words or phrases, case folded).

    The detail names them in term order, or (``listed`` false, for lists of thousands of terms)
    says how many of how many; ``missing_terms`` then has them one a row.  Rows that share a key
    are one text.
    """
    if listed:
        d = missing_terms(df, terms, key, text).groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("term")), ",").alias("m"))
        return _issue(d, key, "missing_terms", F.col("m"))
    numbered = stored(numbered_terms(terms), "terms")
    n = numbered.count()
    per = found_terms(df, numbered, key, text).groupBy(key).agg(F.sum(F.bitmap_count("bits")).alias("found"))
    d = df.select(key).distinct().join(per, key, "left").withColumn("lacks", F.lit(n) - F.coalesce("found", F.lit(0)))
    return _issue(d, key, "missing_terms", F.concat(F.col("lacks").cast("string"), F.lit(f" of {n}")), when=F.col("lacks") > 0)


NUMBER = "[0-9]+(?:[,.][0-9]+)*"
# a month and day (with or without its year), an amount of money, or a number
CLAIM = f"(?:{'|'.join(m.lower() for m in MONTHS)}) [0-9]{{1,2}}(?:, [0-9]{{4}})?|\\$ ?{NUMBER}|{NUMBER}"


def check_support(df: DataFrame, key: str = "doc_id", summary: str = "summary",
                  transcript: str = "transcript") -> DataFrame:
    """Q7: dates, amounts and numbers in a summary that do not occur in its
    transcript (case folded).  A plain number is also supported by the
    numbers inside the transcript's dates and amounts.  Lexical evidence only."""
    t = F.lower(transcript)
    s = F.regexp_extract_all(F.lower(summary), F.lit(CLAIM), 0)
    known = F.array_union(F.regexp_extract_all(t, F.lit(CLAIM), 0), F.regexp_extract_all(t, F.lit(NUMBER), 0))
    d = df.select(key, F.sort_array(F.array_except(s, known)).alias("u"))
    return _issue(d, key, "unsupported_claims", F.array_join("u", ";"), when=F.size("u") > 0)


SENTENCE = "[^.!?\\n]+"
# a word: letters, digits and whatever is not ASCII
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


#: words of transcripts and sentences in one batch, whose different words are numbered together
BATCH_WORDS = 1 << 19


def _numbered(schema: pa.Schema, most: int):
    """Rows (key, transcript, summary, whole) in lower case as batches of about ``most`` words (a row at least): the
    batch's different words (the first ``asked`` have a number), how many transcripts hold each, and as numbers the words
    that the transcript holds or lacks, of each sentence that lacks one (of every sentence where ``whole`` is true)."""
    from pyspark import TaskContext
    find, cut = re.compile(TERM).findall, re.compile(SENTENCE).findall

    def ints(flat: array) -> pa.Array:
        return pa.array(np.array(flat, np.int32))

    def made(batch: int, numbers: dict, often: Counter, keys: list, no: array, held: array, lacks: array, ends: tuple):
        def lists(flat: array, at: array):
            return pa.ListArray.from_arrays(pa.array([0, *at], pa.int32()), ints(flat))

        def single(values, dtype):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(dtype)
        one = schema.field("sentences").type.value_type
        rows = pa.StructArray.from_arrays([pa.array(keys, one.field(0).type), ints(no), lists(held, ends[0]), lists(lacks, ends[1])],
                                          fields=list(one))
        words = [*numbers, *(w for w in often if w not in numbers)]
        return pa.RecordBatch.from_arrays([
            pa.array([batch], pa.int64()), single(pa.array(words, pa.string()), schema.field("words").type),
            single(pa.array([often[w] for w in words], pa.int64()), schema.field("n").type),
            pa.array([len(numbers)], pa.int32()), single(rows, schema.field("sentences").type)], schema=schema)

    def fresh():
        numbers = defaultdict()
        numbers.default_factory = numbers.__len__
        return numbers, Counter(), [], array("i"), array("i"), array("i"), (array("i"), array("i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, state, size = TaskContext.get().partitionId() << 32, fresh(), 0
        for rows in batches:
            for key, transcript, said, whole in zip(*rows.columns):
                numbers, often, keys, no, held, lacks, ends = state
                number, name, every = numbers.__getitem__, key.as_py(), whole.as_py()
                known = set(find(transcript.as_py() or ""))
                often.update(known)
                size += len(known)
                at = 0
                for words in map(set, map(find, cut(said.as_py() or ""))):
                    if not words:
                        continue
                    if every or not words <= known:
                        held.extend(map(number, words & known))
                        lacks.extend(map(number, words - known))
                        keys.append(name)
                        no.append(at)
                        ends[0].append(len(held))
                        ends[1].append(len(lacks))
                        size += len(words)
                    at += 1
                if size >= most:
                    yield made(batch, *state)
                    batch, state, size = batch + 1, fresh(), 0
        if size:
            yield made(batch, *state)
    return run


def check_evidence(df: DataFrame, key: str = "doc_id", summary: str = "summary", transcript: str = "transcript",
                   least: int = 60) -> DataFrame:
    """Q7 beyond numbers: summary sentences whose words the transcript does not hold.

    A sentence's support is the weight of its different words (case folded) that the transcript holds, as a share of
    the weight of all of them.  A word weighs floor(1000 ln((2N+2)/(2n+1))) where n of N transcripts hold it, so
    common words prove little.  Sentences below ``least`` percent are issues: ``number: percent``, numbered from 1.
    Sentences without a word are none; a null transcript holds nothing; rows that share a key share their numbers.

    One pass over the texts writes bounded batches whose words are numbered.  Only a batch's different words meet the
    counts of all transcripts, and return to it as one list of weights; no row is made for a word of a sentence.  A
    sentence that lacks no word is fully supported, so it is left out unless rows share its key.
    """
    ship_package(df.sparkSession)
    n = df.count()
    # lower case depends on what is around a letter for one letter only: there each sentence is lowered by itself
    alone = F.array_join(F.transform(F.regexp_extract_all(F.col(summary), F.lit(SENTENCE), 0), lambda s: F.lower(s)), "\n")
    said = F.when(F.contains(F.col(summary), F.lit("\u03a3")), alone).otherwise(F.lower(summary))
    shared = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    whole = F.lit(least > 100)
    if not shared.isEmpty():  # else no text moves
        df, whole = df.join(shared, F.col(key).eqNullSafe(F.col("_key")), "left"), whole | F.col("_rows").isNotNull()
    rows = df.select(F.col(key).alias("key"), F.lower(transcript).alias("transcript"), said.alias("said"), whole.alias("whole"))
    numbers = T.ArrayType(T.IntegerType())
    sentence = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("no", T.IntegerType()),
                             T.StructField("held", numbers), T.StructField("lacks", numbers)])
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("words", T.ArrayType(T.StringType())),
                           T.StructField("n", T.ArrayType(T.LongType())), T.StructField("asked", T.IntegerType()),
                           T.StructField("sentences", T.ArrayType(sentence))])
    batches = stored(rows.mapInArrow(_numbered(to_arrow_schema(schema), BATCH_WORDS), schema), "evidence")
    held = batches.select(F.inline(F.arrays_zip("words", "n"))).groupBy("words").agg(F.sum("n").alias("n"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * n + 2) / (2 * F.col("n") + 1))).cast("long")
    asked = batches.select("batch", F.posexplode(F.slice("words", F.lit(1), F.col("asked"))).alias("at", "words"))
    weights = asked.join(held.select("words", weight.alias("weight")), "words").groupBy("batch").agg(
        F.sort_array(F.collect_list(F.struct("at", "weight"))).alias("w"))
    # a plain array of numbers: the lookups of a batch read it in place
    met = batches.select("batch", "sentences").join(weights.select("batch", F.col("w.weight").alias("w")), "batch")

    def total(places: F.Column) -> F.Column:
        return F.aggregate(places, F.lit(0).cast("long"), lambda acc, i: acc + F.get("w", i))
    each = met.select(F.inline(F.transform("sentences", lambda s: F.struct(
        s["key"].alias("key"), s["no"].alias("no"), total(s["held"]).alias("held"), total(s["lacks"]).alias("lacks")))))
    per = each.groupBy("key", "no").agg(F.sum("held").alias("held"), F.sum(F.col("held") + F.col("lacks")).alias("w"))
    weak = per.where(100 * F.col("held") < least * F.col("w"))
    return _issue(weak, "key", "weak_evidence", F.concat((F.col("no") + 1).cast("string"), F.lit(": "),
                                                         F.expr("100 * held div w").cast("string")))


def check_dates(files: DataFrame, path: str = "path", name: str = "name", parent: str = "parent",
                text: str = "text") -> DataFrame:
    """Q8: the date in a file name against the date found in its text.

    The issue row comes out of a generator rather than a filter on the
    check, so Catalyst cannot push the check below the projection and parse
    every text twice; the two dates are computed once per file.
    """
    d = with_page_date(files.select(path, file_date_key(name, parent).alias("fd"), upper_text(text).alias("_up")),
                       "_up", "td")
    check = (F.when(F.col("fd").isNull(), "no_file_date").when(F.col("td").isNull(), "no_text_date")
             .when(F.col("fd") != F.col("td"), "date_mismatch"))
    det = F.concat_ws(" / ", F.col("fd").cast("string"), F.col("td").cast("string"))
    row = F.struct(F.col(path).cast("string").alias("file"), check.alias("check"), det.alias("detail"))
    return d.select(F.inline(F.filter(F.array(row), lambda r: r["check"].isNotNull())))


RUN = "[\\p{L}\\p{N}]+"
EDGE = 4


def _name_tokens(name) -> F.Column:
    """Tokens that every text holding ``name`` has: its inner runs of letters and digits as whole runs, the
    first letters of a run that ends it, the last ones of a run that begins it; empty if there are none."""
    runs = F.regexp_extract_all(name, F.lit(RUN), 0)
    open_left, open_right = name.rlike(f"^{RUN}"), name.rlike(f"{RUN}\\z")

    def token(r, i):
        left, right = open_left & (i == 0), open_right & (i == F.size(runs) - 1)
        return (F.when(~left & ~right, F.concat(F.lit("="), r))
                .when(~left & (F.length(r) >= EDGE), F.concat(F.lit("^"), F.left(r, F.lit(EDGE))))
                .when(~right & (F.length(r) >= EDGE), F.concat(F.lit("$"), F.right(r, F.lit(EDGE)))))
    return F.array_distinct(F.filter(F.transform(runs, token), lambda t: t.isNotNull()))


def _text_tokens(text) -> F.Column:
    """Every token of a text that a name's token can meet (the empty one included)."""
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(RUN), 0))
    ends = F.filter(runs, lambda r: F.length(r) >= EDGE)
    return F.array_distinct(F.concat(
        F.array(F.lit("")), F.transform(runs, lambda r: F.concat(F.lit("="), r)),
        F.transform(ends, lambda r: F.concat(F.lit("^"), F.left(r, F.lit(EDGE)))),
        F.transform(ends, lambda r: F.concat(F.lit("$"), F.right(r, F.lit(EDGE))))))


def named_in(texts: DataFrame, names: DataFrame, by: str, key: str, text: str, per_row: int = 1000) -> DataFrame:
    """The (key, name) pairs of upper-cased ``names`` (by, name) that occur in a text of the same ``by``.

    An inverted index of the names: each is filed under the rarest of its tokens (in how many texts of its
    ``by`` the token occurs), and only texts that hold this token are searched, once for at most about
    ``per_row`` names.  ``texts`` is read twice (tokens, search), so it should be a written table; names
    without a token (one bare run, which may lie inside a longer one) meet every text of their ``by``.
    """
    filed = names.select(by, "name", F.explode(F.coalesce(F.nullif(_name_tokens(F.col("name")), F.array().cast("array<string>")),
                                                          F.array(F.lit("")))).alias("token"))
    held = texts.select(by, key, F.explode(_text_tokens(F.upper(text))).alias("token"))
    held = stored(held.join(filed.select(by, "token").distinct(), [by, "token"], "left_semi"), "name-tokens")
    often = held.groupBy(by, "token").agg(F.count(F.lit(1)).alias("n"))
    # a name one of whose tokens no text holds is in no text
    rarest = (filed.join(often, [by, "token"], "left").groupBy(by, "name")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("t"))
              .where("t.n > 0").select(by, "name", F.col("t.token").alias("token")))
    asked = held.join(rarest, [by, "token"]).select(key, "name")
    sized = asked.join(asked.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / per_row).alias("_lists")), key)
    lists = sized.groupBy(key, F.pmod(F.xxhash64("name"), "_lists").alias("_list")).agg(F.collect_set("name").alias("_names"))
    found = texts.select(key, F.upper(text).alias("_up")).join(lists, key)
    return found.select(key, F.explode(F.filter("_names", lambda n: F.instr(F.col("_up"), n) > 0)).alias("name")).distinct()


def check_names(transcripts: DataFrame, members: DataFrame, meeting: str = "meeting",
                text: str = "transcript", by: str | None = None, listed: bool = True) -> DataFrame:
    """Q9: roster members whose name the transcript never mentions (case folded, anywhere in the text).

    ``by`` is the column (the meeting year) that says whose members are asked for, so a year's members are
    referred to by key and no transcript is repeated for them; without it ``members`` name their meeting.
    Transcripts that share a meeting count as one; null names are left out; one row per missing member.
    With ``listed`` false these are counted only: one row per meeting, with their number ``n`` and no detail.
    """
    by = by or meeting
    cols = [meeting] if by == meeting else [meeting, by]
    texts = stored(transcripts.where(F.col(by).isNotNull()).select(*cols, F.coalesce(text, F.lit("")).alias("_text")), "name-texts")
    m = members.where(F.col("name").isNotNull()).select(by, "name", F.upper("name").alias("_up"))
    found = named_in(texts, m.select(by, F.col("_up").alias("name")).distinct(), by, meeting, "_text")
    asked = texts.select(*cols).distinct()
    if not listed:
        # those of the year, less those found: no row for each meeting and member
        each = m.groupBy(by, "_up").agg(F.count(F.lit(1)).alias("_rows"))
        there = (asked.join(found.withColumnRenamed("name", "_up"), meeting).join(each, [by, "_up"])
                 .groupBy(*cols).agg(F.sum("_rows").alias("_found")))
        per = asked.join(each.groupBy(by).agg(F.sum("_rows").alias("_all")), by).join(there, cols, "left")
        n = F.col("_all") - F.coalesce("_found", F.lit(0))
        return per.withColumn("n", n).where("n > 0").select(F.col(meeting).cast("string").alias("file"), F.lit("name_missing").alias("check"),
                                                            F.lit(None).cast("string").alias("detail"), "n")
    # the found names travel with their meeting, so the rows of all members are made and left in one task
    asked = asked.join(found.groupBy(meeting).agg(F.collect_set("name").alias("_found")), meeting, "left")
    missing = _with_members(asked, m, by).where(~F.coalesce(F.array_contains("_found", F.col("_up")), F.lit(False)))
    return _issue(missing, meeting, "name_missing", F.col("name"))


def _with_members(asked: DataFrame, members: DataFrame, by: str) -> DataFrame:
    """Each row of ``asked`` with every member of its ``by``, dealt over tasks ``PER_SLICE`` rows of a ``by`` at a time."""
    sizes = asked.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / PER_SLICE).cast("int").alias("_slices"))
    dealt = members.join(sizes, by).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    rows = asked.join(sizes, by)
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64(*asked.columns), F.col("_slices")).cast("int")).drop("_slices")
    return spread(rows, by, "_slice").join(dealt, [by, "_slice"])


def qc_report(issues: list[DataFrame], files: DataFrame, file: str = "file") -> DataFrame:
    """Q10: the issue log summed up per file: every file gets exactly one
    row, ``pass`` when it has no issue.  A row stands for one issue, or for
    ``n`` where a check counts them."""
    one = F.lit(1).cast("long")
    log = reduce(lambda a, b: a.unionByName(b), [i.select(*ISSUE_COLS, (F.col("n") if "n" in i.columns else one).alias("n")) for i in issues])
    per = log.groupBy("file").agg(F.sum("n").alias("n_issues"),
                                  F.array_join(F.array_sort(F.collect_set("check")), ",").alias("checks"))
    u = files.select(F.col(file).alias("file")).distinct()
    out = u.join(per, "file", "left")
    return out.select("file", F.coalesce("n_issues", F.lit(0)).alias("n_issues"), "checks",
                      F.when(F.col("n_issues").isNull(), "pass").otherwise("fail").alias("status"))
