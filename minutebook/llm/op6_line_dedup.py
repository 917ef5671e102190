"""Line dedup: exact set-similarity join of lines; a line that matches an earlier one is removed.

A line is the set of its lower-cased words (split at white space).  A line
with a word is removed if an earlier line has a word-set Jaccard similarity of
at least 4/5 with it, whether or not that earlier line stays.  Earlier is by
doc_id, then a hash of the text, then line number.  Lines of one to three
different words match equal sets only, as does a line of one unbroken word (a
sentence without spaces): no other set comes to 4/5.

1. One pass over the texts writes the word hashes of every line, dictionary
   coded; nothing after it tokenizes a text again.
2. Word frequencies over all lines are summed in a fixed number of hash
   buckets; their logarithmic class orders words by rarity (ties by hash), so
   what every task holds is bounded.
3. Lines with equal sets become one, at its first position, before any join.
4. Each line of at least four words is indexed under its rarest words (the
   prefix that two similar lines must share).  A semi-join on those words with
   length, positional and sketch filters (the parity of 64 word buckets, for
   lines of over 64 words of 128, bounds how many words two sets may differ
   in) finds the lines that may have a partner; its output is never more than
   the index.
5. The few lines left get their full word sets; each is verified first
   against the earliest line under each of its words, and only those not
   decided by that against others.  So a group of many like lines is
   decided without listing its pairs.
6. Lines with a word, first lines of a set and near lines meet as bits, 64
   lines of a document in a long; the report needs no text again.

Words are told apart by 64 bits of a hash.  Only DataFrame functions are
used.  Defined results: null and empty texts have no lines; rows without
doc_id are ordered first; rows that share a doc_id, or have none, are
documents of their own if their texts differ, and rows that repeat both are
one document (each copy loses the same lines); an empty table gives an empty
result; other columns are ignored or passed on.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import discard, maybe_in, read, saved

#: similarity as a fraction
NUM, DEN = 4, 5
#: 65,536 buckets fit into the fast map of Spark's aggregates
BUCKET_BITS = 16
#: lines of more words get the second half of the sketch; for shorter ones 64 buckets tell sets apart
SMALL = 64
_LOW56 = (1 << 56) - 1


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _plain(low: Column) -> Column:
    """A space for every other blank but the line feed, in lower-cased text; texts without those skip the slow replacing."""
    other = [F.contains(low, F.lit(c)) for c in "\t\r\x0b\x0c"]
    return F.when(other[0] | other[1] | other[2] | other[3], F.translate(low, "\t\r\x0b\x0c", "    ")).otherwise(low)


def line_words(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n_lines (its lines), line_no, h (hashes of the line's different words) and n, their number,
    for each line (written).  A null or empty text has 0 lines, and one row without words like any other blank line.
    """
    # a column of its own, so that each text is lower-cased once and not for every mention
    low = docs.select("doc_id", _text_hash().alias("th"), F.lower(F.col("text").cast("string")).alias("low"))
    # cut once, and counted below the generator: beside it, the count would be made for each line
    cut = low.select("doc_id", "th", F.coalesce(F.col("low"), F.lit("")).alias("low"), lines_of(_plain(F.col("low"))).alias("lines"))
    cut = cut.select("doc_id", "th", "lines", F.when(F.col("low") == "", F.lit(0)).otherwise(F.size("lines")).alias("n_lines"))
    # a cut is never empty; the outer form keeps Spark from adding a filter on its size, which would cut each text again
    lines = cut.select("doc_id", "th", "n_lines", F.posexplode_outer("lines").alias("line_no", "line"))
    # one space to split at is much faster than a pattern; what is empty between two spaces leaves as a hash
    h = F.array_remove(F.array_distinct(F.transform(F.split("line", " "), lambda t: F.xxhash64(t))), F.xxhash64(F.lit("")))
    # word hashes repeat: a dictionary that holds a file's vocabulary takes about a third of the plain longs
    counted = lines.select("doc_id", "th", "n_lines", "line_no", h.alias("h")).withColumn("n", F.size("h"))
    return saved(counted, "line-words", {"parquet.dictionary.page.size": str(16 << 20)})


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def rarity_classes(hashes: DataFrame) -> Column:
    """Class (48 for the rarest) of each hash bucket's number of words, above 56 zero bits, as one constant array.

    The counts run over every word of ``h``; what reaches the driver is one small number for
    each of the fixed buckets.
    """
    size = 1 << BUCKET_BITS
    counted = hashes.groupBy(F.col("h").bitwiseAND(F.lit(size - 1)).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    classes = [48] * size
    found = counted.select("b", F.least(F.lit(63), F.floor(F.log2(F.col("n") + 1) * 2)).cast("int").alias("c")).toPandas()
    for b, c in zip(found["b"], found["c"]):
        classes[b] = 48 + c
    return F.split(F.lit(",".join(str(c << 56) for c in classes)), ",").cast("array<bigint>")


def _keys(hashes: Column, classes: Column) -> Column:
    """Sorted word keys: rarity class above 56 bits of the hash."""
    size = 1 << BUCKET_BITS

    def key(h: Column) -> Column:
        found = F.get(classes, h.bitwiseAND(F.lit(size - 1)).cast("int"))
        # never null, which lets the sort run over plain longs
        return F.coalesce(found.bitwiseOR(h.bitwiseAND(F.lit(_LOW56))), F.lit(0).cast("long"))
    return F.sort_array(F.transform(hashes, key))


def _prefix_size(n: Column) -> Column:
    return n - F.ceil(n * NUM / DEN).cast("int") + 1


def _parity(hashes: Column, half: bool) -> Column:
    """Parity of 64 word buckets, as the bits of a long: of all words, or of the half that another bit of the hash picks.

    The two together are the parity of 128 buckets.  A shift takes its count modulo 64.
    """
    def bit(h: Column) -> Column:
        one = F.shiftrightunsigned(h, 50).bitwiseAND(F.lit(1)) if half else F.lit(1).cast("long")
        return F.call_function("shiftleft", one, F.shiftrightunsigned(h, 40).cast("int"))
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(bit(h)))


def distinct_lines(words: DataFrame) -> DataFrame:
    """Lines with equal word sets as one row at their first position (written): id, pos, n, s1, s2, prefix."""
    hashed = words.filter("n > 0")
    classes = rarity_classes(hashed.select(F.explode("h").alias("h")))
    keyed = hashed.withColumn("keys", _keys(F.col("h"), classes))
    n = F.col("n")
    rows = keyed.select(
        F.struct("doc_id", "th", "line_no").alias("pos"), F.xxhash64("keys").alias("k1"), F.xxhash64("keys", F.lit(1)).alias("k2"),
        n.alias("n"), _parity(F.col("h"), False).alias("s1"),
        F.when(n > SMALL, _parity(F.col("h"), True)).otherwise(F.lit(0).cast("long")).alias("s2"),
        F.transform(F.slice("keys", F.lit(1), _prefix_size(n)), lambda k: F.hash(k)).alias("prefix"))
    one = rows.groupBy("k1", "k2").agg(F.min("pos").alias("pos"), F.first("n").alias("n"), F.first("s1").alias("s1"),
                                       F.first("s2").alias("s2"), F.first("prefix").alias("prefix"))
    return saved(one.select(F.monotonically_increasing_id().alias("id"), "pos", "n", "s1", "s2", "prefix"), "lines")


def _index(lines: DataFrame) -> DataFrame:
    """One narrow row for each prefix word; ``nm`` holds the line's size and the most words of a line
    that shares this word, none before it, and is similar: the overlap is at most this word and those after it.

    Under ``NUM`` words only equal sets are similar, and those are one line already.
    """
    words = lines.filter(F.col("n") >= NUM).select("id", F.col("n").cast("long").alias("n"), "s1", "s2", F.posexplode("prefix").alias("i", "word"))
    most = F.floor((F.col("n") - F.col("i")) * (NUM + DEN) / NUM).cast("long") - F.col("n")
    return words.select("word", "id", F.shiftleft("n", 32).bitwiseOR(most).alias("nm"), "s1", "s2")


def _may_match(a: str, b: str) -> Column:
    """Length, positional and sketch filters at the first word that two lines share; ``a`` and ``b`` begin the column names.

    The filters that reject most for the least work come first, as many pairs share a word.
    """
    na, nb = (F.shiftright(F.col(f"{x}nm"), 32) for x in (a, b))
    # the most words hold the length filter, too: at a line's first word they are 5/4 of its own
    ma, mb = (F.col(f"{x}nm").bitwiseAND(F.lit((1 << 32) - 1)) for x in (a, b))
    every, half = (F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}")) for s in ("s1", "s2"))
    allowed = (na + nb) * (DEN - NUM)
    finer = (F.bit_count(half) + F.bit_count(every.bitwiseXOR(half))) * (NUM + DEN) <= allowed
    short = (F.col(f"{a}s2") == 0) | (F.col(f"{b}s2") == 0)
    return (nb <= ma) & (na <= mb) & (F.bit_count(every) * (NUM + DEN) <= allowed) & (short | finer)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """id of every b of the pairs (a, b) whose word sets are similar."""
    a = sets.select(F.col("id").alias("a"), F.col("h").alias("a_h"))
    b = sets.select(F.col("id").alias("b"), F.col("h").alias("b_h"))
    shared = F.size(F.array_intersect("a_h", "b_h"))
    similar = shared * (NUM + DEN) >= (F.size("a_h") + F.size("b_h")) * NUM
    return pairs.join(a, "a").join(b, "b").filter(similar).select(F.col("b").alias("id")).distinct()


def near_repeats(words: DataFrame, lines: DataFrame) -> DataFrame:
    """doc_id, th and line_no of the distinct lines that are similar to an earlier distinct line (written)."""
    index = _index(lines)
    # both sides under the same column names, so that the index is shuffled once and read by both
    matched = index.alias("b").join(index.alias("a"), (F.col("a.word") == F.col("b.word")) & _may_match("a.", "b.")
                                    & (F.col("a.id") != F.col("b.id")), "left_semi")
    marked = saved(matched, "line-marks")
    flagged = saved(marked.join(lines.select("id", "pos"), "id"), "line-flags")
    at = saved(flagged.select("id", "pos").distinct(), "line-places")
    # the word sets of these lines: a key filter comes before the join, so other lines do not move
    wanted = at.select("id", F.col("pos.doc_id").alias("d"), F.col("pos.th").alias("t"), F.col("pos.line_no").alias("l"))
    here = maybe_in(words, F.xxhash64("doc_id", "th", "line_no"), wanted, F.xxhash64("d", "t", "l"))
    met = here.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")) & (F.col("line_no") == F.col("l")))
    sets = saved(met.select("id", "h").dropDuplicates(["id"]), "line-sets")
    # the earliest line under each word
    columns = [c for c in flagged.columns if c != "word"]
    lead = flagged.groupBy("word").agg(F.min(F.struct("pos", *[c for c in columns if c != "pos"])).alias("f")).select(
        "word", *[F.col(f"f.{c}").alias(f"a_{c}") for c in columns])

    def pairs(later: DataFrame, earlier: DataFrame) -> DataFrame:
        named = later.select("word", *[F.col(c).alias(f"b_{c}") for c in columns])
        met = named.join(earlier, "word").filter((F.col("a_pos") < F.col("b_pos")) & _may_match("a_", "b_"))
        return met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()

    decided = saved(_verified(pairs(flagged, lead), sets), "line-near")
    # what is left, against all others
    open_ = flagged.join(decided, "id", "left_anti")
    others = flagged.select("word", *[F.col(c).alias(f"a_{c}") for c in columns])
    every = decided.unionByName(_verified(pairs(open_, others), sets)).distinct()
    found = saved(at.join(every, "id", "left_semi").select("pos.*"), "line-near")
    discard(marked, at, flagged, sets, decided)
    return found


def gone_lines(words: DataFrame) -> DataFrame:
    """doc_id, th and the sorted numbers of the removed lines, for each different document that has any (written).

    A line with a word goes unless it is the first of its set and not near an earlier one.  64 lines
    of a document are the bits of a long, so no line is a row of a join and sums hold numbers only.
    """
    lines = distinct_lines(words)
    near = near_repeats(words, lines)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    bit = F.call_function("shiftleft", one, F.col("line_no").bitwiseAND(F.lit(63)))
    kinds = {"worded": words.filter("n > 0"), "first": lines.select("pos.*"), "near": near}
    marks = [rows.select("doc_id", "th", F.shiftright("line_no", 6).alias("part"), *[(bit if k == kind else none).alias(k) for k in kinds])
             for kind, rows in kinds.items()]
    parts = marks[0].unionByName(marks[1]).unionByName(marks[2]).groupBy("doc_id", "th", "part").agg(
        *[F.bit_or(k).alias(k) for k in kinds])
    lost = F.col("worded").bitwiseAND(F.bitwise_not("first").bitwiseOR(F.col("near")))
    held = parts.select("doc_id", "th", "part", lost.alias("lost")).filter("lost != 0").groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_list(F.struct("part", "lost"))).alias("parts"))
    numbers = F.transform("parts", lambda p: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(p["lost"], i) == 1), lambda i: p["part"] * 64 + i))
    out = saved(held.select("doc_id", "th", F.flatten(numbers).alias("gone")), "line-gone")
    discard(lines, near)
    return out


def _with_gone(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` (doc_id, __th) with the column __gone."""
    held = gone.select(F.col("doc_id").alias("__doc"), F.col("th").alias("__of"), F.col("gone").alias("__gone"))
    joined = rows.join(held, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__th") == F.col("__of")), "left")
    return joined.drop("__doc", "__of")


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines and the sorted numbers of the removed lines, for each row."""
    words = line_words(docs)
    gone = gone_lines(words)
    # each row of docs has one line 0, so the texts are not read again
    rows = saved(words.filter("line_no = 0").select("doc_id", F.col("th").alias("__th"), F.col("n_lines").cast("long")), "line-counts")
    discard(words)
    joined = _with_gone(rows, gone)
    return joined.select("doc_id", "n_lines", F.coalesce("__gone", F.array().cast("array<int>")).alias("removed"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines taken out of ``text`` (``n_chars`` follows, if there).

    Documents that lose all their non-blank lines go.  All columns stay as they are.
    """
    words = line_words(docs)
    gone = gone_lines(words)
    discard(words)
    # the removed line numbers are a plain column of the joined side, so no later filter repeats work for each line
    rows = _with_gone(docs.withColumn("__th", _text_hash()), gone)
    left = F.array_join(F.filter(lines_of(F.col("text")), lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(left)
    # a generator, so that the text is put together once and no filter on it is pushed down
    made = rows.select("*", F.explode(F.filter(F.array(text), lambda t: F.col("__gone").isNull() | (F.trim(t) != ""))).alias("__text"))
    changed = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(
            F.char_length("__text").cast(docs.schema["n_chars"].dataType))
    return made.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _report(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                       F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, n_lines, n_removed and the removed lines' numbers."""
    return _report(removed_lines(read(spark, sf_dir, "documents")))


ORACLE = r"""
WITH x AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no FROM documents),
t AS (SELECT doc_id, line_no, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '\s+'),
             lambda w: w <> ''))) AS words FROM x),
j AS (SELECT * FROM t WHERE len(words) >= 1),
c AS (SELECT words, min((doc_id, line_no)) AS pos FROM j GROUP BY words),
l AS (SELECT row_number() OVER (ORDER BY pos) AS id, words, len(words) AS n, pos FROM c),
k AS (SELECT id, n, unnest(words) AS w FROM l),
f AS (SELECT w, count(*) AS df FROM k GROUP BY w),
p AS (SELECT id, n, w, row_number() OVER (PARTITION BY id ORDER BY df, w) AS i FROM k JOIN f USING (w)),
q AS (SELECT * FROM p WHERE 5 * i <= n + 5),
m AS (SELECT DISTINCT a.id AS a, b.id AS b FROM q a JOIN q b ON a.w = b.w AND a.id < b.id
      WHERE 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
g AS (SELECT DISTINCT y.id FROM m JOIN l x ON x.id = m.a JOIN l y ON y.id = m.b
      WHERE 9 * len(list_intersect(x.words, y.words)) >= 4 * (x.n + y.n)),
s AS (SELECT pos FROM l WHERE id NOT IN (SELECT id FROM g)),
r AS (SELECT doc_id, line_no FROM j WHERE (doc_id, line_no) NOT IN (SELECT pos FROM s)),
d AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS removed
      FROM r GROUP BY doc_id)
SELECT documents.doc_id, CAST(CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN d ON documents.doc_id = d.doc_id
"""
