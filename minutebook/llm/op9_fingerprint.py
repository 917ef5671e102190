"""Document fingerprints: a Merkle tree over paragraphs and sections, as one string.

A paragraph is a line; its hash covers its text.  A section is a run of
paragraphs that ends where a paragraph's hash says so (about one in four),
so an edit changes the sections it touches and no others; its hash covers its
paragraphs' hashes.  The root covers the sections.  Below the paragraphs lie
blocks: a paragraph's sentences in runs of at most 32 characters (8 in a
text's first 256), each with a short hash.  Blocks tell how alike two
differing texts are, and where inside a paragraph they part.

A fingerprint reads ``root:sections:paragraphs:blocks`` (64, 16, 16 and 8
hexadecimal digits an entry).  Equal texts have equal fingerprints; equal
roots mean equal texts up to collisions of sha256 cut to 64 bits a paragraph.

Only DataFrame functions are used.  Defined results: a null text is an empty
one (one empty paragraph, no blocks); repeated rows follow each other in the
order of their texts; an empty table gives an empty result; other columns
are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import read, with_next

#: a block: up to so many characters of a sentence, with the marks that end it
HEAD_CHARS = 256
HEAD_BLOCK = r"[^.!?\n]{0,8}[.!?\n]{1,4}|[^.!?\n]{1,8}"
BLOCK = r"[^.!?\n]{0,32}[.!?\n]{1,4}|[^.!?\n]{1,32}"
#: a section: paragraph hashes up to one that begins with 0, 4, 8 or c, or the rest
SECTION = "(?:[1235679abdef][0-9a-f]{15})*(?:[048c][0-9a-f]{15}|$)"


def _block_hashes(text: Column) -> Column:
    head = F.regexp_extract_all(F.substring(text, 1, HEAD_CHARS), F.lit(HEAD_BLOCK), 0)
    rest = F.regexp_extract_all(F.substring(text, HEAD_CHARS + 1, 2 ** 31 - 1), F.lit(BLOCK), 0)
    return F.transform(F.concat(head, rest), lambda b: F.substring(F.md5(b.cast("binary")), 1, 8))


def fingerprint(text: Column) -> Column:
    """The fingerprint string of a whole text (not null)."""
    paragraphs = F.array_join(F.transform(F.split(text, "\n"), lambda p: F.substring(F.sha2(p, 256), 1, 16)), "")
    sections = F.array_join(F.transform(
        F.filter(F.regexp_extract_all(paragraphs, F.lit(SECTION), 0), lambda s: s != ""),
        lambda s: F.substring(F.sha2(s, 256), 1, 16)), "")
    return F.concat_ws(":", F.sha2(sections, 256), sections, paragraphs, F.array_join(_block_hashes(text), ""))


def _level(print_: Column, level: int, digits: int) -> Column:
    """The hashes of one level of a fingerprint (0 root, 1 sections, 2 paragraphs, 3 blocks)."""
    return F.regexp_extract_all(F.element_at(F.split(print_, ":"), level + 1), F.lit(f"[0-9a-f]{{{digits}}}"), 0)


def _dice(a: Column, b: Column) -> Column:
    """2 x shared / all, over distinct entries; 1 for two empty lists."""
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two fingerprints: 1 where they agree, else the share of blocks they have in common.

    The larger of two shares: of distinct blocks anywhere, and of blocks at the same
    place (which also counts blocks that a text repeats).
    """
    blocks_a, blocks_b = _level(a, 3, 8), _level(b, 3, 8)
    placed = F.size(F.filter(F.zip_with(blocks_a, blocks_b, lambda x, y: x == y), lambda same: F.coalesce(same, F.lit(False))))
    aligned = placed / F.greatest(F.size(blocks_a), F.size(blocks_b), F.lit(1))
    return F.when(a == b, F.lit(1.0)).otherwise(
        F.greatest(_dice(F.array_distinct(blocks_a), F.array_distinct(blocks_b)), aligned))


def _common(x: Column, y: Column) -> Column:
    """How many entries two lists have in common from their beginnings."""
    at = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), False)
    return F.when(at == 0, F.size(x)).otherwise(at - 1).cast("int")


def _from(x: Column, n: Column) -> Column:
    return F.slice(x, n + 1, F.size(x))


def _counted(side: str, part: Column) -> Column:
    """The paragraphs (struct of hash and place) of one side, as (hash, how often it occurred so far, side, place)."""
    ordered = F.sort_array(part)
    # equal hashes follow each other: each run of them is numbered from 1
    runs = F.regexp_extract_all(F.array_join(F.transform(ordered, lambda x: x["h"]), ""), F.lit(r"([0-9a-f]{16})\1*+"), 0)
    nth = F.flatten(F.transform(runs, lambda r: F.sequence(F.lit(1), (F.length(r) / 16).cast("int"))))
    return F.zip_with(ordered, nth, lambda x, n: F.struct(x["h"].alias("h"), n.alias("n"), F.lit(side).alias("side"), x["at"].alias("at")))


def with_edits(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adds where fingerprint ``b`` differs from ``a``: the paragraphs (from 0, joined by commas) that are ``removed`` (of a),
    ``added`` (of b) and ``moved`` (of b: in both, in another order).

    Descends from the root: equal roots give empty lists; the leading and trailing sections that agree are passed over by
    their hashes, then the paragraphs that agree in the first and last differing section.  Of the paragraphs between,
    the n-th occurrence of one matches the n-th on the other side; the rest is removed or added.  A rewritten paragraph
    is one removed and one added.
    """
    lengths = F.transform(F.filter(F.regexp_extract_all(F.element_at(F.split(a, ":"), 3), F.lit(SECTION), 0), lambda s: s != ""),
                          lambda s: (F.length(s) / 16).cast("int"))

    def total(x):
        return F.aggregate(x, F.lit(0), lambda acc, n: acc + n)
    out = df.withColumns({"__pa": _level(F.col(a), 2, 16), "__pb": _level(F.col(b), 2, 16), "__n": lengths,
                          "__sa": _level(F.col(a), 1, 16), "__sb": _level(F.col(b), 1, 16)})
    same = F.col(a) == F.col(b)
    lead = total(F.slice("__n", F.lit(1), _common(F.col("__sa"), F.col("__sb"))))
    tail = total(F.slice(F.reverse("__n"), F.lit(1), _common(F.reverse("__sa"), F.reverse("__sb"))))
    out = out.withColumns({"__lead": F.when(same, 0).otherwise(lead), "__tail": F.when(same, 0).otherwise(tail)})
    out = out.withColumns({
        "__lead": F.col("__lead") + _common(_from(F.col("__pa"), F.col("__lead")), _from(F.col("__pb"), F.col("__lead"))),
        "__tail": F.col("__tail") + _common(_from(F.reverse("__pa"), F.col("__tail")), _from(F.reverse("__pb"), F.col("__tail")))})
    out = out.withColumn("__tail", F.least("__tail", F.least(F.size("__pa"), F.size("__pb")) - F.col("__lead")))

    def between(p):
        part = F.slice(p, F.col("__lead") + 1, F.size(p) - F.col("__lead") - F.col("__tail"))
        return F.transform(part, lambda h, i: F.struct(h.alias("h"), (i + F.col("__lead")).alias("at")))
    nothing = F.array().cast("array<struct<h:string,n:int,side:string,at:int>>")
    both = F.sort_array(F.concat(_counted("a", between("__pa")), _counted("b", between("__pb"))))
    out = out.withColumn("__all", F.when(same, nothing).otherwise(both))
    # an occurrence on both sides stands twice in a row, a before b
    after = F.concat(_from(F.col("__all"), F.lit(1)), F.array(F.lit(None)))
    before = F.concat(F.array(F.lit(None)), F.col("__all"))

    def pair(x, y):
        return F.coalesce((x["h"] == y["h"]) & (x["n"] == y["n"]), F.lit(False))
    out = out.withColumns({
        "__gone": F.zip_with("__all", after, lambda x, y: F.when((x["side"] == "a") & ~pair(x, y), x["at"])),
        "__new": F.zip_with("__all", F.slice(before, F.lit(1), F.size("__all")), lambda x, y: F.when((x["side"] == "b") & ~pair(x, y), x["at"])),
        "__kept": F.array_sort(F.filter(F.zip_with("__all", after, lambda x, y: F.when(
            (x["side"] == "a") & pair(x, y), F.struct(x["at"].alias("a"), y["at"].alias("b")))), lambda k: k.isNotNull()))})
    places = F.transform("__kept", lambda k: k["b"])
    moved = F.zip_with(places, F.sort_array(places), lambda x, y: F.when(x != y, x))

    def numbers(x):
        return F.array_join(F.sort_array(F.filter(x, lambda n: n.isNotNull())).cast("array<string>"), ",")
    out = out.withColumns({"removed": numbers(F.col("__gone")), "added": numbers(F.col("__new")), "moved": numbers(moved)})
    return out.drop("__pa", "__pb", "__n", "__sa", "__sb", "__lead", "__tail", "__all", "__gone", "__new", "__kept")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and fingerprint of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("fingerprint", fingerprint(F.col("text")))


def with_edit(printed: DataFrame) -> DataFrame:
    """Each row's edited text: its last third replaced by as much of the next document's beginning."""
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    rows = with_next(printed, "doc_id", ["text"], ["text", "fingerprint"], descending=True)
    return (rows.withColumn("n_chars", n.cast("long"))
            .withColumn("edited", F.concat(F.expr("left(text, char_length(text) - int(floor(char_length(text) / 3)))"),
                                           F.substring(F.col("next_text"), F.lit(1), third))))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint, its edited text's, how alike they and the next document's are, and which
    paragraphs the edit removed, added and moved."""
    rows = with_edit(fingerprints(read(spark, sf_dir, "documents")))
    rows = with_edits(rows.withColumn("edited_fingerprint", fingerprint(F.col("edited"))), "fingerprint", "edited_fingerprint")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), "removed", "added", "moved")


def _sql_print(text: str) -> str:
    paragraphs = f"array_to_string(list_transform(string_split({text}, chr(10)), lambda p: substr(sha256(p), 1, 16)), '')"
    sections = (f"array_to_string(list_transform(list_filter(regexp_extract_all({paragraphs}, "
                f"'(?:[1235679abdef][0-9a-f]{{15}})*(?:[048c][0-9a-f]{{15}}|$)'), lambda s: s <> ''), "
                "lambda s: substr(sha256(s), 1, 16)), '')")
    blocks = (f"array_to_string(list_transform(list_concat(regexp_extract_all(substr({text}, 1, {HEAD_CHARS}), '{HEAD_BLOCK}'), "
              f"regexp_extract_all(substr({text}, {HEAD_CHARS + 1}), '{BLOCK}')), lambda b: substr(md5(b), 1, 8)), '')")
    return f"sha256({sections}) || ':' || {sections} || ':' || {paragraphs} || ':' || {blocks}"


def _sql_like(a: str, b: str) -> str:
    def every(x):
        return f"regexp_extract_all(string_split({x}, ':')[4], '[0-9a-f]{{8}}')"

    def blocks(x):
        return f"list_distinct({every(x)})"
    both = f"(len({blocks(a)}) + len({blocks(b)}))"
    placed = f"len(list_filter(list_zip({every(a)}, {every(b)}), lambda z: z[1] = z[2]))"
    return (f"CASE WHEN {a} = {b} OR {both} = 0 THEN 1.0::DOUBLE "
            f"ELSE greatest(2.0::DOUBLE * len(list_intersect({blocks(a)}, {blocks(b)})) / {both}, "
            f"{placed}::DOUBLE / greatest(len({every(a)}), len({every(b)}), 1)) END")


def _sql_common(x: str, y: str) -> str:
    same = f"list_transform(list_zip({x}, {y}), lambda z: coalesce(z[1] = z[2], false))"
    return f"coalesce(nullif(list_position({same}, false), 0) - 1, len({x}))"


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (SELECT *, {_sql_print('text')} AS fingerprint FROM d),
n AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text,
             coalesce(lead(fingerprint) OVER w, first_value(fingerprint) OVER w) AS next_fingerprint
      FROM f WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, text)),
e AS (SELECT *, substr(text, 1, length(text) - length(text) // 3) || substr(next_text, 1, length(text) // 3) AS edited FROM n),
g AS MATERIALIZED (SELECT row_number() OVER () AS rid, *, {_sql_print('edited')} AS edited_fingerprint FROM e),
p AS (SELECT rid, regexp_extract_all(string_split(fingerprint, ':')[3], '[0-9a-f]{{16}}') AS pa,
             regexp_extract_all(string_split(edited_fingerprint, ':')[3], '[0-9a-f]{{16}}') AS pb
      FROM g WHERE fingerprint <> edited_fingerprint),
c AS (SELECT *, {_sql_common('pa', 'pb')} AS lead, {_sql_common('list_reverse(pa)', 'list_reverse(pb)')} AS tail FROM p),
r AS (SELECT rid, pa, pb, lead, least(tail, least(len(pa), len(pb)) - lead) AS tail FROM c),
x AS (SELECT rid, 'a' AS side, unnest(pa) AS h, unnest(range(0, len(pa))) AS place, lead, len(pa) - tail AS stop FROM r
      UNION ALL SELECT rid, 'b', unnest(pb), unnest(range(0, len(pb))), lead, len(pb) - tail FROM r),
y AS (SELECT rid, side, h, place, row_number() OVER (PARTITION BY rid, side, h ORDER BY place) AS nth FROM x WHERE place >= lead AND place < stop),
m AS (SELECT coalesce(a.rid, b.rid) AS rid, a.place AS a_at, b.place AS b_at FROM (FROM y WHERE side = 'a') a
      FULL JOIN (FROM y WHERE side = 'b') b ON a.rid = b.rid AND a.h = b.h AND a.nth = b.nth),
o AS (SELECT rid, a_at, b_at, row_number() OVER (PARTITION BY rid, a_at IS NULL OR b_at IS NULL ORDER BY a_at) AS ra,
             row_number() OVER (PARTITION BY rid, a_at IS NULL OR b_at IS NULL ORDER BY b_at) AS rb FROM m),
t AS (SELECT rid, string_agg(CAST(a_at AS VARCHAR), ',' ORDER BY a_at) FILTER (WHERE b_at IS NULL) AS removed,
             string_agg(CAST(b_at AS VARCHAR), ',' ORDER BY b_at) FILTER (WHERE a_at IS NULL) AS added,
             string_agg(CAST(b_at AS VARCHAR), ',' ORDER BY b_at) FILTER (WHERE a_at IS NOT NULL AND b_at IS NOT NULL AND ra <> rb) AS moved
      FROM o GROUP BY rid)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       {_sql_like('fingerprint', 'edited_fingerprint')} AS near_edited,
       {_sql_like('fingerprint', 'next_fingerprint')} AS near_next,
       coalesce(removed, '') AS removed, coalesce(added, '') AS added, coalesce(moved, '') AS moved
FROM g LEFT JOIN t USING (rid)
"""
