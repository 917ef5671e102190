"""Filter interaction audit with a counting-Bloom duplicate prepass.

Five filters judge whole texts (words are maximal runs of other characters
than ASCII white space, case-sensitive):

A  under 50 words;
B  100 * distinct words < 65 * words;
C  100 * capitals A-Z > 5 * code points;
D  holds one of ``#$%&*|``;
E  identical to the text of a smaller doc_id, anywhere in the table.

1. One pass over the texts writes one narrow row per document: the filters A
   to D as bits of a mask, and hashes of the text.
2. Counting-Bloom sketch: the tasks count their hashes in cells, ``CELLS_PER_TEXT``
   cells a document in blocks of ``BLOCK_CELLS`` (a hash picks the block and
   three cells in it); the merged counts saturate at two.  A text with a cell
   counted once is unique for certain.
3. Only texts whose cells were all counted twice or more are shuffled, and
   grouped by their full text (copies are combined before the shuffle); a
   group of more than one gives its smallest doc_id.
4. Rows of equal text, part, mask and labels are counted before they meet
   that table, so a large group of copies is a few rows there.  The outcome is
   a count for each part, mask and label: additive, and at most 128 a part.
5. All orders of the filters are read off those counts.  A filter's Shapley
   value: a text that fails k filters is removed by each of them in 120/k of
   the 120 orders.

What is broadcast are the sketch's bits: ``MAX_BLOCKS`` blocks, 64 MB, at most.
A larger corpus fills the cells more densely, so more unique texts are
shuffled; the results stay the same.  Rows find their group by SHA-256 of the
text; the groups themselves are made on full texts.

Defined results: null texts count as empty (A fails, and E by the first of
several empty ones); a null source is the part ""; rows without doc_id never
fail E and never make others fail it, and have no labels; rows that repeat the
smallest doc_id of a text pass E, all of them; repeated label rows count once
(1 if any says so); an empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import discard, read, saved
from minutebook.session import ship_package

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: bytes of UTF-8 that begin no character
CONTINUATION = bytes(range(0x80, 0xC0))
BLOCK_CELLS, CELLS_PER_TEXT, MAX_BLOCKS = 4096, 8, 1 << 17
#: where a text's three cells are read from its second hash
SHIFTS = (0, 12, 24)
#: rows that a task counts before it hands on what it has
_FLUSH = 1 << 19


def failed_of_text(raw: bytes) -> int:
    """The filters A to D that a whole text (UTF-8) fails, as bits."""
    words = raw.split()  # bytes split at the six ASCII blanks only
    chars = len(raw.translate(None, CONTINUATION))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return ((len(words) < MIN_WORDS) + 2 * (100 * len(set(words)) < DISTINCT_PERCENT * len(words))
            + 4 * (100 * capitals > CAPITAL_PERCENT * chars) + 8 * (len(raw.translate(None, SYMBOLS)) < len(raw)))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _hashes(text: Column) -> list[Column]:
    """h1 picks a block, h2 the cells."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(12), text).alias("h2")]


def features(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (A to D), h1, h2, sha for each row (written)."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), _text().alias("t")).select(
        "doc_id", "part", *_hashes(F.col("t")), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha"),
        F.col("t").cast("binary").alias("t"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [failed_of_text(x.as_py()) for x in batch.column(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(masks, pa.int32())],
                                             names=["doc_id", "part", "h1", "h2", "sha", "mask"])

    return saved(source.mapInArrow(judged, f"doc_id {kind}, part string, h1 long, h2 long, sha binary, mask int"), "features")


def _cells(h2: np.ndarray, cells: int) -> np.ndarray:
    """Three cells of a block for each hash."""
    return np.stack([(h2 >> np.int64(s)) & np.int64(cells - 1) for s in SHIFTS], 1)


def sketch(rows: DataFrame, n_rows: int, max_blocks: int = MAX_BLOCKS, block_cells: int = BLOCK_CELLS) -> tuple[DataFrame, int]:
    """block and bits (as longs: cells counted twice or more) of the blocks that have any, and the number of blocks."""
    wanted = max(1, -(-n_rows * CELLS_PER_TEXT // block_cells))
    blocks = min(max_blocks, 1 << (wanted - 1).bit_length())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial sketches: touched cells and their counts, by block."""
        held, size = [], 0

        def partial() -> pa.RecordBatch:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            block, first = np.unique(cell // block_cells, return_index=True)
            ends = [*first[1:], len(cell)]
            low, n = (cell % block_cells).astype("<u2"), np.minimum(n, 2).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array([low[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                 pa.array([n[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())], names=["block", "cells", "n"])

        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            # cells of one text that coincide count once
            cells = np.sort(_cells(h2, block_cells), 1)
            again = np.concatenate([np.zeros((len(cells), 1), bool), cells[:, 1:] == cells[:, :-1]], 1)
            held.append(((np.mod(h1, blocks) * block_cells)[:, None] + cells)[~again])
            size += len(h1)
            if size >= _FLUSH:
                yield partial()
                held, size = [], 0
        if size:
            yield partial()

    def merged(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(block_cells, np.int64)
        for cells, n in zip(pdf["cells"], pdf["n"]):
            np.add.at(total, np.frombuffer(cells, "<u2"), np.frombuffer(n, np.uint8).astype(np.int64))
        if not (total > 1).any():
            return pd.DataFrame({"block": pd.Series([], dtype="int64"), "bits": pd.Series([], dtype=object)})
        bits = np.packbits(total > 1, bitorder="little").view("<i8")
        return pd.DataFrame({"block": [key[0]], "bits": [bits.tolist()]})

    partials = rows.select("h1", "h2").mapInArrow(counted, "block long, cells binary, n binary")
    return partials.groupBy("block").applyInPandas(merged, "block long, bits array<long>"), blocks


def repeated(docs: DataFrame, rows: DataFrame, max_blocks: int = MAX_BLOCKS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """sha and lo (smallest doc_id) of each text that more than one row has (written)."""
    found, blocks = sketch(rows, rows.count(), max_blocks, block_cells)
    held = saved(found, "sketch")
    texts = docs.select("doc_id", _text().alias("t")).select("doc_id", "t", *_hashes(F.col("t")))
    texts = texts.withColumn("b", F.pmod("h1", F.lit(blocks).cast("long")))

    def counted_twice(shift: int) -> Column:
        cell = F.shiftright("h2", shift).bitwiseAND(F.lit(block_cells - 1)).cast("int")
        return F.getbit(F.element_at("bits", F.shiftright(cell, 6) + 1), cell.bitwiseAND(F.lit(63))) == 1

    # at most MAX_BLOCKS blocks of 512 bytes: this bound does not grow with the corpus
    maybe = texts.join(F.broadcast(held), F.col("b") == F.col("block")).filter(
        counted_twice(SHIFTS[0]) & counted_twice(SHIFTS[1]) & counted_twice(SHIFTS[2]))
    groups = maybe.groupBy("t").agg(F.min("doc_id").alias("lo"), F.count(F.lit(1)).alias("n")).filter("n > 1 and lo is not null")
    out = saved(groups.select(F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha"), "lo"), "repeated")
    discard(held)
    return out


def mask_counts(docs: DataFrame, labels: DataFrame, max_blocks: int = MAX_BLOCKS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """part, mask (A to E), good, toxic and n: the additive counts."""
    rows = features(docs)
    again = repeated(docs, rows, max_blocks, block_cells)
    marks = labels.groupBy("doc_id").agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
                                         F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    key = ["sha", "part", "mask", "good", "toxic"]
    marked = rows.join(marks, "doc_id", "left").select(
        "doc_id", "part", "mask", "sha", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    by_doc = marked.groupBy("doc_id", *key).agg(F.count(F.lit(1)).alias("r"))
    # rows of the smallest doc_id here; rows without one come last
    by_text = by_doc.groupBy(*key).agg(
        F.sum("r").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("r")).otherwise(0)).alias("n_null"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "r")).alias("first"))
    joined = by_text.join(again, "sha", "left")
    at_lowest = F.when(F.col("first.doc_id") == F.col("lo"), F.col("first.r")).otherwise(0)
    late = F.when(F.col("lo").isNotNull(), F.col("n") - F.col("n_null") - at_lowest).otherwise(0)
    split = joined.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - late).alias("n")),
        F.struct((F.col("mask") + F.lit(16)).alias("mask"), late.alias("n")))))
    out = saved(split.filter("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")), "mask-counts")
    discard(rows, again)
    return out


def audit(counts: DataFrame) -> DataFrame:
    """All orders and steps of each part, from its mask counts."""
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = per_part.select("part", "c", F.explode(orders).alias("filter_order")).select(
        "part", "c", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bit(at: Column) -> Column:
        letter = F.ascii(F.substring(F.col("filter_order"), at, F.lit(1))) - ord("A")
        return F.element_at(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), letter + 1)

    before = sum((F.when(F.lit(i) < F.col("step"), bit(F.lit(i))).otherwise(0) for i in range(1, len(FILTERS))), F.lit(0))
    rows = steps.withColumns({"bit": bit(F.col("step")), "before": before})

    def total(test, times=lambda m: F.lit(1)) -> Column:
        return F.aggregate("c", F.lit(0).cast("long"), lambda acc, s: acc + F.when(test(s["mask"], s), s["n"] * times(s["mask"])).otherwise(0))

    def fails(m: Column) -> Column:
        return m.bitwiseAND(F.col("bit")) != 0

    def gone(m: Column) -> Column:
        return m.bitwiseAND(F.col("before")) != 0

    n_orders = 120
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m, s: ~fails(m) & ~gone(m)).alias("kept"),
        total(lambda m, s: fails(m) & ~gone(m)).alias("removed"),
        total(lambda m, s: fails(m) & gone(m)).alias("redundant"),
        total(lambda m, s: m == F.col("bit")).alias("unique_fails"),
        total(lambda m, s: fails(m) & ~gone(m) & (s["good"] == 1)).alias("good_lost"),
        total(lambda m, s: fails(m) & ~gone(m) & (s["toxic"] == 1)).alias("toxic_lost"),
        total(lambda m, s: fails(m), lambda m: F.element_at(F.array(*[F.lit(n_orders // max(1, k)) for k in range(6)]),
                                                            F.bit_count(m) + 1)).alias("shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, order and step with its counts."""
    return audit(mask_counts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
g AS (SELECT t, min(doc_id) AS lo FROM d GROUP BY t),
f AS (SELECT w.doc_id, part, len(words) < 50 AS fa, 100 * len(list_distinct(words)) < 65 * len(words) AS fb,
        100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 5 * length(w.t) AS fc,
        regexp_matches(w.t, '[#$%&*|]') AS fd, coalesce(g.lo < w.doc_id, false) AS fe,
        coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
      FROM w JOIN g ON w.t = g.t LEFT JOIN labels l ON l.doc_id = w.doc_id),
c AS (SELECT part, CAST(fa AS INT) + 2 * CAST(fb AS INT) + 4 * CAST(fc AS INT) + 8 * CAST(fd AS INT) + 16 * CAST(fe AS INT) AS mask,
        good, toxic, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT filter_order, CAST(step AS INT) AS step, ascii(substr(filter_order, step, 1)) - 65 AS place FROM o, range(1, 6) r(step)),
b AS (SELECT s.*, 1 << place AS bit, (SELECT coalesce(sum(1 << p.place), 0) FROM s p
        WHERE p.filter_order = s.filter_order AND p.step < s.step) AS earlier FROM s),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & CAST(bit + earlier AS INT) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit <> 0 AND mask & CAST(earlier AS INT) = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit <> 0 AND mask & CAST(earlier AS INT) <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN good AND mask & bit <> 0 AND mask & CAST(earlier AS INT) = 0 THEN n ELSE 0 END) AS good_lost,
        sum(CASE WHEN toxic AND mask & bit <> 0 AND mask & CAST(earlier AS INT) = 0 THEN n ELSE 0 END) AS toxic_lost
      FROM c, b GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
