"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

Documents are sets of five-word shingles (lower-cased words; a text of one to
four words is one shingle).  Texts with equal sets are one class of copies.

1. One pass gives each document the key of its set and a MinHash signature:
   ``TREES`` trees of ``DEPTH`` values each.
2. In the forest, documents that share a prefix of a tree's values are
   candidates.  Matching begins at the longest prefix and is shortened, all
   trees together, until the recall reaches ``RECALL`` at the least similarity
   that links have: the similarity of the candidate links is estimated from
   whole signatures (of every one, less two standard errors), and a prefix is
   long enough if links as unlike as the least of them are found with that chance.  Links just above the threshold always shorten
   it to the length that finds them; a corpus of close copies alone stops early.
3. Candidates of one connected group are verified exactly, on their full
   shingle sets, in blocks of at most about ``BLOCK`` documents and ``BLOCK_SHINGLES``
   shingles; a group larger than that is dealt over pairs of blocks.  A block
   gives each of its documents a count of links and one link towards the
   smallest document it is connected with, so no list of pairs is ever made.
4. Connected documents form classes.

Defined results: null texts and texts without a word have no shingles, no
links and are a class of their own; repeated rows and exact copies share a
class; ties go to the smallest doc_id, then to a hash of the text; rows that
share a doc_id are told apart by their text; rows without doc_id come last; an
empty table gives an empty result; other columns are ignored or passed on.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import discard, maybe_in, read, saved
from minutebook.llm.units import by_bytes
from minutebook.session import ship_package

WORDS = 5
#: similarity as a fraction
NUM, DEN = 4, 5
TREES, DEPTH = 20, 8
#: prefix lengths, longest first; they find 0.975, 0.998, 0.9996 and 0.99997 of all links at the least similarity
DEPTHS = (8, 6, 5, 4)
RECALL = 0.9995
#: bytes of a signature value: the low bits of a minimum; two different minima agree in them once in 65,536
VALUE = 2
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
_CHUNK = 1 << 19
_RNG = np.random.default_rng(20240501)
_WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_MUL = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_PERM_MUL = _RNG.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_PERM_ADD = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's different shingles."""
    split = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    words = [w for ws in split for w in ws]
    if not words:
        return [np.zeros(0, np.uint64)] * len(texts)
    encoded = [w.encode("utf-8", "replace") for w in words]
    sizes = np.array(list(map(len, encoded)), np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(encoded), np.uint8).astype(np.uint64) + np.uint64(1)
    powers = np.ones(int(sizes.max()), np.uint64)
    powers[1:] = _WORD_BASE
    powers = np.multiply.accumulate(powers)
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    word = _mixed(np.add.reduceat(raw * powers[place], starts) + sizes.astype(np.uint64))
    padded = np.concatenate([word, np.zeros(WORDS, np.uint64)])
    ends = np.cumsum(counts)
    out = []
    mixed = sum((padded[i:len(word) + i] * _SHINGLE_MUL[i] for i in range(WORDS)), np.zeros(len(word), np.uint64))
    mixed = _mixed(mixed)
    for n, end in zip(counts, ends):
        if n == 0:
            out.append(np.zeros(0, np.uint64))
        elif n < WORDS:
            few = word[end - n:end]
            out.append(_mixed((few * _SHINGLE_MUL[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.unique(mixed[end - n:end - WORDS + 1]))
    return out


def signatures(sets: list[np.ndarray]) -> list[bytes]:
    """MinHash values (the low 16 bits of 32-bit minima, little-endian) of non-empty sets."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = np.empty((len(sets), TREES * DEPTH), f"<u{VALUE}")
    for i in range(TREES * DEPTH):
        least = np.minimum.reduceat((joined * _PERM_MUL[i] + _PERM_ADD[i]) >> np.uint64(32), starts)
        values[:, i] = least & np.uint64((1 << 8 * VALUE) - 1)
    return [v.tobytes() for v in values]


def _set_key(shingles: np.ndarray) -> str | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest() if len(shingles) else None


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), k (key of the shingle set, null without words), n (its size) and sig for each row (written)."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", _text_hash().alias("th"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in by_bytes(texts, _CHUNK):
                sets = shingle_sets(texts[lo:hi])
                known = [s for s in sets if len(s)]
                sigs = iter(signatures(known) if known else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array([_set_key(s) for s in sets], pa.string()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([next(sigs) if len(s) else None for s in sets], pa.binary())], names=["doc_id", "th", "k", "n", "sig"])

    return saved(source.mapInArrow(sign, f"doc_id {kind}, th long, k string, n long, sig binary"), "signed")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _chance(s: float, depth: int) -> float:
    """The chance that some tree shares a prefix of this length at similarity s."""
    return 1 - (1 - s ** depth) ** TREES


def _least_similarity(sigs: DataFrame, links: DataFrame) -> float | None:
    """The least similarity, estimated from whole signatures less two standard errors, that links of the threshold may have.

    Every candidate link is looked at.  None where no link comes near the threshold.
    """
    # the end that many links share comes first, while their rows are two numbers
    half = links.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("x")), "a")
    both = half.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("y")), "b").select("x", "y")

    def agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), f"<u{VALUE}").reshape(batch.num_rows, -1) for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array((x == y).sum(1), pa.int64())], names=["agree"])

    values = TREES * DEPTH
    counts = both.mapInArrow(agreement, "agree long").groupBy("agree").count().collect()  # at most one row for each number of values
    near = [s for r in counts for s in [r["agree"] / values] if s + 2 * _error(s) >= NUM / DEN]
    return max(NUM / DEN, min(s - 2 * _error(s) for s in near)) if near else None


def _error(s: float) -> float:
    """The standard error of a similarity estimated from a signature."""
    return (s * (1 - s) / (TREES * DEPTH)) ** 0.5


def forest_links(sigs: DataFrame) -> tuple[DataFrame, int, float]:
    """Candidate links (written), the prefix length reached, and the recall it has at the least similarity of links."""
    for depth in DEPTHS:
        links = saved(_candidates(sigs, depth), f"links-{depth}")
        least = _least_similarity(sigs, links)
        recall = _chance(NUM / DEN if least is None and depth == DEPTHS[0] else least or 1.0, depth)
        if recall >= RECALL or depth == DEPTHS[-1]:
            return links, depth, recall
        discard(links)
    raise AssertionError("unreachable")


def _candidates(sigs: DataFrame, depth: int) -> DataFrame:
    """Links (a, b) that connect each document with the smallest that shares a prefix of ``depth`` with it, in every tree.

    Only the smallest of these is linked with the document itself, the others with that one:
    the members of a large group name the same few, so its links become few when repeats go.
    """
    rows = sigs.select("id", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    prefix = F.expr(f"substring(sig, tree * {VALUE * DEPTH} + 1, {VALUE * depth})")
    nodes = rows.select("id", F.xxhash64("tree", prefix).alias("node"))
    shared = nodes.groupBy("node").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    firsts = (nodes.join(shared, "node").filter(F.col("a") < F.col("id")).groupBy("id")
              .agg(F.min("a").alias("a"), F.collect_set("a").alias("all")))
    ends = F.concat(F.array("id"), F.filter("all", lambda x: x != F.col("a")))
    return firsts.select("a", F.explode(ends).alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id and the smallest id it is connected with, from edges (a, b); written each round.

    Each round takes the smallest label among neighbours and then the label's own label, so
    the number of rounds grows with the logarithm of the longest path.
    """
    edges = saved(edges.select("a", "b").distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("c")), "labels")
    while True:
        spread = (both.join(labels.select(F.col("id").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("m")))
        near = labels.join(spread.withColumnRenamed("a", "id"), "id").select("id", "c", F.least("c", "m").alias("n"))
        jump = labels.select(F.col("id").alias("n"), F.col("c").alias("j"))
        new = saved(near.join(jump, "n", "left").select("id", F.col("c").alias("old"), F.least("n", F.coalesce("j", "n")).alias("c")), "labels")
        labels = new.select("id", "c")
        if new.filter(F.col("old") != F.col("c")).isEmpty():
            return labels


def _linked(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Which sets are similar, as a matrix: rows before ``first`` against the others, or all pairs where it is 0."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(np.concatenate(sets), kind="stable")
    flat, owner = np.concatenate(sets)[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1  # a shingle of one document alone is in no intersection
    column, owner = column[often], owner[often]
    left = np.arange(first) if first else np.arange(len(sets))
    right = np.arange(first, len(sets)) if first else left
    shared = np.zeros((len(left), len(right)), np.float64)
    if len(column):
        _, column = np.unique(column, return_inverse=True)
        for lo in range(0, int(column.max()) + 1, 8192):
            at = slice(*np.searchsorted(column, [lo, lo + 8192]))
            part = np.zeros((len(sets), 8192), np.float32)
            part[owner[at], column[at] - lo] = 1
            shared += part[left] @ part[right].T
    total = sizes[left][:, None] + sizes[right][None, :]
    return np.rint(shared).astype(np.int64) * (NUM + DEN) >= total * NUM


def _verify(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Per document of a block or pair of blocks: linked texts, linked rows, and the smallest connected id."""
    pdf = pdf.sort_values(["side", "id"]).reset_index(drop=True)
    n, first = len(pdf), int((pdf["side"] == 0).sum())
    first = 0 if first == n else first
    links = np.zeros((n, n), bool)
    if first:
        links[:first, first:] = _linked([np.frombuffer(x, np.uint64) for x in pdf["shingles"]], first)
        links |= links.T
    elif n:
        links = _linked([np.frombuffer(x, np.uint64) for x in pdf["shingles"]], 0)
        np.fill_diagonal(links, False)
    rank = pdf["id"].rank(method="first").to_numpy(np.int64)
    label = rank.copy()
    while True:  # smallest label among linked ones, until nothing changes
        new = np.minimum(label, np.where(links, label[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (new == label).all():
            break
        label = new
    by_rank = pdf["id"].to_numpy()[np.argsort(rank)]
    return pd.DataFrame({"id": pdf["id"], "texts": links.sum(1).astype(np.int64),
                         "rows": links @ pdf["copies"].to_numpy(np.int64), "low": by_rank[label - 1]})


def _classed(docs: DataFrame) -> DataFrame:
    """doc_id, th, c (number of the class, null without words), class_id, n_links and n_copies for each row."""
    rows = signed(docs)
    sets = rows.filter("k is not null").groupBy("k").agg(
        F.first("sig").alias("sig"), F.first("n").alias("n"), F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies"))
    sigs = saved(sets.withColumn("id", F.monotonically_increasing_id()), "sets")  # an id stays: the rows are written
    links, _, _ = forest_links(sigs)
    groups = components(links)
    sized = groups.join(sigs.select("id", "k", "copies", "n"), "id")
    blocks = sized.groupBy("c").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = sized.join(blocks, "c").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = saved(members.select("id", "k", "c", "copies", "block", "blocks"), "members")
    here = members.join(_sets_of(docs, rows, members), "k")
    # a block meets itself and every other block of its group
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = here.withColumn("other", other).withColumns({
        "i": F.least("block", "other"), "j": F.greatest("block", "other"),
        "side": F.when(F.col("block") <= F.col("other"), 0).otherwise(1)})
    checked = saved(dealt.select("c", "i", "j", "side", "id", "copies", "shingles").groupBy("c", "i", "j").applyInPandas(
        _verify, "id long, texts long, rows long, low long"), "verified")
    discard(links, members)
    counts = checked.groupBy("id").agg(F.sum("texts").alias("texts"), F.sum("rows").alias("linked"))
    tied = components(checked.filter("low <> id").select(F.col("low").alias("a"), F.col("id").alias("b")))
    named = sigs.select("id", "k", "doc", "copies").join(tied, "id", "left").withColumn("c", F.coalesce("c", "id"))
    lowest = named.groupBy("c").agg(F.min("doc").alias("class_id"))
    per_set = (named.join(lowest, "c").join(counts, "id", "left")
               .select("k", "c", "class_id", "copies", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    out = rows.select("doc_id", "th", "k").join(per_set, "k", "left")
    return out.select("doc_id", "th", "c", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class), n_links (rows linked), n_copies (rows with its set, itself too)."""
    return _classed(docs).drop("th", "c")


def _sets_of(docs: DataFrame, rows: DataFrame, members: DataFrame) -> DataFrame:
    """k and the full shingle set (binary) of every member, from the text of one of its rows.

    A key filter comes before the join, so the texts of other documents do not move.
    """
    ship_package(docs.sparkSession)
    wanted = saved(rows.join(members.select("k"), "k", "left_semi").groupBy("k").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("f")).select(
        F.xxhash64("f.doc_id", "f.th").alias("w")), "wanted")
    source = docs.select(F.xxhash64("doc_id", _text_hash()).alias("key"), F.col("text").cast("string").alias("t"))
    source = maybe_in(source, F.col("key"), wanted, F.col("w")).join(wanted, F.col("key") == F.col("w"), "left_semi").select("t")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for lo, hi in by_bytes(texts, _CHUNK):
                sets = shingle_sets(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array([_set_key(s) for s in sets], pa.string()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["k", "shingles"])

    return source.mapInArrow(full, "k string, shingles binary").filter("k is not null").dropDuplicates(["k"])


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest doc_id, then text hash.

    Rows that repeat a document in full (same id and text) become one; columns stay as they are.
    """
    rows = saved(_classed(docs).select("doc_id", "th", "c"), "classed")
    first = rows.filter("c is not null").groupBy("c").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("f")).select("f.doc_id", "f.th")
    stay = first.unionByName(rows.filter("c is null").select("doc_id", "th")).select(
        F.xxhash64("doc_id", "th").alias("__key"), F.col("doc_id").alias("__doc"), F.col("th").alias("__of"))
    held = docs.withColumns({"__th": _text_hash(), "__key": F.xxhash64("doc_id", _text_hash())})
    same = (held["__key"] == stay["__key"]) & held["doc_id"].eqNullSafe(stay["__doc"]) & (held["__th"] == stay["__of"])
    # one row of each: clustered by the key of the join already
    return held.join(stay, same, "left_semi").dropDuplicates(["__key", "doc_id", "__th"]).select(*docs.columns)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and number of links."""
    return near_classes(read(spark, sf_dir, "documents"))
