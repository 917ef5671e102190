"""Ranked lexical search by pipelined term partitioning.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII,
only A-Z lower-cased.  A document's score for an item sums, over the item's
terms with repeats, w * ((10^9 * tf) div (1000 * tf + 12 * m)), where
w = floor(1000 * ln((2N + 2) / (2 df + 1))) and m = 75 + (25 n N) div L.

1. One pass over the whole texts makes inverted blocks: up to ``BLOCK_DOCS``
   documents in the order of doc_id, and one row per block and term with the
   places, frequencies and document lengths.  Terms that no item has are left
   out by a bitmap of the items' terms (2^20 hash buckets) that goes to the
   tasks; what the bitmap lets through by chance leaves in an exact join.
2. N, L and df are sums over the blocks.  A term's weight decides its owner,
   one of ``STAGES``: rare terms belong to the first, common ones to the last.
3. Bundles travel through the owners.  A bundle holds an item's sparse
   accumulators (places and integer scores) over one block; an owner meets the
   bundles by cogroup on (block, item group), adds its terms' contributions,
   makes bundles for items that had none, and hands them on as a written
   table.  An accumulator is let go only if even the most that later owners
   can add leaves it below the scores that ``k`` documents of its block have
   already, so the result is exact.
4. Each block's last owner hands on its ``k`` best places an item, ties by
   doc_id; their doc_ids come from the block's row, and ``k`` are kept an item.

A group of a cogroup is one block and at most ``ITEM_GROUP`` items whatever
the tables hold.  Documents beyond the first ``k`` of a block leave only by
the bound of step 3; there is no other cap.

Defined results: null and empty texts have no terms; rows that share a doc_id
are documents of their own, rows without doc_id are ranked after others of
equal score; rows that share an item_id are one item; a document with a score
of 0 is not ranked; an item without terms, or with none that a document has,
gives no row; empty tables give an empty result; other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from minutebook.llm.common import discard, empty, read, saved
from minutebook.session import ship_package

K = 20
STAGES = 4
BLOCK_DOCS, BLOCK_CHARS = 4096, 16 << 20
ITEM_GROUP = 256
BITMAP_BITS = 20
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_INDEX = "block long, term string, places binary, tf binary, n binary, docs long, words long"


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_FOLD).split()


def _bucket(term: bytes) -> int:
    return zlib.crc32(term) & ((1 << BITMAP_BITS) - 1)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term and qtf for each different term of an item (written)."""
    ship_package(items.sparkSession)
    kind = items.schema["item_id"].dataType.simpleString()
    source = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("t"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t.decode("utf-8", "replace"), n) for i, x in enumerate(batch.column(1))
                     for t, n in Counter(terms_of(x.as_py())).items()]
            at = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([f[1] for f in found], pa.string()),
                                              pa.array([f[2] for f in found], pa.int64())], names=["item_id", "term", "qtf"])

    rows = source.mapInArrow(split, f"item_id {kind}, term string, qtf long")
    return saved(rows.groupBy("item_id", "term").agg(F.sum("qtf").alias("qtf")), "item-terms")


def inverted_blocks(docs: DataFrame, terms: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The blocks' rows (written): one with ``ids`` for each block, and one for each of its terms."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema["doc_id"].dataType
    buckets = terms.select(F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("b")).distinct()
    bits = np.zeros(1 << BITMAP_BITS, bool)
    bits[buckets.toPandas()["b"].to_numpy(np.int64)] = True  # at most 2^20 small numbers, whatever the items hold
    wanted = spark.sparkContext.broadcast(np.packbits(bits).tobytes())
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("t"))
    schema = T.StructType([*T._parse_datatype_string(_INDEX).fields, T.StructField("ids", T.ArrayType(kind))])

    def inverted(ids: pa.Array, texts: list[bytes], block: int, bitmap: np.ndarray) -> pa.RecordBatch:
        order = pc.sort_indices(ids, null_placement="at_end").to_pylist()
        postings: dict[bytes, list[int] | None] = {}
        lengths = np.zeros(len(order), "<u4")
        for place, i in enumerate(order):
            words = terms_of(texts[i])
            lengths[place] = len(words)
            for term, tf in Counter(words).items():
                try:
                    held = postings[term]
                except KeyError:
                    held = postings[term] = [] if bitmap[_bucket(term)] else None
                if held is not None:
                    held += (place, tf)
        named, places, tfs, ns = [None], [None], [None], [lengths.tobytes()]
        for term, flat in postings.items():
            if flat is not None:
                pairs = np.array(flat, "<u4").reshape(-1, 2)
                named.append(term.decode("utf-8", "replace"))
                places.append(pairs[:, 0].astype("<u2").tobytes())
                tfs.append(np.ascontiguousarray(pairs[:, 1]).tobytes())
                ns.append(lengths[pairs[:, 0]].tobytes())
        rest = [None] * (len(named) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * len(named), pa.int64()), pa.array(named, pa.string()), pa.array(places, pa.binary()),
             pa.array(tfs, pa.binary()), pa.array(ns, pa.binary()), pa.array([int((lengths > 0).sum()), *rest], pa.int64()),
             pa.array([int(lengths.sum(dtype=np.int64)), *rest], pa.int64()),
             pa.array([ids.take(pa.array(order, pa.int64())).to_pylist(), *rest], pa.list_(ids.type))],
            names=[*schema.names])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).astype(bool)
        block = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, x in enumerate(batch.column(1)):
                raw = x.as_py()
                if texts and (len(texts) == block_docs or size + len(raw) > BLOCK_CHARS):
                    yield inverted(pa.concat_arrays(ids), texts, block, bitmap)
                    ids, texts, size, block = [], [], 0, block + 1
                ids.append(batch.column(0).slice(i, 1))
                texts.append(raw)
                size += len(raw)
        if texts:
            yield inverted(pa.concat_arrays(ids), texts, block, bitmap)

    return saved(source.mapInArrow(blocks, schema), "inverted")


def term_table(blocks: DataFrame, terms: DataFrame) -> tuple[DataFrame, int, int]:
    """term, w and stage of every item term that a document has (written); N and L."""
    total = blocks.filter("term is null").agg(F.sum("docs").alias("n"), F.sum("words").alias("l")).first()
    n, words = total["n"] or 0, total["l"] or 0
    counts = blocks.filter("term is not null").groupBy("term").agg(F.sum(F.length("places") / 2).cast("long").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double")))
    known = terms.select("term").distinct().join(counts, "term").withColumn("w", weight).filter("w > 0")
    heaviest = int(np.floor(1000 * np.log((2 * n + 2) / 3))) + 1 if n else 1
    stage = F.least(F.lit(STAGES - 1), F.floor((F.lit(heaviest) - F.col("w")) * STAGES / heaviest)).cast("int")
    return saved(known.select("term", "w", stage.alias("stage")), "terms"), n, words


def _best(places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The k best by score, then place."""
    return np.lexsort((places, -scores))[:k]


def ranked(docs: DataFrame, items: DataFrame, k: int = K, block_docs: int = BLOCK_DOCS, item_group: int = ITEM_GROUP) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents."""
    spark = docs.sparkSession
    item_kind, doc_kind = items.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    terms = item_terms(items)
    blocks = inverted_blocks(docs, terms, block_docs)
    weights, n_docs, n_words = term_table(blocks, terms)
    result = T.StructType([T.StructField("item_id", item_kind), T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", doc_kind), T.StructField("score", T.LongType())])
    if not n_words:
        return empty(spark, result)
    groups = max(1, -(-terms.select("item_id").distinct().count() // item_group))
    used = terms.join(weights, "term")
    # the most that an item can still get from the owners after each stage: a contribution is below 10^6 * w
    later = [F.sum(F.when(F.col("stage") > s, F.col("qtf") * F.col("w") * 1_000_000).otherwise(0)).alias(f"later{s}") for s in range(STAGES)]
    most = used.groupBy(F.col("item_id").alias("of")).agg(*later)
    after = F.element_at(F.array(*[F.col(f"later{s}") for s in range(STAGES)]), F.col("stage") + 1)
    users = (used.join(most, F.col("item_id").eqNullSafe(F.col("of"))).select(
        "term", "w", "stage", F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int").alias("g"),
        F.struct("item_id", "qtf", after.alias("later")).alias("user"))
        .groupBy("term", "w", "stage", "g").agg(F.collect_list("user").alias("users")))
    users = saved(users, "users")

    bundle = T.StructType([T.StructField("block", T.LongType()), T.StructField("g", T.IntegerType()), T.StructField("item_id", item_kind),
                           T.StructField("places", T.BinaryType()), T.StructField("scores", T.BinaryType())])

    def owner(last: bool):
        def add(key: tuple, carried: pa.Table, owned: pa.Table) -> pa.Table:
            """One owner's terms added to the bundles of one block and item group."""
            held: dict = {}
            later: dict = {}
            for item, places, scores in zip(*(carried.column(c).to_pylist() for c in ("item_id", "places", "scores"))):
                held[item] = (np.frombuffer(places, "<u2"), np.frombuffer(scores, "<i8"))
            added: dict = {}
            for row in owned.to_pylist():
                places = np.frombuffer(row["places"], "<u2")
                tf = np.frombuffer(row["tf"], "<u4").astype(np.int64)
                m = 75 + (25 * np.frombuffer(row["n"], "<u4").astype(np.int64) * n_docs) // n_words
                gain = row["w"] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
                for user in row["users"]:
                    added.setdefault(user["item_id"], []).append((places, gain * user["qtf"]))
                    later[user["item_id"]] = user["later"]
            rows: list[tuple] = []
            for item in {**held, **added}:
                parts = [held[item]] if item in held else []
                parts += added.get(item, [])
                dense = np.zeros(max(int(p[-1]) for p, _ in parts) + 1, np.int64)
                for places, scores in parts:  # places of one part are different and ascending
                    dense[places] += scores
                places = np.flatnonzero(dense)
                scores = dense[places]
                if last:
                    keep = np.sort(_best(places, scores, k))
                elif len(scores) > k and item in later:
                    keep = scores + later[item] >= np.partition(scores, -k)[-k]
                else:
                    keep = np.arange(len(scores))
                rows.append((item, places[keep].astype("<u2").tobytes(), scores[keep].astype("<i8").tobytes()))
            n = len(rows)
            kind = (carried if carried.num_rows else owned).schema
            kind = kind.field("item_id").type if carried.num_rows else kind.field("users").type.value_type.field("item_id").type
            return pa.table({"block": pa.array([key[0].as_py()] * n, pa.int64()), "g": pa.array([key[1].as_py()] * n, pa.int32()),
                             "item_id": pa.array([r[0] for r in rows], kind), "places": pa.array([r[1] for r in rows], pa.binary()),
                             "scores": pa.array([r[2] for r in rows], pa.binary())})
        return add

    postings = blocks.filter("term is not null").drop("docs", "words", "ids")
    bundles = empty(spark, bundle)
    for stage in range(STAGES):
        owned = postings.join(users.filter(F.col("stage") == stage).drop("stage"), "term").drop("term")
        met = bundles.groupBy("block", "g").cogroup(owned.groupBy("block", "g"))
        passed = saved(met.applyInArrow(owner(stage == STAGES - 1), bundle), f"bundles-{stage}")
        discard(bundles)
        bundles = passed

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(x) // 2 for x in batch.column(2).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            joined = [b"".join(batch.column(c).to_pylist()) for c in (2, 3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.frombuffer(joined[0], "<u2").astype(np.int32)),
                 pa.array(np.frombuffer(joined[1], "<i8"))], names=["block", "item_id", "place", "score"])

    flat = T.StructType([bundle["block"], bundle["item_id"], T.StructField("place", T.IntegerType()), T.StructField("score", T.LongType())])
    found = bundles.select("block", "item_id", "places", "scores").mapInArrow(unpack, flat)
    # at most k places an item and block; a local top k comes before the shuffle by item
    ids = blocks.filter("term is null").select("block", "ids")
    named = found.join(ids, "block").select("item_id", "block", "place", "score", F.get("ids", F.col("place")).alias("doc_id"))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "block", "place")
    top = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's 20 best documents."""
    return ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM documents),
p AS (SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, sum(tf) AS n FROM p GROUP BY doc_id),
t AS (SELECT count(*) AS n_docs, sum(n) AS n_words FROM n),
m AS (SELECT doc_id, CAST(75 + (25 * n * n_docs) // n_words AS BIGINT) AS m FROM n, t),
i AS (SELECT item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM benchmark),
q AS (SELECT item_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS qtf FROM i GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), t),
s AS (SELECT item_id, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 20
"""
