"""Exact top-k search by integer inner product, pruned a block of documents at a time.

Vectors are laid out in ranges of a locality order (strongest components and
their signs), cut into blocks; each block keeps the largest and smallest
value of every component and a forward index (its vectors as one matrix).
The sum over a query's components of what a block could add at most bounds
every score in the block.

A query is first scored against the range of highest bound, which gives a kth
score to beat.  It is then sent only to the ranges whose bound reaches that score;
there the blocks are visited in order of their bounds until the bounds fall
below the query's kth score.  Partial results meet per query.

What is broadcast is one bound row for each range; ranges grow in size rather
than in number beyond ``MAX_RANGES``, so its size is limited to
``MAX_RANGES`` x components x 2 numbers.  Within a range, queries are dealt
over parts of at most about ``QUERIES_PER_PART``; a range's blocks go only to
the parts in which some query asks for it.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part, nor rows without an id; vectors of different length
are filled up with zeros; rows that share a query's id are not its
candidates; repeated rows of another id are candidates each; repeated equal
query rows count once; ties go to the smaller id.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import read, saved
from minutebook.session import ship_package

BLOCK_ROWS = 64
RANGE_ROWS = 4096
MAX_RANGES = 4096
QUERIES_PER_PART = 8192
#: the score of a place not yet taken
NONE = np.iinfo(np.int64).min + 1
_BLOCKS = "rng int, block int, n int, ids binary, vectors binary, most binary, least binary"
_FOUND = "query_key long, query_id long, vec_id long, score long"


def quantized(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """vec_id and q = floor(256 x component) as longs, for the vectors that take part."""
    x = F.col(vec)
    usable = (F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
              & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                         & (F.abs(c.cast("double")) < F.lit(float("inf")))))
    return vectors.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"),
                                         F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("q"))


def _locality(q: Column) -> Column:
    """Groups vectors that point alike: places and signs of the three strongest components."""
    ranked = F.array_sort(F.transform(q, lambda c, i: F.struct(-F.abs(c), i.alias("i"), (c < 0).alias("neg"))))
    return F.transform(F.slice(ranked, 1, 3), lambda s: s["i"] * 2 + s["neg"].cast("int"))


def laid_out(rows: DataFrame, dims: int, n_ranges: int) -> DataFrame:
    """Written blocks of ``rows`` (vec_id, q) in ranges of the locality order."""
    ship_package(rows.sparkSession)
    ordered = rows.withColumn("k", _locality(F.col("q"))).repartitionByRange(n_ranges, "k", "vec_id")

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng, at = TaskContext.get().partitionId(), 0
        for pdf in batches:
            pdf = pdf.sort_values(["o", "vec_id"])
            ids, mat = pdf["vec_id"].to_numpy(np.int64), _matrix(pdf["q"], dims)
            out = []
            for lo in range(0, len(ids), BLOCK_ROWS):
                m = mat[lo:lo + BLOCK_ROWS]
                out.append((rng, at, len(m), ids[lo:lo + BLOCK_ROWS].tobytes(), m.tobytes(),
                            m.max(0).tobytes(), m.min(0).tobytes()))
                at += 1
            yield pd.DataFrame(out, columns=["rng", "block", "n", "ids", "vectors", "most", "least"])

    blocks = ordered.select("vec_id", "q", F.concat_ws(",", F.transform("k", lambda c: F.lpad(c.cast("string"), 6, "0"))).alias("o"))
    return saved(blocks.mapInPandas(block, _BLOCKS), "blocks")


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _exact(a: np.ndarray, b: np.ndarray, biggest: float) -> np.ndarray:
    """Integer inner products; in floating point only where every sum is exact."""
    if biggest < 2 ** 52:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _bounds(q: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each query and each summary, the largest sum its component maxima allow (rounded up)."""
    q = q.astype(np.float64)
    top = np.maximum(q, 0) @ most.astype(np.float64).T + np.minimum(q, 0) @ least.astype(np.float64).T
    return top + np.abs(top) * 1e-12 + 1e-6


def search_blocks(ids: list[np.ndarray], mats: list[np.ndarray], most: np.ndarray, least: np.ndarray,
                  q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``k`` (scores, ids) of each query in these blocks; ``floor`` is a score to reach at least.

    Unused places have the smallest score.  Blocks are visited in order of their bounds per
    query; a query stops at the first bound below its kth score.
    """
    best = np.full((len(q), k), NONE, np.int64)
    who = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    top = _bounds(q, most, least)
    order = np.argsort(-top, 1, kind="stable")
    ranked = np.take_along_axis(top, order, 1)
    biggest = float(np.abs(q).max(initial=0)) * max([float(np.abs(m).max(initial=0)) for m in mats], default=0) * q.shape[1]
    for turn in range(order.shape[1]):
        reach = np.maximum(best[:, k - 1].astype(np.float64), floor)
        active = np.flatnonzero(ranked[:, turn] >= reach)
        if not len(active):
            break
        for b in np.unique(order[active, turn]):
            rows = active[order[active, turn] == b]
            scores = _exact(q[rows], mats[b], biggest)
            scores = np.where(ids[b][None, :] == q_ids[rows][:, None], NONE, scores)
            all_scores = np.hstack([best[rows], scores])
            all_ids = np.hstack([who[rows], np.broadcast_to(ids[b], scores.shape)])
            pick = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            best[rows], who[rows] = np.take_along_axis(all_scores, pick, 1), np.take_along_axis(all_ids, pick, 1)
    return best, who


def _searcher(dims: int, k: int):
    def search(key, queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(blocks):
            return pd.DataFrame({"query_key": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        read_ = np.frombuffer
        ids = [read_(x, np.int64) for x in blocks["ids"]]
        mats = [read_(x, np.int64).reshape(-1, dims) for x in blocks["vectors"]]
        most = np.stack([read_(x, np.int64) for x in blocks["most"]])
        least = np.stack([read_(x, np.int64) for x in blocks["least"]])
        q_ids, q = queries["query_id"].to_numpy(np.int64), _matrix(queries["q"], dims)
        best, who = search_blocks(ids, mats, most, least, q_ids, q, queries["floor"].to_numpy(np.float64), k)
        row, place = np.nonzero(best != NONE)
        return pd.DataFrame({"query_key": queries["query_key"].to_numpy()[row], "query_id": q_ids[row],
                             "vec_id": who[row, place], "score": best[row, place]})
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = saved(quantized(vectors, vec), "vectors")
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("dims"),
                     F.sum(is_query.cast("long")).alias("queries")).first()
    if not shape["queries"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = shape["dims"]
    n_ranges = max(1, min(MAX_RANGES, shape["n"] // RANGE_ROWS))
    parts = max(1, shape["queries"] // QUERIES_PER_PART)
    blocks = laid_out(rows, dims, n_ranges)

    def asked_blocks(ask: DataFrame) -> DataFrame:
        """The blocks of each (range, part) that ``ask`` (written rows) names."""
        cells = ask.select("rng", F.col("part").alias("in_part")).distinct()
        return blocks.join(cells, "rng").withColumnRenamed("in_part", "part")

    queries = (rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "q").distinct()
               .withColumn("query_key", F.xxhash64("query_id", "q"))
               .withColumn("part", F.pmod("query_key", F.lit(parts)).cast("int")))

    # one bound row per range: at most MAX_RANGES of them reach the driver and the tasks
    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for rng, part in pdf.groupby("rng"):
                most = np.stack([np.frombuffer(x, np.int64) for x in part["most"]]).max(0)
                least = np.stack([np.frombuffer(x, np.int64) for x in part["least"]]).min(0)
                yield pd.DataFrame({"rng": [rng], "most": [most.tobytes()], "least": [least.tobytes()]})

    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in blocks.select("rng", "most", "least").mapInPandas(summary, "rng int, most binary, least binary").toLocalIterator():
        a, b = np.frombuffer(r["most"], np.int64), np.frombuffer(r["least"], np.int64)
        old = held.get(r["rng"])
        held[r["rng"]] = (a, b) if old is None else (np.maximum(a, old[0]), np.minimum(b, old[1]))
    names = np.array(sorted(held), np.int64)
    most, least = np.stack([held[x][0] for x in names]), np.stack([held[x][1] for x in names])

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            top = _bounds(_matrix(pdf["q"], dims), most, least)
            yield pdf.assign(rng=names[top.argmax(1)].astype(np.int32), floor=-np.inf)

    asked = "query_id long, q array<bigint>, query_key long, part int, rng int, floor double"
    search = _searcher(dims, k)
    first_ask = saved(queries.select("query_id", "q", "query_key", "part").mapInPandas(nearest, asked), "asked")
    seeds = saved(first_ask.groupBy("rng", "part").cogroup(asked_blocks(first_ask).groupBy("rng", "part"))
                  .applyInPandas(search, _FOUND), "seeds")
    kth = (seeds.groupBy("query_key").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("held"))
           .select("query_key", F.when(F.col("held") >= k, F.col("worst").cast("double"))
                   .otherwise(F.lit(float("-inf"))).alias("reach")))

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            top = _bounds(_matrix(pdf["q"], dims), most, least)
            wanted = top >= pdf["reach"].to_numpy(np.float64)[:, None]
            wanted[np.arange(len(pdf)), top.argmax(1)] = False  # searched already
            row, rng = np.nonzero(wanted)
            out = pdf.iloc[row].reset_index(drop=True)
            yield out.assign(rng=names[rng].astype(np.int32), floor=out["reach"])[
                ["query_id", "q", "query_key", "part", "rng", "floor"]]

    known = queries.join(kth, "query_key", "left").withColumn("reach", F.coalesce("reach", F.lit(float("-inf"))))
    second_ask = saved(known.select("query_id", "q", "query_key", "part", "reach").mapInPandas(others, asked), "asked")
    rest = (second_ask.groupBy("rng", "part").cogroup(asked_blocks(second_ask).groupBy("rng", "part"))
            .applyInPandas(search, _FOUND))
    # a query gathers at most k rows from each range; sorted slices keep k of them
    gathered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id"))))
    merged = (seeds.unionByName(rest).groupBy("query_key", "query_id")
              .agg(F.slice(gathered, 1, k).alias("top")))
    return merged.select("query_id", F.posexplode("top").alias("place", "c")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"),
        (-F.col("c.s")).alias("score"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: vec_id divisible by 50; candidates: every other row; the five best."""
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(c::DOUBLE * 256) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))),
e AS (SELECT vec_id, generate_subscripts(q, 1) AS i, unnest(q) AS x FROM v),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
      FROM e a JOIN e b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
