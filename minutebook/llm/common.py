"""Helpers shared by the operators of this folder."""
from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from minutebook.session import scratch_path

#: Spark's setting that removes an execution's shuffle files when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: most ranges that ``with_next`` cuts an order into; their borders go through the driver
MAX_RANGES = 4096


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, through Spark's reader only (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Executions planned in this block remove their shuffle files when they end.

    For results that are written or go to the driver: nothing reads those
    shuffles again.  An executor lost before the end is handled as usual.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def saved(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again.

    Cuts the lineage with files that survive a lost executor, and lets a
    later step read the rows twice without computing them twice.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, label)}-{uuid.uuid4().hex}"
    with freed(spark):
        df.write.options(**(options or {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes written tables of ``saved`` that nothing reads any more (other tables stay)."""
    for df in tables:
        path = getattr(df, "written_at", None)
        if path:
            spark = df.sparkSession
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: a key filter: bits a block, bits a key, and most blocks (64 MB of bits)
BLOCK_BITS, BITS_PER_KEY, MAX_BLOCKS = 4096, 16, 1 << 17


def maybe_in(df: DataFrame, key: Column, keys: DataFrame, of: Column) -> DataFrame:
    """The rows of ``df`` whose hash ``key`` may be among the hashes ``of`` of ``keys`` (written rows, counted here).

    A Bloom filter by blocks (three bits a key) that is broadcast; its size follows the number of
    keys up to a bound of 64 MB, above which it lets more rows through.  No row that matches is
    lost, so a join on the full key may follow at any size.
    """
    wanted = max(1, -(-keys.count() * BITS_PER_KEY // BLOCK_BITS))
    blocks = F.lit(min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())).cast("long")

    def places(h: Column) -> list[Column]:
        mixed = F.xxhash64(h)
        return [F.shiftright(mixed, s).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for s in (0, 12, 24)]

    bits = keys.select(F.pmod(of, blocks).alias("block"), F.explode(F.array(*places(of))).alias("place")).select(
        "block", F.shiftright("place", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63))).alias("bits"))
    words = bits.groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    held = words.groupBy(F.col("block").alias("__block")).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("__bits"))
    tests = [F.getbit(F.coalesce(F.try_element_at("__bits", F.shiftright(p, 6)), F.lit(0).cast("long")), p.bitwiseAND(F.lit(63))) == 1
             for p in places(key)]
    return (df.join(F.broadcast(held), F.pmod(key, blocks) == F.col("__block")).filter(tests[0] & tests[1] & tests[2])
            .drop("__block", "__bits"))


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def uniform(*cols: Column, salt: str = "") -> Column:
    """A number in (0, 1) that depends only on the given columns (52 bits of an md5)."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols], F.lit(salt))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_next(df: DataFrame, key: str, ties: Sequence[str], payload: Sequence[str],
              descending: bool, rows_per_range: int = 2000) -> DataFrame:
    """Adds ``next_<p>`` for each payload column: its value in the following row by ``key``.

    The order is by ``key`` (nulls last), then by ``ties``; after the last row
    comes the first.  No window runs over the whole table: rows are cut into
    ranges at border values of ``key`` found by one pass over that column.
    Every row whose key is a border also enters the range before it as a
    guest, and every row with the first key enters the last range, so each
    range holds the row that follows its own last one.
    """
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("k"),
                   F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    n_ranges = max(1, min(MAX_RANGES, stats["n"] // rows_per_range))
    borders: list = []
    if n_ranges > 1 and stats["k"]:
        cuts = [i / n_ranges for i in range(1, n_ranges)]
        found = df.agg(F.percentile_approx(key, cuts, 20 * n_ranges).alias("q")).first()["q"]
        first = stats["hi"] if descending else stats["lo"]
        borders = sorted({x for x in found or [] if x != first}, reverse=descending)
    k = F.col(key)
    head = F.lit(stats["hi"] if descending else stats["lo"])
    if borders:
        held = F.lit(borders)
        begun = F.size(F.filter(held, lambda b: (b >= k) if descending else (b <= k)))
        rng = F.when(k.isNull(), F.lit(len(borders))).otherwise(begun)
        is_border = F.array_contains(held, k)
    else:
        rng, is_border = F.lit(0), F.lit(False)
    is_first = (k == head) if stats["k"] else F.lit(True)
    first_guest = F.lit(len(borders)) if borders else F.lit(0)
    places = F.filter(F.array(
        F.struct(rng.alias("rng"), F.lit(0).alias("guest")),
        F.struct(F.when(is_border & k.isNotNull(), rng - 1).alias("rng"), F.lit(1).alias("guest")),
        F.struct(F.when(F.coalesce(is_first, F.lit(False)), first_guest).alias("rng"), F.lit(2).alias("guest"))),
        lambda s: s["rng"].isNotNull())
    placed = df.withColumn("__place", F.explode(places))
    order = [F.col("__place.guest")]
    order += [F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()]
    order += [F.col(t).asc_nulls_first() for t in ties]
    w = Window.partitionBy(F.col("__place.rng")).orderBy(*order)
    out = placed.withColumns({f"next_{p}": F.lead(p).over(w) for p in payload})
    return out.filter("__place.guest = 0").drop("__place")
