"""Best-fit packing by minimum bin slack.

Every document becomes its token ids and an end id; documents longer than a
sequence are cut into full pieces, the first piece taking the remainder.
How pieces share sequences depends only on how many pieces have each length,
so the search runs on that histogram (at most ``capacity`` numbers at any
input size): per bin the longest remaining length is placed and a bitset
subset-sum over the available lengths finds the fullest combination for the
rest, which is removed as often as the supply allows.  Pieces of one length
are then numbered in parallel (per bucket, with offsets between buckets) and
their numbers give sequence and place.

Defined results: a null or empty text is one piece that holds the end id; repeated
rows are packed once each; an empty table gives no pieces; columns other
than the id and the text are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from minutebook.llm.common import read, saved
from minutebook.llm.op2_token_counts import BATCH_CHARS, tokenizer_file
from minutebook.llm.units import by_bytes, crc32_of, units_for
from minutebook.session import ship_package

#: pieces that one numbering bucket of a length holds about
PIECES_PER_BUCKET = 4000


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ``ids``, little-endian 32-bit) per piece."""
    ship_package(docs.sparkSession)
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(tokenizer_path, ids=True)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in by_bytes(texts, BATCH_CHARS):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, got in enumerate(units.batch(texts[lo:hi]), lo):
                    got += end
                    n = len(got) // 4
                    at, upto, k = 0, (n - 1) % capacity + 1, 0
                    while at < n:
                        part = got if upto - at == n else got[4 * at:4 * upto]
                        row.append(i), piece.append(k), start.append(at), length.append(upto - at)
                        crc.append(crc32_of(part))
                        if with_ids:
                            ids.append(part)
                        at, upto, k = upto, upto + capacity, k + 1
                cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return source.mapInArrow(cut, T.StructType(fields))


def _fullest(room: int, supply: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """The combination of available lengths (descending list) with the largest sum up to ``room``."""
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []  # length, copies allowed, sums reachable before it
    for size in lengths:
        if size > room:
            continue
        most = min(supply[size], room // size)
        if not most:
            continue
        steps.append((size, most, reach))
        left, part = most, 1
        while left:  # bounded copies by doubling
            take = min(part, left)
            reach |= (reach << (take * size)) & mask
            left -= take
            part *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for size, most, before in reversed(steps):
        for copies in range(most + 1):
            if total - copies * size >= 0 and before >> (total - copies * size) & 1:
                if copies:
                    chosen[size] = copies
                total -= copies * size
                break
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many alike, [(length, copies)]); every piece is in one bin.

    Each round fixes the longest remaining length, completes the bin with
    the fullest combination of the others, and repeats that bin until one of
    its lengths runs short; so there are few rounds for each length, however
    many pieces there are.
    """
    supply = {int(k): int(v) for k, v in counts.items() if v > 0}
    lengths = sorted(supply, reverse=True)
    bins = []
    while lengths:
        seed = lengths[0]
        supply[seed] -= 1
        content = _fullest(capacity - seed, supply, lengths)
        supply[seed] += 1
        content[seed] = content.get(seed, 0) + 1
        times = min(supply[size] // copies for size, copies in content.items())
        bins.append((times, sorted(content.items(), reverse=True)))
        for size, copies in content.items():
            supply[size] -= times * copies
        lengths = [size for size in lengths if supply[size]]
    return bins


def _places(bins) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, copies, first sequence and offset of each kind of bin that uses it."""
    by: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, content in bins:
        offset = 0
        for size, copies in content:
            by.setdefault(size, []).append((ranks.get(size, 0), copies, sequence, offset))
            ranks[size] = ranks.get(size, 0) + times * copies
            offset += size * copies
        sequence += times
    return {size: tuple(np.array(x, np.int64) for x in zip(*rows)) for size, rows in by.items()}


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (written rows with doc_id, piece, start, length, ids_crc32) plus sequence_id and offset."""
    spark = pieces.sparkSession
    ship_package(spark)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(minimum_bin_slack(counts, capacity))
    buckets = max(1, sum(counts.values()) // PIECES_PER_BUCKET)
    bucketed = pieces.withColumn("__b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = (bucketed.groupBy("length", "__b").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__before", F.coalesce(F.sum("__n").over(
                  Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("__n"))
    order = Window.partitionBy("length", "__b").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = (bucketed.withColumn("__i", F.row_number().over(order)).join(before, ["length", "__b"])
              .withColumn("__rank", F.col("__before") + F.col("__i") - 1))
    keep = pieces.columns
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    n_keep, at_length = len(keep), keep.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(at_length).to_numpy(zero_copy_only=False)
            rank = batch.column(n_keep).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            order_ = np.argsort(size, kind="stable")
            for part in np.split(order_, np.flatnonzero(np.diff(size[order_])) + 1) if len(size) else []:
                of = int(size[part[0]])
                first, copies, start, at = places[of]
                kind = np.searchsorted(first, rank[part], "right") - 1
                inside = rank[part] - first[kind]
                sequence[part] = start[kind] + inside // copies[kind]
                offset[part] = at[kind] + inside % copies[kind] * of
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_keep], pa.array(sequence), pa.array(offset)],
                                             names=schema.names)

    return ranked.select(*keep, "__rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                   with_ids: bool = False) -> DataFrame:
    """Tokenizes, cuts and packs all documents; one row per piece."""
    return pack(saved(cut_pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ``ids`` (binary) from pieces packed with ``with_ids``; a group is one sequence."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    parts = F.transform(held, lambda s: F.hex(s["ids"]))
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(parts, "")).alias("ids"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    packed = pack_documents(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
