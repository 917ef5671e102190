"""SentencePiece encoding and decoding by a distinct-chunk table.

The model writes every space as a marker, puts one before the text, and has
no piece with a marker behind another character.  So no piece crosses the
place where a marker follows a character, and a text may be cut there into
chunks: a run of markers and the word behind it.

1. Each Arrow batch of texts is cut into chunks; its distinct chunks make the
   chunk table.
2. The library segments each distinct chunk once (a worker keeps a bounded
   table from batch to batch, so a frequent chunk is segmented once per
   worker), and decodes the ids of that chunk once.
3. The ids, and the decoded chunks, are joined back by position.

Nothing is shuffled and no task holds more than one batch and its table; a
lost executor repeats its splits only.  A table over the whole corpus would
need one row per word and position in a shuffle, several times the input.

Defined results: null texts count as empty; an empty text has no ids and
decodes to an empty text; the marker character itself in a text counts as a
space, as in the library; repeated rows give repeated results; an empty table
gives an empty table; other columns are ignored unless named in ``keep``.
"""
from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutebook.llm.common import read
from minutebook.llm.op2_token_counts import tokenizer_file
from minutebook.llm.units import by_bytes
from minutebook.session import ship_package

MARKER = "▁"
#: most chunks that a worker keeps from batch to batch, and the longest one kept
MAX_CHUNKS, LONG_CHUNK = 200_000, 64
#: characters of one piece of work
BATCH_CHARS = 2 << 20
_CHUNK = re.compile(f"{MARKER}+[^{MARKER}]*")


def chunks_of(text: str) -> list[str]:
    """The text's chunks, each without its first marker (further ones written as markers)."""
    if not text:
        return []
    parts = text.replace(MARKER, " ").split(" ")
    if "" not in parts:
        return parts
    return [c[1:] for c in _CHUNK.findall(MARKER + text.replace(" ", MARKER))]


class ChunkTable:
    """Ids (as 32-bit values) and decoded text of distinct chunks."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(MARKER in p.lstrip(MARKER) for p in pieces):
            raise ValueError("the model has pieces that cross a whitespace marker")
        self.kept: dict[str, tuple[bytes, str]] = {}

    def _segmented(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        """The library puts the first marker before each chunk, and takes it off again in decoding."""
        ids = self.library.encode(chunks, num_threads=1)
        ids = [x if c else [self.library.piece_to_id(MARKER)] for c, x in zip(chunks, ids)]
        return [(array("i", x).tobytes(), " " + t) for x, t in zip(ids, self.library.decode(ids, num_threads=1))]

    def rows(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Of each text: its ids as bytes, and its decoded text."""
        split = [chunks_of(t) for t in texts]
        new = list({c for chunks in split for c in chunks if c not in self.kept})
        table = self.kept
        if new:
            found = dict(zip(new, self._segmented(new)))
            table = {**{c: self.kept[c] for chunks in split for c in chunks if c in self.kept}, **found}
            for c in new[:max(0, MAX_CHUNKS - len(self.kept))]:
                if len(c) <= LONG_CHUNK:
                    self.kept[c] = found[c]
        ids, decoded = [], []
        for chunks in split:
            rows = [table[c] for c in chunks]
            ids.append(b"".join([r[0] for r in rows]))
            decoded.append("".join([r[1] for r in rows])[1:])
        return ids, decoded


_READY: dict[str, ChunkTable] = {}


def _table(path: str) -> ChunkTable:
    if path not in _READY:
        _READY[path] = ChunkTable(path)
    return _READY[path]


def _id_lists(ids: list[bytes]) -> pa.Array:
    sizes = np.array([0, *[len(x) // 4 for x in ids]], np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)),
                                    pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(docs: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",), text: str = "text",
           batch_chars: int = BATCH_CHARS) -> DataFrame:
    """``keep`` columns, ``ids`` (all ids of the whole text) and ``decoded`` (the text of these ids)."""
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    n_keep = len(keep)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_path)
        for batch in batches:
            texts = batch.column(n_keep).to_pylist()
            for lo, hi in by_bytes(texts, batch_chars):
                ids, decoded = table.rows(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(n_keep)]
                    + [_id_lists(ids), pa.array(decoded, pa.string())], names=[*keep, "ids", "decoded"])

    return source.mapInArrow(encoded, schema)


def decode(rows: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """``keep`` columns and ``decoded``: the library's text of any list of ids (null: empty; null ids are left out)."""
    ship_package(rows.sparkSession)
    whole = F.filter(F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")), lambda x: x.isNotNull())
    source = rows.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], whole.alias("x"))
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in keep] + [T.StructField("decoded", T.StringType())])
    n_keep = len(keep)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _table(model_path).library
        for batch in batches:
            texts = [library.decode(x) for x in batch.column(n_keep).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n_keep)], pa.array(texts, pa.string())],
                                             names=[*keep, "decoded"])

    return source.mapInArrow(decoded, schema)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, n_tokens, and the digests of its ids and of its decoded text."""
    rows = encode(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    listed = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
