"""Token counts: batch encoding in Arrow functions that return lengths only.

``count_tokens`` adds to each document the bytes and tokens of its whole
text.  Texts go to the tokenizer in batches of about equal bytes; a very
long text is cut at safe boundaries (where no token can span the cut) and
the lengths are added.  Only lengths leave the Arrow function.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated
rows give repeated results; an empty table gives an empty table; other
columns are ignored unless named in ``keep``.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutebook.llm.common import read
from minutebook.llm.units import by_bytes, units_for
from minutebook.session import ship_package

#: characters that one call of the tokenizer gets
BATCH_CHARS = 2 << 20


def count_tokens(docs: DataFrame, tokenizer_path: str, keep: Sequence[str] = ("doc_id",), text: str = "text",
                 batch_chars: int = BATCH_CHARS) -> DataFrame:
    """``keep`` columns plus ``n_bytes`` and ``n_tokens`` of the whole text."""
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep]
                          + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    n_keep = len(keep)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(tokenizer_path, ids=False)
        for batch in batches:
            column = batch.column(n_keep)
            texts = column.to_pylist()
            n: list[int] = []
            for lo, hi in by_bytes(texts, batch_chars):
                n.extend(units.batch(texts[lo:hi]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n_keep)]
                + [pc.cast(pc.binary_length(column), pa.int64()), pa.array(n, pa.int64())],
                names=[*keep, "n_bytes", "n_tokens"])

    return source.mapInArrow(lengths, schema)


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, n_bytes, n_tokens, over_limit (more than 2,048 tokens)."""
    counted = count_tokens(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))
