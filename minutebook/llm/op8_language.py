"""Language identification by error-correcting output codes.

Each language has a codeword; for each bit a binary classifier over hashed
byte n-grams (one to three bytes of the lower-cased text) separates the
languages whose bit is 1 from the others.  A document's margins are its mean
log odds per bit; decoding sums each bit's logistic loss, weighted by how
reliable that bit is on learning rows, and takes the codeword of least loss.
A document whose second-best codeword is almost as near is flagged.

N-gram counts come from at most about ``MAX_DOCS`` learning documents of each
language (chosen by a hash of the id; all where there are fewer), so the
model is bounded: languages x ``BUCKETS`` counts.  Every document is scored
over its whole text.

Defined results: ``und`` with score 0 for a null text, a text without a
letter, or when there is nothing to learn from; null languages are not
learned; one language only is predicted with score 1; repeated rows are
treated alike.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import doc_crc, read, saved
from minutebook.session import ship_package

MAX_DOCS = 4000
FIT_PARTITIONS = 8
BUCKETS = 1 << 15
#: bytes that are looked up at once
CHUNK = 1 << 20
UNDETERMINED = "und"
#: relative lead of the best codeword under which a prediction is ambiguous
MARGIN = 0.05


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """Rows of +1 and -1: all splits up to six languages, else the random code with the farthest rows."""
    if n <= 6:
        cols = [[1 if (k >> i) & 1 else -1 for i in range(n)] for k in range(1, 1 << (n - 1))]
        return np.array(cols, np.float64).T.reshape(n, -1)
    rng, best, far = np.random.default_rng(seed), None, -1
    length = 16 + 4 * int(np.ceil(np.log2(n)))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, length))
        code[0] = np.where(np.abs(code.sum(0)) == n, -code[0], code[0])
        apart = (length - code @ code.T)[np.triu_indices(n, 1)].min()
        if apart > far:
            best, far = code, apart
    return best


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _grams(raw: np.ndarray, last: np.ndarray) -> Iterator[np.ndarray]:
    """Hashed n-grams that begin at each byte, for n of 1, 2, 3; bucket 0 where the text ends first.

    ``raw`` has two bytes more than there are positions; ``last`` tells how
    many bytes the position's text still has after it (2 at most).
    """
    n = len(raw) - 2
    code = raw[:n].astype(np.uint32)
    for size in (1, 2, 3):
        if size > 1:
            code = code * np.uint32(256) + raw[size - 1:n + size - 1]
        hashed = (code + np.uint32(size << 24)) * np.uint32(2654435761) >> np.uint32(17)
        yield np.where(last >= size - 1, hashed | np.uint32(1), np.uint32(0)).astype(np.int64)


def _each_chunk(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Over the texts' bytes in chunks: the documents there, where each begins, and its n-grams."""
    encoded = [b" " + t.lower().encode("utf-8", "replace") + b" " for t in texts]
    sizes = np.array([len(e) for e in encoded], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(encoded) + b"\0\0", np.uint8)
    for at in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
        upto = min(at + CHUNK, int(ends[-1]))
        first = int(np.searchsorted(ends, at, "right"))
        final = int(np.searchsorted(ends, upto - 1, "right"))
        docs = np.arange(first, final + 1)
        begins = np.maximum(ends[docs] - sizes[docs], at) - at
        owner_end = np.repeat(ends[docs], np.diff(np.append(begins, upto - at)))
        last = np.minimum(owner_end - 1 - np.arange(at, upto), 2)
        yield docs, begins, list(_grams(raw[at:upto + 2], last))


def gram_counts(texts: list[str]) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for _, _, grams in _each_chunk(texts):
        for g in grams:
            total += np.bincount(g, minlength=BUCKETS)
    total[0] = 0
    return total


class Model:
    """Languages, codewords, per-bit gram weights, and each bit's scale and reliability."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages)) if languages else np.zeros((0, 0))
        rates = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True) if languages else counts
        bits = [np.log(rates[c > 0].mean(0)) - np.log(rates[c < 0].mean(0)) for c in self.code.T]
        self.weights = np.array(bits, np.float32).T.reshape(BUCKETS, -1) if bits else np.zeros((BUCKETS, 0), np.float32)
        self.weights[0] = 0
        self.scale = np.ones(self.code.shape[1])
        self.trust = np.ones(self.code.shape[1])

    def margins(self, texts: list[str]) -> np.ndarray:
        """Mean log odds of each bit over each whole text."""
        total = np.zeros((len(texts), self.weights.shape[1]))
        size = np.zeros(len(texts))
        for docs, begins, grams in _each_chunk(texts):
            for g in grams:
                total[docs] += np.add.reduceat(self.weights[g], begins, axis=0)
            size[docs] += np.diff(np.append(begins, len(grams[0])))
        return total / np.maximum(size, 1)[:, None]

    def calibrate(self, margins: np.ndarray, truth: np.ndarray) -> None:
        """Scale: a bit's typical margin.  Trust: one minus its mean logistic loss on learning rows."""
        if not len(margins) or not margins.shape[1]:
            return
        self.scale = 4.0 / np.maximum(np.abs(margins).mean(0), 1e-9)
        loss = np.logaddexp(0, -self.code[truth] * margins * self.scale).mean(0)
        self.trust = np.maximum(1 - loss / np.log(2), 0.05)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language's index, score, and whether the second best is almost as near."""
        if self.code.shape[1] == 0:
            return np.zeros(len(margins), int), np.ones(len(margins)), np.zeros(len(margins), bool)
        z = margins * self.scale
        loss = np.stack([(np.logaddexp(0, -z * word) * self.trust).sum(1) for word in self.code], 1)
        ranked = np.sort(loss, 1)
        p = np.exp(ranked[:, :1] - loss)
        best = loss.argmin(1)
        score = 1 / p.sum(1)
        return best, score, (ranked[:, 1] - ranked[:, 0]) < MARGIN * self.trust.sum()


def fit(sample: DataFrame) -> Model:
    """The model from written learning rows with text and lang."""
    ship_package(sample.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, part in pdf.groupby("lang")["text"]:
                held[lang] = held.get(lang, 0) + gram_counts(list(part))
        yield pd.DataFrame({"lang": list(held), "n": [c.tobytes() for c in held.values()]})

    rows = sample.select("lang", "text").coalesce(FIT_PARTITIONS).mapInPandas(count, "lang string, n binary").collect()
    by: dict[str, np.ndarray] = {}
    for r in rows:
        by[r["lang"]] = by.get(r["lang"], 0) + np.frombuffer(r["n"], np.int64)
    languages = sorted(by)
    model = Model(languages, np.array([by[x] for x in languages], np.float64).reshape(len(languages), BUCKETS))
    if len(languages) > 1:
        place = {x: i for i, x in enumerate(languages)}

        def margin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                m = model.margins(list(pdf["text"]))
                yield pd.DataFrame({"truth": pdf["lang"].map(place), "m": list(m)})

        few = sample.filter(F.pmod(F.xxhash64("doc_id", F.lit("trust")), F.lit(4)) == 0).select("lang", "text")
        got = few.mapInPandas(margin, "truth int, m array<double>").toPandas()
        if len(got):
            model.calibrate(np.stack(got["m"].to_numpy()), got["truth"].to_numpy())
    return model


def learning_rows(docs: DataFrame, learn: Callable, max_docs: int = MAX_DOCS) -> DataFrame:
    """At most about ``max_docs`` documents of each language, chosen by a hash of the id; written."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & learn(F.col("doc_id")))
    share = known.groupBy("lang").agg(F.least(F.lit(1.0), max_docs / F.count(F.lit(1))).alias("share"))
    u = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1_000_000)) / 1_000_000.0
    limits = {r["lang"]: r["share"] for r in share.collect()}  # one number for each language
    if not limits:
        return known.limit(0)
    keep = F.coalesce(*[F.when(F.col("lang") == k, F.lit(v)) for k, v in limits.items()])
    return saved(known.filter(u < keep), "language-fit")


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for the whole text of each row."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = np.array(model.languages or [UNDETERMINED], object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            known = np.array([has_letter(t) for t in texts], bool) & bool(model.languages)
            lang = np.full(len(texts), UNDETERMINED, object)
            score, unsure = np.zeros(len(texts)), np.ones(len(texts), bool)
            if known.any():
                best, p, near = model.decode(model.margins([t for t, k in zip(texts, known) if k]))
                lang[known], score[known], unsure[known] = names[best], p, near
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(lang), pa.string()), pa.array(score), pa.array(unsure)],
                names=["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def learn_rows(doc_id):
    """The rows that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return doc_crc(doc_id) % 3 != 1


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, held_out, lang_pred, score, ambiguous."""
    docs = read(spark, sf_dir, "documents")
    model = fit(learning_rows(docs, learn_rows))
    return identify(docs, model).select("doc_id", (doc_crc(F.col("doc_id")) % 3 == 1).alias("held_out"), "lang_pred",
                                        "score", "ambiguous")
