"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic calibration.

``document_stats`` reduces each whole text to a few statistics.  A fixed
random map turns the standardized statistics into features whose inner
products approximate a Gaussian kernel.  Each partition sums its part of the
normal equations; the ridge solution scores every document, and an isotonic
fit on labelled rows kept out of the ridge turns raw scores into
probabilities.

The fit uses at most about ``MAX_FIT_ROWS`` labelled rows (chosen by a hash
of the id; all of them when there are fewer), so what reaches the driver is
bounded: one matrix for each of ``FIT_PARTITIONS`` partitions and the
calibration pairs.  Statistics and scores cover every document and its whole
text.

Defined results: null and empty texts have zero statistics and are scored;
null labels are not learned from; conflicting labels of one id count as their
mean; without any labelled row all scores are the prior 0.5; repeated rows
are scored alike.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import doc_crc, read, saved
from minutebook.session import ship_package

MAX_FIT_ROWS = 100_000
FIT_PARTITIONS = 8
N_FEATURES = 384
RIDGE = 1e-3
THRESHOLD = 0.3
STATS = ["log_words", "word_length", "longest_word", "distinct_share", "repeat_share", "short_share", "symbol_share",
         "digit_share", "upper_share", "stop_share", "comma_share", "line_share", "beyond_ascii_share", "other_share",
         "space_share"]
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))


def text_stats(text: str) -> tuple[float, ...]:
    """The statistics of one text, each in a range that does not grow with its length (the first: slowly)."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATS)
    raw = text.encode("utf-8", "replace")
    n, size = len(words), len(raw)
    sizes = list(map(len, words))

    def share(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    symbol, digit, upper, lower = share(_SYMBOLS), share(b"0123456789"), share(_UPPER), share(_LOWER)
    beyond = (size - len(raw.decode("utf-8", "replace").encode("ascii", "ignore"))) / size if not text.isascii() else 0.0
    stop, comma, line, space = raw.count(b".") / n, raw.count(b",") / n, raw.count(b"\n") / n, raw.count(b" ") / size
    distinct = np.log1p(len(set(words))) / np.log1p(n)
    repeat = sum(map(eq, words, words[1:])) / n
    short = sum(1 for s in sizes if s <= 2) / n
    other = max(0.0, 1 - symbol - digit - upper - lower - beyond - space)
    return (float(np.log1p(n)), min(sum(sizes) / n, 50.0), min(max(sizes), 100) / 100.0, float(distinct), repeat, short,
            symbol, digit, upper, min(stop, 2.0), min(comma, 2.0), min(line, 2.0), beyond, other, space)


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of its whole text, one row for each row."""
    ship_package(docs.sparkSession)
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_stats(t.as_py()) for t in batch.column(1)]
            cols = np.array(rows, np.float64).reshape(-1, len(STATS)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in cols]], names=["doc_id", *STATS])

    return source.mapInArrow(stats, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATS))


class Model:
    """Standardization, random map, ridge weights and calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 0.6, (len(mean), N_FEATURES)) / np.sqrt(len(mean)) * 2
        self.b = rng.uniform(0, 2 * np.pi, N_FEATURES)
        self.weights = np.zeros(N_FEATURES + 1)
        self.steps_x, self.steps_y = np.array([0.0]), np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / N_FEATURES) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.steps_x, self.steps_y), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and their non-decreasing means."""
    order = np.lexsort((y, x))
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for xi, yi in zip(x[order], y[order]):
        blocks.append([1.0, float(yi), float(xi)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, sy, sx = blocks.pop()
            blocks[-1][0] += n
            blocks[-1][1] += sy
            blocks[-1][2] += sx
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def fit(labelled: DataFrame) -> Model:
    """The model from rows with STATS, ``y`` (0 to 1) and ``part`` (0: calibration, others: ridge).

    ``labelled`` should be written rows of a bounded number; see ``MAX_FIT_ROWS``.
    """
    ship_package(labelled.sparkSession)
    moments = labelled.agg(*[F.avg(s).alias(f"m_{s}") for s in STATS],
                           *[F.stddev_pop(s).alias(f"s_{s}") for s in STATS]).first()
    if moments[f"m_{STATS[0]}"] is None:
        return Model(np.zeros(len(STATS)), np.ones(len(STATS)))
    mean = np.array([moments[f"m_{s}"] for s in STATS])
    scale = np.array([moments[f"s_{s}"] or 1.0 for s in STATS])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))
    dim = N_FEATURES + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, c, n = np.zeros((dim, dim)), np.zeros(dim), 0
        for pdf in batches:
            z = model.features(pdf[STATS].to_numpy(np.float64))
            a += z.T @ z
            c += z.T @ pdf["y"].to_numpy(np.float64)
            n += len(pdf)
        yield pd.DataFrame({"a": [a.tobytes()], "c": [c.tobytes()], "n": [n]})

    parts = (labelled.filter("part <> 0").select(*STATS, "y").coalesce(FIT_PARTITIONS)
             .mapInPandas(sums, "a binary, c binary, n long").collect())
    a = sum((np.frombuffer(r["a"]).reshape(dim, dim) for r in parts), np.zeros((dim, dim)))
    c = sum((np.frombuffer(r["c"]) for r in parts), np.zeros(dim))
    n = sum(r["n"] for r in parts)
    model.weights = np.linalg.solve(a + RIDGE * max(n, 1) / dim * np.eye(dim), c)
    held = labelled.filter("part = 0").select(*STATS, "y").toPandas()
    if len(held):
        model.steps_x, model.steps_y = isotonic(model.raw(held[STATS].to_numpy(np.float64)), held["y"].to_numpy(np.float64))
    else:
        model.steps_x, model.steps_y = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def train(stats: DataFrame, labels: DataFrame, learn: Callable | None = None) -> Model:
    """Fits on the labelled rows of ``stats`` (written rows) for which ``learn`` holds."""
    y = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
         .groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y")))
    if learn is not None:
        y = y.filter(learn(F.col("doc_id")))
    total = y.count()
    share = min(1.0, MAX_FIT_ROWS / max(total, 1))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    rows = stats.join(y.filter(chosen), "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)))
    return fit(saved(rows, "quality-fit"))


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for each row of ``stats``."""
    kind = stats.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": model.score(pdf[STATS].to_numpy(np.float64))})

    return stats.select("doc_id", *STATS).mapInPandas(score, f"doc_id {kind}, score double")


def learn_rows(doc_id):
    """The rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return doc_crc(doc_id) % 5 != 0


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, held_out, score, predicted (score of at least 0.3)."""
    stats = saved(document_stats(read(spark, sf_dir, "documents")), "quality-stats")
    model = train(stats, read(spark, sf_dir, "labels"), learn_rows)
    return scored(stats, model).select(
        "doc_id", (doc_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose score is below ``threshold``; all columns stay.

    Statistics are taken twice, once for the fit and once in the pass that filters the
    rows, so no join ever moves texts.
    """
    ship_package(spark)
    model = train(saved(document_stats(docs), "quality-stats"), labels, learn_rows)

    @F.pandas_udf("double")
    def score_of(texts: pd.Series) -> pd.Series:
        rows = [text_stats(t if isinstance(t, str) else "") for t in texts]
        return pd.Series(model.score(np.array(rows, np.float64).reshape(-1, len(STATS))))

    return docs.filter(score_of(F.col("text")) >= threshold)
