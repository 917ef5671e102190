"""Resumable model calls: a reply ledger that a stream of request batches fills.

A request is named by a hash of all that the service sees (prompt, user
message, settings, retry text).  ``queue_requests`` writes the requests that
the ledger has no answer for, each once, as files of a bounded number of
requests; ``answer_queue`` reads them as a stream, one batch at a time, and
appends the replies of each batch to the ledger when the batch is done.  The
stream's checkpoint remembers the batches that are done and the ledger the
requests that are answered, so a run that breaks goes on where it broke: at
most the requests of the batch that was open are sent again, and no request
that another run answered is sent at all.

Replies with status ``error`` (the service failed) are kept in the ledger but
do not count as answers: the next run sends those requests again.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import pending
from ..sources.io import path_exists

ANSWERS = ["request_key", "status", "content", "error"]


def request_key(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns; every part carries its length (or that it is missing), so no two requests share a text."""
    parts = []
    for c in columns:
        v = F.col(c).cast("string")
        parts.append(F.when(v.isNull(), F.lit("-:")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def answers(spark: SparkSession, ledger: str, answered_only: bool = True) -> DataFrame:
    """One reply for each request of the ledger; without service failures unless asked for.

    A request sent twice (its batch broke) has one reply here: the first by status (an answer
    before a failure), then by text.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ANSWERS])
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(ledger)
    if answered_only:
        rows = rows.where("status <> 'error'")
    best = F.min(F.struct((F.col("status") == "error").alias("failed"), "status", "content", "error"))
    return rows.groupBy("request_key").agg(best.alias("r")).select("request_key", "r.status", "r.content", "r.error")


#: requests of one file, so of one task
PER_FILE = 2000


def _files_of(per_batch: int) -> int:
    return max(1, -(-per_batch // PER_FILE))


def queue_requests(requests: DataFrame, ledger: str, queue: str, per_batch: int = 1000) -> DataFrame:
    """Writes the requests without an answer to ``queue``: each different request once, ``per_batch`` a batch, whose
    files hold about ``PER_FILE`` at most, however large the batch is."""
    spark = requests.sparkSession
    new = pending(requests.dropDuplicates(["request_key"]), answers(spark, ledger), "request_key")
    files = max(1, -(-new.count() // per_batch)) * _files_of(per_batch)
    # the number is given, so neither adaptive merging nor the size of the input changes the batches
    new.repartition(files, "request_key").write.mode("overwrite").parquet(queue)
    return spark.read.parquet(queue)


def answer_queue(spark: SparkSession, queue: str, ledger: str, checkpoint: str, call: Callable[[DataFrame, list[str]], DataFrame],
                 schema: T.StructType, files_per_batch: int = 1, stop_after: int | None = None) -> None:
    """Sends what waits in ``queue``, batch by batch, until nothing is left.

    ``call(requests, keys)`` is the model run of request rows.  The replies of a batch go to the
    ledger's folder of that batch, which a repeated batch replaces.  ``stop_after`` breaks the run
    after that many batches, as a lost driver would (for tests).
    """
    done = 0

    def answer(batch: DataFrame, number: int) -> None:
        nonlocal done
        if stop_after is not None and done >= stop_after:
            raise InterruptedError("stopped between two batches")
        session = batch.sparkSession
        waiting = pending(batch, answers(session, ledger), "request_key")
        call(waiting, ["request_key"]).select(*ANSWERS).write.mode("overwrite").parquet(f"{ledger}/run={_name(queue)}/batch={number}")
        done += 1

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(queue)
    rows.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _name(queue: str) -> str:
    return queue.rstrip("/").rsplit("/", 1)[-1]


def times_sent(spark: SparkSession, ledger: str) -> DataFrame:
    """request_key and n_sent: how often each request of the ledger was sent."""
    return spark.read.schema("request_key string").parquet(ledger).groupBy("request_key").agg(F.count(F.lit(1)).alias("n_sent"))


def run_resumable(requests: DataFrame, call: Callable[[DataFrame, list[str]], DataFrame], folder: str, keys: list[str],
                  key_columns: Sequence[str], run: str = "run", per_batch: int = 1000, stop_after: int | None = None) -> DataFrame:
    """U3 + J3: the replies of ``requests`` (``keys``, status, content, error), sending only what no run answered yet.

    ``folder`` (shared storage) holds the ledger, which all runs share, and the queue and progress
    of the run named ``run``: the same name goes on with a broken run, a new one begins anew.
    Requests of equal content are sent once and answer all their rows.
    """
    spark = requests.sparkSession
    named = requests.withColumn("request_key", request_key(key_columns))
    ledger, queue = f"{folder}/ledger", f"{folder}/queue-{run}"
    if not path_exists(spark, f"{queue}/_SUCCESS"):
        queue_requests(named, ledger, queue, per_batch)
    schema = spark.read.parquet(queue).schema
    answer_queue(spark, queue, ledger, f"{folder}/progress-{run}", call, schema,
                 files_per_batch=_files_of(per_batch), stop_after=stop_after)
    return named.select(*keys, "request_key").join(answers(spark, ledger, answered_only=False), "request_key", "left").select(
        *keys, F.coalesce("status", F.lit("missing")).alias("status"), "content", "error")
