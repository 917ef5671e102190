"""Resumable model calls: a batch of any size comes in files of bounded size."""
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from minutebook.operators import ledger, model


def test_a_large_batch_has_several_files(spark, tmpdir_path):
    df = spark.range(12000).select("id", F.concat(F.lit("t"), "id").alias("prompt"), F.lit(None).cast("string").alias("user_text"))
    df = df.withColumn("source_text", F.col("prompt"))

    def go(rows, keys):
        return model.run_model(rows, lambda: lambda p, u: p.upper(), keys=keys)
    out = ledger.run_resumable(df, go, tmpdir_path, ["id"], ["prompt"], per_batch=6000)
    assert out.where("content = upper(concat('t', id))").count() == 12000
    queue = os.path.join(tmpdir_path, "queue-run")
    rows = [pq.ParquetFile(os.path.join(queue, f)).metadata.num_rows for f in os.listdir(queue) if f.endswith(".parquet")]
    assert sum(rows) == 12000 and max(rows) < 1.2 * ledger.PER_FILE
    batches = [f for f in os.listdir(os.path.join(tmpdir_path, "ledger", "run=queue-run")) if f.startswith("batch=")]
    assert len(batches) == 2
