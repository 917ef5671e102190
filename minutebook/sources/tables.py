"""Driver tables: one parquet file per table under an ``sf`` folder."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, as it is scanned; Catalyst prunes columns and pushes filters into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
