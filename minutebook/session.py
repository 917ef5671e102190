"""Session helpers: one place for the settings every job relies on."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "minutebook", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC dates and no UI.

    On a cluster the master and most settings come from spark-submit; the
    values here only fill in what is unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"
    # under spark-submit the submitted settings are known already and stay as they are
    given = SparkConf() if "PYSPARK_GATEWAY_PORT" in os.environ else None
    conf = {k: v for k, v in conf.items() if given is None or not given.contains(k)}
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    in local mode (local runs and tests) a private folder is created and
    registered; on a cluster a machine-local folder would be lost with its
    executor, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
        configured = tempfile.mkdtemp(prefix="minutebook-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


# A parquet reader never takes rows of two row groups at once: with small ones, a batch of rows that are wide
# (whole transcripts) is bounded in bytes, as is what a writer holds back.
# The writer looks at its sizes every 16 rows at most: by itself it does so after 100 rows, then after as many as it
# expects from the rows before, up to 10,000, however wide those turn out to be.
ROW_GROUP = {"parquet.block.size": str(16 << 20), "parquet.page.size": str(1 << 20),
             "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "16"}
# The sizes above are those of compressed pages, so for whole texts the rows are counted too. A page has room for
# several texts, and zstd finds in one what another had (the member line of a year), which snappy does not.
WIDE_ROWS = ROW_GROUP | {"parquet.block.row.count.limit": "64", "parquet.page.size": str(2 << 20), "compression": "zstd"}


def stored(df: DataFrame, name: str, options: dict[str, str] = ROW_GROUP) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: computed once, and safe from lost executors."""
    path = f"{scratch_path(df.sparkSession, name)}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``minutebook`` importable in the Python workers.

    Functions handed to ``mapInPandas`` may refer to this package; the
    workers import it from a zip that Spark distributes with ``addPyFile``
    (on a cluster the same is done with ``--py-files``).  Once per
    application; a no-op when the package itself runs from a zip.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    if key in _SHIPPED or not os.path.isdir(pkg_dir):
        return
    out = os.path.join(tempfile.mkdtemp(prefix="minutebook-pkg-"), "minutebook.zip")
    root = os.path.dirname(pkg_dir)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
