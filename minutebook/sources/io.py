"""Sources and sinks: file listings, CSV tables, the index, documents and
per-meeting page folders.  Everything is a DataFrame read or write; no
driver-side file loops."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.patterns import IMAGE_EXTENSIONS
from ..session import ROW_GROUP, WIDE_ROWS, stored

LISTING_COLS = ["path", "dir", "parent", "name", "length", "modificationTime"]


def list_files(spark: SparkSession, root: str, exts=IMAGE_EXTENSIONS, recursive: bool = False) -> DataFrame:
    """File listing (path, dir, parent, name, length, mtime).

    Uses the ``binaryFile`` source for the listing only: ``content`` is
    never selected, so Spark prunes it and no file is read.  Extensions are
    matched in any case; each path appears once.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(root).select("path", "length", "modificationTime")
    low = F.lower(F.col("path"))
    if exts:
        df = df.where(F.reduce(F.array(*[low.endswith(e.lower()) for e in exts]), F.lit(False),
                               lambda a, b: a | b))
    name = F.element_at(F.split("path", "/"), -1)
    dir_ = F.regexp_replace("path", "/[^/]*$", "")
    parent = F.element_at(F.split(dir_, "/"), -1)
    return df.select("path", dir_.alias("dir"), parent.alias("parent"), name.alias("name"),
                     "length", "modificationTime").dropDuplicates(["path"])


def read_table(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass).
    A missing path gives an empty table when ``missing_ok`` (the roster case:
    a run without a roster simply has no member headers)."""
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .schema(schema).csv(path))


def write_csv(df: DataFrame, path: str, cols: list[str] | None = None) -> None:
    """Overwrite a CSV folder with a fixed column list; arrays and
    structs are written as JSON (nulls kept), since CSV cannot hold them.
    Quotes inside values are doubled (RFC 4180), as ``read_table`` expects."""
    cols = cols or df.columns
    out = []
    for c in cols:
        dt = df.schema[c].dataType
        col = F.col(f"`{c}`")
        if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
            col = F.to_json(col, {"ignoreNullFields": "false"})
        out.append(col.alias(c))
    (df.select(*out).write.mode("overwrite").option("header", True).option("escape", '"')
     .csv(path))


INDEX_BUCKETS = 256
BUCKET = "_bucket"


def append_index(df: DataFrame, path: str, key: str = "file", buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Append index rows not yet present (anti join on ``key``), so a
    re-run adds nothing twice.  Returns the rows that were appended.

    The index is a table partitioned by a hash of the key (``buckets`` must stay the same for a table): an append
    reads only the buckets its own keys fall into.  A null key is a key like others.
    """
    spark = df.sparkSession
    # one row per key, also inside a batch: the first by all columns
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = df.groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("_row"))
    new = first.select("_row.*").withColumn(BUCKET, F.pmod(F.hash(key), F.lit(buckets)))
    if path_exists(spark, path):
        new = stored(new, "index-batch")
        wanted = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        there = spark.read.parquet(path).where(F.col(BUCKET).isin(wanted)).select(F.col(key).alias("_there"), BUCKET)
        there = there.withColumnRenamed(BUCKET, "_in")
        new = new.join(there, (F.col(BUCKET) == F.col("_in")) & F.col(key).eqNullSafe(F.col("_there")), "left_anti")
    # one file per bucket, or several for a large one
    new.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
    return new.drop(BUCKET)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index table of ``append_index``."""
    return spark.read.parquet(path).drop(BUCKET)


def write_documents(df: DataFrame, path: str, kind: str = "doc_kind", heading: str | None = "heading",
                    body: str = "body", even: tuple[str, ...] = ()) -> None:
    """Per-meeting text outputs of all kinds as one table partitioned by kind; the
    Markdown form is ``# heading`` + blank line + body.

    One write for all kinds: rows are rebalanced by kind, and a kind that holds most of
    the bytes is split over several tasks.  A kind that is written again replaces itself only.
    Kinds named in ``even`` come from a stored table, in tasks of like size: they are written
    where they lie, not shuffled or sorted.
    """
    md = F.concat(F.lit("# "), F.col(heading), F.lit("\n\n"), F.col(body)) if heading else F.col(body)
    for k in even:
        (df.where(F.col(kind) == k).withColumn("markdown", md).drop(kind).write.mode("overwrite")
         .options(**WIDE_ROWS).parquet(f"{path}/{kind}={k}"))
        df = df.where(~F.col(kind).eqNullSafe(k))
    _write_parts(df.withColumn("markdown", md), path, kind, WIDE_ROWS)


def write_decisions(decisions: DataFrame, path: str, doc: str = "doc") -> None:
    """The decision records as a table (doc, idx, motion, result, yes, no); a meeting without any has no row."""
    decisions.select(doc, "idx", "motion", "result", "yes", "no").write.mode("overwrite").parquet(path)


def write_by_meeting(pages: DataFrame, path: str) -> None:
    """Pages filed under their meeting (``meeting_key`` folders, ``unassigned`` included) as a
    partitioned table; a meeting with very many pages is written by several tasks, and a repeated
    run replaces the meetings it holds."""
    _write_parts(pages, path, "meeting_key", ROW_GROUP)


def _write_parts(df: DataFrame, path: str, by: str, options: dict[str, str]) -> None:
    """A table partitioned by ``by``: small partitions share a task, large ones are split (adaptive rebalancing)."""
    (df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(**options).partitionBy(by).parquet(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)
