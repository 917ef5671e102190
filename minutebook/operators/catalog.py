"""File catalog: what to process, which version wins, what is done."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import file_date_key
from ..functions.patterns import MEETING_PDF_SUFFIX, OCR_SUFFIX
from ..functions.text import strip


def pending_pdfs(files: DataFrame, name: str = "name") -> DataFrame:
    """PDFs still to OCR: not ``*_backup.pdf``, not ``*_ocr.pdf``, not
    ``temp_*`` and no ``.backup`` in the name (all case-sensitive)."""
    n = F.col(name)
    skip = (n.endswith("_backup.pdf") | n.endswith("_ocr.pdf") | n.startswith("temp_")
            | n.contains(".backup"))
    return files.where(n.endswith(".pdf") & ~skip)


def meeting_folders(files: DataFrame, name: str = "name", parent: str = "parent") -> DataFrame:
    """S3: folders holding ``*_part_*.wav`` files, distinct."""
    return (files.where(F.col(name).rlike("^.*_part_.*\\.wav$"))
            .select(F.col(parent).alias("folder")).distinct())


def page_totals(pdf_pages: DataFrame, path: str = "path", first_n: int = 3, min_chars: int = 100) -> DataFrame:
    """For each file with pages, by one aggregate over one scan: ``has_text`` (P12), ``chars`` (stripped, of all
    pages) and ``pages``.  Columns that are not read leave the aggregate."""
    chars = F.length(strip("text"))
    return pdf_pages.groupBy(path).agg(
        F.coalesce(F.sum(F.when(F.col("page_no") <= first_n, chars)) > min_chars, F.lit(False)).alias("has_text"),
        F.sum(chars).alias("chars"), F.count(F.lit(1)).alias("pages"))


def has_text(pdf_pages: DataFrame, catalog: DataFrame | None = None, path: str = "path",
             first_n: int = 3, min_chars: int = 100) -> DataFrame:
    """A PDF is searchable when the stripped text of its first
    ``first_n`` pages adds up to more than ``min_chars``.

    Without a ``catalog`` the files are those of the pages, read once.  With
    one, its files without pages get false, and the page filter is pushed
    into the scan of the pages."""
    if catalog is None:
        return page_totals(pdf_pages, path, first_n, min_chars).select(path, "has_text")
    per = (pdf_pages.where(F.col("page_no") <= first_n)
           .groupBy(path).agg(F.sum(F.length(strip("text"))).alias("_chars")))
    return (catalog.select(path).distinct().join(per, path, "left")
            .select(path, F.coalesce(F.col("_chars") > min_chars, F.lit(False)).alias("has_text")))


def plan_moves(files: DataFrame, dest: str, name: str = "name", path: str = "path") -> DataFrame:
    """Manifest of non-OCR PDFs (``.pdf`` without ``_ocr``, any case) to
    move into one flat folder; ``conflict`` marks targets claimed twice."""
    low = F.lower(name)
    m = files.where(low.endswith(".pdf") & ~low.contains(OCR_SUFFIX))
    m = m.select(F.col(path).alias("source"), F.concat(F.lit(dest.rstrip("/") + "/"), F.col(name)).alias("target"))
    # counted with a partial + final aggregate and joined back, so a target
    # claimed by very many files never lands whole in one window partition
    claims = m.groupBy("target").agg((F.count(F.lit(1)) > 1).alias("conflict"))
    return m.join(claims, "target").select("source", "target", "conflict")


def derived_names(files: DataFrame, name: str = "name") -> DataFrame:
    """Names of the files a PDF gives rise to."""
    stem = F.regexp_replace(F.col(name), "\\.pdf$", "")
    return files.select(
        "*",
        F.concat(stem, F.lit(OCR_SUFFIX + ".pdf")).alias("ocr_name"),
        F.concat(stem, F.lit(".pdf.backup")).alias("backup_name"),
        F.concat(F.lit("temp_"), F.col(name)).alias("temp_name"))


def meeting_pdf_name(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(k, F.lit(MEETING_PDF_SUFFIX))


def recording_names(stem) -> Column:
    s = F.col(stem) if isinstance(stem, str) else stem
    return F.struct(F.concat(s, F.lit(".mp3")).alias("mp3"), F.concat(s, F.lit(".txt")).alias("transcript"),
                    F.concat(s, F.lit(".summary.txt")).alias("summary"))


def best_version(files: DataFrame, name: str = "name", parent: str = "parent",
                 order_by: str = "path") -> DataFrame:
    """One PDF per date key; names containing ``backup`` (any case) are
    skipped, files without a date key dropped, and the first ``_ocr`` file
    (case-sensitive) in path order wins, else the first file.

    ``row_number() == 1`` plans a WindowGroupLimit, so only the best row per
    key (per partition, then per key) reaches the window sort.
    """
    f = (files.where(~F.lower(name).contains("backup"))
         .withColumn("date_key", file_date_key(name, parent))
         .where(F.col("date_key").isNotNull()))
    w = Window.partitionBy("date_key").orderBy(F.col(name).contains(OCR_SUFFIX).desc(), F.col(order_by))
    return f.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def best_candidate(cands: DataFrame, key: str = "path") -> DataFrame:
    """Per page the longest stripped candidate text, earliest config on
    ties (a hash aggregate with partial combine, no sort); ``""`` when every
    candidate is blank."""
    score = F.struct(F.length(strip("text")).alias("n"), (-F.col("config_rank")).alias("r"))
    return cands.groupBy(key).agg(
        F.max_by(F.struct("config_rank", "text"), score).alias("_b")
    ).select(key, F.col("_b.config_rank").alias("config_rank"),
             F.when(strip("_b.text") == "", F.lit("")).otherwise(F.col("_b.text")).alias("text"))


def pending(inputs: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Inputs whose output is not there yet (anti join on the key)."""
    return inputs.join(done, key, "left_anti")
