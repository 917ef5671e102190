import datetime as dt

from minutebook.operators import catalog


def test_best_version_prefers_first_ocr(spark):
    df = spark.createDataFrame([
        ("r/a_ocr.pdf", "r", "1970-01-05_a_ocr.pdf"),
        ("r/b.pdf", "r", "1970-01-05_b.pdf"),
        ("r/c_ocr.pdf", "r", "1970-01-05_c_ocr.pdf"),
        ("r/d_backup_ocr.pdf", "r", "1970-01-05_d_backup_ocr.pdf"),
        ("r/e.pdf", "r", "1970-01-06_e.pdf"),
        ("r/f_OCR.pdf", "r", "1970-01-06_f_OCR.pdf"),     # case-sensitive: not an OCR name
        ("r/none.pdf", "r", "none.pdf"),                  # no date: dropped
    ], "path string, parent string, name string")
    got = {r.date_key: r.name for r in catalog.best_version(df).collect()}
    assert got == {dt.date(1970, 1, 5): "1970-01-05_a_ocr.pdf", dt.date(1970, 1, 6): "1970-01-06_e.pdf"}


def test_best_candidate_ties_and_empty(spark):
    df = spark.createDataFrame([
        ("p", 0, "abc"), ("p", 1, " abcd "), ("p", 2, "wxyz"), ("p", 3, "x"),
        ("q", 0, ""), ("q", 1, "  "), ("q", 2, ""), ("q", 3, ""),
    ], "path string, config_rank int, text string")
    got = {r.path: (r.config_rank, r.text) for r in catalog.best_candidate(df).collect()}
    assert got == {"p": (1, " abcd "), "q": (0, "")}


def test_pending_pdfs_and_moves(spark):
    df = spark.createDataFrame([
        ("a/x.pdf", "x.pdf"), ("a/x_ocr.pdf", "x_ocr.pdf"), ("a/x_backup.pdf", "x_backup.pdf"),
        ("a/temp_x.pdf", "temp_x.pdf"), ("a/x.backup.pdf", "x.backup.pdf"), ("b/x.pdf", "x.pdf"),
        ("b/Y_OCR.PDF", "Y_OCR.PDF")], "path string, name string")
    assert sorted(r.path for r in catalog.pending_pdfs(df).collect()) == ["a/x.pdf", "b/x.pdf"]
    moves = {(r.source, r.conflict) for r in catalog.plan_moves(df, "flat").collect()}
    assert ("a/x.pdf", True) in moves and ("b/x.pdf", True) in moves
    assert not any(s == "b/Y_OCR.PDF" for s, _ in moves)   # _ocr in any case stays


def test_has_text_first_pages_only(spark):
    pages = spark.createDataFrame([
        ("f1", 1, "a" * 60), ("f1", 2, "b" * 41), ("f2", 1, "a" * 60), ("f2", 4, "b" * 400),
    ], "path string, page_no int, text string")
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "path string")
    got = {r.path: r.has_text for r in catalog.has_text(pages, files).collect()}
    assert got == {"f1": True, "f2": False, "f3": False}
    once = catalog.page_totals(pages.union(spark.createDataFrame([("f4", 9, None)], pages.schema))).collect()
    assert {r.path: (r.has_text, r.chars, r.pages) for r in once} == {"f1": (True, 101, 2), "f2": (False, 460, 2), "f4": (False, None, 1)}
