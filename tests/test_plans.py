"""Physical-plan checks: the plans we want at scale, not just right rows."""
from minutebook.operators import catalog
from minutebook.plans import views
from minutebook.plans.registry import ORACLE, QUERIES

from .conftest import SF_SMALL


def plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString(), df


def test_w2_has_no_single_partition_over_pages(spark):
    p, _ = plan(spark, "w2_assign_meetings_bucketed")
    assert "SinglePartition" not in p


def test_w3_uses_window_group_limit(spark):
    p, df = plan(spark, "w3_best_version")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p or "WindowGroupLimit" in final


def test_roster_join_is_equi_join(spark):
    p, _ = plan(spark, "j2_roster_for")
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_no_python_outside_model_calls(spark):
    for name in QUERIES:
        if name in ("u3_run_model", "j4_attach_responses", "r3_placeholder", "w7_sorted_summaries",
                    "a8_summary_run_stats", "st1_stream_index"):
            continue
        p, _ = plan(spark, name)
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in p, (name, node)


def test_first_pages_filter_reaches_scan(spark):
    pages = views.v_pdf_pages(spark, SF_SMALL)
    p = catalog.has_text(pages, pages)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "turn" in p


def test_file_outcomes_read_the_pages_once(spark):
    for name in ("p12_has_text", "a7_ocr_run_stats"):
        p, _ = plan(spark, name)
        assert p.count("FileScan") == 1 and "Join" not in p, name


def test_no_cross_joins_anywhere(spark):
    for name in QUERIES:
        if name == "st1_stream_index":
            continue
        p, _ = plan(spark, name)
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
