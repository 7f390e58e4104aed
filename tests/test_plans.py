"""What the physical plans must and must not hold."""

import pytest

import __spark_entry__ as entry_points
from newsroster import catalog

FOLDER = entry_points.SMOKE_DATA
QUERIES = catalog.queries()


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")
    ).split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {
    "stream_resume", "stream_state", "stream_logs", "publish_job", "state_store", "append_results"}))
def test_no_single_task_window_no_cross_join_no_row_udf(spark, name):
    text = plan(spark, name)
    assert "BatchEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for line in text.splitlines():
        if " Window [" in line:
            # Window [functions], [partition], [order]
            assert "], [], [" not in line and not line.rstrip().endswith("], []"), line


@pytest.mark.parametrize("name", ["dedup_links", "unique_links_capped", "page_facts"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_k_is_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "review_top_k")


def test_small_renames_are_broadcast_by_size(spark):
    assert "BroadcastHashJoin" in plan(spark, "rename_person")


@pytest.mark.parametrize("name", ["html_to_text", "fill_blanks", "process_job"])
def test_html_is_in_no_exchange(spark, name):
    from newsroster.catalog.landed import Landed
    from newsroster.operators import enrich
    from newsroster.plans.process import Rules, scored

    landed = Landed(spark, FOLDER)
    frame = {
        "html_to_text": lambda: QUERIES["html_to_text"](spark, FOLDER),
        "fill_blanks": lambda: enrich.fill_blanks(landed.mentions, enrich.page_facts(landed.pages)),
        # The query ranks a pinned table; the stage that reads pages is this one.
        "process_job": lambda: scored(landed.mentions, Rules(), landed.pages, landed.link_answers),
    }[name]()
    exchanged = [
        node.output().mkString(",") for node in _nodes(frame._jdf.queryExecution().sparkPlan())
        if "Exchange" in node.nodeName()]
    plan_ = frame._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan_
    assert not any("html" in columns for columns in exchanged)
    for line in plan_.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "html" not in line


def _nodes(plan_):
    yield plan_
    children = plan_.children()
    for k in range(children.size()):
        yield from _nodes(children.apply(k))


def test_link_filters_run_before_the_dedup(spark):
    from newsroster.catalog.landed import Landed
    from newsroster.plans.process import Rules, cleaned

    mentions = Landed(spark, FOLDER).mentions
    rows = cleaned(mentions, Rules(["bad.com"], ["word"], ["gone"]))
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Window [row_number") < text.index("gone")
