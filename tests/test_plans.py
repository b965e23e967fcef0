"""Plan shape: no nested-loop or cartesian joins, equi-keys on the bar join,
pruned scans."""

import re

import pytest

import __spark_entry__ as se

STREAMS = {"stream_dedup", "stream_bars", "daily_digest"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# the training-data queries run jobs when built; their plans are tested beside them
NAMES = sorted(q for q in set(se.queries()) - STREAMS if not q.startswith("op") and q != "pipeline")


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loop_or_cartesian(spark, sf_small, name):
    p = plan(se.queries()[name](spark, sf_small))
    assert "BroadcastNestedLoopJoin" not in p
    assert "CartesianProduct" not in p


def test_bar_join_has_equi_keys_and_pruned_scan(spark, sf_small):
    df = se.queries()["target_touch"](spark, sf_small)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ticker" in p and "session_date" in p
    assert "NestedLoop" not in p
    explained = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(explained)
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]


def test_scan_counts(spark, sf_small):
    p = plan(se.queries()["scan_funnel"](spark, sf_small))
    assert p.count("orders.parquet") <= 12 and p.count("documents.parquet") <= 2


def test_document_work_only_where_needed(spark, sf_small):
    """Cleaning follows the semi-join to the filings that need their document."""
    for name in ("alert_payload", "rule_score", "ticker_resolution"):
        p = plan(se.queries()[name](spark, sf_small))
        assert "LeftSemi" in p, name


def test_python_only_decodes_entities_and_scores(spark, sf_small):
    for name in NAMES:
        p = plan(se.queries()[name](spark, sf_small))
        assert "BatchEvalPython" not in p and ("MapInPandas" not in p or name == "batch_scorer"), name


def nodes(p):
    if p.nodeName() == "AdaptiveSparkPlan":
        p = p.initialPlan()
    yield p
    for i in range(p.children().size()):
        yield from nodes(p.children().apply(i))


@pytest.mark.parametrize("name", ["scan_funnel", "rule_score", "score_requests", "batch_scorer", "feed_diagnostics"])
def test_no_filing_text_is_shuffled(spark, sf_small, name):
    """documents are dealt out once each, never as the text of a filing."""
    df = se.queries()[name](spark, sf_small)
    moved = [n.output().toString() for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]
    assert moved and not [m for m in moved if re.search(r"\b(raw|_text|clean|section)#", m)]
