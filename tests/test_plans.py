"""What the plans must look like for the work to scale."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as contract
from riverglass.operators.windows import edges, sliding_counts, watermarked
from riverglass.plans import standins as G

SMALL = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def of(spark, name):
    return plan(contract.queries()[name](spark, SMALL))


@pytest.mark.parametrize("name", ["rating_top10", "rating_top10_sql", "hot_keywords_top10",
                                  "user_hot_terms_top10", "error_prone_top"])
def test_top_lists_keep_a_bounded_heap_per_task(spark, name):
    text = of(spark, name)
    assert "TakeOrderedAndProject" in text and "partial_" in text
    assert "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["user_top_terms", "sliding_top3"])
def test_group_limits_come_before_the_shuffle(spark, name):
    text = of(spark, name)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


@pytest.mark.parametrize("name, columns", [
    ("rating_top10", "struct<l_suppkey:bigint,l_quantity:double>"),
    ("search_heat_by_hour", "struct<ts:timestamp_ntz>"),
    ("hot_keywords_top10", "struct<text:string>"),
    ("distinct_devices_by_type", "struct<user_id:bigint,event_type:string>"),
    ("answer_stats_by_grade", "struct<user_id:bigint,event_type:string,value:double>")])
def test_scans_read_only_what_is_needed(spark, name, columns):
    assert f"ReadSchema: {columns}" in of(spark, name)


def test_filters_reach_the_scan(spark):
    assert "EqualTo(role,user)" in of(spark, "user_top_terms")


@pytest.mark.parametrize("name", ["signal_over_30", "device_stats", "learning_report"])
def test_json_is_parsed_once(spark, name):
    assert of(spark, name).count("from_json") == 1


@pytest.mark.parametrize("name", sorted(
    n for n in contract.oracle_sql() if not any(w in n for w in ("stream", "live", "als", "recs", "stored", "etl"))))
def test_no_pairs_of_tables(spark, name):
    text = of(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_stream_combines_before_the_state(spark):
    stream = watermarked(G.events_stream(spark, SMALL))
    text = plan(edges(sliding_counts(stream, "2 days", "1 day", ["event_type"])))
    assert "StateStoreSave" in text and "partial_count" in text
