"""Plans stay the ones meant: no pairing without keys, filters in the scan, few shuffles."""

import contextlib
import io

import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
TABLE_QUERIES = [name for name in QUERIES if not name.startswith("stream_")]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def plans(spark, sf):
    return {name: plan(QUERIES[name](spark, sf)) for name in TABLE_QUERIES}


def test_nothing_is_paired_without_a_key(plans):
    pairing = {n for n, text in plans.items() if "CartesianProduct" in text or "BroadcastNestedLoopJoin" in text}
    assert not pairing


@pytest.mark.parametrize("name, pushed", [
    ("action_count_history", "EqualTo(event_type,view)"), ("rule_model2_matches", "In(event_type"),
    ("sequence_history", "In(event_type"), ("window_join_inner", "EqualTo(event_type,click)"),
    ("profile_audience", "GreaterThanOrEqual(c_acctbal,0.0)"), ("profile_audience", "GreaterThanOrEqual(c_nationkey,5)"),
])
def test_filters_reach_the_scan(plans, name, pushed):
    assert [line for line in plans[name].splitlines() if line.startswith("PushedFilters") and pushed in line]


@pytest.mark.parametrize("name, shuffles", [
    ("session_count_keyed", 1), ("bounce_detail", 1), ("count_window_keyed", 1), ("count_slide_keyed", 1),
    ("tumbling_count_keyed", 1), ("first_visit_daily", 1), ("cdc_latest_state", 1), ("rolling_min_by", 1),
    ("watermark_progress", 1), ("json_typed_events", 0), ("dirty_record_split", 0), ("cdc_flatten", 0),
    ("display_explode", 0), ("rule_model1_matches", 2), ("late_refire_log", 2),
])
def test_shuffles(plans, name, shuffles):
    tree = plans[name].split("\n\n")[0]
    assert sum(" Exchange " in line or line.rstrip().endswith("Exchange") for line in tree.splitlines()
               if "BroadcastExchange" not in line) <= shuffles


def test_scans_read_only_the_columns_they_need(plans):
    for name in ("first_visit_daily", "tumbling_count_keyed", "bounce_detail", "watermark_progress"):
        schemas = [line for line in plans[name].splitlines() if line.startswith("ReadSchema")]
        assert schemas and all("props" not in line for line in schemas), name
