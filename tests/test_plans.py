"""Plan checks (section 5.7): built-in expressions only, pushdown, partial
aggregation, bounded windows."""

import pytest

import __spark_entry__ as E
from sensorstream import queries as _q
from sensorstream.plans import checks as C

from .conftest import SF_SMALL

BATCH = [n for n in _q.QUERIES if not n.startswith("stream_")]


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_python_udf(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert not C.has_python_udf(df)


def test_filters_reach_the_scan(spark):
    df = E.queries()["time_range"](spark, SF_SMALL)
    pushed = " ".join(C.pushed_filters(df))
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_key_filter_below_latest_wins(spark):
    df = E.queries()["device_filter"](spark, SF_SMALL)
    assert any("device_id" in p for p in C.pushed_filters(df))


def test_column_pruning(spark):
    df = E.queries()["count_by_device"](spark, SF_SMALL)
    schemas = C.read_schemas(df)
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def test_partial_aggregation_before_shuffle(spark):
    for name in ("tumbling_avg_1m", "count_by_device", "upsert_latest", "sum_by_label"):
        assert C.has_partial_aggregate(E.queries()[name](spark, SF_SMALL)), name


def test_windows_are_partitioned(spark):
    for name in ("latest_n", "counter_rate_5m", "anomalies", "status_distribution", "status_distribution_by_device"):
        assert not C.has_unpartitioned_window(E.queries()[name](spark, SF_SMALL)), name


@pytest.mark.parametrize("name", sorted(BATCH))
def test_no_broadcast(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert "Broadcast" not in C.plan_text(df)


def _shuffles(df):
    import re
    return [e for e in re.findall(r"Exchange (\w+)", C.plan_text(df))]


def test_counter_rate_shuffles_once(spark):
    df = E.queries()["counter_rate_5m"](spark, SF_SMALL)
    assert _shuffles(df) == ["hashpartitioning"]


def test_global_top_n_limits_before_the_shuffle(spark):
    plan = C.plan_text(E.queries()["latest_n_device"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") == 2 and "TakeOrderedAndProject" in plan


def test_counter_rate_has_running_frames_only(spark):
    """A sliding frame would be summed anew for every sample."""
    plan = E.queries()["counter_rate_5m"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe" in plan
    assert all("unboundedpreceding" in frame.split(")")[0] for frame in plan.split("specifiedwindowframe(")[1:])


@pytest.mark.parametrize("name", ["read_latest_table", "device_filter", "compacted_table", "serve_latest_windows", "serve_count_by_device"])
def test_table_reads_shuffle_once(spark, name):
    """The keys' shuffle serves both choices; what is served from the table may shuffle its own (reduced) rows."""
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1, plan
    assert plan.count("Exchange ") == 1 + name.startswith("serve"), plan


def test_time_range_prunes_a_table_partitioned_by_day(spark):
    plan = E.queries()["serve_windows_in_range"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    found = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "day" in found and ">= 2024-01-03" in found and "<= 2024-01-05" in found
