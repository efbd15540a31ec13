"""Physical-plan properties the design relies on, read from ``explain``."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from indicata.plans.driver_queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def test_projection_reads_only_kept_columns_and_never_shuffles(spark):
    plan = plan_of(entry.queries()["project_excluding"](spark, SF))
    assert "Exchange" not in plan
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "l_orderkey" in schema and "l_tax" not in schema and "l_shipdate" not in schema


def test_month_join_is_an_equi_join_and_scans_are_pruned(spark):
    plan = plan_of(entry.queries()["monthly_daily_join"](spark, SF))
    assert "year(" in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_aggregates_combine_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["series_average"](spark, SF))
    # One partial aggregate on the six keys; no other aggregate before it.
    assert plan.count("[partial_") == 1 and "[partial_avg(" in plan


def test_first_n_is_take_ordered(spark):
    plan = plan_of(entry.queries()["latest_n_rows"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_preamble_files_are_read_once_and_lines_never_shuffled(spark):
    plan = plan_of(entry.queries()["preamble_csv_scan"](spark, SF))
    # One listing, one exchange of its byte ranges, one pass over the text.
    assert plan.count("Scan binaryFile") == 2  # the node and its details
    assert "Join" not in plan and plan.count("MapInArrow (") == 1
    assert "content" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_regions_need_no_sort(spark):
    plan = plan_of(entry.queries()["region_scaled_series"](spark, SF))
    assert "rangepartitioning" not in plan


def test_region_fan_out_is_a_generator_not_a_join(spark):
    plan = plan_of(entry.queries()["region_scaled_series"](spark, SF))
    assert "Generate (" in plan and "inline(" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_join_key_null_filters_reach_the_scan(spark):
    plan = plan_of(entry.queries()["series_average"](spark, SF))
    assert "IsNotNull(l_partkey), IsNotNull(l_suppkey)]" in plan


def test_orders_reduced_per_customer_before_the_customer_join(spark):
    plan = plan_of(entry.queries()["period_over_period_by_key"](spark, SF))
    assert "Keys [2]: [o_custkey" in plan and "partial_count(v_m_IPC" in plan
