"""Plan-shape assertions: the physical plans we want at scale."""

import os

import pytest

import __spark_entry__ as E
from terrace.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_form_uses_partial_window_group_limit_and_no_nested_loop(spark):
    p = plan(E.queries()["club_form_last5"](spark, SF))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "WindowGroupLimit" in p


def test_top_scorers_is_take_ordered_with_pushed_filter(spark):
    df = E.queries()["top_scorers"](spark, SF)
    p = plan(df)
    assert "TakeOrderedAndProject" in p or "Limit" in p
    formatted = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters" in formatted


def test_global_rank_scaled_has_no_single_partition_exchange(spark):
    assert "SinglePartition" not in plan(E.queries()["global_rank_scaled"](spark, SF))


def test_no_row_at_a_time_python_udf(spark):
    for name, q in QUERIES.items():
        p = plan(q(spark, SF))
        assert "BatchEvalPython" not in p, name


def test_scan_prunes_columns(spark):
    df = E.queries()["clubs_by_city"](spark, SF)
    formatted = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<n_nationkey:int,n_name:string,n_regionkey:int>" in formatted


def test_no_cross_or_nested_loop_join_anywhere(spark):
    for name, q in QUERIES.items():
        p = plan(q(spark, SF))
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name


@pytest.mark.parametrize("name", ["audit_metrics", "quality_report", "audit_first_wins", "club_detail_counts", "league_audit_metrics"])
def test_audits_aggregate_by_hash(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, SF))


def test_first_rows_are_cut_down_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["audit_issue_log"](spark, SF))


def test_integrity_report_reads_each_table_once_per_check_pass(spark):
    p = plan(QUERIES["integrity_report"](spark, SF))
    assert p.count("orders.parquet") <= 6 and p.count("FileScan parquet") <= 40, p.count("FileScan parquet")


LEAGUE = ["league_table", "league_table_rint", "standings_position", "club_analytics", "club_form_last5", "form_letter_counts",
          "zone_badges", "table_counts", "fk_violations", "check_violations", "not_null_report", "cascade_delete",
          "club_detail_counts", "top_scorers_sql", "standings_surrogate_ids", "integrity_report"]


def test_league_queries_write_nothing(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = sorted(os.walk(folder))
    for name in LEAGUE:
        QUERIES[name](spark, SF).count()
    assert sorted(os.walk(folder)) == before


def test_one_plan_for_every_size(spark):
    """Operators only: sizes change what AQE does when it runs, not what is asked for."""
    import re
    shapes = [re.sub(r"#\d+L?|sf[0-9.]+|\[plan_id=\d+\]|\d+", "", QUERIES["standings_position"](spark, d)
                     ._jdf.queryExecution().optimizedPlan().toString()) for d in (SF, SF.replace("0.001", "0.1"))]
    assert shapes[0].replace("parquet", "") == shapes[1].replace("parquet", "")


def test_sql_top_k_takes_the_rows_first(spark):
    p = plan(QUERIES["top_scorers_sql"](spark, SF))
    assert "TakeOrderedAndProject" in p and "terrace-tables" not in p


@pytest.mark.parametrize("name,most", [("league_audit_metrics", 24), ("league_audit_issues", 24), ("audit_issue_log", 21)])
def test_audits_scan_each_batch_a_bounded_number_of_times(spark, name, most):
    n = plan(QUERIES[name](spark, SF)).count("FileScan parquet")
    assert n <= most, n
