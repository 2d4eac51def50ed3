"""The physical plans that the design counts on."""

import pytest

from logquarry.operators import errors, parse, quality, resources, rollup, traffic
from logquarry.plans.catalog import QUERIES
from logquarry.sinks import files
from logquarry.sources.corpus import corpus_lines


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return corpus_lines(spark, sf_dir)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def requests_of(lines):
    return parse.filter_resources(parse.parse_lines(lines))


def test_line_pattern_runs_once_per_row(lines):
    for df in (
        traffic.daily_status(parse.parse_lines(lines)),
        errors.hourly_errors(parse.parse_lines(lines)),
        resources.resource_totals(requests_of(lines)),
        rollup.partials(lines),
        parse.malformed_lines(lines),
    ):
        assert plan_of(df).count(r"regexp_replace(line") == 1


def test_request_pattern_and_path_run_once_per_row(lines):
    plan = plan_of(resources.resource_totals(requests_of(lines)))
    assert plan.count("regexp_replace(request") == 1
    assert plan.count("UrlCodec.decode") == 1


@pytest.mark.parametrize("name", ["q1_daily_status", "q2_top20", "q3_hourly_errors", "rollup_partials"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Python" not in plan and "InPandas" not in plan


def test_aggregation_starts_before_the_shuffle(lines):
    plan = plan_of(traffic.daily_status(parse.parse_lines(lines)))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert plan_of(rollup.partials(lines)).count("Exchange") == 1


def test_top_resources_need_no_global_sort(lines):
    plan = plan_of(resources.top_resources(resources.resource_totals(requests_of(lines))))
    assert "TakeOrderedAndProject" in plan and "SinglePartition" not in plan


def test_merge_broadcasts_the_ranked_paths_only(spark, lines, tmp_path):
    path = f"{tmp_path}/partials"
    files.replace_partitions(resources.resource_partials(requests_of(lines)), path, "batch_id")
    stored = spark.read.parquet(path)
    plan = plan_of(resources.merge_top_resources(stored))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Ranking reads no hosts.
    assert "ReadSchema: struct<resource_path:string,host:string>" in plan


@pytest.mark.parametrize("name, reads", [("q2_stage1_hostset", 1), ("q2_hostset_union", 1), ("q2_stage2_top20", 2)])
def test_what_reads_twice_reads_stored_rows(spark, sf_dir, name, reads):
    """Joins back onto the same rows must not parse the logs a second time; host sets need none."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "regexp_replace" not in plan and plan.count("FileScan parquet") == reads
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(QUERIES["q3_hourly_errors"](spark, sf_dir))
    scan = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert scan.count(":") == 6  # the event columns a log line is made of


def test_host_sets_shuffle_once_by_part_and_join_nothing(spark):
    partials = spark.range(100).selectExpr(
        "id % 2 as batch_id", "concat('/p', id % 3) as resource_path", "concat('h', id) as host", "1L as req_count", "1L as bytes"
    )
    plan = plan_of(resources.host_set_partials(partials))
    assert "Join" not in plan and plan.count("Exchange") == 1 and "hashpartitioning(batch_id" in plan
    assert "_groupingexpression" in plan or "host_part" in plan


def test_average_batch_size_holds_large_batches(spark):
    rows = spark.createDataFrame([(1, 600_000_000_000), (2, 400_000_000_000)], "batch_id int, total_lines long")
    averages = quality.with_average_size(rows).select("average_batch_size").collect()
    assert [float(r[0]) for r in averages] == [5e11, 5e11]
