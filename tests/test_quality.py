"""Counts on the way, differences between definitions and results, the audit of a store, SQL views."""

import pytest
from pyspark.sql import functions as F

from logquarry import schemas
from logquarry.operators import parse, quality
from logquarry.plans import jobs
from logquarry.sinks import store as sink
from logquarry.sources import logs, tables
from logquarry.sources.views import create_log_view

GOOD = 'h{i} - - [01/Jul/1995:03:00:00 -0400] "GET /p{i} HTTP/1.0" 200 10'


def good(i=0):
    return GOOD.format(i=i)


def test_counts_on_the_way_are_those_of_a_pass(spark, lines_of, tmp_path):
    lines = lines_of(good(), "", "junk", (2, good(1)), (2, "é  "), (3, " \t"))
    classified, counts = quality.observed(lines, batches=[1, 2, 3, 4])
    classified.filter(F.col("line_kind") == parse.PARSED).drop("line").write.parquet(f"{tmp_path}/parsed")
    found, names = counts.get, ("total_lines", "blank_lines", "malformed", "records_processed", "batch_bytes")
    whole = quality.parse_quality(lines).collect()
    for r in whole:
        assert [found[f"{n}_{r.batch_id}"] for n in names] == [r[n] for n in names]
    assert [found[n] for n in names] == [sum(r[n] for r in whole) for n in names]
    assert all(found[f"{n}_4"] == 0 for n in names)
    empty, none = quality.observed(lines.limit(0), "none")
    assert empty.count() == 0 and none.get["total_lines"] == 0 and none.get["batch_bytes"] == 0


def test_equal_counts_may_hide_different_lines(spark, lines_of):
    only_lenient, only_strict = "  " + good(1), good(2).replace(" - - [", " a b [").replace(" 200 ", " 200 ")
    lines = lines_of(good(), only_lenient, only_lenient, "junk", (2, only_lenient), only_strict)
    found = {(r.batch_id, r.line, r.kept_by): r.line_count for r in quality.profile_difference(lines, "lenient", "strict_daily").collect()}
    assert found == {(1, only_lenient, "lenient"): 2, (2, only_lenient, "lenient"): 1}
    back = quality.profile_difference(lines, "strict_daily", "lenient")
    assert {r.kept_by for r in back.collect()} == {"lenient"}
    assert quality.profile_difference(lines, "lenient", "lenient").count() == 0


def test_groups_that_differ(spark):
    schema = "day string, code int, n bigint, size decimal(38,0)"
    a = spark.createDataFrame([("x", 1, 5, None), ("x", None, 2, None), (None, 1, 3, None), ("same", 1, 1, None)], schema)
    b = spark.createDataFrame([("x", 1, 6, None), ("x", None, 2, None), ("new", 1, 9, None), ("same", 1, 1, None)], schema)
    found = quality.compare_groups(a, b, ("day", "code"), ("n", "size"))
    assert sorted(map(tuple, found.select("day", "code", "n_first", "n_second").collect()), key=str) == [
        ("new", 1, None, 9), ("x", 1, 5, 6), (None, 1, 3, None)
    ]
    assert quality.compare_groups(a, a, ("day", "code"), ("n", "size")).count() == 0


@pytest.fixture
def store(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"b{i}").mkdir()
        (tmp_path / f"b{i}/a.log").write_text("\n".join([good(i), "junk", good(3)]) + "\n")
    batches = [logs.Batch(f"{tmp_path}/b{i}", f"B{i}") for i in (1, 2)]
    jobs.run_all(spark, f"{tmp_path}/store", batches, run_id=1)
    jobs.run_all(spark, f"{tmp_path}/store", batches, run_id=2, per_batch=True)
    return f"{tmp_path}/store"


def test_a_sound_store_has_no_faults(spark, store):
    held = {t: tables.read_store(spark, store, t) for t in schemas.STORE_TABLES}
    assert quality.store_faults(held).count() == 0
    empty = {t: df.limit(0) for t, df in held.items()}
    assert quality.store_faults(empty).count() == 0


def test_faults_in_a_store(spark, store):
    sink.append(spark.sql("select 9L run_id, 'Q1' query_name, 1 batch_id, 'd' log_date, 200 status_code"), store, "query_results")
    sink.append(spark.sql("select null pipeline_name, current_timestamp() execution_timestamp, 3L run_id"), store, "run_metadata")
    twice = spark.sql("select 2L run_id, 'Q9' query_name, 4 batch_id, explode(array(1, 2, 3)) malformed_record_count")
    sink.append(twice, store, "malformed_record_summary")
    held = {t: tables.read_store(spark, store, t) for t in schemas.STORE_TABLES}
    found = {(r.fault, r.table_name, r.run_id, r.query_name): r.row_count for r in quality.store_faults(held).collect()}
    assert found == {
        ("orphan_run", "query_results", 9, "Q1"): 1,
        ("orphan_batch", "query_results", 9, "Q1"): 1,
        ("null_key", "run_metadata", 3, None): 1,
        ("repeated_group", "malformed_record_summary", 2, "Q9"): 2,
    }


def test_a_view_shows_what_schema_on_read_does(spark, tmp_path):
    folders = [tmp_path / "a`b", tmp_path / "c"]
    for f in folders:
        f.mkdir()
        (f / "x.log").write_text("\n".join([good(1), "junk", "", good(2) + " ", 'h - - [d] "GET /q" 404 -']) + "\n")
    batches = [logs.Batch(str(f), "B") for f in folders]
    for shape in ("lenient", "strict_resources", "clock_hourly"):
        create_log_view(spark, "raw_logs", f"view_{shape}", batches, shape)
        seen = spark.table(f"raw_logs.view_{shape}")
        ours = parse.read_with_pattern(logs.batch_lines(spark, batches), shape)
        assert seen.columns == ours.columns
        assert sorted(map(str, seen.collect())) == sorted(map(str, ours.collect()))
    plan = spark.sql("select host from raw_logs.view_lenient where host like 'h%'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    (folders[1] / "y.log").write_text(good(7) + "\n")
    assert spark.sql("refresh table raw_logs.view_lenient").count() == 0
    assert spark.sql("select count(*) from raw_logs.view_lenient where host = 'h7'").first()[0] == 1
