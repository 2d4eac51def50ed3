"""Sources, sinks, the result store, jobs and incremental ingest."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logquarry import schemas
from logquarry.operators import parse, resources, rollup
from logquarry.plans import jobs, reports
from logquarry.plans.workspace import shared_folder
from logquarry.sinks import files, jdbc
from logquarry.sinks import store as sink
from logquarry.sources import logs, tables
from logquarry.streaming.ingest import ingest_stream

LINE = 'h{h} - - [01/Jul/1995:{hour:02d}:00:00 -0400] "GET /p{p} HTTP/1.0" {status} 10'


def log_lines(count, start=0):
    return [
        LINE.format(h=i % 7, hour=i % 5, p=i % 3, status=404 if i % 4 == 0 else 200)
        for i in range(start, start + count)
    ] + ["", "garbage"]


@pytest.fixture
def batches(tmp_path):
    for number, (count, start) in enumerate([(40, 0), (25, 3)], start=1):
        folder = tmp_path / "logs" / f"batch_{number}"
        folder.mkdir(parents=True)
        lines = log_lines(count, start)
        (folder / "a.log").write_text("\n".join(lines[:15]) + "\n")
        (folder / "b.log").write_text("\n".join(lines[15:]) + "\n")
    root = tmp_path / "logs"
    return [logs.Batch(f"{root}/batch_1", "July"), logs.Batch(f"{root}/batch_2", "August")]


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_select_batches():
    both = [logs.Batch("a", "July"), logs.Batch("b", "August")]
    assert logs.select_batches(both) == both
    assert logs.select_batches(both, "august") == both[1:]
    with pytest.raises(ValueError):
        logs.select_batches(both, "May")


def test_line_ends_and_hidden_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.log").write_bytes(b"one\r\ntwo\rthree\n\nfour")
    (tmp_path / "in" / "deep" / "b.log").write_text("five\n")
    (tmp_path / "in" / "_SUCCESS").write_text("no\n")
    (tmp_path / "in" / ".hidden").write_text("no\n")
    found = [r.line for r in logs.read_lines_recursive(spark, f"{tmp_path}/in").collect()]
    assert sorted(found) == ["", "five", "four", "one", "three", "two"]
    assert logs.read_lines(spark, f"{tmp_path}/in/*.log").count() == 5


@pytest.mark.parametrize("broadcast_splits", [0, logs.BROADCAST_SPLITS])
@pytest.mark.parametrize("split_bytes", ["1000000", "700"])
def test_chunks_hold_consecutive_lines(spark, tmp_path, split_bytes, broadcast_splits):
    """Membership, not only sizes, also when files span several input splits."""
    (tmp_path / "in").mkdir()
    expected = []
    for name, count in (("a", 90), ("b", 7), ("c", 41)):
        lines = [f"{name}{i} " + "x" * (i % 40) for i in range(count)]
        (tmp_path / "in" / f"{name}.log").write_text("\n".join(lines) + "\n")
        expected += lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        chunks = logs.chunk_lines(spark, [f"{tmp_path}/in"], f"{tmp_path}/staging", 25, broadcast_splits)
        plan = chunks._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (broadcast_splits > 0)
        found = chunks.orderBy("line_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in found] == expected
    assert [r.line_index for r in found] == list(range(len(expected)))
    assert [r.batch_id for r in found] == [i // 25 + 1 for i in range(len(expected))]


def test_tsv_keeps_awkward_values(spark, tmp_path):
    data = [("/q\"x\"", "h\\1", 1), (" /lead", "trail ", 2), ("/a#b", None, 3), ("'", "\\", 4)]
    df = spark.createDataFrame(data, "resource_path string, host string, n int")
    files.write_tsv(df, f"{tmp_path}/out")
    assert rows(tables.read_tsv(spark, f"{tmp_path}/out", df.schema)) == rows(df)
    files.write_tsv(df.limit(1), f"{tmp_path}/out")
    assert tables.read_tsv(spark, f"{tmp_path}/out", df.schema).count() == 1


def test_quarantine_and_results_are_apart(spark, lines_of, tmp_path):
    lines = lines_of((1, "junk"), (2, " more junk\t"), (2, ""), (1, log_lines(1)[0]))
    files.write_quarantine(lines, f"{tmp_path}/bad")
    kept = spark.read.schema(schemas.RAW_LINES).parquet(f"{tmp_path}/bad")
    assert sorted((r.batch_id, r.line) for r in kept.collect()) == [(1, "junk"), (2, "more junk")]


def test_replaced_partitions_leave_others(spark, tmp_path):
    schema = "batch_id int, resource_path string, host string, req_count bigint, bytes bigint"
    first = spark.createDataFrame([(1, "/a", "h", 1, 1), (2, "/b", "h", 1, 1), (2, "/c", "h", 1, 1)], schema)
    again = spark.createDataFrame([(2, "/b", "h", 5, 5), (3, "/d", "h", 1, 1)], schema)
    path = f"{tmp_path}/p"
    for df in (first, again, again):
        files.replace_partitions(df, path, "batch_id")
    found = spark.read.schema(schemas.RESOURCE_PARTIALS).parquet(path).collect()
    assert sorted((r.batch_id, r.resource_path, r.req_count) for r in found) == [
        (1, "/a", 1), (2, "/b", 5), (3, "/d", 1)
    ]


def test_gather_without_adaptive_execution(spark):
    df = spark.range(1000).selectExpr("id % 2 as batch_id", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert files.gather(df, ["batch_id"]) is df
        spread = files.gather(df, ["batch_id"], spread=4).groupBy(
            "batch_id", F.spark_partition_id().alias("p")
        ).count()
        assert 2 < spread.count() <= 8
        assert spread.agg(F.sum("count")).first()[0] == 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_all_questions_at_once_equal_one_at_a_time(spark, batches, tmp_path):
    together, apart = f"{tmp_path}/a", f"{tmp_path}/b"
    jobs.run_all(spark, together, batches, run_id=5)
    for job in (jobs.run_q1, jobs.run_q2, jobs.run_q3):
        job(spark, apart, batches, run_id=5, per_batch=True)
    for table in ("query_results", "malformed_record_summary"):
        a, b = (tables.read_store(spark, s, table) for s in (together, apart))
        assert rows(a) == rows(b) and a.count()
    sizes = [
        tables.read_store(spark, s, "batch_metadata").drop("runtime_ms", "stage")
        for s in (together, apart)
    ]
    assert rows(sizes[0]) == rows(sizes[1])


def test_a_run_again_adds_nothing(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    jobs.run_all(spark, store, batches, run_id=1)
    before = {t: rows(tables.read_store(spark, store, t).drop("runtime_ms", "execution_timestamp"))
              for t in schemas.STORE_TABLES}
    jobs.run_all(spark, store, batches[:1], run_id=2)
    jobs.run_all(spark, store, batches, run_id=1)
    for table in schemas.STORE_TABLES:
        stored = tables.read_store(spark, store, table)
        again = stored.filter("run_id = 1").drop("runtime_ms", "execution_timestamp")
        assert rows(again) == before[table]
        assert stored.filter("run_id = 2").count() > 0


def test_a_run_again_over_fewer_batches_forgets_the_others(spark, batches, tmp_path):
    jobs.run_all(spark, f"{tmp_path}/a", batches, run_id=1)
    jobs.run_all(spark, f"{tmp_path}/a", batches[:1], run_id=1)
    jobs.run_all(spark, f"{tmp_path}/b", batches[:1], run_id=1)
    for table in schemas.STORE_TABLES:
        a, b = (
            tables.read_store(spark, f"{tmp_path}/{s}", table).drop(
                "runtime_ms", "execution_timestamp"
            )
            for s in "ab"
        )
        assert rows(a) == rows(b)


def test_batch_metadata_and_reports(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    run = jobs.run_all(spark, store, batches)
    summary = reports.batch_summary(spark, store, run).collect()
    assert [(r.query_name, r.batch_id, r.batch_label) for r in summary] == [
        (q, i, label) for q in ("Q1", "Q2", "Q3") for i, label in ((1, "July"), (2, "August"))
    ]
    july, august = summary[0], summary[1]
    assert (july.batch_size, july.blank_lines, july.malformed_lines, july.records_processed) == (42, 1, 1, 40)
    assert (august.batch_size, august.records_processed) == (27, 25)
    assert float(july.average_batch_size) == 34.5
    expected_bytes = sum(len(x) + 1 for x in log_lines(40))
    assert july.batch_bytes == expected_bytes
    assert all(r.runtime_ms > 0 for r in summary)
    assert reports.total_runtime(spark, store, run).first()[0] >= july.runtime_ms / 1000

    assert reports.report_q1(spark, store, run).agg(F.sum("request_count")).first()[0] == 65
    top = reports.report_q2(spark, store, run).collect()
    assert [r.request_count for r in top] == sorted((r.request_count for r in top), reverse=True)
    assert {r.distinct_hosts for r in top} == {7}
    hours = reports.report_q3(spark, store, run, chronological=True).collect()
    assert [r.log_hour for r in hours] == [0, 1, 2, 3, 4]
    assert sum(r.total_requests for r in hours) == 65


def test_total_runtime_counts_each_job_once(spark, tmp_path):
    data = [("Q1", 1, "all_batches", 1000), ("Q1", 2, "all_batches", 1000),
            ("Q2", 1, "all_batches", 1000), ("Q1", None, "merge", 20), ("Q2", None, "merge", 20)]
    for run, stage, expected in ((1, "all_batches", 1.02), (2, "batch", 2.02)):
        df = spark.createDataFrame(
            [(q, b, stage if s != "merge" else s, ms, run) for q, b, s, ms in data],
            "query_name string, batch_id int, stage string, runtime_ms bigint, run_id bigint",
        )
        sink.save_batch_metadata(df, str(tmp_path))
        assert reports.total_runtime(spark, str(tmp_path), run).first()[0] == expected


def test_runs_get_their_own_ids(spark, tmp_path):
    ids = [sink.create_run(spark, str(tmp_path), "spark") for _ in range(2)]
    assert ids[0] < ids[1]
    stored = tables.read_store(spark, str(tmp_path), "run_metadata").collect()
    assert sorted(r.run_id for r in stored) == ids
    assert all(r.execution_timestamp is not None for r in stored)


def test_store_tables_in_the_catalog(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    jobs.run_q1(spark, store, batches, run_id=1)
    sink.create_tables(spark, store, "access_logs")
    found = spark.sql(
        "select sum(request_count) from access_logs.query_results where run_id = 1 and query_name = 'Q1'"
    ).first()[0]
    assert found == 65


def test_results_reading_prunes_partitions(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    jobs.run_q1(spark, store, batches, run_id=1)
    plan = tables.results_for_run(spark, store, 1, "Q1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_jdbc_properties():
    found = jdbc.connection_properties("me", "secret", driver="org.example.Driver", ssl="true")
    assert found == {"user": "me", "password": "secret", "driver": "org.example.Driver",
                     "ssl": "true", "batchsize": "10000"}


def test_export_takes_one_run_of_every_table(spark, batches, tmp_path, monkeypatch):
    """The rows and tables handed to the writer; no database is there to take them."""
    store = f"{tmp_path}/store"
    jobs.run_q1(spark, store, batches, run_id=1)
    jobs.run_q1(spark, store, batches[:1], run_id=2)
    handed = {}
    monkeypatch.setattr(
        jdbc, "write_jdbc", lambda df, url, table, properties: handed.update({table: df.collect()})
    )
    jdbc.export_run(spark, store, 2, "jdbc:example:x", {})
    assert set(handed) == set(schemas.STORE_TABLES)
    assert all(found and {r.run_id for r in found} == {2} for found in handed.values())


def test_shared_folder_follows_the_session(spark):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != shared_folder(spark, "x")


def ingest(spark, root, batches, target, checkpoint, **options):
    ingest_stream(spark, root, batches, target, checkpoint, **options).awaitTermination()
    return jobs.read_partials(spark, target)


def test_ingest_is_exactly_once(spark, batches, tmp_path):
    root, target = f"{tmp_path}/logs", f"{tmp_path}/target"
    lines = logs.read_batches(spark, batches).drop("batch_label")
    requests = parse.filter_resources(parse.parse_lines(lines))
    expected = rows(resources.resource_totals(requests))

    def totals(stored):
        return rows(resources.merge_partials(rollup.resource_rows_of(stored)))

    stored = ingest(spark, root, batches, target, f"{tmp_path}/c1", max_files_per_trigger=1)
    assert totals(stored) == expected
    assert totals(ingest(spark, root, batches, target, f"{tmp_path}/c1")) == expected
    assert totals(ingest(spark, root, batches, target, f"{tmp_path}/c2")) == expected
    assert rows(rollup.hourly_of(jobs.read_partials(spark, target))) == rows(
        rollup.hourly_of(rollup.partials(lines))
    )

    # A batch grows: only the new file is read, and all results move on.
    (tmp_path / "logs" / "batch_2" / "c.log").write_text("\n".join(log_lines(9, 50)) + "\n")
    grown = ingest(spark, root, batches, target, f"{tmp_path}/c2")
    lines = logs.read_batches(spark, batches).drop("batch_label")
    requests = parse.filter_resources(parse.parse_lines(lines))
    assert totals(grown) == rows(resources.resource_totals(requests)) != expected


def test_ingest_finds_folders_with_odd_names(spark, tmp_path):
    folder = tmp_path / "logs" / "July 1995+50%"
    folder.mkdir(parents=True)
    (folder / "a b.log").write_text(log_lines(1)[0] + "\n")
    single = tmp_path / "logs" / "august.log"
    single.write_text("\n".join(log_lines(2)) + "\n")
    listed = [logs.Batch(f"file://{folder}/", "July"), logs.Batch(str(single), "August")]
    stored = ingest(spark, f"{tmp_path}/logs", listed, f"{tmp_path}/t", f"{tmp_path}/c")
    found = {r.batch_id: r.total_lines for r in rollup.quality_of(stored).collect()}
    assert found == {1: 1, 2: 4}


def test_bytes_that_are_no_utf8(spark, tmp_path):
    good = log_lines(1)[0].encode()
    lines = [good.replace(b"/p0", b"/p\xe9"), good + b"\xe9 ", b"\xe9", b"\xf0\x9f \t", b" \xff "]
    (tmp_path / "a.log").write_bytes(b"\n".join(lines) + b"\n")
    read = logs.read_lines(spark, str(tmp_path)).withColumn("batch_id", F.lit(1))
    kinds = [r.line_kind for r in parse.classify_lines(read).collect()]
    assert kinds == ["parsed", "parsed", "malformed", "malformed", "malformed"]
    paths = [r.resource_path for r in parse.filter_resources(parse.parse_lines(read)).collect()]
    assert paths == ["/p", "/p0"]
    assert [r.line for r in parse.malformed_lines(read).collect()] == ["\ufffd"] * 3


def test_ingest_stops_at_a_file_no_batch_lists(spark, batches, tmp_path):
    with pytest.raises(StreamingQueryException, match="no batch lists"):
        ingest(spark, f"{tmp_path}/logs", batches[:1], f"{tmp_path}/t", f"{tmp_path}/c")
