"""Runs over and over, very large sizes, chunks, quarantine, imports and places of files."""

import pytest
from pyspark.sql import functions as F

from logquarry import schemas
from logquarry.operators import parse, resources, rollup, traffic
from logquarry.plans import jobs
from logquarry.sinks import files
from logquarry.sinks import store as sink
from logquarry.sources import logs, tables
from logquarry.streaming.ingest import ingest_stream, listed_places, place_of, with_source

LARGEST = 2**63 - 1
LINE = '{host} - - [01/Jul/1995:03:00:00 -0400] "GET {path} HTTP/1.0" {status} {size}'


def line(host="h", path="/p", status=200, size=10):
    return LINE.format(host=host, path=path, status=status, size=size)


@pytest.fixture
def batches(tmp_path):
    for number in (1, 2):
        folder = tmp_path / "logs" / f"batch_{number}"
        folder.mkdir(parents=True)
        (folder / "a.log").write_text("\n".join([line(), "garbage", line(path="/q")]) + "\n")
    return [logs.Batch(f"{tmp_path}/logs/batch_{i}", f"B{i}") for i in (1, 2)]


def test_the_largest_sizes_add_up(spark, lines_of):
    lines = lines_of(*[line(size=LARGEST)] * 3)
    parsed = parse.parse_lines(lines)
    requests = parse.filter_resources(parsed)
    partials = resources.resource_partials(requests)
    sums = [
        traffic.daily_status(parsed),
        traffic.roll_up_daily(traffic.daily_status(parsed, by_batch=True)),
        resources.resource_totals(requests),
        resources.merge_partials(partials),
        resources.merge_top_resources(partials),
        resources.merge_host_sets(resources.host_set_partials(partials)),
        rollup.daily_of(rollup.partials(lines)),
    ]
    for df in sums:
        assert df.schema["total_bytes"].dataType.simpleString() == "decimal(38,0)"
        assert [int(r.total_bytes) for r in df.collect()] == [3 * LARGEST]


def test_hosts_that_hold_the_separator(spark, lines_of):
    hosts = ["a#b", "a", "b", "c%23d", "c#d", "%"]
    lines = lines_of(*[line(host=h) for h in hosts])
    partials = resources.resource_partials(parse.filter_resources(parse.parse_lines(lines)))
    sets = resources.host_set_partials(partials)
    assert [r.distinct_hosts for r in resources.merge_host_sets(sets).collect()] == [len(hosts)]
    assert sorted(r.host for r in resources.host_tokens(sets).collect()) == sorted(hosts)
    assert sum(r.host_count for r in resources.union_host_sets(sets).collect()) == len(hosts)


def test_requests_without_a_path_share_one_row(spark, lines_of):
    lines = lines_of(*[line(host=f"h{i}", path="noslash") for i in range(50)])
    plan = rollup.partials(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "request_host" in plan
    assert rollup.partials(lines).filter(F.col("part") == rollup.REQUESTS).count() == 0


def test_named_partitions_are_emptied(spark, tmp_path):
    path = f"{tmp_path}/p"
    df = spark.range(1, 4).selectExpr("cast(id as int) batch_id", "'/a' resource_path")
    files.replace_partitions(df, path, "batch_id")
    files.replace_partitions(df.filter("batch_id = 1"), path, "batch_id", named=[1, 2])
    found = spark.read.schema("resource_path string, batch_id int").parquet(path)
    assert sorted(r.batch_id for r in found.collect()) == [1, 3]


def test_a_run_again_without_good_lines_keeps_nothing(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    jobs.run_all(spark, store, batches, run_id=1)
    for i in (1, 2):
        (tmp_path / "logs" / f"batch_{i}" / "a.log").write_text("garbage\n")
    jobs.run_all(spark, store, batches, run_id=1)
    assert tables.read_store(spark, store, "query_results").count() == 0
    assert len(files.folders_in(spark, f"{store}/partials/run_id=1")) == 1


def test_a_run_anew_forgets_its_other_questions(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    jobs.run_all(spark, store, batches, run_id=1)
    jobs.run_all(spark, store, batches, run_id=2)
    jobs.run_q1(spark, store, batches, run_id=1, anew=True)
    for table in ("query_results", "batch_metadata", "malformed_record_summary"):
        stored = tables.read_store(spark, store, table)
        assert {r.query_name for r in stored.filter("run_id = 1").collect()} == {"Q1"}
        assert {r.query_name for r in stored.filter("run_id = 2").collect()} == {"Q1", "Q2", "Q3"}


def test_quarantine_holds_what_the_run_counts(spark, batches, tmp_path):
    store, path = f"{tmp_path}/store", f"{tmp_path}/bad"
    jobs.run_q1(spark, store, batches, run_id=1, quarantine=path)
    counted = tables.read_store(spark, store, "malformed_record_summary")
    bad = spark.read.schema(schemas.RAW_LINES).parquet(path)
    assert bad.count() == counted.agg(F.sum("malformed_record_count")).first()[0] == 2


def test_chunks_are_batches_of_a_run(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    chunks = logs.chunk_lines(spark, [b.path for b in batches], f"{tmp_path}/staging", 4)
    jobs.run_all(spark, store, chunks, run_id=1)
    sizes = tables.read_store(spark, store, "batch_metadata").filter("batch_id is not null")
    found = {(r.batch_label, r.batch_size) for r in sizes.collect()}
    assert found == {("chunk 1", 4), ("chunk 2", 2)}
    with pytest.raises(ValueError):
        jobs.run_q1(spark, store, chunks, per_batch=True)


def test_imported_rows_and_damaged_ones(spark, tmp_path):
    (tmp_path / "q1").mkdir()
    kept = ["01/Jul/1995_200\t3_" + str(LARGEST * 2)]
    damaged = ["01/Jul/1995_200\t3_1.5", "no tab", "", "a\tb\tc"]
    (tmp_path / "q1" / "part").write_text("\n".join(kept + damaged) + "\n")
    store = f"{tmp_path}/store"
    for _ in range(2):
        run = jobs.import_packed(spark, store, {"Q1": f"{tmp_path}/q1"}, run_id=4)
    rows = tables.results_for_run(spark, store, run, "Q1").collect()
    assert [(r.request_count, int(r.total_bytes)) for r in rows] == [(3, LARGEST * 2)]
    assert sorted(r._corrupt for r in jobs.read_corrupt(spark, store, run).collect()) == sorted(damaged)


def test_registered_tables_show_later_runs(spark, batches, tmp_path):
    store, database = f"{tmp_path}/store", "later_runs"
    jobs.run_q1(spark, store, batches, run_id=1)
    sink.create_tables(spark, store, database)
    assert spark.table(f"{database}.query_results").count() == 2
    jobs.run_q1(spark, store, batches, run_id=2, database=database)
    assert spark.table(f"{database}.query_results").count() == 4


def test_places_keep_scheme_and_bucket(spark, tmp_path):
    assert place_of(spark, f"{tmp_path}/x/") == place_of(spark, f"file://{tmp_path}/x") == f"file:{tmp_path}/x"
    two = [logs.Batch("s3://bucket-a/logs", "a"), logs.Batch("s3://bucket-b/logs/", "b")]
    places = listed_places(spark, two)
    assert places == [(1, "s3://bucket-a/logs"), (2, "s3://bucket-b/logs")]
    names = ["s3://bucket-a/logs/x.log", "s3://bucket-b/logs/x.log", "s3://bucket-b/logs/deep/y.log"]
    df = spark.createDataFrame([(n,) for n in names], "source_file string")
    found = with_source(df, places).collect()
    assert sorted(r.batch_id for r in found) == [1, 2, 2]
    assert len({r.source_id for r in found}) == 3
    with pytest.raises(ValueError):
        listed_places(spark, [logs.Batch("s3://b/x", "a"), logs.Batch("s3://b/x/", "b")])


def test_nested_files_go_to_the_nearest_place(spark, tmp_path):
    for folder, count in (("year", 1), ("year/june/deep", 2), ("year/july/deep/er", 4)):
        (tmp_path / "logs" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "logs" / folder / "a.log").write_text("\n".join([line()] * count) + "\n")
    root = f"{tmp_path}/logs"
    listed = [logs.Batch(f"{root}/year", "rest"), logs.Batch(f"{root}/year/july", "July")]
    ingest_stream(spark, root, listed, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    stored = jobs.read_partials(spark, f"{tmp_path}/t")
    assert {r.batch_id: r.total_lines for r in rollup.quality_of(stored).collect()} == {1: 3, 2: 4}


def test_one_reader_tells_batches_by_their_place(spark, tmp_path):
    for folder, count in (("year", 1), ("year/june ä+b%/deep", 2), ("year/july/deep/er", 4)):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "a.log").write_text("\n".join([line()] * count) + "\n")
    root = f"{tmp_path}/year"
    listed = [
        logs.Batch(root, "rest"),
        logs.Batch(f"{root}/july/", "July"),
        logs.Batch(f"file://{root}/june ä+b%/deep/*.log", "June"),
    ]
    counts = lambda df: {r.batch_label: r["count"] for r in df.groupBy("batch_label").count().collect()}
    assert counts(logs.read_batches(spark, listed, recursive=True)) == {"rest": 1, "June": 2, "July": 4}
    assert counts(logs.read_batches(spark, listed, recursive=True, only=1)) == {"rest": 1}
    flat = [logs.Batch(root, "rest"), logs.Batch(f"{root}/a.log", "file")]
    assert counts(logs.read_batches(spark, flat)) == {"file": 1}
    with pytest.raises(ValueError):
        logs.read_batches(spark, [listed[0], logs.Batch(f"{root}/", "again")])
    with pytest.raises(FileNotFoundError):
        logs.read_batches(spark, [logs.Batch(f"{root}/*.gz", "none")])
    run = jobs.run_q1(spark, f"{tmp_path}/store", listed, recursive=True, per_batch=True)
    sizes = tables.read_store(spark, f"{tmp_path}/store", "batch_metadata").filter("stage = 'batch'")
    assert {r.batch_label: r.batch_size for r in sizes.filter(f"run_id = {run}").collect()} == {
        "rest": 1, "June": 2, "July": 4
    }


def test_many_batches_are_planned_fast(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"b{i}").mkdir()
        (tmp_path / f"b{i}" / "a.log").write_text("x\n")
    listed = [logs.Batch(f"{tmp_path}/b{i}", str(i)) for i in range(400)]
    df = logs.read_batches(spark, listed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_a_folder_and_one_in_it_are_two_batches(spark, tmp_path):
    (tmp_path / "logs/august").mkdir(parents=True)
    (tmp_path / "logs/july.log").write_text(line() + "\n")
    (tmp_path / "logs/august/a.log").write_text("\n".join([line()] * 2) + "\n")
    listed = [logs.Batch(f"{tmp_path}/logs", "July"), logs.Batch(f"{tmp_path}/logs/august", "August")]
    found = {r.batch_label: r["count"] for r in logs.read_batches(spark, listed).groupBy("batch_label").count().collect()}
    assert found == {"July": 1, "August": 2}
    for per_batch in (False, True):
        store = f"{tmp_path}/store-{per_batch}"
        run = jobs.run_q1(spark, store, listed, per_batch=per_batch)
        sizes = tables.read_store(spark, store, "batch_metadata").filter(f"run_id = {run}")
        assert sizes.filter("stage = 'batch'" if per_batch else "true").agg(F.sum("batch_size")).first()[0] == 3


def stored_tables(spark, store):
    return {
        t: sorted(map(str, tables.read_store(spark, store, t).drop("runtime_ms", "execution_timestamp").collect()))
        for t in schemas.STORE_TABLES
    }


def test_a_run_that_dies_leaves_the_earlier_one_whole(spark, batches, tmp_path, monkeypatch):
    store = f"{tmp_path}/store"
    jobs.run_all(spark, store, batches, run_id=1)
    before = stored_tables(spark, store)
    put = sink.put
    for last in ("query_results", "batch_metadata", "malformed_record_summary"):
        with monkeypatch.context() as patched:
            def dies(attempt, df, table, last=last):
                put(attempt, df, table)
                if table == last:
                    raise OSError("executor lost")

            patched.setattr(sink, "put", dies)
            with pytest.raises(OSError):
                jobs.run_all(spark, store, batches[:1], run_id=1, anew=True)
        assert stored_tables(spark, store) == before
    assert len(sink.forget_unpublished(spark, store)) == 3
    assert stored_tables(spark, store) == before
    jobs.run_all(spark, store, batches[:1], run_id=1)
    assert stored_tables(spark, store) != before


def test_a_reader_keeps_what_it_began_with(spark, batches, tmp_path):
    store = f"{tmp_path}/store"
    jobs.run_all(spark, store, batches, run_id=1)
    reading = tables.read_store(spark, store, "query_results")
    count = reading.count()
    (tmp_path / "logs" / "batch_1" / "a.log").write_text("garbage\n")
    jobs.run_all(spark, store, batches, run_id=1)
    assert reading.count() == count != tables.read_store(spark, store, "query_results").count()


def test_a_run_is_taken_up_where_it_died(spark, batches, tmp_path, monkeypatch):
    store = f"{tmp_path}/store"
    jobs.run_all(spark, f"{tmp_path}/whole", batches, run_id=3, per_batch=True, quarantine=f"{tmp_path}/bad-whole")
    read = []
    lines = jobs.batch_lines
    monkeypatch.setattr(jobs, "batch_lines", lambda *a, only=None: (read.append(only), lines(*a, only=only))[1])
    write = jobs.write_partials

    def dies(df, *args):
        if read[-1] == 2:
            raise OSError("driver lost")
        write(df, *args)

    options = {"run_id": 3, "resume": True, "quarantine": f"{tmp_path}/bad"}
    with monkeypatch.context() as patched:
        patched.setattr(jobs, "write_partials", dies)
        with pytest.raises(OSError):
            jobs.run_all(spark, store, batches, **options)
    assert read == [1, 2] and stored_tables(spark, store)["query_results"] == []
    read.clear()
    jobs.run_all(spark, store, batches, **options)
    assert read == [2]
    assert stored_tables(spark, store) == stored_tables(spark, f"{tmp_path}/whole")
    bad = [spark.read.schema(schemas.RAW_LINES).parquet(f"{tmp_path}/{p}").select("batch_id", "line") for p in ("bad", "bad-whole")]
    assert sorted(bad[0].collect()) == sorted(bad[1].collect()) != []

    # A file that changed, a question that is new and other patterns are read again.
    read.clear()
    (tmp_path / "logs" / "batch_1" / "b.log").write_text(line() + "\n")
    jobs.run_all(spark, store, batches, **options)
    assert read == [1]
    read.clear()
    jobs.run_q1(spark, store, batches, run_id=4, resume=True)
    jobs.run_all(spark, store, batches, run_id=4, resume=True)
    assert read == [1, 2, 1, 2]
    read.clear()
    monkeypatch.setattr(logs, "PATTERNS_MARK", "others")
    jobs.run_all(spark, store, batches, **options)
    assert read == [1, 2]
    with pytest.raises(ValueError):
        jobs.run_all(spark, store, batches, resume=True)


def test_quarantine_in_the_same_pass(spark, batches, tmp_path, monkeypatch):
    path = f"{tmp_path}/bad"
    plans = []
    write = jobs.replace_partitions
    monkeypatch.setattr(
        jobs, "replace_partitions", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a))
    )
    listener_before = sum(p.count("FileScan text") for p in plans)
    jobs.run_all(spark, f"{tmp_path}/store", batches, run_id=1, quarantine=path)
    assert listener_before == 0 and sum(p.count("FileScan text") for p in plans) == 1
    # Another run, and then the first one again, keep the other's lines.
    (tmp_path / "logs" / "batch_2" / "a.log").write_text("other\nother\n\n")
    jobs.run_q2(spark, f"{tmp_path}/store", batches, run_id=2, quarantine=path)
    count = lambda: {(r.run_id, r.batch_id, r.line): r["count"] for r in spark.read.parquet(path).groupBy("run_id", "batch_id", "line").count().collect()}
    both = {(1, 1, "garbage"): 1, (1, 2, "garbage"): 1, (2, 1, "garbage"): 1, (2, 2, "other"): 2}
    assert count() == both
    (tmp_path / "logs" / "batch_1" / "a.log").write_text(line() + "\n")
    jobs.run_all(spark, f"{tmp_path}/store", batches, run_id=1, quarantine=path)
    assert count() == {(1, 2, "other"): 2, (2, 1, "garbage"): 1, (2, 2, "other"): 2}


def test_a_line_without_end_is_spread(spark, lines_of, monkeypatch):
    monkeypatch.setattr(rollup, "COPIES_AT_ONCE", 7)
    stored = rollup.partials(lines_of(*["junk"] * 50, "other", line(), ""), rejected=True)
    found = {r.line: r["count"] for r in rollup.rejected_of(stored).groupBy("line").count().collect()}
    assert found == {"junk": 50, "other": 1}
    assert rollup.daily_of(stored).first()["request_count"] == 1


def test_named_partitions_may_read_what_they_replace(spark, tmp_path):
    path = f"{tmp_path}/p"
    df = spark.range(1, 4).selectExpr("cast(id as int) batch_id", "'/a' resource_path")
    files.replace_partitions(df, path, "batch_id")
    schema = "resource_path string, batch_id int"
    one = spark.read.schema(schema).parquet(path).filter("batch_id = 1").withColumn("resource_path", F.lit("/b"))
    files.replace_partitions(one, path, "batch_id", named=[1, 2])
    found = sorted(map(tuple, spark.read.schema(schema).parquet(path).collect()))
    assert found == [("/a", 3), ("/b", 1)]
