"""Every operator as a query over the corpus derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry import schemas
from logquarry.functions import clf, packed
from logquarry.operators import errors, parse, quality, resources, rollup, traffic
from logquarry.plans import jobs, reports
from logquarry.plans.workspace import shared_folder
from logquarry.sinks import files, upsert
from logquarry.sinks.store import create_tables
from logquarry.sources import logs, tables
from logquarry.sources.corpus import BATCH_LABELS, corpus_lines
from logquarry.sources.views import create_log_view
from logquarry.streaming.compact import compact, read_ingested
from logquarry.streaming.ingest import ingest_stream
from logquarry.streaming.totals import forget_files, read_totals, refresh_totals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_RUN, LATEST_RUN = 1, 2
# A run id that the store does not know.
UNKNOWN_RUN = 99
CHUNK_SIZE = 3_000
_written: dict[tuple[str, str, str], object] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Log files and the result store are written once per session and shared by
    the queries that read them."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = make()
    return _written[key]


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_lines(corpus_lines(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str, path_mode: str = "decoded") -> DataFrame:
    return parse.filter_resources(_parsed(spark, sf_dir), path_mode)


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.resource_partials(_requests(spark, sf_dir))


def log_batches(spark: SparkSession, sf_dir: str) -> list[logs.Batch]:
    """The corpus as text files, one folder per batch."""

    def write() -> list[logs.Batch]:
        root = shared_folder(spark, "logs")
        lines = corpus_lines(spark, sf_dir)
        for i, label in BATCH_LABELS.items():
            lines.filter(F.col("batch_id") == i).select("line").write.text(f"{root}/batch_{i}")
        return [logs.Batch(f"{root}/batch_{i}", label) for i, label in BATCH_LABELS.items()]

    return _once(spark, sf_dir, "logs", write)


def _store(spark: SparkSession, sf_dir: str) -> str:
    """A result store with two runs: the first batch alone, then all of them."""

    def write() -> str:
        store = shared_folder(spark, "store")
        batches = log_batches(spark, sf_dir)
        jobs.run_all(spark, store, batches[:1], run_id=FIRST_RUN)
        jobs.run_all(spark, store, batches, run_id=LATEST_RUN)
        return store

    return _once(spark, sf_dir, "store", write)


# --- sources -----------------------------------------------------------------


@query
def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.read_lines(spark, *[b.path for b in log_batches(spark, sf_dir)])


@query
def scan_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested folders, next to one with a leading '_' that must be skipped."""

    def write() -> str:
        root = shared_folder(spark, "nested")
        lines = corpus_lines(spark, sf_dir)
        for i in BATCH_LABELS:
            one = lines.filter(F.col("batch_id") == i).select("line")
            one.write.text(f"{root}/year/batch_{i}/part")
        lines.select("line").write.text(f"{root}/year/_unfinished")
        return root

    return logs.read_lines_recursive(spark, _once(spark, sf_dir, "nested", write))


@query
def scan_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = logs.select_batches(log_batches(spark, sf_dir), "all")
    return logs.read_batches(spark, chosen)


@query
def scan_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over one batch numbers it 1, whatever its place in the full list."""
    chosen = logs.select_batches(log_batches(spark, sf_dir), "August")
    return logs.read_batches(spark, chosen)


@query
def chunk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [b.path for b in log_batches(spark, sf_dir)]
    chunks = logs.chunk_lines(spark, paths, shared_folder(spark, "chunks"), CHUNK_SIZE)
    return chunks.groupBy("batch_id").agg(
        F.count("*").alias("line_count"),
        F.min("line_index").alias("first_index"),
        F.max("line_index").alias("last_index"),
        F.count_distinct("line_index").alias("indexes"),
    )


@query
def hive_schema_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.read_with_pattern(corpus_lines(spark, sf_dir), "strict_resources")


@query
def sql_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs selected by SQL from a view in the catalog."""
    batches = log_batches(spark, sf_dir)
    database = "logs_" + batches[0].path.split("/")[-2].rsplit("-", 1)[-1]
    create_log_view(spark, database, "access_log", batches)
    return spark.sql(f"SELECT * FROM `{database}`.access_log WHERE host IS NOT NULL AND method <> 'HEAD'")


@query
def schema_on_read_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.read_with_pattern(corpus_lines(spark, sf_dir), "strict_daily")


@query
def schema_on_read_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.read_with_pattern(corpus_lines(spark, sf_dir), "strict_hourly")


@query
def schema_on_read_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.read_with_pattern(corpus_lines(spark, sf_dir), "clock_hourly")


@query
def results_for_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = tables.results_for_run(spark, _store(spark, sf_dir), FIRST_RUN, "Q1")
    return stored.select(
        "run_id", "query_name", "batch_id", "log_date", "status_code", "request_count", "total_bytes"
    )


# --- sinks -------------------------------------------------------------------


@query
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "tsv")
    files.write_tsv(_partials(spark, sf_dir), path)
    return tables.read_tsv(spark, path, schemas.RESOURCE_PARTIALS)


@query
def out_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second output takes the place of the first."""
    path = shared_folder(spark, "replaced")
    parsed = _parsed(spark, sf_dir)
    files.replace_output(errors.hourly_errors(parsed), path)
    files.replace_output(traffic.daily_status(parsed), path)
    return spark.read.schema(
        "log_date string, status_code int, request_count bigint, total_bytes decimal(38,0)"
    ).parquet(path)


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outdated rows of the second batch are replaced; the first batch stays."""
    path = shared_folder(spark, "merged")
    partials = _partials(spark, sf_dir)
    outdated = partials.withColumn("req_count", F.col("req_count") * 2)
    files.replace_partitions(outdated, path, "batch_id")
    files.replace_partitions(partials.filter(F.col("batch_id") == 1), path, "batch_id")
    files.replace_partitions(partials.filter(F.col("batch_id") == 2), path, "batch_id")
    return spark.read.schema(schemas.RESOURCE_PARTIALS).parquet(path)


@query
def merge_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch has no rows any more, so its earlier ones go."""
    path = shared_folder(spark, "emptied")
    partials = _partials(spark, sf_dir)
    files.replace_partitions(partials, path, "batch_id")
    files.replace_partitions(partials.filter(F.col("batch_id") > 2), path, "batch_id", named=[2])
    return spark.read.schema(schemas.RESOURCE_PARTIALS).parquet(path)


@query
def merge_partial_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A correction of some rows of the second batch, with rows of new keys: all others stay."""
    path = shared_folder(spark, "keyed")
    partials = _partials(spark, sf_dir)
    upsert.create_keyed(spark, path, schemas.RESOURCE_PARTIALS, ("resource_path", "host", "batch_id"))
    upsert.upsert(spark, path, partials)
    second = partials.filter((F.col("batch_id") == 2) & (F.col("req_count") > 1))
    corrected = second.withColumn("req_count", F.col("req_count") * 2)
    added = second.withColumn("resource_path", F.concat("resource_path", F.lit("/new")))
    left_out = partials.filter((F.col("batch_id") == 1) & (F.col("bytes") == 0))
    upsert.upsert(spark, path, corrected.unionByName(added), gone=left_out)
    return upsert.read_keyed(spark, path)


@query
def malformed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "quarantine")
    files.write_quarantine(corpus_lines(spark, sf_dir), path)
    return spark.read.schema(schemas.RAW_LINES).parquet(path)


@query
def packed_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed_results(spark, sf_dir)


def _packed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    encoded = {
        "Q1": packed.encode_daily(traffic.daily_status(parsed)),
        "Q2": packed.encode_resources(resources.resource_totals(parse.filter_resources(parsed))),
        "Q3": packed.encode_hourly(errors.hourly_errors(parsed)),
    }
    named = [df.withColumn("query_name", F.lit(name)) for name, df in encoded.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.malformed_lines(corpus_lines(spark, sf_dir)).select(
        F.explode(F.array(F.lit("Q1"), F.lit("Q2"), F.lit("Q3"))).alias("query_name"),
        F.lit("damaged").alias("packed_key"),
        F.col("line").alias("packed_value"),
    )


@query
def packed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows back to columns. Malformed log lines stand in for damaged rows."""
    path = shared_folder(spark, "packed")
    _packed_results(spark, sf_dir).unionByName(_damaged(spark, sf_dir)).write.partitionBy("query_name").parquet(path)
    stored = spark.read.schema(
        "packed_key string, packed_value string, query_name string"
    ).parquet(path)
    decoded = [
        decode(stored.filter(F.col("query_name") == name))
        for name, decode in (
            ("Q1", packed.decode_daily),
            ("Q2", packed.decode_resources),
            ("Q3", packed.decode_hourly),
        )
    ]
    both = decoded[0].unionByName(decoded[1], allowMissingColumns=True)
    return both.unionByName(decoded[2], allowMissingColumns=True)


@query
def packed_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed outputs, each with damaged rows, loaded into a result store."""
    root = shared_folder(spark, "packed-outputs")
    _packed_results(spark, sf_dir).unionByName(_damaged(spark, sf_dir)).select(
        "query_name", F.concat_ws("\t", "packed_key", "packed_value").alias("value")
    ).write.partitionBy("query_name").text(root)
    outputs = {name: f"{root}/query_name={name}" for name in jobs.QUESTIONS}
    store = shared_folder(spark, "imported")
    run_id = jobs.import_packed(spark, store, outputs, run_id=FIRST_RUN)
    kept = tables.read_store(spark, store, "query_results").drop("run_id", "batch_id")
    corrupt = jobs.read_corrupt(spark, store, run_id)
    return kept.unionByName(corrupt, allowMissingColumns=True)


# --- projections and filters -------------------------------------------------


@query
def lines_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.clean_lines(corpus_lines(spark, sf_dir))


@query
def clf_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).drop("bytes_text")


@query
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.malformed_lines(corpus_lines(spark, sf_dir))


@query
def request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.parse_requests(_parsed(spark, sf_dir))
    return rows.select("batch_id", "request", "method", "path", "protocol")


@query
def request_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _requests(spark, sf_dir)
    return rows.select("batch_id", "host", "method", "resource_path", "bytes")


@query
def path_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every requested path, decoded and cleaned, whatever it starts with."""
    rows = parse.parse_requests(_parsed(spark, sf_dir))
    return rows.select("batch_id", "path", clf.clean_path(F.col("path")).alias("resource_path"))


@query
def bytes_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("batch_id", "bytes_text", "bytes")


@query
def bytes_union_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.tag_byte_branches(_parsed(spark, sf_dir))
    return rows.groupBy("byte_branch", "log_date", "status_code").agg(
        F.count("*").alias("request_count"), clf.total_bytes(F.col("bytes")).alias("total_bytes")
    )


@query
def log_date_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("batch_id", "log_time", "log_date", "log_hour")


@query
def error_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("status_code")
    return _parsed(spark, sf_dir).select(
        "batch_id",
        "status_code",
        F.when(clf.is_error(status), 1).otherwise(0).alias("is_error"),
        F.when(clf.is_error(status, "ge400"), 1).otherwise(0).alias("is_error_ge400"),
    )


# --- quality -----------------------------------------------------------------


@query
def parse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_average_size(quality.parse_quality(corpus_lines(spark, sf_dir)))


@query
def parity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.parity_audit(corpus_lines(spark, sf_dir))


@query
def parse_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per batch that a write of the parsed rows takes on its way."""
    classified, counts = quality.observed(corpus_lines(spark, sf_dir), batches=list(BATCH_LABELS))
    kept = classified.filter(F.col("line_kind") == parse.PARSED).drop("line", "line_bytes", "line_kind")
    files.replace_output(kept, shared_folder(spark, "parsed"))
    found = counts.get
    names = ("total_lines", "blank_lines", "malformed", "records_processed", "batch_bytes")
    rows = [(i, *(int(found[f"{n}_{i}"]) for n in names)) for i in BATCH_LABELS]
    return spark.createDataFrame(rows, "batch_id int, " + ", ".join(f"{n} bigint" for n in names))


@query
def parity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the lenient pattern and a strict one do not both keep."""
    return quality.profile_difference(corpus_lines(spark, sf_dir), "lenient", "strict_resources")


@query
def parity_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = traffic.daily_status(parse.parse_strict(corpus_lines(spark, sf_dir), "strict_daily"))
    keys, measures = ("log_date", "status_code"), ("request_count", "total_bytes")
    return quality.compare_groups(traffic.daily_status(_parsed(spark, sf_dir)), strict, keys, measures)


@query
def parity_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = resources.resource_totals(parse.parse_strict(corpus_lines(spark, sf_dir), "strict_resources"))
    measures = ("request_count", "total_bytes", "distinct_hosts")
    return quality.compare_groups(resources.resource_totals(_requests(spark, sf_dir)), strict, ("resource_path",), measures)


@query
def parity_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = errors.hourly_errors(parse.parse_strict(corpus_lines(spark, sf_dir), "strict_hourly"), error_mode="ge400")
    keys, measures = ("log_date", "log_hour"), ("total_requests", "error_request_count", "distinct_error_hosts")
    return quality.compare_groups(errors.hourly_errors(_parsed(spark, sf_dir)), strict, keys, measures)


# --- daily traffic -----------------------------------------------------------


@query
def q1_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.daily_status(_parsed(spark, sf_dir), by_batch=True)


@query
def q1_daily_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.daily_status(_parsed(spark, sf_dir))


@query
def q1_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.daily_status(parse.parse_strict(corpus_lines(spark, sf_dir), "strict_daily"))


# --- top resources -----------------------------------------------------------


@query
def q2_stage1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partials(spark, sf_dir)


@query
def q2_stage1_hostset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.host_set_partials(_stored_partials(spark, sf_dir))


@query
def q2_stage2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All resources, from partials stored per batch."""
    return resources.merge_partials(_stored_partials(spark, sf_dir))


@query
def q2_stage2_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.merge_top_resources(_stored_partials(spark, sf_dir))


def _stored_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write() -> str:
        path = shared_folder(spark, "partials")
        files.replace_partitions(_partials(spark, sf_dir), path, "batch_id")
        return path

    path = _once(spark, sf_dir, "partials", write)
    return spark.read.schema(schemas.RESOURCE_PARTIALS).parquet(path)


@query
def q2_tokenized_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All resources, from host sets stored as packed text."""
    path = shared_folder(spark, "host-sets")
    sets = resources.host_set_partials(_stored_partials(spark, sf_dir))
    files.write_tsv(packed.encode_host_sets(sets), path)
    stored = tables.read_tsv(
        spark, path, "batch_id int, packed_key string, packed_value string"
    )
    return resources.merge_host_sets(packed.decode_host_sets(stored))


@query
def q2_hostset_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write() -> str:
        path = shared_folder(spark, "host-sets")
        sets = resources.host_set_partials(_stored_partials(spark, sf_dir))
        files.replace_partitions(sets, path, "batch_id")
        return path

    path = _once(spark, sf_dir, "host-sets", write)
    return resources.union_host_sets(spark.read.schema(schemas.HOST_SETS).parquet(path))


@query
def q2_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All resources in one pass, without stages."""
    return resources.resource_totals(_requests(spark, sf_dir))


@query
def q2_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.top_resources(resources.resource_totals(_requests(spark, sf_dir)))


@query
def q2_path_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.resource_totals(_requests(spark, sf_dir, "raw"))


@query
def q2_path_printable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.resource_totals(_requests(spark, sf_dir, "printable"))


@query
def q2_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = parse.parse_strict(corpus_lines(spark, sf_dir), "strict_resources")
    return resources.top_resources(resources.resource_totals(requests))


# --- hourly errors -----------------------------------------------------------


@query
def q3_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.hourly_errors(_parsed(spark, sf_dir), by_batch=True)


@query
def q3_two_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.hourly_errors_two_phase(_parsed(spark, sf_dir))


@query
def q3_hourly_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.hourly_errors(_parsed(spark, sf_dir))


@query
def q3_ge400(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.hourly_errors(_parsed(spark, sf_dir), error_mode="ge400")


@query
def q3_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_strict(corpus_lines(spark, sf_dir), "strict_hourly")
    return errors.hourly_errors(parsed, error_mode="ge400")


@query
def q3_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse.parse_strict(corpus_lines(spark, sf_dir), "clock_hourly")
    return errors.hourly_errors(parsed, error_mode="ge400")


# --- result store, reports and jobs ------------------------------------------


@query
def query_results_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_store(spark, _store(spark, sf_dir), "query_results")


@query
def store_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored results, read by the name of their table."""
    store = _store(spark, sf_dir)
    database = "logquarry_" + store.rsplit("-", 1)[-1]
    create_tables(spark, store, database)
    return spark.table(f"{database}.query_results")


@query
def store_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit finds in the store with faults put in: runs nobody knows, batches without metadata,
    repeated groups and missing values."""
    store = _store(spark, sf_dir)
    held = {t: tables.read_store(spark, store, t) for t in schemas.STORE_TABLES}
    first = held["query_results"].filter(F.col("run_id") == FIRST_RUN)
    unknown = F.lit(UNKNOWN_RUN).cast("bigint")
    q1 = first.filter("query_name = 'Q1'")
    held["query_results"] = (
        held["query_results"]
        .unionByName(q1.withColumn("run_id", unknown))
        .unionByName(first.filter("query_name = 'Q2'"))
        .unionByName(q1.withColumn("batch_id", F.lit(7)))
    )
    summary = held["malformed_record_summary"]
    held["malformed_record_summary"] = summary.unionByName(
        summary.filter(F.col("run_id") == LATEST_RUN).withColumns(
            {"batch_id": F.lit(8), "malformed_record_count": F.lit(None).cast("bigint")}
        ).limit(1).withColumn("query_name", F.lit("Q1"))
    )
    return quality.store_faults(held)


@query
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with the result rows each has stored; the time of the run is left out."""
    store = _store(spark, sf_dir)
    counts = tables.read_store(spark, store, "query_results").groupBy("run_id").agg(
        F.count("*").alias("result_rows")
    )
    runs = tables.read_store(spark, store, "run_metadata")
    return runs.drop("execution_timestamp").join(counts, "run_id", "left")


@query
def batch_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run times are left out."""
    rows = tables.read_store(spark, _store(spark, sf_dir), "batch_metadata")
    return rows.drop("runtime_ms")


@query
def malformed_record_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_store(spark, _store(spark, sf_dir), "malformed_record_summary")


@query
def report_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_q1(spark, _store(spark, sf_dir), LATEST_RUN)


@query
def report_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_q2(spark, _store(spark, sf_dir), LATEST_RUN)


@query
def report_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_q3(spark, _store(spark, sf_dir), LATEST_RUN)


@query
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run times are left out."""
    rows = reports.batch_summary(spark, _store(spark, sf_dir), LATEST_RUN)
    return rows.select(
        "query_name",
        "batch_id",
        "batch_label",
        "batch_size",
        "average_batch_size",
        "records_processed",
    )


def _job_results(spark: SparkSession, sf_dir: str, run, **options) -> DataFrame:
    store = shared_folder(spark, "job")
    run_id = run(spark, store, log_batches(spark, sf_dir), run_id=LATEST_RUN, **options)
    results = tables.read_store(spark, store, "query_results")
    return results.filter(F.col("run_id") == run_id).drop("run_id")


@query
def job_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_results(spark, sf_dir, jobs.run_q1)


@query
def job_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_results(spark, sf_dir, jobs.run_q2, per_batch=True)


@query
def job_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_results(spark, sf_dir, jobs.run_q3)


@query
def job_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job_results(spark, sf_dir, jobs.run_all)


@query
def job_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of all questions done again with one of them: the others' rows go."""
    store, batches = shared_folder(spark, "job"), log_batches(spark, sf_dir)
    jobs.run_all(spark, store, batches, run_id=LATEST_RUN)
    jobs.run_q1(spark, store, batches, run_id=LATEST_RUN, anew=True)
    return tables.read_store(spark, store, "query_results").drop("run_id")


@query
def job_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose batches are chunks of consecutive lines."""
    paths = [b.path for b in log_batches(spark, sf_dir)]
    chunks = logs.chunk_lines(spark, paths, shared_folder(spark, "chunks"), CHUNK_SIZE)
    store = shared_folder(spark, "job")
    return reports.report_q1(spark, store, jobs.run_q1(spark, store, chunks, run_id=FIRST_RUN))


@query
def job_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The malformed lines that a run sets aside."""
    path = shared_folder(spark, "quarantine")
    _job_results(spark, sf_dir, jobs.run_q1, quarantine=path)
    return spark.read.schema(schemas.RAW_LINES).parquet(path).select("batch_id", "line")


@query
def job_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that has finished its first batch only, taken up again."""
    store, batches = shared_folder(spark, "job"), log_batches(spark, sf_dir)
    jobs.run_all(spark, store, batches[:1], run_id=LATEST_RUN, resume=True)
    jobs.run_all(spark, store, batches, run_id=LATEST_RUN, resume=True)
    return tables.read_store(spark, store, "query_results").drop("run_id")


@query
def rollup_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group rows of all questions that one pass leaves."""
    return rollup.partials(corpus_lines(spark, sf_dir)).drop("line_bytes", "rejected_line")


@query
def ingest_stream_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top resources after ingesting the log files as a stream, twice."""
    batches = log_batches(spark, sf_dir)
    root = batches[0].path.rsplit("/", 1)[0]
    target = shared_folder(spark, "ingest")
    for _ in range(2):
        ingest_stream(
            spark, root, batches, target, f"{target}-state", max_files_per_trigger=1
        ).awaitTermination()
    return resources.merge_top_resources(
        rollup.resource_rows_of(jobs.read_partials(spark, target))
    )


@query
def ingest_nested_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from folders below those listed; the nearest listed one decides."""

    def write() -> str:
        root = shared_folder(spark, "nested-logs")
        lines = corpus_lines(spark, sf_dir)
        for i, folder in ((1, "year/part"), (2, "year/august/deep/part")):
            lines.filter(F.col("batch_id") == i).select("line").write.text(f"{root}/{folder}")
        return root

    root = _once(spark, sf_dir, "nested-logs", write)
    listed = [logs.Batch(f"{root}/year", "July"), logs.Batch(f"{root}/year/august", "August")]
    target = shared_folder(spark, "ingest")
    ingest_stream(spark, root, listed, target, f"{target}-state").awaitTermination()
    return resources.merge_top_resources(
        rollup.resource_rows_of(jobs.read_partials(spark, target))
    )


@query
def ingest_compacted_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after the first batch, then both, were compacted, and the stream was replayed each time."""
    batches = log_batches(spark, sf_dir)
    root = batches[0].path.rsplit("/", 1)[0]
    target = shared_folder(spark, "ingest")
    for turn, closed in enumerate(([1], None, None)):
        ingest_stream(spark, root, batches, target, f"{target}-state-{turn}").awaitTermination()
        compact(spark, target, closed)
    return resources.merge_top_resources(rollup.resource_rows_of(read_ingested(spark, target)))


@query
def ingest_maintained_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top resources from totals kept up to date: outdated files of the second batch are counted first, then
    taken back, and the logs as they are come in their place."""
    batches = log_batches(spark, sf_dir)
    root = batches[0].path.rsplit("/", 1)[0]
    outdated = shared_folder(spark, "outdated")
    corpus_lines(spark, sf_dir).filter((F.col("batch_id") == 2) & ~F.col("line").contains("7")).select("line").write.text(outdated)
    target = shared_folder(spark, "ingest")
    ingest_stream(spark, outdated, [logs.Batch(outdated, "outdated")], target, f"{target}-outdated").awaitTermination()
    refresh_totals(spark, target, f"{target}-totals")
    forget_files(spark, target, [r[0] for r in spark.read.text(outdated).select("_metadata.file_path").distinct().collect()])
    for _ in range(2):
        ingest_stream(spark, root, batches, target, f"{target}-state").awaitTermination()
        refresh_totals(spark, target, f"{target}-totals")
    return resources.top_resources(read_totals(spark, f"{target}-totals"))
