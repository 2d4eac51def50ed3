"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "decimal": T.DecimalType(20, 2),
    # Sums of sizes, each of up to 64 bits.
    "total": T.DecimalType(38, 0),
}


def _struct(text: str) -> T.StructType:
    """From ``name type`` pairs; unlike Spark's own reader it needs no session."""
    fields = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_LINES = _struct("batch_id int, line string")
BATCHES = _struct("batch_id int, batch_label string, path string")
RESOURCE_PARTIALS = _struct(
    "batch_id int, resource_path string, host string, req_count bigint, bytes total"
)
HOST_SETS = _struct(
    "batch_id int, host_part string, resource_path string, "
    "request_count bigint, total_bytes total, hosts string"
)
PACKED = _struct("packed_key string, packed_value string")

# One row per group of one question: `part` names the question, and only the
# columns that question groups by are set.
PARTIALS = _struct(
    "line_kind string, log_date string, log_hour int, status_code int, resource_path string, "
    "host string, req_count bigint, bytes total, error_count bigint, line_bytes bigint, "
    "rejected_line string, part string, batch_id int"
)

RUN_METADATA = _struct("pipeline_name string, execution_timestamp timestamp, run_id bigint")
BATCH_METADATA = _struct(
    "batch_id int, batch_label string, stage string, batch_size bigint, "
    "average_batch_size decimal, batch_bytes bigint, blank_lines bigint, "
    "malformed_lines bigint, records_processed bigint, runtime_ms bigint, "
    "run_id bigint, query_name string"
)
MALFORMED_SUMMARY = _struct(
    "batch_id int, malformed_record_count bigint, run_id bigint, query_name string"
)
QUERY_RESULTS = _struct(
    "batch_id int, log_date string, log_hour int, status_code int, resource_path string, "
    "request_count bigint, total_bytes total, distinct_hosts bigint, "
    "error_request_count bigint, total_requests bigint, error_rate double, "
    "distinct_error_hosts bigint, run_id bigint, query_name string"
)

# Result-store tables and the columns each is partitioned by (always last).
STORE_TABLES = {
    "run_metadata": (RUN_METADATA, ("run_id",)),
    "batch_metadata": (BATCH_METADATA, ("run_id", "query_name")),
    "malformed_record_summary": (MALFORMED_SUMMARY, ("run_id", "query_name")),
    "query_results": (QUERY_RESULTS, ("run_id", "query_name")),
}
