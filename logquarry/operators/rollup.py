"""One scan, one parse, one shuffle for every question.

All questions are counts and sums over the same parsed lines. Two groupings
serve them all: lines by kind, date, hour, status and error host, from which
quality counts, daily traffic and hourly errors add up; and requests by path
and host. Grouping sets compute both together, so a run over several questions
reads and parses its input once and keeps nothing but group rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.functions import clf
from logquarry.operators.errors import with_error_rate
from logquarry.operators.parse import BLANK, MALFORMED, PARSED, classify_lines, with_resource_path

LINES, REQUESTS, REJECTED = "lines", "requests", "rejected"
COPIES_AT_ONCE = 100_000
# What the grouping of lines needs for each question, and the type of each column.
LINE_COLUMNS = {"Q1": ("log_date", "status_code"), "Q3": ("log_date", "log_hour", "error_host")}
COLUMN_TYPES = {
    "log_date": "string",
    "log_hour": "int",
    "status_code": "int",
    "resource_path": "string",
    "request_host": "string",
    "error_host": "string",
    "rejected_line": "string",
}


def partials(
    lines: DataFrame,
    questions: Sequence[str] = ("Q1", "Q2", "Q3"),
    keys: Sequence[str] = ("batch_id",),
    rejected: bool = False,
) -> DataFrame:
    """Group rows for the chosen questions and the quality counts, per ``keys``.

    The grouping of lines holds a host only where it had an error: all other
    requests of an hour and status share one row. With ``rejected`` a grouping of its own keeps the
    malformed lines, each with its count, from the same scan, parse and shuffle.
    """
    error = clf.is_error(F.col("status_code"))
    rows = classify_lines(lines)
    if "Q2" in questions:
        # All requests without a path share a row a task: they are dropped after the grouping.
        wanted = F.col("resource_path").isNotNull()
        rows = with_resource_path(rows).withColumn("request_host", F.when(wanted, F.col("host")))
    rows = rows.withColumns(
        {"is_error": F.coalesce(error, F.lit(False)), "error_host": F.when(error, F.col("host"))}
    )
    line_columns = dict.fromkeys(c for q in questions for c in LINE_COLUMNS.get(q, ()))
    by_line = [*keys, "line_kind", *line_columns]
    measures = [
        F.count("*").alias("req_count"),
        clf.total_bytes(F.col("bytes")).alias("bytes"),
        F.count_if(F.col("is_error")).alias("error_count"),
        F.sum(F.col("line_bytes") + 1).alias("line_bytes"),
    ]
    groupings = {LINES: by_line}
    if "Q2" in questions:
        groupings[REQUESTS] = [*keys, "resource_path", "request_host"]
    if rejected:
        # All other lines share a row a task.
        rows = rows.withColumn("rejected_line", F.when(F.col("line_kind") == MALFORMED, F.col("line")))
        groupings[REJECTED] = [*keys, "rejected_line"]
    if len(groupings) > 1:
        columns = list(dict.fromkeys(c for by in groupings.values() for c in by))
        part = F.when(F.grouping("line_kind") == 0, LINES)
        if "Q2" in questions:
            part = part.when(F.grouping("resource_path") == 0, REQUESTS)
        grouped = rows.groupingSets(list(groupings.values()), *columns).agg(part.otherwise(REJECTED).alias("part"), *measures)
        told = {REQUESTS: "resource_path", REJECTED: "rejected_line"}
        for name in groupings.keys() & told.keys():
            grouped = grouped.filter((F.col("part") != name) | F.col(told[name]).isNotNull())
    else:
        grouped = rows.groupBy(*by_line).agg(F.lit(LINES).alias("part"), *measures)
    absent = {c: F.lit(None).cast(t) for c, t in COLUMN_TYPES.items() if c not in grouped.columns}
    return grouped.withColumns(absent).select(
        "line_kind",
        "log_date",
        "log_hour",
        "status_code",
        "resource_path",
        F.coalesce("request_host", "error_host").alias("host"),
        "req_count",
        "bytes",
        "error_count",
        "line_bytes",
        "rejected_line",
        "part",
        *keys,
    )


def rejected_of(stored: DataFrame) -> DataFrame:
    """``batch_id, line``: the malformed lines, each as often as it came.

    A line with a very large count is spread in parts, so that no row holds a long list.
    """
    rows = stored.filter(F.col("part") == REJECTED)
    count = F.col("req_count")
    parts = rows.withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), count, F.lit(COPIES_AT_ONCE).cast("long"))))
    last = F.least(count, F.col("first") + COPIES_AT_ONCE - 1)
    return parts.select("batch_id", F.col("rejected_line").alias("line"), F.explode(F.sequence("first", last))).drop("col")


def _line_rows(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("part") == LINES)


def quality_of(stored: DataFrame) -> DataFrame:
    kind, n = F.col("line_kind"), F.col("req_count")

    def lines_of(name: str):
        return F.sum(F.when(kind == name, n).otherwise(0))

    return (
        _line_rows(stored)
        .groupBy("batch_id")
        .agg(
            F.sum(n).alias("total_lines"),
            lines_of(BLANK).alias("blank_lines"),
            lines_of(MALFORMED).alias("malformed"),
            lines_of(PARSED).alias("records_processed"),
            F.sum("line_bytes").alias("batch_bytes"),
        )
    )


def daily_of(stored: DataFrame) -> DataFrame:
    return (
        _line_rows(stored)
        .filter(F.col("line_kind") == PARSED)
        .groupBy("batch_id", "log_date", "status_code")
        .agg(F.sum("req_count").alias("request_count"), F.sum("bytes").alias("total_bytes"))
    )


def resource_rows_of(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("part") == REQUESTS).select(
        "batch_id", "resource_path", "host", "req_count", "bytes"
    )


def hourly_of(stored: DataFrame, by_batch: bool = True) -> DataFrame:
    keys = [*(["batch_id"] if by_batch else []), "log_date", "log_hour"]
    counted = (
        _line_rows(stored)
        .filter(F.col("log_hour").isNotNull())
        .groupBy(*keys)
        .agg(
            F.sum("req_count").alias("total_requests"),
            F.sum("error_count").alias("error_request_count"),
            F.count_distinct("host").alias("distinct_error_hosts"),
        )
    )
    return with_error_rate(counted)
