"""Requests, errors and the hosts behind them per date and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.functions import clf


def hourly_errors(
    parsed: DataFrame, by_batch: bool = False, error_mode: str = "4xx5xx"
) -> DataFrame:
    """Exact over all batches unless ``by_batch``. Rows without an hour are left out."""
    keys = [*(["batch_id"] if by_batch else []), "log_date", "log_hour"]
    error = clf.is_error(F.col("status_code"), error_mode)
    counted = (
        parsed.filter(F.col("log_hour").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("total_requests"),
            F.count_if(error).alias("error_request_count"),
            F.count_distinct(F.when(error, F.col("host"))).alias("distinct_error_hosts"),
        )
    )
    return with_error_rate(counted)


def with_error_rate(counted: DataFrame) -> DataFrame:
    errors, total = F.col("error_request_count"), F.col("total_requests")
    return counted.withColumns(
        {
            "error_rate": clf.error_rate(errors, total),
            "error_rate_raw": clf.raw_error_rate(errors, total),
        }
    )


def hourly_errors_two_phase(parsed: DataFrame, error_mode: str = "4xx5xx") -> DataFrame:
    """Group by host first, then count the hosts that had an error."""
    error = clf.is_error(F.col("status_code"), error_mode)
    per_host = (
        parsed.filter(F.col("log_hour").isNotNull())
        .groupBy("log_date", "log_hour", "host")
        .agg(F.count("*").alias("requests"), F.count_if(error).alias("errors"))
    )
    counted = per_host.groupBy("log_date", "log_hour").agg(
        F.sum("requests").alias("total_requests"),
        F.sum("errors").alias("error_request_count"),
        F.count_if(F.col("errors") > 0).alias("distinct_error_hosts"),
    )
    return with_error_rate(counted)


def roll_up_hourly(per_batch: DataFrame) -> DataFrame:
    """Report-style roll-up of batch rows: the plain mean of the rates and the
    sum of the distinct hosts. Right only when no hour spans two batches; see
    :func:`hourly_errors` for the exact figures. The mean is rounded as a decimal."""
    return per_batch.groupBy("log_date", "log_hour").agg(
        F.sum("total_requests").alias("total_requests"),
        F.sum("error_request_count").alias("error_request_count"),
        F.round(F.avg("error_rate").cast("decimal(18,10)"), 5).cast("double").alias("error_rate"),
        F.sum("distinct_error_hosts").alias("distinct_error_hosts"),
    )
