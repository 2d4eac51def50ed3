"""Requests and bytes per day and HTTP status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.functions import clf


def daily_status(parsed: DataFrame, by_batch: bool = False) -> DataFrame:
    keys = [*(["batch_id"] if by_batch else []), "log_date", "status_code"]
    return parsed.groupBy(*keys).agg(
        F.count("*").alias("request_count"), clf.total_bytes(F.col("bytes")).alias("total_bytes")
    )


def roll_up_daily(per_batch: DataFrame) -> DataFrame:
    """Batch results added up; counts and sums add exactly."""
    return per_batch.groupBy("log_date", "status_code").agg(
        F.sum("request_count").alias("request_count"), F.sum("total_bytes").alias("total_bytes")
    )
