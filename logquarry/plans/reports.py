"""Reports over the result store, sorted as they are shown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.functions import clf
from logquarry.operators.errors import roll_up_hourly
from logquarry.operators.resources import top_resources
from logquarry.operators.traffic import roll_up_daily
from logquarry.sources.tables import read_store, results_for_run


def _day(chronological: bool):
    """Dates sort as text, or by calendar."""
    return F.try_to_date("log_date", "dd/MMM/yyyy") if chronological else F.col("log_date")


def report_q1(
    spark: SparkSession, store: str, run_id: int, chronological: bool = False
) -> DataFrame:
    rows = results_for_run(spark, store, run_id, "Q1")
    return roll_up_daily(rows).orderBy(_day(chronological), "status_code")


def report_q2(spark: SparkSession, store: str, run_id: int) -> DataFrame:
    rows = results_for_run(spark, store, run_id, "Q2").select(
        "resource_path", "request_count", "total_bytes", "distinct_hosts"
    )
    return top_resources(rows).withColumn(
        "resource_path", clf.shorten_path(F.col("resource_path"))
    )


def report_q3(
    spark: SparkSession, store: str, run_id: int, chronological: bool = False
) -> DataFrame:
    """Mean of the batch rates and sum of the batch hosts, as stored per batch."""
    rows = results_for_run(spark, store, run_id, "Q3")
    return roll_up_hourly(rows).orderBy(_day(chronological), "log_hour")


def batch_summary(spark: SparkSession, store: str, run_id: int) -> DataFrame:
    """Batches of a run, per question."""
    return (
        read_store(spark, store, "batch_metadata")
        .filter((F.col("run_id") == run_id) & (F.col("stage") != "merge"))
        .orderBy("query_name", "batch_id")
    )


def total_runtime(spark: SparkSession, store: str, run_id: int) -> DataFrame:
    """Seconds a run took. Its questions share their jobs, and batches run together
    share one, so each job counts once."""
    rows = read_store(spark, store, "batch_metadata").filter(F.col("run_id") == run_id)
    jobs = rows.groupBy(
        "stage", F.when(F.col("stage") == "batch", F.col("batch_id")).alias("batch")
    ).agg(F.max("runtime_ms").alias("runtime_ms"))
    return jobs.agg((F.sum("runtime_ms") / 1000).alias("total_runtime_sec"))
