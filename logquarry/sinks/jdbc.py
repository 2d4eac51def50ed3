"""Writing results to a relational store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.schemas import STORE_TABLES
from logquarry.sources.tables import read_store

WRITE_PARTITIONS = 8
ROWS_PER_INSERT = 10_000


def connection_properties(
    user: str, password: str, driver: str | None = None, **options: str
) -> dict[str, str]:
    """Writer properties. Credentials come from the caller and are kept nowhere."""
    properties = {"user": user, "password": password, "batchsize": str(ROWS_PER_INSERT), **options}
    if driver:
        properties["driver"] = driver
    return properties


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append"
) -> None:
    """Append to a table over at most ``WRITE_PARTITIONS`` connections."""
    df.coalesce(WRITE_PARTITIONS).write.jdbc(url, table, mode=mode, properties=properties)


def export_run(
    spark: SparkSession, store: str, run_id: int, url: str, properties: dict[str, str]
) -> None:
    """Append a run's rows of every store table to the tables of the same names."""
    for table in STORE_TABLES:
        rows = read_store(spark, store, table).filter(F.col("run_id") == run_id)
        write_jdbc(rows, url, table, properties)
