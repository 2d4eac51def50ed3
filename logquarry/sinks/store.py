"""The result store: runs, batches, malformed counts and results.

Four Parquet tables under one root, partitioned by run and question. What a run stores goes into a
folder of its own attempt and is published at once, in all tables together: a reader sees the run as it
was or as it is, never a part of it, and a run that failed leaves what was there before.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry.schemas import STORE_TABLES
from logquarry.sinks.files import delete_folder, folders_in, gather
from logquarry.sources.published import current, new_folder_name, partition_folders, publish
from logquarry.sources.tables import ATTEMPTS, store_folders

# Partitions registered in one statement.
REGISTERED_AT_ONCE = 500


class Attempt(NamedTuple):
    """One try to store rows; nothing of it shows before it is published."""

    store: str
    name: str


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``; those ``df`` lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def begin(store: str) -> Attempt:
    return Attempt(store, new_folder_name())


def _folder(attempt: Attempt, table: str) -> str:
    return f"{attempt.store}/{ATTEMPTS}/attempt={attempt.name}/table={table}"


def put(attempt: Attempt, df: DataFrame, table: str) -> None:
    """Write rows of a table into the attempt."""
    schema, partition_columns = STORE_TABLES[table]
    rows = gather(conform(df, schema), partition_columns)
    rows.write.mode("append").partitionBy(*partition_columns).parquet(_folder(attempt, table))


def publish_attempt(
    spark: SparkSession, attempt: Attempt, run_id: int | None = None, questions: Sequence[str] | None = None
) -> None:
    """Let readers see the attempt's rows, in place of earlier ones of the same run and question.

    What run ``run_id`` has stored for ``questions`` (None: for all of them) goes, also where the attempt has
    no rows of it.
    """
    made = {}
    for table, (_, columns) in STORE_TABLES.items():
        for folder in partition_folders(spark, _folder(attempt, table), len(columns)):
            made[f"{table}/{folder}"] = {"folder": f"attempt={attempt.name}/table={table}/{folder}"}

    def goes(name: str) -> bool:
        found = re.fullmatch(r"\w+/run_id=(-?\d+)/query_name=(.*)", name)
        if run_id is None or not found or int(found[1]) != run_id:
            return False
        return questions is None or found[2] in questions

    publish(spark, attempt.store, lambda entries: {k: v for k, v in entries.items() if not goes(k)} | made)


def append(df: DataFrame, store: str, table: str) -> None:
    """Store rows of one table; they take the place of earlier ones of the same runs and questions."""
    attempt = begin(store)
    put(attempt, df, table)
    publish_attempt(df.sparkSession, attempt)


def new_run_id() -> int:
    """The clock in microseconds."""
    return time.time_ns() // 1000


def run_row(spark: SparkSession, pipeline_name: str, run_id: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.current_timestamp().alias("execution_timestamp"),
        F.lit(run_id).cast("bigint").alias("run_id"),
    )


def create_run(
    spark: SparkSession, store: str, pipeline_name: str, run_id: int | None = None
) -> int:
    """Record a run and return its id: the caller's, or the clock in microseconds."""
    run_id = new_run_id() if run_id is None else run_id
    append(run_row(spark, pipeline_name, run_id), store, "run_metadata")
    return run_id


def wide_results(run_id: int, **results: DataFrame) -> DataFrame:
    """Results of several questions in one table, told apart by ``query_name``."""
    tagged = [df.withColumn("query_name", F.lit(name)) for name, df in results.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return union.withColumn("run_id", F.lit(run_id).cast("bigint"))


def save_results(store: str, run_id: int, **results: DataFrame) -> None:
    append(wide_results(run_id, **results), store, "query_results")


def save_batch_metadata(rows: DataFrame, store: str) -> None:
    append(rows, store, "batch_metadata")


def save_malformed(rows: DataFrame, store: str) -> None:
    append(rows, store, "malformed_record_summary")


def forget_unpublished(spark: SparkSession, store: str) -> list[str]:
    """Delete attempts of which no row is published any more, such as failed ones, and return their
    names. Readers of earlier lists and running writers must be done."""
    _, entries = current(spark, store)
    used = {e["folder"].split("/", 1)[0] for e in entries.values()}
    stale = [f for f in folders_in(spark, f"{store}/{ATTEMPTS}") if f.rsplit("/", 1)[-1] not in used]
    for folder in stale:
        delete_folder(spark, folder)
    return [f.rsplit("=", 1)[-1] for f in stale]


def create_tables(spark: SparkSession, store: str, database: str) -> None:
    """Register the store's tables, with all they hold, in the session catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{store}/_catalog'")
    for table, (schema, partition_columns) in STORE_TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(partition_columns)}) LOCATION '{store}/_catalog/{table}' "
            f"TBLPROPERTIES ('logquarry.store' = '{store}')"
        )
    refresh_tables(spark, database)


def _partition(folder: str) -> str:
    """``run_id=1/query_name=Q1`` as Spark's SQL names a partition."""
    parts = [p.split("=", 1) for p in folder.split("/")]
    return ", ".join(f"{name} = '{value}'" for name, value in parts)


def refresh_tables(spark: SparkSession, database: str) -> None:
    """Let registered tables show the runs stored since, and forget those cleared."""
    properties = spark.sql(f"SHOW TBLPROPERTIES `{database}`.query_results").collect()
    store = next(r["value"] for r in properties if r["key"] == "logquarry.store")
    for table, (_, columns) in STORE_TABLES.items():
        name = f"`{database}`.`{table}`"
        folders = {f.split("/", 2)[2]: f for f in store_folders(spark, store, table)}
        shown = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        gone = [f"PARTITION ({_partition(p)})" for p in sorted(shown)]
        for at in range(0, len(gone), REGISTERED_AT_ONCE):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone[at : at + REGISTERED_AT_ONCE])}")
        new = [f"PARTITION ({_partition(p)}) LOCATION '{store}/{ATTEMPTS}/{f}'" for p, f in sorted(folders.items())]
        for at in range(0, len(new), REGISTERED_AT_ONCE):
            spark.sql(f"ALTER TABLE {name} ADD {' '.join(new[at : at + REGISTERED_AT_ONCE])}")
        spark.catalog.refreshTable(name)
