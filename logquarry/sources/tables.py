"""Reading stage outputs and stored results back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry import schemas
from logquarry.sources.published import current, read_folders

# Below a store's root: the folders of its attempts.
ATTEMPTS = "attempts"
# Values are written and read as they are: no quoting, no escaping, no trimming.
TSV_OPTIONS = {
    "sep": "\t",
    "quote": "",
    "escape": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Tab-separated text with a declared schema."""
    return spark.read.options(**TSV_OPTIONS).schema(schema).csv(path)


def store_folders(spark: SparkSession, store: str, table: str, run_id: int | None = None) -> list[str]:
    """The published folders of a result-store table, or those of one run, below the attempts."""
    _, entries = current(spark, store)
    wanted = f"{table}/" if run_id is None else f"{table}/run_id={run_id}"
    return [
        e["folder"] for name, e in sorted(entries.items())
        if name.startswith(wanted) and name[len(wanted) :][:1] in ("", "/", "r")
    ]


def read_store(spark: SparkSession, store: str, table: str, run_id: int | None = None) -> DataFrame:
    """A result-store table, or the rows of one run, as last published; filters on its partition columns
    prune directories."""
    folders = store_folders(spark, store, table, run_id)
    return read_folders(spark, f"{store}/{ATTEMPTS}", folders, schemas.STORE_TABLES[table][0])


def results_for_run(spark: SparkSession, store: str, run_id: int, query_name: str) -> DataFrame:
    return read_store(spark, store, "query_results", run_id).filter(
        (F.col("run_id") == run_id) & (F.col("query_name") == query_name)
    )


def results_for_run_jdbc(
    spark: SparkSession,
    url: str,
    run_id: int,
    query_name: str,
    properties: dict[str, str],
    table: str = "query_results",
) -> DataFrame:
    """The same rows from a relational store; Spark pushes both filters down."""
    return spark.read.jdbc(url, table, properties=properties).filter(
        (F.col("run_id") == run_id) & (F.col("query_name") == query_name)
    )
