"""Writing lines, stage outputs and partials as files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.operators.parse import malformed_lines
from logquarry.plans.workspace import shared_folder
from logquarry.sources.places import file_system
from logquarry.sources.tables import TSV_OPTIONS


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text in place of any earlier output."""
    df.write.mode("overwrite").options(**TSV_OPTIONS).csv(path)


def replace_output(df: DataFrame, path: str) -> None:
    """Parquet in place of any earlier output."""
    df.write.mode("overwrite").parquet(path)


def gather(df: DataFrame, columns: Sequence[str], spread: int | None = None) -> DataFrame:
    """Bring the rows of each output partition together into files of a fair size.

    Without this every task writes a file into every output partition. Adaptive
    execution splits large partitions and joins small ones. Where it is off, as
    inside a streaming micro-batch, ``spread`` tasks share each partition.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *columns)
    if spread:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
        return df.repartition(*columns, salt)
    return df


def write_quarantine(lines: DataFrame, path: str) -> None:
    """Malformed lines, apart from every stage output."""
    bad = gather(malformed_lines(lines), ["batch_id"])
    bad.write.mode("overwrite").partitionBy("batch_id").parquet(path)


def write_run_quarantine(bad: DataFrame, path: str, run_id: int) -> None:
    """The malformed ``batch_id, line`` rows of a run, in place of what it left there before.

    Other runs' lines stay.
    """
    run = bad.withColumn("run_id", F.lit(run_id).cast("bigint")).select("line", "run_id", "batch_id")
    replace_partitions(run, path, "run_id", "batch_id", named=[run_id])


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that is not there is no error."""
    system, place = file_system(spark, path)
    system.delete(place, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    system, place = file_system(spark, path)
    return [s.getPath().toString() for s in system.listStatus(place) if s.isDirectory()]


def replace_partitions(
    df: DataFrame,
    path: str,
    *columns: str,
    spread: int | None = None,
    named: Sequence[object] = (),
) -> None:
    """Replace the partitions ``df`` holds rows of and leave all others alone.

    A batch run again, or a task tried again, puts the same rows in the same
    place. Keys a batch no longer has go away with its old partition. ``named`` values of
    the first column are replaced also where ``df`` has no row of them: what they held before and
    ``df`` did not fill goes after the new rows have come, so ``df`` may read it.
    """
    spark = df.sparkSession
    earlier = {v: _files_below(spark, f"{path}/{columns[0]}={v}") for v in named}
    if earlier and any(earlier.values()):
        # Kept aside first: Spark does not overwrite what a plan still reads.
        aside = shared_folder(spark, "replacing")
        df.write.parquet(aside)
        df = spark.read.schema(df.schema).parquet(aside)
    (
        gather(df, columns, spread)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
    for old in {f for files in earlier.values() for f in files}:
        system, place = file_system(spark, old)
        system.delete(place, False)


def _files_below(spark: SparkSession, path: str) -> list[str]:
    system, place = file_system(spark, path)
    if not system.exists(place):
        return []
    found, files = system.listFiles(place, True), []
    while found.hasNext():
        files.append(found.next().getPath().toString())
    return files
