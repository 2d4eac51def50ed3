"""Incremental ingest: new log files become group rows, exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logquarry.operators import rollup
from logquarry.sinks.files import replace_partitions
from logquarry.sources.logs import Batch
from logquarry.sources.places import distinct_places, place_of, with_batch_id
from logquarry.streaming.compact import without_absorbed

INGEST_KEYS = ("part", "batch_id", "source_id")
TASKS_PER_FILE = 8


def listed_places(spark: SparkSession, batches: Sequence[Batch]) -> list[tuple[int, str]]:
    """``(batch_id, place)`` of the caller's list; two batches must not claim one place."""
    return distinct_places([(i, place_of(spark, b.path)) for i, b in enumerate(batches, start=1)])


def with_source(grouped: DataFrame, places: Sequence[tuple[int, str]]) -> DataFrame:
    """``batch_id`` and ``source_id`` in place of ``source_file``.

    Scheme and authority count, so two buckets are two places.
    """
    # The file's path is URL-encoded, the listed ones are not; '+' stands for itself.
    decoded = F.url_decode(F.replace(F.col("source_file"), F.lit("+"), F.lit("%2B")))
    one_slash = F.regexp_replace(decoded, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")
    placed = with_batch_id(grouped.withColumn("file", one_slash), F.col("file"), places)
    return placed.withColumn("source_id", F.md5("file")).drop("file", "source_file")


def ingest_stream(
    spark: SparkSession,
    root: str,
    batches: Sequence[Batch],
    target: str,
    checkpoint: str,
    questions: Sequence[str] = ("Q1", "Q2", "Q3"),
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Ingest every file below ``root`` not seen yet, then stop.

    Group rows are kept per source file. A file comes whole in one micro-batch,
    so replacing its partition makes a replay harmless, from this checkpoint or
    from a new one. Files that a compaction has absorbed are passed over. A batch may grow, and new ones may be listed, between calls;
    a file that no batch lists stops the stream.
    """
    places = listed_places(spark, batches)
    lines = (
        spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", True)
        .text(root)
        .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))
    )

    def write(micro_batch: DataFrame, _: int) -> None:
        grouped = rollup.partials(micro_batch, questions, keys=("source_file",))
        rows = without_absorbed(with_source(grouped, places), target)
        replace_partitions(rows, target, *INGEST_KEYS, spread=TASKS_PER_FILE)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
