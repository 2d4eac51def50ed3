"""Reading access logs and batching them."""

from __future__ import annotations

import hashlib
from collections.abc import Container, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logquarry import schemas
from logquarry.functions import patterns as P
from logquarry.functions.patterns import CHUNK_LINES
from logquarry.sources.places import distinct_places, file_system, files_at, listed_files, with_batch_id

# Up to this many input splits (40 bytes each, 500 TB of logs at the default split size) their
# offsets are broadcast; beyond it Spark picks the join.
BROADCAST_SPLITS = 4_000_000

# Group rows made with other patterns or bounds are not those of now.
PATTERNS_MARK = repr((P.CLF_LINE, P.CLF_REQUEST, P.METHODS, P.ERROR_LOW, P.ERROR_HIGH, P.NON_PRINTABLE))


class Batch(NamedTuple):
    """One input of a run; its id is its position in the run, from 1."""

    path: str
    label: str


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per line of files, directories or globs."""
    return spark.read.text(list(paths)).withColumnRenamed("value", "line")


def read_lines_recursive(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``; names that start with '_' or '.' are skipped."""
    return spark.read.option("recursiveFileLookup", True).text(root).withColumnRenamed(
        "value", "line"
    )


def select_batches(available: Sequence[Batch], choice: str = "all") -> list[Batch]:
    """The batches of a run: one by label, or all of them in order."""
    if choice.lower() == "all":
        return list(available)
    chosen = [b for b in available if b.label.lower() == choice.lower()]
    if not chosen:
        raise ValueError(f"no batch is labelled {choice!r}")
    return chosen


def batch_table(spark: SparkSession, batches: Sequence[Batch]) -> DataFrame:
    """The caller's list as a table. It comes from Arrow, so Spark knows its size."""
    rows = [
        {"batch_id": i, "batch_label": b.label, "path": b.path}
        for i, b in enumerate(batches, start=1)
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows), schemas.BATCHES)


def batch_lines(
    spark: SparkSession,
    batches: Sequence[Batch],
    recursive: bool = False,
    only: int | None = None,
) -> DataFrame:
    """``batch_id, line`` over all batches, or that numbered ``only``.

    One reader covers all of them, and the batch of a line comes from its file's path: that of the
    nearest listed place. Paths may be patterns; ``recursive`` descends into folders.
    """
    listed = [
        (i, path, place)
        for i, found in enumerate(listed_files(spark, [b.path for b in batches]), start=1)
        for path, place in found
    ]
    places = distinct_places([(i, place) for i, _, place in listed])
    asked = {place: path for i, path, place in listed if only in (None, i)}
    # What a reader of another listed folder reads comes with that one.
    paths = [path for place, path in asked.items() if not _read_with(spark, place, asked, recursive)]
    rows = (
        spark.read.option("recursiveFileLookup", recursive)
        .text(paths)
        .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"))
    )
    placed = with_batch_id(rows, F.col("source_file"), places)
    if only is not None:
        placed = placed.filter(F.col("batch_id") == only)
    return placed.select("batch_id", "line")


def input_marks(spark: SparkSession, batches: Sequence[Batch], recursive: bool = False) -> list[str]:
    """A mark of what each batch would read: its files with their sizes and times, the places listed
    within it, which take files from it, and the patterns that lines are matched with."""
    listed = listed_files(spark, [b.path for b in batches])
    every = [place for found in listed for _, place in found]
    marks = []
    for found in listed:
        facts = [PATTERNS_MARK, str(recursive)]
        for _, place in found:
            facts += [f"{name}\t{size}\t{at}" for name, size, at in files_at(spark, place, recursive)]
            facts += [f"within\t{p}" for p in every if p.startswith(f"{place}/")]
        marks.append(hashlib.sha256("\n".join(sorted(facts)).encode()).hexdigest())
    return marks


def read_batches(spark: SparkSession, batches: Sequence[Batch], **options) -> DataFrame:
    """``batch_id, batch_label, line`` over all batches; options as for :func:`batch_lines`."""
    labels = batch_table(spark, batches).drop("path")
    lines = batch_lines(spark, batches, **options)
    return lines.join(labels, "batch_id").select("batch_id", "batch_label", "line")


def _read_with(spark: SparkSession, place: str, asked: Container[str], recursive: bool) -> bool:
    """Whether a reader of another of the ``asked`` places reads this one too.

    One that does not descend reads the files of its folder, and none of the folders in it.
    """
    above = place.rsplit("/", 1)[0]
    if not recursive:
        return above in asked and _is_file(spark, place)
    while "/" in above:
        if above in asked:
            return True
        above = above.rsplit("/", 1)[0]
    return False


def _is_file(spark: SparkSession, place: str) -> bool:
    system, found = file_system(spark, place)
    return system.getFileStatus(found).isFile()


def chunk_lines(
    spark: SparkSession,
    paths: Sequence[str],
    staging: str,
    lines_per_chunk: int = CHUNK_LINES,
    broadcast_splits: int = BROADCAST_SPLITS,
) -> DataFrame:
    """Cut logs into batches of ``lines_per_chunk`` consecutive lines.

    Lines count in order of file path and then of position in the file. They are
    staged once with the input split they came from and a number that rises
    within the split, so that numbering does not depend on how a second read
    would be planned. The only thing totalled in one task is the list of splits:
    one row per input split (128 MB by default), never one per line. Lines meet
    their split by numbers: its start and 128 bits of hash of the file's path.
    """
    path = F.col("_metadata.file_path")
    (
        spark.read.text(list(paths))
        .select(
            path.alias("source_file"),
            F.xxhash64(path).alias("file_a"),
            F.xxhash64(F.lit(1), path).alias("file_b"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("line_number"),
            F.col("value").alias("line"),
        )
        .write.mode("overwrite")
        .parquet(f"{staging}/lines")
    )
    key = ["file_a", "file_b", "split_start"]
    staged = spark.read.schema(
        "source_file string, file_a bigint, file_b bigint, split_start bigint, line_number bigint, line string"
    ).parquet(f"{staging}/lines")
    splits = staged.groupBy(*key).agg(
        F.min("source_file").alias("source_file"),
        F.count("*").alias("line_count"),
        F.min("line_number").alias("first_number"),
    )
    before = Window.orderBy("source_file", "split_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    (
        splits.select(
            *key,
            "first_number",
            F.coalesce(F.sum("line_count").over(before), F.lit(0)).alias("lines_before"),
        )
        .write.mode("overwrite")
        .parquet(f"{staging}/splits")
    )
    offsets = spark.read.schema(
        "file_a bigint, file_b bigint, split_start bigint, first_number bigint, lines_before bigint"
    ).parquet(f"{staging}/splits")
    small = offsets.count() <= broadcast_splits
    offsets = F.broadcast(offsets) if small else offsets.hint("merge")
    position = F.col("lines_before") + F.col("line_number") - F.col("first_number")
    return staged.join(offsets, key).select(
        (F.floor(position / lines_per_chunk) + 1).cast("int").alias("batch_id"),
        position.alias("line_index"),
        "line",
    )
