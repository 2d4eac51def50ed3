"""Closed batches of an ingest, rewritten so that their files no longer have folders of their own.

The group rows of all files of a batch are added up into one folder per part and batch, and the files
are noted as absorbed. Both are published together. Readers and the ingest pass over the folders of
absorbed files, so a compaction that died half way, and a replay of the stream, change no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry import schemas
from logquarry.sinks.files import delete_folder, gather
from logquarry.sources.published import current, new_folder_name, partition_folders, publish, read_folders

# Spark's readers pass over names that start with '_'.
COMPACTED = "_compacted"
MEASURES = ("req_count", "bytes", "error_count", "line_bytes")
SOURCES = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("batch_id", T.IntegerType())])
OPEN_ROWS = T.StructType([*schemas.PARTIALS.fields, T.StructField("source_id", T.StringType())])


def absorbed_sources(spark: SparkSession, target: str) -> DataFrame | None:
    """``source_id, batch_id`` of the absorbed files; None before the first compaction."""
    _, entries = current(spark, f"{target}/{COMPACTED}")
    folders = sorted({f for e in entries.values() for f in e["sources"]})
    return read_folders(spark, f"{target}/{COMPACTED}/sources", folders, SOURCES) if folders else None


def without_absorbed(rows: DataFrame, target: str) -> DataFrame:
    """``rows`` but for those of absorbed files, by ``source_id`` and ``batch_id``."""
    absorbed = absorbed_sources(rows.sparkSession, target)
    return rows if absorbed is None else rows.join(absorbed, ["source_id", "batch_id"], "left_anti").select(*rows.columns)


def _open_folders(spark: SparkSession, target: str, batch_ids: Sequence[int] | None) -> list[str]:
    folders = partition_folders(spark, target, 3)
    if batch_ids is None:
        return folders
    wanted = {f"batch_id={b}" for b in batch_ids}
    return [f for f in folders if f.split("/")[1] in wanted]


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The group rows of everything ingested into ``target``, compacted or not."""
    rows = without_absorbed(read_folders(spark, target, _open_folders(spark, target, None), OPEN_ROWS), target)
    _, entries = current(spark, f"{target}/{COMPACTED}")
    folders = sorted(f for e in entries.values() for f in e["folders"])
    compacted = read_folders(spark, f"{target}/{COMPACTED}/rows", folders, schemas.PARTIALS)
    return rows.select(*schemas.PARTIALS.names).unionByName(compacted)


def compact(spark: SparkSession, target: str, batch_ids: Sequence[int] | None = None) -> None:
    """Rewrite the given batches, or all of them, and then delete their files' folders.

    No stream may be running that still reads files of these batches. Files that come to a compacted
    batch later are ingested as before, and a later compaction takes them up; one that was absorbed and
    comes again, changed or not, is passed over.
    """
    root = f"{target}/{COMPACTED}"
    folders = _open_folders(spark, target, batch_ids)
    touched = sorted({int(f.split("/")[1].split("=")[1]) for f in folders})
    if not touched:
        return
    _, entries = current(spark, root)
    before = [entries[str(b)] for b in touched if str(b) in entries]
    fresh = without_absorbed(read_folders(spark, target, folders, OPEN_ROWS), target)
    earlier = read_folders(spark, f"{root}/rows", [f for e in before for f in e["folders"]], schemas.PARTIALS)
    groups = [c for c in schemas.PARTIALS.names if c not in MEASURES]
    rows = (
        fresh.select(*schemas.PARTIALS.names)
        .unionByName(earlier)
        .groupBy(*groups)
        .agg(*[F.sum(m).cast(schemas.PARTIALS[m].dataType).alias(m) for m in MEASURES])
        .select(*schemas.PARTIALS.names)
    )
    attempt = f"attempt={new_folder_name()}"
    gather(rows, ["part", "batch_id"]).write.partitionBy("part", "batch_id").parquet(f"{root}/rows/{attempt}")
    sources = fresh.select("source_id", "batch_id").distinct().unionByName(
        read_folders(spark, f"{root}/sources", [f for e in before for f in e["sources"]], SOURCES)
    )
    gather(sources, ["batch_id"]).write.partitionBy("batch_id").parquet(f"{root}/sources/{attempt}")
    made = {"folders": partition_folders(spark, f"{root}/rows/{attempt}", 2), "sources": partition_folders(spark, f"{root}/sources/{attempt}", 1)}
    new = {
        str(b): {name: [f"{attempt}/{f}" for f in found if f.endswith(f"batch_id={b}")] for name, found in made.items()}
        for b in touched
    }
    publish(spark, root, lambda now: now | new)
    for folder in folders:
        delete_folder(spark, f"{target}/{folder}")
    for kind, base in (("folders", "rows"), ("sources", "sources")):
        for folder in {f for e in before for f in e[kind]}:
            delete_folder(spark, f"{root}/{base}/{folder}")
