"""Totals per resource, kept up to date with an ingest.

The state holds what each source file has counted for, requests by path and host with the number of files
behind each, and totals by path. A refresh reads the files that are new, changed or gone, and nothing of
the others: what they counted before is taken back and what they hold now is added. A host leaves a
path's count when no file has it there any more. Rows lie in buckets by path; those of the paths
touched are written anew, and everything is published at once. Top lists read one row per path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry.operators.rollup import REQUESTS
from logquarry.plans.workspace import shared_folder
from logquarry.sinks.files import delete_folder, gather
from logquarry.sources.places import file_system, place_of
from logquarry.sources.published import current, new_folder_name, partition_folders, publish, read_folders
from logquarry.streaming.compact import OPEN_ROWS, absorbed_sources

BUCKETS = 64
_FIELDS = {
    "source_id": T.StringType(), "batch_id": T.IntegerType(), "mark": T.StringType(), "resource_path": T.StringType(),
    "host": T.StringType(), "req_count": T.LongType(), "bytes": T.DecimalType(38, 0), "files": T.LongType(),
    "request_count": T.LongType(), "total_bytes": T.DecimalType(38, 0), "distinct_hosts": T.LongType(),
}


def _schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _FIELDS[n]) for n in names])


SOURCES = _schema("source_id", "batch_id", "mark")
COUNTED = _schema("resource_path", "host", "req_count", "bytes", "source_id", "batch_id")
HOSTS = _schema("resource_path", "host", "req_count", "bytes", "files")
TOTALS = _schema("resource_path", "request_count", "total_bytes", "distinct_hosts")


def _open_sources(spark: SparkSession, target: str) -> DataFrame:
    """``source_id, batch_id, mark`` of the files in the ingest. Spark gives files of every write new names,
    so these tell a file ingested anew. One row per ingested file is listed, as any read of them does."""
    system, place = file_system(spark, target)
    names: dict[tuple[str, int], list[str]] = {}
    found = system.listFiles(place, True) if system.exists(place) else None
    while found is not None and found.hasNext():
        *_, part, batch, source, name = found.next().getPath().toString().split("/")
        if part == f"part={REQUESTS}" and source.startswith("source_id=") and name.startswith("part-"):
            names.setdefault((source.split("=")[1], int(batch.split("=")[1])), []).append(name)
    rows = [{"source_id": s, "batch_id": b, "mark": hashlib.md5(" ".join(sorted(n)).encode()).hexdigest()} for (s, b), n in names.items()]
    return spark.createDataFrame(pa.Table.from_pylist(rows, pa.schema([("source_id", pa.string()), ("batch_id", pa.int32()), ("mark", pa.string())])))


def _layers(spark: SparkSession, state: str, entries: dict, kind: str, schema: T.StructType) -> DataFrame:
    return read_folders(spark, f"{state}/{kind}", entries.get(kind, {}).get("folders", []), schema)


def _bucket(path: str = "resource_path"):
    return F.pmod(F.xxhash64(path), F.lit(BUCKETS)).cast("int")


def _written(rows: DataFrame, state: str, kind: str, *partitions: str) -> str:
    name = f"attempt={new_folder_name()}"
    made = gather(rows, partitions) if partitions else rows
    made.write.partitionBy(*partitions).parquet(f"{state}/{kind}/{name}")
    return name


def refresh_totals(spark: SparkSession, target: str, state: str) -> None:
    """Bring the totals at ``state`` up to date with what is ingested into ``target``.

    Refresh before batches are compacted: files absorbed before they were counted cannot be told
    apart any more, which is an error. One refresh at a time; a refresh that died is done again as if it
    had not begun.
    """
    number, entries = current(spark, state)
    counted = _layers(spark, state, entries, "sources", SOURCES)
    now = _open_sources(spark, target)
    key = ["source_id", "batch_id"]
    absorbed = absorbed_sources(spark, target)
    if absorbed is not None:
        if not absorbed.join(counted, key, "left_anti").isEmpty():
            raise ValueError("files were compacted before they were counted")
        # An absorbed file is as it was; a folder left of it is no new one.
        now = now.join(absorbed, key, "left_anti").unionByName(counted.join(absorbed, key, "left_semi"))
    aside = shared_folder(spark, "sources")
    now.write.parquet(aside)
    now = spark.read.schema(SOURCES).parquet(aside)
    added = now.join(counted, [*key, "mark"], "left_anti").select(*key)
    taken = counted.join(now, [*key, "mark"], "left_anti").select(*key)
    if added.isEmpty() and taken.isEmpty():
        return
    # Folders of changed files alone are read; Spark prunes by their names.
    folders = [
        f"part={REQUESTS}/batch_id={r['batch_id']}/source_id={r['source_id']}" for r in added.collect()
    ]
    fresh = read_folders(spark, target, folders, OPEN_ROWS).select(*COUNTED.names)
    before = _layers(spark, state, entries, "counted", COUNTED)
    old = before.join(taken, key, "left_semi")
    signed = fresh.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))
    change = signed.groupBy("resource_path", "host").agg(
        F.sum(F.col("sign") * F.col("req_count")).alias("req_count"),
        F.sum(F.col("sign") * F.col("bytes")).cast("decimal(38,0)").alias("bytes"),
        F.sum(F.col("sign").cast("long")).alias("files"),
    )
    delta_at = shared_folder(spark, "totals-change")
    change.withColumn("bucket", _bucket()).write.parquet(delta_at)
    delta = spark.read.parquet(delta_at)
    touched = sorted(r[0] for r in delta.select("bucket").distinct().collect())
    held = {int(b): f for b, f in entries.get("buckets", {}).items()}
    hosts = (
        read_folders(spark, f"{state}/hosts", [held[b] for b in touched if b in held], HOSTS)
        .unionByName(delta.select(*HOSTS.names))
        .groupBy("resource_path", "host")
        .agg(F.sum("req_count").alias("req_count"), F.sum("bytes").cast("decimal(38,0)").alias("bytes"), F.sum("files").alias("files"))
        .filter("files > 0")
        .withColumn("bucket", _bucket())
    )
    hosts_name = _written(hosts, state, "hosts", "bucket")
    made = {int(f.split("=")[1]): f"{hosts_name}/{f}" for f in partition_folders(spark, f"{state}/hosts/{hosts_name}", 1)}
    totals = (
        read_folders(spark, f"{state}/hosts", list(made.values()), HOSTS)
        .groupBy("resource_path")
        .agg(
            F.sum("req_count").alias("request_count"),
            F.sum("bytes").cast("decimal(38,0)").alias("total_bytes"),
            F.count(F.lit(1)).alias("distinct_hosts"),
        )
        .withColumn("bucket", _bucket())
    )
    totals_name = _written(totals, state, "totals", "bucket")
    summed = {int(f.split("=")[1]): f"{totals_name}/{f}" for f in partition_folders(spark, f"{state}/totals/{totals_name}", 1)}
    # What the files count for now: rows of the others, and those of the new and changed ones.
    kept = before.join(taken, key, "left_anti").unionByName(fresh)
    new = {
        "sources": {"folders": [_written(now, state, "sources")]},
        "counted": {"folders": [_written(kept.repartitionByRange(*key), state, "counted")]},
        "buckets": {str(b): f for b, f in ({b: f for b, f in held.items() if b not in touched} | made).items()},
        "totals": {str(b): f for b, f in ({int(b): f for b, f in entries.get("totals", {}).items() if int(b) not in touched} | summed).items()},
    }

    def change_list(seen):
        if current(spark, state)[0] != number:
            raise RuntimeError("another refresh was faster")
        return new

    publish(spark, state, change_list)


def read_totals(spark: SparkSession, state: str) -> DataFrame:
    """``resource_path, request_count, total_bytes, distinct_hosts`` as of the last refresh."""
    _, entries = current(spark, state)
    return read_folders(spark, f"{state}/totals", sorted(entries.get("totals", {}).values()), TOTALS)


def forget_files(spark: SparkSession, target: str, paths: Sequence[str]) -> None:
    """Take log files that are gone out of an ingest: their group rows go."""
    gone = {hashlib.md5(place_of(spark, p).encode()).hexdigest() for p in paths}
    for folder in partition_folders(spark, target, 3):
        if folder.rsplit("source_id=", 1)[-1] in gone:
            delete_folder(spark, f"{target}/{folder}")
