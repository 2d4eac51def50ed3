"""Tables whose rows are replaced or added by key.

Rows lie in buckets by a hash of their key. A correction reads and writes the buckets it touches and no
others, into folders of its own, and then publishes them together: a reader sees all of it or nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry.plans.workspace import shared_folder
from logquarry.sinks.files import delete_folder, folders_in, gather
from logquarry.sources.published import current, new_folder_name, partition_folders, publish, read_folders

BUCKETS = 64
TABLE = "table"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _settings(spark: SparkSession, path: str) -> dict:
    _, entries = current(spark, path)
    if TABLE not in entries:
        raise FileNotFoundError(f"no keyed table at {path}")
    return entries[TABLE]


def create_keyed(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS
) -> None:
    """An empty table of ``schema`` at ``path``. One that is there already stays, if it is alike."""
    table = {"keys": list(keys), "buckets": buckets, "schema": schema.json()}

    def change(entries):
        if entries.get(TABLE, table) != table:
            raise ValueError(f"{path} holds a table of other keys, buckets or columns")
        return {**entries, TABLE: table}

    publish(spark, path, change)


def read_keyed(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The table's rows, or those of some buckets."""
    table = _settings(spark, path)
    _, entries = current(spark, path)
    wanted = None if buckets is None else set(buckets)
    folders = [
        e["folder"] for e in entries.values() if "folder" in e and (wanted is None or e["bucket"] in wanted)
    ]
    schema = T.StructType.fromJson(json.loads(table["schema"]))
    return read_folders(spark, path, folders, schema)


def upsert(spark: SparkSession, path: str, rows: DataFrame, gone: DataFrame | None = None) -> None:
    """Replace the rows of the keys in ``rows``, add those of new keys, keep all others.

    ``gone`` has keys whose rows go. Null is a key like others. A key that ``rows`` holds twice is an error,
    since none of its rows is the one meant; nothing is changed then. Columns that the table lacks are
    ignored, missing ones are null. A correction done twice leaves the same rows; if another one is
    published at the same time, buckets that both touch are worked out again on top of it.
    """
    table = _settings(spark, path)
    keys, buckets = table["keys"], table["buckets"]
    schema = T.StructType.fromJson(json.loads(table["schema"]))
    given = rows.select(
        *[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    staged_at = shared_folder(spark, "upsert")
    marked = given.withColumn("upsert_bucket", _bucket(keys, buckets)).withColumn("upsert_gone", F.lit(False))
    if gone is not None:
        typed = {f.name: f.dataType for f in schema.fields}
        leaving = gone.select(*[F.col(f"`{k}`").cast(typed[k]).alias(k) for k in keys]).distinct()
        leaving = leaving.withColumn("upsert_bucket", _bucket(keys, buckets)).withColumn("upsert_gone", F.lit(True))
        marked = marked.unionByName(leaving, allowMissingColumns=True)
    marked.write.parquet(staged_at)
    staged = spark.read.schema(marked.schema).parquet(staged_at)
    twice = staged.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"a key is there twice: {twice[0].asDict()}")
    # As many numbers as there are buckets at most.
    touched = [r[0] for r in staged.select("upsert_bucket").distinct().collect()]
    new = staged.filter("not upsert_gone").select(*schema.names, "upsert_bucket")
    keyed = staged.select(*[F.col(f"`{k}`").alias(f"given_{i}") for i, k in enumerate(keys)])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"given_{i}")) for i, k in enumerate(keys)]
    done: dict[int, tuple[str | None, str | None]] = {}

    def change(entries):
        named = {e["bucket"]: e["folder"] for e in entries.values() if "folder" in e}
        stale = [b for b in touched if b not in done or done[b][0] != named.get(b)]
        if stale:
            # Only what another writer has changed meanwhile is worked out again.
            old = read_folders(spark, path, [named[b] for b in stale if b in named], schema)
            kept = old.join(keyed, same, "left_anti").withColumn("upsert_bucket", _bucket(keys, buckets))
            merged = kept.unionByName(new.filter(F.col("upsert_bucket").isin(stale)))
            name = f"data/attempt={new_folder_name()}"
            gather(merged, ["upsert_bucket"]).write.partitionBy("upsert_bucket").parquet(f"{path}/{name}")
            made = {int(f.split("=")[1]): f"{name}/{f}" for f in partition_folders(spark, f"{path}/{name}", 1)}
            done.update({b: (named.get(b), made.get(b)) for b in stale})
        fresh = {str(b): {"bucket": b, "folder": done[b][1]} for b in touched if done[b][1]}
        return {k: v for k, v in entries.items() if v.get("bucket") not in touched} | fresh

    if touched:
        publish(spark, path, change)


def forget_unpublished(spark: SparkSession, path: str) -> None:
    """Delete the folders that the latest list no longer names. Readers of earlier lists must be done."""
    _, entries = current(spark, path)
    used = {e["folder"] for e in entries.values() if "folder" in e}
    for folder in partition_folders_of(spark, path):
        if folder not in used:
            delete_folder(spark, f"{path}/{folder}")


def partition_folders_of(spark: SparkSession, path: str) -> list[str]:
    """Every bucket folder ever written below ``path``."""
    return [
        f"data/{attempt.rsplit('/', 1)[-1]}/{f}"
        for attempt in folders_in(spark, f"{path}/data")
        for f in partition_folders(spark, attempt, 1)
    ]
