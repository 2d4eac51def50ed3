"""Which batch a file belongs to: that of the nearest listed place."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that make a path a pattern.
PATTERN_MARKS = r"[\\{}\[\]*?]"


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def place_of(spark: SparkSession, path: str) -> str:
    """A listed path with scheme and authority and no last slash: ``file:/logs``, ``s3://bucket/logs``."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/]", path):
        system, place = file_system(spark, path)
        path = system.makeQualified(place).toString()
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", path).rstrip("/")


def distinct_places(places: Sequence[tuple[int, str]]) -> list[tuple[int, str]]:
    """``places`` as they are; two batches must not claim one place."""
    if len({place for _, place in places}) < len(places):
        raise ValueError("two batches list the same place")
    return list(places)


def listed_files(spark: SparkSession, paths: Sequence[str]) -> list[list[tuple[str, str]]]:
    """For each of ``paths`` what it names, as Spark reads it and as Spark tells a file's path.

    A pattern gives each of its matches; other paths are taken as they are, without a look at them.
    """
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    make = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for path in paths:
        place = make(path)
        system = place.getFileSystem(conf)
        if re.search(PATTERN_MARKS, path):
            names = [s.getPath().toString() for s in system.globStatus(place) or []]
            if not names:
                raise FileNotFoundError(path)
        else:
            names = [system.makeQualified(place).toString()]
        escaped = [re.sub(PATTERN_MARKS, r"\\\g<0>", name) for name in names]
        found.append([(e, make(n).toUri().toString()) for e, n in zip(escaped, names, strict=True)])
    return found


def files_at(spark: SparkSession, place: str, recursive: bool) -> list[tuple[str, int, int]]:
    """Name, size and time of the files that Spark reads at ``place``, as :func:`listed_files` tells it: a
    file, or a folder's files but those whose names, or whose folders' names, start with '_' or '.'."""
    at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(place))
    system = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    top = system.getFileStatus(at)
    found, folders = ([], [at]) if top.isDirectory() else ([top], [])
    while folders:
        for status in system.listStatus(folders.pop()):
            if status.getPath().getName().startswith(("_", ".")):
                continue
            if not status.isDirectory():
                found.append(status)
            elif recursive:
                folders.append(status.getPath())
    return [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found]


def with_batch_id(rows: DataFrame, file: Column, places: Sequence[tuple[int, str]]) -> DataFrame:
    """``rows`` with ``batch_id``: the batch whose place is ``file`` or the nearest folder above it.

    The batch comes from where the file lies, not from the order of arrival. There is one join for
    each depth at which places are listed; Spark knows the size of the list and picks the join. A
    file that no batch lists is an error.
    """
    by_depth: dict[int, list[dict]] = {}
    for batch_id, place in places:
        depth = place.count("/") + 1
        row = {f"place_{depth}": place, f"found_{depth}": batch_id}
        by_depth.setdefault(depth, []).append(row)
    depths = sorted(by_depth, reverse=True)
    placed = rows
    for depth in depths:
        listed = rows.sparkSession.createDataFrame(
            pa.Table.from_pylist(by_depth[depth]), f"place_{depth} string, found_{depth} int"
        )
        placed = placed.withColumn(f"place_{depth}", F.substring_index(file, "/", depth)).join(
            listed, f"place_{depth}", "left"
        )
    unlisted = F.raise_error(F.concat(F.lit("no batch lists "), file)).cast("int")
    used = [f"{name}_{depth}" for depth in depths for name in ("place", "found")]
    return placed.withColumn(
        "batch_id", F.coalesce(*[f"found_{depth}" for depth in depths], unlisted)
    ).drop(*used)
