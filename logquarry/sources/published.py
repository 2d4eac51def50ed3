"""Folders that appear at once.

Data goes into folders that are written once and never changed. What a reader may see is a list of them,
a small numbered file under ``_published``. A new list is written aside and renamed into place, so that a
reader finds the old one or the new one whole, and a writer that died has changed nothing. The rename
does not replace: of two writers with the same number one fails, takes up the other's list and tries
again. It needs a file system whose rename is atomic; on stores without one, one writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from logquarry.sources.places import file_system

LISTS = "_published"
TRIES = 30
# Lists that stay for readers that have begun with them.
KEPT_LISTS = 5

Entries = dict[str, dict]


def new_folder_name() -> str:
    """A name no other writer uses; later ones sort behind earlier ones of the same clock."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _lists(spark: SparkSession, root: str) -> list[int]:
    system, place = file_system(spark, f"{root}/{LISTS}")
    if not system.exists(place):
        return []
    names = [s.getPath().getName() for s in system.listStatus(place)]
    return sorted(int(n) for n in names if n.isdigit())


def _list_path(root: str, number: int) -> str:
    return f"{root}/{LISTS}/{number:012d}"


def _read(spark: SparkSession, path: str) -> Entries:
    system, place = file_system(spark, path)
    stream = system.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> tuple[int, Entries]:
    """Number and entries of the latest list; 0 and none where nothing is published."""
    numbers = _lists(spark, root)
    return (numbers[-1], _read(spark, _list_path(root, numbers[-1]))) if numbers else (0, {})


def publish(spark: SparkSession, root: str, change: Callable[[Entries], Entries]) -> Entries:
    """Put ``change`` of the latest entries in their place; with other writers, after theirs."""
    for _ in range(TRIES):
        number, entries = current(spark, root)
        entries = change(dict(entries))
        aside = f"{root}/{LISTS}/_{uuid.uuid4().hex}"
        system, place = file_system(spark, aside)
        stream = system.create(place, False)
        try:
            stream.write(bytearray(json.dumps(entries, sort_keys=True).encode()))
        finally:
            stream.close()
        if _renamed(spark, aside, _list_path(root, number + 1)):
            for old in [n for n in _lists(spark, root) if n <= number + 1 - KEPT_LISTS]:
                system, place = file_system(spark, _list_path(root, old))
                system.delete(place, False)
            return entries
        system.delete(place, False)
    raise RuntimeError(f"others kept publishing under {root}")


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Rename unless ``target`` exists."""
    jvm = spark._jvm
    _, place = file_system(spark, source)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(place, jvm.org.apache.hadoop.fs.Path(target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Paths below ``folder`` of its partitions, ``depth`` levels down; none if it is not there."""
    system, place = file_system(spark, folder)
    found = [("", place)] if system.exists(place) else []
    for _ in range(depth):
        found = [
            (f"{name}/{s.getPath().getName()}".lstrip("/"), s.getPath())
            for name, at in found
            for s in system.listStatus(at)
            if s.isDirectory() and "=" in s.getPath().getName()
        ]
    return sorted(name for name, _ in found)


def read_folders(spark: SparkSession, base: str, folders: Iterable[str], schema: T.StructType) -> DataFrame:
    """The rows of ``folders`` below ``base``; columns of ``schema`` may stand in the folders' names."""
    paths = [f"{base}/{f}" for f in folders]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
