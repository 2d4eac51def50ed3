"""Keyed upsert against a dictionary, with failures and two writers at a time."""

import random

import pytest
from logquarry.sinks import upsert
from logquarry.sources import published
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("host", T.StringType()),
                       T.StructField("n", T.LongType()), T.StructField("note", T.StringType())])
KEYS = ("path", "host")


def rows_of(spark, items):
    return spark.createDataFrame([(p, h, n, "x") for (p, h), n in items.items()], SCHEMA)


def held(spark, path):
    found = upsert.read_keyed(spark, path).collect()
    assert len({(r.path, r.host) for r in found}) == len(found)
    return {(r.path, r.host): r.n for r in found}


def test_corrections_one_after_the_other(spark, tmp_path):
    path, rng, wanted = f"{tmp_path}/t", random.Random(4), {}
    upsert.create_keyed(spark, path, SCHEMA, KEYS, buckets=8)
    assert held(spark, path) == {}
    for turn in range(4):
        part = {(rng.choice([None, "/a", "/b", f"/{i}"]), rng.choice([None, "h", f"h{i % 3}"])): turn * 100 + i for i in range(30)}
        upsert.upsert(spark, path, rows_of(spark, part))
        wanted |= part
        assert held(spark, path) == wanted
    leaving = list(wanted)[:5] + [("not", "there")]
    gone = spark.createDataFrame(leaving, "path string, host string")
    upsert.upsert(spark, path, rows_of(spark, {("/new", "h"): 1}), gone=gone)
    wanted = {k: v for k, v in wanted.items() if k not in leaving} | {("/new", "h"): 1}
    assert held(spark, path) == wanted
    upsert.forget_unpublished(spark, path)
    assert held(spark, path) == wanted


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert.create_keyed(spark, path, SCHEMA, KEYS, buckets=32)
    upsert.upsert(spark, path, rows_of(spark, {(f"/{i}", "h"): i for i in range(200)}))
    before = published.current(spark, path)[1]
    upsert.upsert(spark, path, rows_of(spark, {("/7", "h"): -1}))
    after = published.current(spark, path)[1]
    assert sum(before[k] != after[k] for k in before) == 1
    assert held(spark, path)["/7", "h"] == -1 and len(held(spark, path)) == 200


def test_a_failed_correction_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    upsert.create_keyed(spark, path, SCHEMA, KEYS)
    upsert.upsert(spark, path, rows_of(spark, {("/a", "h"): 1}))
    twice = rows_of(spark, {("/a", "h"): 2}).unionByName(rows_of(spark, {("/a", "h"): 3}))
    with pytest.raises(ValueError, match="twice"):
        upsert.upsert(spark, path, twice)
    with monkeypatch.context() as patched:
        patched.setattr(published, "_renamed", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert.upsert(spark, path, rows_of(spark, {("/a", "h"): 9, ("/b", "h"): 9}))
    assert held(spark, path) == {("/a", "h"): 1}
    with pytest.raises(ValueError):
        upsert.create_keyed(spark, path, SCHEMA, ("path",))
    with pytest.raises(FileNotFoundError):
        upsert.upsert(spark, f"{tmp_path}/none", twice)


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """Another correction is published between reading and publishing of this one."""
    path = f"{tmp_path}/t"
    upsert.create_keyed(spark, path, SCHEMA, KEYS, buckets=2)
    upsert.upsert(spark, path, rows_of(spark, {("/a", "h"): 1, ("/b", "h"): 1}))
    rename, calls = published._renamed, []

    def late(*args):
        calls.append(1)
        if len(calls) == 1:
            upsert.upsert(spark, path, rows_of(spark, {("/a", "h"): 5, ("/c", "h"): 5}))
        return rename(*args)

    monkeypatch.setattr(published, "_renamed", late)
    upsert.upsert(spark, path, rows_of(spark, {("/b", "h"): 7, ("/d", "h"): 7}))
    assert held(spark, path) == {("/a", "h"): 5, ("/b", "h"): 7, ("/c", "h"): 5, ("/d", "h"): 7}


def test_readers_of_an_earlier_list_go_on(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert.create_keyed(spark, path, SCHEMA, KEYS)
    upsert.upsert(spark, path, rows_of(spark, {("/a", "h"): 1}))
    earlier = upsert.read_keyed(spark, path)
    for n in range(8):
        upsert.upsert(spark, path, rows_of(spark, {("/a", "h"): n}))
    assert [r.n for r in earlier.collect()] == [1]
    assert len(published._lists(spark, path)) == published.KEPT_LISTS
