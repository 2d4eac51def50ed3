"""Maintained totals against a full merge, while files come, change and go away."""

import pytest
from logquarry.operators import resources, rollup
from logquarry.sources import logs
from logquarry.sources import published
from logquarry.streaming import totals
from logquarry.streaming.compact import compact, read_ingested
from logquarry.streaming.ingest import ingest_stream

LINE = 'h{h} - - [01/Jul/1995:03:00:00 -0400] "GET /p{p} HTTP/1.0" 200 {size}'


def write(path, items):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(LINE.format(h=h, p=p, size=s) for h, p, s in items) + "\n")


@pytest.fixture
def made(tmp_path):
    for b in (1, 2):
        for f in range(3):
            write(tmp_path / f"logs/b{b}/{f}.log", [(i % (f + 2), i % 5, i + b) for i in range(12)])
    return tmp_path, [logs.Batch(f"{tmp_path}/logs/b{b}", f"B{b}") for b in (1, 2)], f"{tmp_path}/target", f"{tmp_path}/state"


def step(spark, made, checkpoint):
    root, batches, target, state = made
    ingest_stream(spark, f"{root}/logs", batches, target, f"{root}/{checkpoint}").awaitTermination()
    totals.refresh_totals(spark, target, state)


def check(spark, made):
    ours = sorted(map(str, totals.read_totals(spark, made[3]).collect()))
    full = resources.merge_partials(rollup.resource_rows_of(read_ingested(spark, made[2])))
    assert ours == sorted(map(str, full.select("resource_path", "request_count", "total_bytes", "distinct_hosts").collect()))
    return ours


def test_files_come_change_and_go(spark, made):
    root, _, target, state = made
    totals.refresh_totals(spark, target, state)
    assert totals.read_totals(spark, state).count() == 0
    step(spark, made, "c1")
    first = check(spark, made)
    step(spark, made, "c1")
    assert published.current(spark, state)[0] == 1
    write(root / "logs/b1/new.log", [(9, 1, 5), (9, 77, 5)])
    step(spark, made, "c1")
    assert check(spark, made) != first
    # A file changes: its host leaves one path and comes to another. A stream that begins anew reads it.
    write(root / "logs/b1/new.log", [(9, 2, 5)])
    step(spark, made, "c2")
    check(spark, made)
    (root / "logs/b1/new.log").unlink()
    totals.forget_files(spark, target, [f"{root}/logs/b1/new.log"])
    totals.refresh_totals(spark, target, state)
    assert check(spark, made) == first
    # Compacted files stay counted, also when more come.
    compact(spark, target, [1])
    totals.refresh_totals(spark, target, state)
    assert check(spark, made) == first
    write(root / "logs/b1/late.log", [(1, 1, 5)])
    step(spark, made, "c1")
    assert check(spark, made) != first
    write(root / "logs/b2/late.log", [(1, 1, 5)])
    ingest_stream(spark, f"{root}/logs", made[1], target, f"{root}/c1").awaitTermination()
    compact(spark, target)
    with pytest.raises(ValueError):
        totals.refresh_totals(spark, target, state)


def test_a_refresh_that_dies(spark, made, monkeypatch):
    root, _, target, state = made
    step(spark, made, "c1")
    before = check(spark, made)
    write(root / "logs/b1/new.log", [(9, 1, 5)])
    ingest_stream(spark, f"{root}/logs", made[1], target, f"{root}/c1").awaitTermination()
    with monkeypatch.context() as patched:
        patched.setattr(totals, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            totals.refresh_totals(spark, target, state)
    assert sorted(map(str, totals.read_totals(spark, state).collect())) == before
    totals.refresh_totals(spark, target, state)
    assert check(spark, made) != before
