"""Compaction of an ingest: results, replays, later files and a compaction that dies."""

import pytest
from logquarry import schemas
from logquarry.operators import rollup
from logquarry.sources import logs
from logquarry.streaming import compact as compacting
from logquarry.streaming.ingest import ingest_stream

LINE = 'h{h} - - [01/Jul/1995:0{hour}:00:00 -0400] "GET /p{p} HTTP/1.0" {status} {size}'


def write(folder, name, n, start=0):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [LINE.format(h=i % 3, hour=i % 5, p=i % 4, status=(200, 404)[i % 7 == 0], size=i) for i in range(start, start + n)]
    (folder / name).write_text("\n".join([*lines, "junk", ""]) + "\n")


@pytest.fixture
def made(tmp_path):
    for b in (1, 2):
        for f in range(3):
            write(tmp_path / f"logs/b{b}", f"{f}.log", 10 + f, b * 100)
    batches = [logs.Batch(f"{tmp_path}/logs/b{b}", f"B{b}") for b in (1, 2)]
    return tmp_path, batches, f"{tmp_path}/target"


def ingest(spark, made, state):
    root, batches, target = made
    ingest_stream(spark, f"{root}/logs", batches, target, f"{root}/{state}").awaitTermination()


def results(rows):
    of = (rollup.quality_of, rollup.daily_of, rollup.hourly_of, lambda r: rollup.resource_rows_of(r).groupBy("batch_id", "resource_path", "host").sum("req_count", "bytes"))
    return [sorted(map(str, f(rows).collect())) for f in of]


def expected(spark, made):
    return results(rollup.partials(logs.batch_lines(spark, made[1])))


def folders(target):
    return sorted(str(p.relative_to(target)) for p in target.glob("part=*/batch_id=*/source_id=*"))


def test_results_stay_and_folders_go(spark, made):
    root, _, target = made
    ingest(spark, made, "c1")
    assert results(compacting.read_ingested(spark, target)) == expected(spark, made)
    compacting.compact(spark, target, [1])
    assert not [f for f in folders(root / "target") if "batch_id=1/" in f] and folders(root / "target")
    assert results(compacting.read_ingested(spark, target)) == expected(spark, made)
    for state in ("c1", "c2"):  # a stream that goes on, and one that begins anew
        ingest(spark, made, state)
        assert results(compacting.read_ingested(spark, target)) == expected(spark, made)
    write(root / "logs/b1", "late.log", 5, 500)
    ingest(spark, made, "c1")
    assert results(compacting.read_ingested(spark, target)) == expected(spark, made)
    compacting.compact(spark, target)
    compacting.compact(spark, target)
    assert folders(root / "target") == []
    assert results(compacting.read_ingested(spark, target)) == expected(spark, made)
    assert compacting.absorbed_sources(spark, target).count() == 7
    assert len(list((root / "target/_compacted/rows").glob("attempt=*/part=*/batch_id=*"))) == 4


def test_a_compaction_that_dies(spark, made, monkeypatch):
    root, _, target = made
    ingest(spark, made, "c1")
    wanted = expected(spark, made)
    for step in ("publish", "delete_folder"):
        with monkeypatch.context() as patched:
            patched.setattr(compacting, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                compacting.compact(spark, target)
        assert results(compacting.read_ingested(spark, target)) == wanted
        ingest(spark, made, f"again-{step}")
        assert results(compacting.read_ingested(spark, target)) == wanted
    compacting.compact(spark, target)
    assert folders(root / "target") == [] and results(compacting.read_ingested(spark, target)) == wanted


def test_nothing_to_compact(spark, tmp_path):
    compacting.compact(spark, f"{tmp_path}/none")
    assert compacting.read_ingested(spark, f"{tmp_path}/none").schema.names == schemas.PARTIALS.names
