"""Jobs: run one question, or all of them, over the batches of a run."""

from __future__ import annotations

import time
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry import schemas
from logquarry.functions import packed
from logquarry.operators import rollup
from logquarry.operators.quality import with_average_size
from logquarry.operators.resources import merge_top_resources
from logquarry.sinks import store as sink
from logquarry.sinks.files import (
    delete_folder,
    folders_in,
    replace_output,
    replace_partitions,
    write_run_quarantine,
)
from logquarry.sources.logs import Batch, batch_lines, batch_table, input_marks
from logquarry.sources.published import current, partition_folders, publish, read_folders

QUESTIONS = ("Q1", "Q2", "Q3")
PARTIAL_KEYS = ("part", "batch_id")


def _now_ms() -> int:
    return time.monotonic_ns() // 1_000_000


def write_partials(
    lines: DataFrame, path: str, questions: Sequence[str] = QUESTIONS, rejected: bool = False
) -> None:
    """Group rows of the batches in ``lines``; a batch run again replaces its own."""
    replace_partitions(rollup.partials(lines, questions, rejected=rejected), path, *PARTIAL_KEYS)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PARTIALS).parquet(path)


def progress_of(store: str, run_id: int) -> str:
    """Where a run keeps its group rows and the list of its finished batches."""
    return f"{store}/partials/run_id={run_id}"


def _commit(
    spark: SparkSession, root: str, attempt: str, done: dict[int, dict], questions: Sequence[str], rejected: bool
) -> None:
    """Note batches as finished, with the folders that hold their group rows."""
    folders = partition_folders(spark, f"{root}/{attempt}", len(PARTIAL_KEYS))
    entries = {}
    for batch_id, facts in done.items():
        mine = [f"{attempt}/{f}" for f in folders if f.endswith(f"/batch_id={batch_id}")]
        entries[str(batch_id)] = {"folders": mine, "questions": sorted(questions), "rejected": rejected, **facts}
    publish(spark, root, lambda before: before | entries)


def _finished(spark: SparkSession, root: str, prints: dict[int, str], questions: Sequence[str], rejected: bool) -> set[int]:
    """The batches whose group rows are there already: of the same files, patterns and questions."""
    _, entries = current(spark, root)
    return {
        i
        for i, mark in prints.items()
        if (e := entries.get(str(i)))
        and e["inputs"] == mark
        and set(questions) <= set(e["questions"])
        and (e["rejected"] or not rejected)
    }


def run_questions(
    spark: SparkSession,
    store: str,
    batches: Sequence[Batch] | DataFrame,
    questions: Sequence[str] = QUESTIONS,
    run_id: int | None = None,
    pipeline_name: str = "spark",
    per_batch: bool = False,
    quarantine: str | None = None,
    anew: bool = False,
    database: str | None = None,
    recursive: bool = False,
    resume: bool = False,
) -> int:
    """Run ``questions`` over ``batches``, fill the result store, return the run id.

    ``batches`` may also be rows of ``batch_id, line``, such as chunks. What the run has stored
    under its id for these questions is replaced, and with ``anew`` for all questions; readers see the
    earlier rows of all tables until the new ones are all there. ``recursive`` descends into the folders
    of batches. Malformed lines go to the folder ``quarantine`` where one is named, in place of those of
    an earlier try of this run; they come from the same pass. Tables that ``database`` has of the store are
    brought up to date.

    The logs are read and parsed once, into group rows per batch; all results,
    quality counts and metadata come from those. By default one Spark job covers
    all batches and its wall clock stands on each of their metadata rows (stage
    ``all_batches``). ``per_batch`` runs them one after the other, each with its
    own time (stage ``batch``). A last row per question, without a batch, holds the
    time of the final step they share (stage ``merge``).

    ``resume``, with a ``run_id``, works batch by batch and passes over those that an earlier try with this
    id has finished, if their files (names, sizes, times), the patterns and the places of batches within
    them are as they were; their time is that of the earlier try.
    """
    chunked = isinstance(batches, DataFrame)
    if chunked and (per_batch or resume):
        raise ValueError("rows with a batch id run together")
    if resume and run_id is None:
        raise ValueError("only a run with an id can be taken up again")
    run_id = sink.new_run_id() if run_id is None else run_id
    attempt = sink.begin(store)
    sink.put(attempt, sink.run_row(spark, pipeline_name, run_id), "run_metadata")
    # A folder of its own for each attempt: a run done again over fewer batches
    # must not meet the group rows of the batches it leaves out.
    progress = progress_of(store, run_id)
    own = f"attempt={attempt.name}"
    partials_path = f"{progress}/{own}"
    rejected = bool(quarantine)
    if per_batch or resume:
        prints = {i: mark for i, mark in enumerate(input_marks(spark, batches, recursive), start=1)}
        finished = _finished(spark, progress, prints, questions, rejected) if resume else set()
        for i in prints.keys() - finished:
            start = _now_ms()
            write_partials(batch_lines(spark, batches, recursive, only=i), partials_path, questions, rejected)
            _commit(spark, progress, own, {i: {"inputs": prints[i], "runtime_ms": _now_ms() - start}}, questions, rejected)
        entries = current(spark, progress)[1]
        mine = {i: entries[str(i)] for i in prints}
        runtimes = [{"batch_id": i, "stage": "batch", "runtime_ms": e["runtime_ms"]} for i, e in mine.items()]
        stored = read_folders(spark, progress, [f for e in mine.values() for f in e["folders"]], schemas.PARTIALS)
    else:
        lines = batches.select("batch_id", "line") if chunked else batch_lines(spark, batches, recursive)
        start = _now_ms()
        write_partials(lines, partials_path, questions, rejected)
        elapsed = _now_ms() - start
        mine = {}
        stored = read_partials(spark, partials_path)

    start = _now_ms()
    if quarantine:
        write_run_quarantine(rollup.rejected_of(stored), quarantine, run_id)
    results = {q: question_result(stored, q) for q in questions}
    sink.put(attempt, sink.wide_results(run_id, **results), "query_results")
    merge_elapsed = _now_ms() - start
    merges = [{"query_name": q, "stage": "merge", "runtime_ms": merge_elapsed} for q in questions]

    sized = with_average_size(rollup.quality_of(stored))
    if chunked:
        label = F.concat(F.lit("chunk "), F.col("batch_id").cast("string"))
        sized = sized.withColumn("batch_label", label)
    else:
        sized = batch_table(spark, batches).drop("path").join(sized, "batch_id")
    if per_batch or resume:
        times = spark.createDataFrame(
            pa.Table.from_pylist(runtimes), "batch_id int, stage string, runtime_ms bigint"
        )
        sized = sized.join(times, "batch_id")
    else:
        sized = sized.withColumns(
            {"stage": F.lit("all_batches"), "runtime_ms": F.lit(elapsed).cast("bigint")}
        )
    batch_rows = (
        sized
        .withColumn("query_name", F.explode(F.array(*[F.lit(q) for q in questions])))
        .withColumnRenamed("malformed", "malformed_lines")
    )
    merge_rows = spark.createDataFrame(
        pa.Table.from_pylist(merges), "query_name string, stage string, runtime_ms bigint"
    )
    run = F.lit(run_id).cast("bigint")
    sink.put(
        attempt,
        batch_rows.unionByName(merge_rows, allowMissingColumns=True).withColumn("run_id", run),
        "batch_metadata",
    )
    sink.put(
        attempt,
        batch_rows.withColumn("run_id", run).withColumn(
            "malformed_record_count", F.col("malformed_lines")
        ),
        "malformed_record_summary",
    )
    sink.publish_attempt(spark, attempt, run_id, None if anew else questions)
    used = {own} | {f.split("/", 1)[0] for e in mine.values() for f in e["folders"]}
    for folder in folders_in(spark, progress):
        name = folder.rsplit("/", 1)[-1]
        if name.startswith("attempt=") and name not in used:
            delete_folder(spark, folder)
    if database:
        sink.refresh_tables(spark, database)
    return run_id


DECODERS = {"Q1": packed.decode_daily, "Q2": packed.decode_resources, "Q3": packed.decode_hourly}


def import_packed(
    spark: SparkSession,
    store: str,
    outputs: dict[str, str],
    run_id: int | None = None,
    pipeline_name: str = "import",
) -> int:
    """Load packed outputs, a folder for each question, into the result store; return the run id.

    A row is cut at its first tab. Rows that cannot be decoded are kept apart, whole
    (see :func:`read_corrupt`). The outputs hold no batches, so ``batch_id`` is NULL.
    """
    run_id = sink.new_run_id() if run_id is None else run_id
    attempt = sink.begin(store)
    sink.put(attempt, sink.run_row(spark, pipeline_name, run_id), "run_metadata")
    value = F.col("value")
    key = F.substring_index(value, "\t", 1)
    rest = F.when(value.contains("\t"), F.substring(value, F.length(key) + 2, F.length(value)))
    decoded = {
        name: DECODERS[name](
            spark.read.text(path).select(key.alias("packed_key"), rest.alias("packed_value"))
        )
        for name, path in outputs.items()
    }
    sound = {n: df.filter(F.col("_corrupt").isNull()).drop("_corrupt") for n, df in decoded.items()}
    sink.put(attempt, sink.wide_results(run_id, **sound), "query_results")
    for name, df in decoded.items():
        replace_output(
            df.filter(F.col("_corrupt").isNotNull()).select("_corrupt"),
            f"{store}/packed_corrupt/run_id={run_id}/query_name={name}",
        )
    sink.publish_attempt(spark, attempt, run_id, list(outputs))
    return run_id


def read_corrupt(spark: SparkSession, store: str, run_id: int) -> DataFrame:
    """``query_name, _corrupt``: the rows of packed outputs that could not be decoded."""
    rows = spark.read.schema("_corrupt string, run_id bigint, query_name string").parquet(
        f"{store}/packed_corrupt"
    )
    return rows.filter(F.col("run_id") == run_id).select("query_name", "_corrupt")


def question_result(stored: DataFrame, question: str) -> DataFrame:
    """Daily and hourly results per batch; top resources over all batches, so
    their ``batch_id`` is NULL."""
    if question == "Q1":
        return rollup.daily_of(stored)
    if question == "Q2":
        return merge_top_resources(rollup.resource_rows_of(stored))
    if question == "Q3":
        return rollup.hourly_of(stored)
    raise ValueError(f"unknown question: {question}")


def run_q1(spark: SparkSession, store: str, batches: Sequence[Batch], **options) -> int:
    return run_questions(spark, store, batches, ("Q1",), **options)


def run_q2(spark: SparkSession, store: str, batches: Sequence[Batch], **options) -> int:
    return run_questions(spark, store, batches, ("Q2",), **options)


def run_q3(spark: SparkSession, store: str, batches: Sequence[Batch], **options) -> int:
    return run_questions(spark, store, batches, ("Q3",), **options)


def run_all(spark: SparkSession, store: str, batches: Sequence[Batch], **options) -> int:
    return run_questions(spark, store, batches, QUESTIONS, **options)
