"""Data-quality counts and batch metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from logquarry.functions import clf
from logquarry.functions import patterns as P
from logquarry.operators.parse import BLANK, MALFORMED, PARSED, classify_lines

# Per table of the result store: when a value that must be there is missing, and what tells its rows apart.
STORE_RULES = {
    "run_metadata": ("run_id is null or pipeline_name is null or execution_timestamp is null", ("run_id",)),
    "batch_metadata": (
        "run_id is null or query_name is null or stage is null or runtime_ms is null or (stage <> 'merge' and "
        "(batch_id is null or batch_label is null or batch_size is null or average_batch_size is null "
        "or records_processed is null))",
        ("run_id", "query_name", "batch_id", "stage"),
    ),
    "malformed_record_summary": (
        "run_id is null or query_name is null or batch_id is null or malformed_record_count is null",
        ("run_id", "query_name", "batch_id"),
    ),
    "query_results": (
        "run_id is null or query_name is null or (query_name = 'Q2' and resource_path is null) "
        "or (query_name in ('Q1', 'Q3') and log_date is null)",
        ("run_id", "query_name", "batch_id", "log_date", "log_hour", "status_code", "resource_path"),
    ),
}


def parse_quality(lines: DataFrame) -> DataFrame:
    """Line counts per batch. Aggregated, not accumulated: a retried task cannot
    count its lines twice."""
    kind = F.col("line_kind")
    return (
        classify_lines(lines)
        .groupBy("batch_id")
        .agg(
            F.count("*").alias("total_lines"),
            F.count_if(kind == BLANK).alias("blank_lines"),
            F.count_if(kind == MALFORMED).alias("malformed"),
            F.count_if(kind == PARSED).alias("records_processed"),
            F.sum(F.col("line_bytes") + 1).alias("batch_bytes"),
        )
    )


def with_average_size(quality: DataFrame) -> DataFrame:
    """Batch size in lines and the mean over the run's batches (a few rows)."""
    every = Window.partitionBy()
    return quality.withColumn("batch_size", F.col("total_lines")).withColumn(
        "average_batch_size", F.avg("total_lines").over(every).cast("decimal(20,2)")
    )


def parity_audit(lines: DataFrame) -> DataFrame:
    """Malformed and kept lines under every definition of a well-formed line,
    counted in one pass. Only ``lenient`` trims lines and skips blank ones."""
    tried = lines.withColumn("trimmed", clf.trim_edges(F.col("line")))
    considered = {n: (F.col("trimmed") != "") if n == "lenient" else F.lit(True) for n in P.READ_SHAPES}
    fits = [
        (considered[n] & F.rlike(F.col("trimmed" if n == "lenient" else "line"), F.lit(pattern))).alias(n)
        for n, (pattern, _) in P.READ_SHAPES.items()
    ]
    marked = clf.evaluate_once(tried, "fits", F.struct(*fits))
    counts = []
    for name in P.READ_SHAPES:
        fit = F.col(f"fits.{name}")
        counts += [
            F.count_if(considered[name] & ~fit).alias(f"{name}_malformed"),
            F.count_if(fit).alias(f"{name}_kept"),
        ]
    rows = ", ".join(f"'{n}', {n}_malformed, {n}_kept" for n in P.READ_SHAPES)
    return (
        marked.groupBy("batch_id")
        .agg(*counts)
        .selectExpr(
            "batch_id",
            f"stack({len(P.READ_SHAPES)}, {rows}) as (profile, malformed_count, kept_count)",
        )
    )


def observed(lines: DataFrame, name: str = "quality", batches: Sequence[int] = ()) -> tuple[DataFrame, Observation]:
    """The classified ``lines``, and the counts that the first action on them takes on its way.

    The observation holds the counts of :func:`parse_quality` over all batches and, by names that end in
    ``_<batch>``, for each of ``batches`` (a short list). They cost no pass of their own. A task tried again
    counts once; a whole stage done again, because its output was lost with an executor, counts again.
    Where that may not be, take :func:`parse_quality`.
    """
    observation = Observation(name)
    kind = F.col("line_kind")
    measures = {
        "total_lines": F.lit(True),
        "blank_lines": kind == BLANK,
        "malformed": kind == MALFORMED,
        "records_processed": kind == PARSED,
    }
    size = F.col("line_bytes") + 1
    counts = [F.count_if(m).alias(n) for n, m in measures.items()]
    counts.append(F.coalesce(F.sum(size), F.lit(0)).alias("batch_bytes"))
    for i in batches:
        own = F.col("batch_id") == i
        counts += [F.count_if(m & own).alias(f"{n}_{i}") for n, m in measures.items()]
        counts.append(F.coalesce(F.sum(F.when(own, size)), F.lit(0)).alias(f"batch_bytes_{i}"))
    return classify_lines(lines).observe(observation, *counts), observation


def profile_difference(lines: DataFrame, first: str, second: str) -> DataFrame:
    """``batch_id, line, kept_by, line_count``: the lines that one of two definitions keeps and the other does
    not, as often as they came. Only these lines are shuffled. Equal counts of :func:`parity_audit`
    may hide such lines; none here means that both keep the same ones.
    """
    trimmed = clf.trim_edges(F.col("line"))

    def keeps(profile: str):
        pattern = P.READ_SHAPES[profile][0]
        text = trimmed if profile == "lenient" else F.col("line")
        return F.rlike(text, F.lit(pattern))

    marked = clf.evaluate_once(lines, "kept", F.struct(keeps(first).alias("a"), keeps(second).alias("b")))
    by = F.when(F.col("kept.a"), first).otherwise(second)
    return (
        marked.filter(F.col("kept.a") != F.col("kept.b"))
        .groupBy("batch_id", "line", by.alias("kept_by"))
        .agg(F.count("*").alias("line_count"))
    )


def compare_groups(first: DataFrame, second: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The groups in which two results differ: ``keys``, each measure as ``<name>_first`` and ``<name>_second``.

    Groups are matched by ``keys``, null like any value; one that a result lacks has null measures there.
    """
    a, b = (df.select(*keys, *measures, F.lit(True).alias("here")).alias(n) for df, n in ((first, "a"), (second, "b")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    differs = ~F.col("a.here").eqNullSafe(F.col("b.here"))
    for m in measures:
        differs = differs | ~F.col(f"a.{m}").eqNullSafe(F.col(f"b.{m}"))
    picked = [F.when(F.col("a.here"), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys]
    shown = [F.col(f"{s}.{m}").alias(f"{m}_{n}") for m in measures for s, n in (("a", "first"), ("b", "second"))]
    return a.join(b, same, "full").filter(differs).select(*picked, *shown)


def store_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """``fault, table_name, run_id, query_name, row_count``: rows of the result store that break its rules.

    ``orphan_run``: no run of that id is known; ``orphan_batch``: results of a batch that the run's metadata
    lack; ``null_key``: a value that must be there is not; ``repeated_group``: rows beyond the first of
    a group. ``tables`` has the store's tables by name. Runs are few beside results, so rows are counted by
    run before they are joined.
    """
    found = []

    def report(rows: DataFrame, fault: str, table: str) -> None:
        named = rows if "query_name" in rows.columns else rows.withColumn("query_name", F.lit(None).cast("string"))
        found.append(
            named.groupBy("run_id", "query_name").agg(F.sum("row_count").alias("row_count"))
            .select(F.lit(fault).alias("fault"), F.lit(table).alias("table_name"), "run_id", "query_name", "row_count")
        )

    runs = tables["run_metadata"].select(F.col("run_id").alias("known_run")).distinct()
    batches = tables["batch_metadata"].select(
        F.col("run_id").alias("known_run"), F.col("query_name").alias("known_query"), F.col("batch_id").alias("known_batch")
    ).distinct()
    one = F.count("*").alias("row_count")
    for table, (missing, group) in STORE_RULES.items():
        rows = tables[table]
        if table != "run_metadata":
            by_run = rows.groupBy("run_id", "query_name").agg(one)
            report(by_run.join(runs, F.col("run_id") == F.col("known_run"), "left_anti"), "orphan_run", table)
        query = [c for c in ("query_name",) if c in rows.columns]
        report(rows.filter(missing).groupBy("run_id", *query).agg(one), "null_key", table)
        again = rows.groupBy(*group).agg((F.count("*") - 1).alias("row_count")).filter("row_count > 0")
        report(again, "repeated_group", table)
    by_batch = tables["query_results"].filter("batch_id is not null").groupBy("run_id", "query_name", "batch_id").agg(one)
    same = (
        (F.col("run_id") == F.col("known_run")) & (F.col("query_name") == F.col("known_query"))
        & (F.col("batch_id") == F.col("known_batch"))
    )
    report(by_batch.join(batches, same, "left_anti"), "orphan_batch", "query_results")
    return reduce(lambda a, b: a.unionByName(b), found)
