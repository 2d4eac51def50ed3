"""Headline queries over log files derived from the given events.

Prints one JSON line. Figures are medians of three runs after a warm-up,
on text files written beforehand; the ``_3m`` ones use the same logs repeated to
3.46 million lines. In the ``_grown`` ones, of as many lines, each copy has its own hosts
and paths, so that group rows grow too, and a third of all requests goes to one path; they run once
and stand outside the total.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.operators import errors, parse, resources, rollup, traffic
from logquarry.plans import jobs
from logquarry.sources.corpus import BATCH_LABELS, corpus_lines
from logquarry.sources.logs import Batch, batch_lines

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FULL_LINES = 3_461_612
RUNS = 3


def session(folder: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("logquarry-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def write_logs(lines: DataFrame, root: str) -> list[Batch]:
    for i in BATCH_LABELS:
        one = lines.filter(F.col("batch_id") == i).select("line")
        one.repartition(int(CPUS)).write.mode("overwrite").text(f"{root}/batch_{i}")
    return [Batch(f"{root}/batch_{i}", label) for i, label in BATCH_LABELS.items()]


def grown(repeated: DataFrame) -> DataFrame:
    """Hosts and paths of their own for each copy; one path for each third one."""
    copy = F.col("copy").cast("string")
    own = F.regexp_replace("line", F.lit("/p/"), F.concat(F.lit("/p/"), copy, F.lit("/")))
    path = F.when(F.col("copy") % 3 == 0, F.regexp_replace("line", " /p/[0-9]+", " /hot")).otherwise(own)
    return repeated.withColumn("line", F.regexp_replace(path, F.lit("^u"), F.concat(F.lit("c"), copy, F.lit("u"))))


def seconds(action, runs: int = RUNS) -> float:
    if runs > 1:
        action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = tempfile.mkdtemp(prefix="logquarry-bench-")
    spark = session(folder)
    lines = corpus_lines(spark, SF_DIR)
    copies = max(1, round(FULL_LINES / lines.count()))
    repeated = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    found: dict[str, float] = {}
    for suffix, source in (("", lines), ("_3m", repeated), ("_grown", grown(repeated))):
        batches = write_logs(source, f"{folder}/logs{suffix}")
        text = batch_lines(spark, batches)
        parsed = parse.parse_lines(text)
        requests = parse.filter_resources(parsed)
        partials_path = f"{folder}/partials{suffix}"
        jobs.write_partials(text, partials_path)
        stored = jobs.read_partials(spark, partials_path)
        queries = {
            "q1_daily_status": lambda: run(traffic.daily_status(parsed)),
            "q2_top20": lambda: run(resources.top_resources(resources.resource_totals(requests))),
            "q3_hourly_errors": lambda: run(errors.hourly_errors(parsed)),
            "q2_stage2_top20": lambda: run(
                resources.merge_top_resources(rollup.resource_rows_of(stored))
            ),
            "rollup_partials": lambda: run(rollup.partials(text)),
            "job_all": lambda: jobs.run_all(spark, f"{folder}/store{suffix}", batches, run_id=1),
        }
        if suffix == "_grown":
            queries = {n: queries[n] for n in ("q2_top20", "rollup_partials", "job_all")}
            queries["q2_stage1_hostset"] = lambda: run(
                resources.host_set_partials(resources.resource_partials(requests))
            )
            queries["job_all_quarantine"] = lambda: jobs.run_all(
                spark, f"{folder}/store{suffix}", batches, run_id=2, quarantine=f"{folder}/quarantine"
            )
        for name, action in queries.items():
            found[name + suffix] = seconds(action, 1 if suffix == "_grown" else RUNS)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(v for n, v in found.items() if not n.endswith("_grown")), 3),
                "unit": "sec",
                "queries": found,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
                "cpus": int(CPUS),
                "copies_3m": copies,
            }
        )
    )


if __name__ == "__main__":
    main()
