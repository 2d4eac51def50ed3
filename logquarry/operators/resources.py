"""Most-requested resources with exact distinct hosts.

Distinct hosts never add up over batches, so batches leave one row per path and
host, and the merge counts hosts over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions import clf
from logquarry.functions.patterns import HOST_SEPARATOR, TOP_RESOURCES

# Hosts of a path are spread over 16^HOST_DIGITS sets, by the first hex digits of their md5.
HOST_DIGITS = 2


def top_resources(totals: DataFrame, n: int = TOP_RESOURCES) -> DataFrame:
    """First ``n`` by requests; equal counts go by path, so the cut is stable."""
    return totals.orderBy(F.desc("request_count"), F.asc("resource_path")).limit(n)


def resource_totals(requests: DataFrame) -> DataFrame:
    """All resources straight from the requests, in one pass."""
    return requests.groupBy("resource_path").agg(
        F.count("*").alias("request_count"),
        clf.total_bytes(F.col("bytes")).alias("total_bytes"),
        F.count_distinct("host").alias("distinct_hosts"),
    )


def resource_partials(requests: DataFrame) -> DataFrame:
    """Per batch: one row per path and host."""
    return requests.groupBy("batch_id", "resource_path", "host").agg(
        F.count("*").alias("req_count"), clf.total_bytes(F.col("bytes")).alias("bytes")
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """All resources from the partials of any number of batches."""
    pairs = (
        partials.dropna(subset=["resource_path", "host"])
        .groupBy("resource_path", "host")
        .agg(F.sum("req_count").alias("req_count"), F.sum("bytes").alias("bytes"))
    )
    totals = pairs.groupBy("resource_path").agg(
        F.sum("req_count").alias("request_count"),
        F.sum("bytes").alias("total_bytes"),
        F.count("*").alias("distinct_hosts"),
    )
    return totals.filter(F.col("request_count") > 0)


def merge_top_resources(partials: DataFrame, n: int = TOP_RESOURCES) -> DataFrame:
    """The first ``n`` of :func:`merge_partials`, from stored partials.

    Ranking needs only the sums, so paths are ranked first and hosts are counted
    for the ``n`` ranked paths alone. Spark knows the size of a limit: for a small
    ``n`` the second read keeps the rows of those paths through a broadcast, with no
    shuffle of all path-host pairs.
    """
    rows = partials.dropna(subset=["resource_path", "host"])
    sums = (
        rows.groupBy("resource_path")
        .agg(F.sum("req_count").alias("request_count"), F.sum("bytes").alias("total_bytes"))
        .filter(F.col("request_count") > 0)
    )
    ranked = top_resources(sums, n)
    counted = (
        rows.select("resource_path", "host")
        .join(ranked, "resource_path")
        .groupBy("resource_path", "request_count", "total_bytes")
        .agg(F.count_distinct("host").alias("distinct_hosts"))
    )
    return top_resources(counted, n)


def _host_part(digits: int):
    return F.substring(F.md5("host"), 1, digits)


def _joined(hosts: Column) -> Column:
    """Hosts as one text, in order; '#' within a host, and '%', are written as escapes."""
    escaped = F.transform(
        F.array_sort(hosts),
        lambda h: F.replace(F.replace(h, F.lit("%"), F.lit("%25")), F.lit(HOST_SEPARATOR), F.lit("%23")),
    )
    return F.array_join(escaped, HOST_SEPARATOR)


def _unescaped(host: Column) -> Column:
    return F.replace(F.replace(host, F.lit("%23"), F.lit(HOST_SEPARATOR)), F.lit("%25"), F.lit("%"))


def host_set_partials(partials: DataFrame, digits: int = HOST_DIGITS) -> DataFrame:
    """Per batch and path: counts and the hosts as '#'-joined texts.

    Every path's hosts are split by the same rule, the first ``digits`` hex digits of their md5
    (``host_part``), whatever their number. Each row is a whole partial of its own, and a path that
    most hosts ask for is spread over as many groups; the merge adds them up as it adds up batches.
    """
    return partials.groupBy("batch_id", "resource_path", _host_part(digits).alias("host_part")).agg(
        F.sum("req_count").alias("request_count"),
        F.sum("bytes").alias("total_bytes"),
        _joined(F.collect_list("host")).alias("hosts"),
    )


def host_tokens(sets: DataFrame) -> DataFrame:
    """One row per path and listed host, empty names left out."""
    listed = sets.select("resource_path", F.explode(F.split("hosts", HOST_SEPARATOR)).alias("host"))
    return listed.filter(F.col("host") != "").withColumn("host", _unescaped(F.col("host")))


def merge_host_sets(sets: DataFrame) -> DataFrame:
    """All resources from '#'-joined host sets.

    Each listed host becomes a row; a set's counts ride on one extra row with no
    host, so a set is read once and counts are not multiplied by its hosts.
    """
    listed = F.filter(F.split("hosts", HOST_SEPARATOR), lambda h: h != "")
    no_requests, no_bytes = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(38,0)")
    tokens = sets.select(
        "resource_path",
        F.explode(
            F.concat(
                F.array(
                    F.struct(
                        F.lit(None).cast("string").alias("host"),
                        F.col("request_count").alias("n"),
                        F.col("total_bytes").cast("decimal(38,0)").alias("b"),
                    )
                ),
                F.transform(
                    listed, lambda h: F.struct(h.alias("host"), no_requests.alias("n"), no_bytes.alias("b"))
                ),
            )
        ).alias("t"),
    )
    return tokens.groupBy("resource_path").agg(
        F.sum("t.n").alias("request_count"),
        F.sum("t.b").alias("total_bytes"),
        F.count_distinct("t.host").alias("distinct_hosts"),
    )


def union_host_sets(sets: DataFrame, digits: int = HOST_DIGITS) -> DataFrame:
    """Union of the stored host sets of all batches, split by the same rule, in one pass."""
    found = (
        host_tokens(sets)
        .groupBy("resource_path", _host_part(digits).alias("host_part"))
        .agg(F.collect_set("host").alias("found"))
    )
    return found.select(
        "resource_path",
        "host_part",
        F.size("found").cast("bigint").alias("host_count"),
        _joined(F.col("found")).alias("hosts"),
    )
