"""From raw lines to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.functions import clf
from logquarry.functions import patterns as P

BLANK, MALFORMED, PARSED = "blank", "malformed", "parsed"
FIELDS = ("host", "log_time", "request", "status_code", "bytes", "log_date", "log_hour")


def _keys(df: DataFrame, *used: str) -> list[str]:
    """Columns that ride along: batch id, label, source file and the like."""
    return [c for c in df.columns if c not in used]


def clean_lines(lines: DataFrame) -> DataFrame:
    """Lines trimmed at both ends, blank ones dropped."""
    trimmed = lines.select(*_keys(lines, "line"), clf.trim_edges(F.col("line")).alias("line"))
    return trimmed.filter(F.col("line") != "")


def classify_lines(lines: DataFrame) -> DataFrame:
    """Every line with its ``line_kind`` and, when it parses, its typed fields.

    One pass, no filter: quality counts and all questions can share it.
    """
    keys = _keys(lines, "line")
    trimmed = lines.select(
        *keys,
        F.octet_length("line").cast("bigint").alias("line_bytes"),
        clf.trim_edges(F.col("line")).alias("line"),
    )
    matched = clf.evaluate_once(trimmed, "found", clf.match_groups(F.col("line"), P.CLF_LINE, 5))
    groups = F.when(F.size("found") == 5, F.col("found"))
    tagged = matched.select(
        *keys,
        "line",
        "line_bytes",
        F.when(F.col("line") == "", BLANK)
        .when(groups.isNull(), MALFORMED)
        .otherwise(PARSED)
        .alias("line_kind"),
        *[
            F.get(groups, F.lit(i)).alias(name)
            for i, name in enumerate(("host", "log_time", "request", "status", "bytes_text"))
        ],
    )
    return tagged.select(
        *keys,
        "line",
        "line_bytes",
        "line_kind",
        "host",
        "log_time",
        "request",
        F.col("status").cast("int").alias("status_code"),
        "bytes_text",
        F.when(F.col("bytes_text").isNotNull(), clf.byte_count(F.col("bytes_text"))).alias("bytes"),
        clf.log_date(F.col("log_time")).alias("log_date"),
        clf.log_hour(F.col("log_time")).alias("log_hour"),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Well-formed lines only, with typed fields."""
    classified = classify_lines(lines).filter(F.col("line_kind") == PARSED)
    return classified.drop("line", "line_bytes", "line_kind")


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Non-blank lines that do not have the log format."""
    classified = classify_lines(lines).filter(F.col("line_kind") == MALFORMED)
    return classified.select(*_keys(lines, "line"), "line")


def parse_requests(parsed: DataFrame) -> DataFrame:
    """Method, path and optional protocol; other request texts are skipped."""
    groups = clf.match_groups(F.col("request"), P.CLF_REQUEST, 3)
    found = clf.evaluate_once(parsed, "request_groups", groups).filter(
        F.size("request_groups") == 3
    )
    return found.select(
        *parsed.columns,
        F.get("request_groups", F.lit(0)).alias("method"),
        F.get("request_groups", F.lit(1)).alias("path"),
        F.nullif(F.get("request_groups", F.lit(2)), F.lit("")).alias("protocol"),
    )


def with_resource_path(parsed: DataFrame, path_mode: str = "decoded") -> DataFrame:
    """Add ``method`` and ``resource_path``; the path is NULL unless the request
    has a counted method and its cleaned path starts with '/'."""
    groups = clf.match_groups(F.col("request"), P.CLF_REQUEST, 3)
    grouped = parsed.withColumn("request_groups", groups)
    method = F.get("request_groups", F.lit(0))
    counted = (F.size("request_groups") == 3) & method.isin(*P.METHODS)
    cleaned = clf.clean_path(F.get("request_groups", F.lit(1)), path_mode)
    found = clf.evaluate_once(grouped, "cleaned_path", F.when(counted, cleaned))
    return found.select(
        *parsed.columns,
        F.when(counted, method).alias("method"),
        F.when(F.col("cleaned_path").startswith("/"), F.col("cleaned_path")).alias(
            "resource_path"
        ),
    )


def filter_resources(parsed: DataFrame, path_mode: str = "decoded") -> DataFrame:
    """Requests that count as resource requests."""
    return with_resource_path(parsed, path_mode).filter(F.col("resource_path").isNotNull())


def read_with_pattern(lines: DataFrame, shape: str) -> DataFrame:
    """Schema on read: all-string columns named by ``shape``; a line that does
    not match gives a row of NULLs. Lines are taken untrimmed."""
    pattern, names = P.READ_SHAPES[shape]
    keys = _keys(lines, "line")
    matched = clf.evaluate_once(
        lines, "found", clf.match_groups(F.col("line"), pattern, len(names))
    )
    groups = F.when(F.size("found") == len(names), F.col("found"))
    return matched.select(
        *keys, *[F.get(groups, F.lit(i)).alias(name) for i, name in enumerate(names)]
    )


def parse_strict(lines: DataFrame, shape: str, path_mode: str = "raw") -> DataFrame:
    """Typed rows under one of the single-space patterns, matching lines only."""
    rows = read_with_pattern(lines, shape).filter(F.col("host").isNotNull())
    typed = rows.withColumn("status_code", F.col("status").cast("int")).drop("status")
    if "log_time" in rows.columns:
        typed = typed.withColumn("log_date", F.substring("log_time", 1, 11))
    if "log_hour" in rows.columns:
        typed = typed.withColumn("log_hour", F.col("log_hour").try_cast("int"))
    if "bytes" in rows.columns:
        typed = typed.withColumn("bytes", clf.byte_count(F.col("bytes")))
    if "path" in rows.columns:
        typed = typed.filter(F.col("method").isin(*P.METHODS) & F.col("path").startswith("/"))
        typed = typed.withColumn("resource_path", clf.clean_path(F.col("path"), path_mode))
    return typed


def tag_byte_branches(parsed: DataFrame) -> DataFrame:
    """The size text's branch: ``dash``, ``empty``, ``valid`` or ``other``. One CASE over
    one scan stands for the union of one filtered copy per branch."""
    text = F.col("bytes_text")
    branch = (
        F.when(text == "-", "dash")
        .when(text == "", "empty")
        .when(text.try_cast("bigint") >= 0, "valid")
        .otherwise("other")
    )
    return parsed.withColumn("byte_branch", branch)
