"""Column expressions for Common Log Format fields. All are built-ins, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions import patterns as P


def trim_edges(line: Column) -> Column:
    """Strip every character up to U+0020 from both ends (not only spaces).

    Bytes that are no UTF-8 become U+FFFD first; a stray one would hide the
    space after it.
    """
    return F.btrim(F.make_valid_utf8(line), F.lit(P.EDGE_CHARACTERS))


def match_groups(text: Column, pattern: str, groups: int) -> Column:
    """All groups of ``pattern`` as an array of ``groups`` strings.

    The regex runs once per row: it rewrites a matching line to its groups, one
    per line feed, and the split gives them back. A text that does not match
    comes back whole, as an array of one. A text that itself holds a line feed
    takes the plain route, one extraction per group, and gives NULL on a miss.
    A group that took no part in the match is ''.
    """
    rewritten = F.regexp_replace(text, pattern, "\n".join(f"${i}" for i in range(1, groups + 1)))
    plain = F.when(
        F.rlike(text, F.lit(pattern)),
        F.array(*[F.regexp_extract(text, pattern, i) for i in range(1, groups + 1)]),
    )
    return F.when(~F.contains(text, F.lit("\n")), F.split(rewritten, "\n", -1)).otherwise(plain)


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that later filters cannot duplicate.

    Catalyst pushes a filter below the projection that defines its column and so
    runs a costly expression twice, once to filter and once to project. It does
    not push one below a generator, hence the one-element explode.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def log_date(log_time: Column) -> Column:
    return F.substring_index(log_time, ":", 1)


def log_hour(log_time: Column) -> Column:
    """Hour as int; NULL when the time has no such part or it is not a number."""
    second = F.substring_index(F.substring_index(log_time, ":", 2), ":", -1)
    return F.when(F.contains(log_time, F.lit(":")), second).try_cast("int")


def byte_count(text: Column) -> Column:
    """'-', non-numeric, overflowing and negative sizes count as 0.

    '-' is common and goes first: a cast that fails costs far more than a comparison.
    """
    zero = F.lit(0).cast("bigint")
    number = F.greatest(F.coalesce(text.try_cast("bigint"), zero), zero)
    return F.when(text == "-", zero).otherwise(number)


def total_bytes(size: Column) -> Column:
    """Sum of sizes of up to 64 bits each, in 38 digits: no number of lines overflows it."""
    return F.sum(size.cast("decimal(28,0)"))


def is_error(status_code: Column, mode: str = "4xx5xx") -> Column:
    """``4xx5xx``: 400 to 599. ``ge400``: 400 and up, also 600 to 999."""
    if mode == "4xx5xx":
        return status_code.between(P.ERROR_LOW, P.ERROR_HIGH)
    if mode == "ge400":
        return status_code >= P.ERROR_LOW
    raise ValueError(f"unknown error mode: {mode}")


def raw_error_rate(errors: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(errors.cast("double"), total), F.lit(0.0))


def error_rate(errors: Column, total: Column) -> Column:
    return F.round(raw_error_rate(errors, total), 5)


def strip_unprintable(path: Column) -> Column:
    return F.trim(F.regexp_replace(path, P.NON_PRINTABLE, ""))


def decode_path(path: Column) -> Column:
    """URL-decode; a path with a broken escape stays as it is."""
    encoded = F.contains(path, F.lit("%")) | F.contains(path, F.lit("+"))
    return F.when(encoded, F.coalesce(F.try_url_decode(path), path)).otherwise(path)


def clean_path(path: Column, mode: str = "decoded") -> Column:
    """Path as it is grouped by; the caller keeps those that start with '/'.

    ``decoded``: URL-decoded, printable ASCII only, trimmed. ``printable``: not
    decoded, and the leading slash is required before cleaning. ``raw``: as is.
    """
    if mode == "decoded":
        return strip_unprintable(decode_path(path))
    if mode == "printable":
        return F.when(path.startswith("/"), strip_unprintable(path))
    if mode == "raw":
        return path
    raise ValueError(f"unknown path mode: {mode}")


def shorten_path(path: Column) -> Column:
    """Report form: paths over 48 characters keep 45 and an ellipsis."""
    return F.when(
        F.char_length(path) > P.REPORT_PATH_WIDTH,
        F.concat(F.substring(path, 1, P.REPORT_PATH_KEPT), F.lit("...")),
    ).otherwise(path)
