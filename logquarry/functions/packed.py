"""Import and export of results as two-column packed text.

Daily traffic: ``date_status`` and ``count_bytes``. Resources: the path and
``count_bytes_distinct``. Hourly errors: ``date_hour`` and
``total_errors_rate_distinct``. Inside the library columns stay typed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions import patterns as P


def _join(*parts: Column) -> Column:
    return F.concat_ws(P.FIELD_SEPARATOR, *[p.cast("string") for p in parts])


def encode_daily(df: DataFrame) -> DataFrame:
    return df.select(
        _join(F.col("log_date"), F.col("status_code")).alias("packed_key"),
        _join(F.col("request_count"), F.col("total_bytes")).alias("packed_value"),
    )


def encode_resources(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("resource_path").alias("packed_key"),
        _join(F.col("request_count"), F.col("total_bytes"), F.col("distinct_hosts")).alias(
            "packed_value"
        ),
    )


def encode_hourly(df: DataFrame) -> DataFrame:
    rate = F.format_string("%.5f", F.col("error_rate"))
    return df.select(
        _join(F.col("log_date"), F.format_string("%02d", F.col("log_hour"))).alias("packed_key"),
        _join(
            F.col("total_requests"),
            F.col("error_request_count"),
            rate,
            F.col("distinct_error_hosts"),
        ).alias("packed_value"),
    )


def _flag_corrupt(df: DataFrame, fields: list[tuple[str, Column]]) -> DataFrame:
    """Typed columns, plus ``_corrupt``: the row's text when any field failed."""
    typed = df.select("*", *[value.alias(name) for name, value in fields])
    failed = F.col(fields[0][0]).isNull()
    for name, _ in fields[1:]:
        failed = failed | F.col(name).isNull()
    text = F.concat_ws("\t", "packed_key", "packed_value")
    return typed.select(
        *[c for c in df.columns if c not in ("packed_key", "packed_value")],
        *[F.when(~failed, F.col(name)).alias(name) for name, _ in fields],
        F.when(failed, text).alias("_corrupt"),
    )


def _part(column: str, index: int, of: int) -> Column:
    """Part ``index`` of exactly ``of`` parts, else NULL."""
    parts = F.split(F.col(column), P.FIELD_SEPARATOR, -1)
    return F.when(F.size(parts) == of, F.get(parts, F.lit(index)))


def _whole(text: Column) -> Column:
    """A whole number of up to 38 digits, else NULL."""
    return F.when(text.rlike(r"^[+-]?[0-9]{1,38}$"), text.try_cast("decimal(38,0)"))


def decode_daily(df: DataFrame) -> DataFrame:
    return _flag_corrupt(
        df,
        [
            ("log_date", F.nullif(_part("packed_key", 0, 2), F.lit(""))),
            ("status_code", _part("packed_key", 1, 2).try_cast("int")),
            ("request_count", _part("packed_value", 0, 2).try_cast("bigint")),
            ("total_bytes", _whole(_part("packed_value", 1, 2))),
        ],
    )


def decode_resources(df: DataFrame) -> DataFrame:
    return _flag_corrupt(
        df,
        [
            ("resource_path", F.nullif(F.col("packed_key"), F.lit(""))),
            ("request_count", _part("packed_value", 0, 3).try_cast("bigint")),
            ("total_bytes", _whole(_part("packed_value", 1, 3))),
            ("distinct_hosts", _part("packed_value", 2, 3).try_cast("bigint")),
        ],
    )


def decode_hourly(df: DataFrame) -> DataFrame:
    return _flag_corrupt(
        df,
        [
            ("log_date", F.nullif(_part("packed_key", 0, 2), F.lit(""))),
            ("log_hour", _part("packed_key", 1, 2).try_cast("int")),
            ("total_requests", _part("packed_value", 0, 4).try_cast("bigint")),
            ("error_request_count", _part("packed_value", 1, 4).try_cast("bigint")),
            ("error_rate", _part("packed_value", 2, 4).try_cast("double")),
            ("distinct_error_hosts", _part("packed_value", 3, 4).try_cast("bigint")),
        ],
    )


def encode_host_sets(df: DataFrame) -> DataFrame:
    """``path`` and ``count_bytes_host#host``, one row per bounded host set."""
    return df.select(
        "batch_id",
        F.col("resource_path").alias("packed_key"),
        _join(F.col("request_count"), F.col("total_bytes"), F.col("hosts")).alias("packed_value"),
    )


def decode_host_sets(df: DataFrame) -> DataFrame:
    """Host names may hold the field separator, so only the first two count."""

    def field(i: int) -> Column:
        return F.get(F.split(F.col("packed_value"), P.FIELD_SEPARATOR, 3), F.lit(i))

    return df.select(
        "batch_id",
        F.col("packed_key").alias("resource_path"),
        field(0).try_cast("bigint").alias("request_count"),
        _whole(field(1)).alias("total_bytes"),
        field(2).alias("hosts"),
    )
