"""Raw logs as views that any SQL user of the catalog can select from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from logquarry.functions import patterns as P
from logquarry.sources.logs import Batch


def _literal(text: str) -> str:
    """A raw SQL string; the patterns hold no single quote."""
    if "'" in text:
        raise ValueError("a quote in a pattern")
    return f"r'{text}'"


def log_view_sql(name: str, batches: Sequence[Batch], shape: str) -> str:
    """The statement that makes the view.

    Each line is matched once: it is rewritten to its groups and split again, behind a generator, so that a
    filter of the view's user does not match it a second time.
    """
    pattern, columns = P.READ_SHAPES[shape]
    lines = " UNION ALL ".join(
        f"SELECT {i} AS batch_id, value FROM text.`{b.path.replace('`', '``')}`" for i, b in enumerate(batches, start=1)
    )
    groups = ", ".join(f"'${i}'" for i in range(1, len(columns) + 1))
    split = f"split(regexp_replace(value, {_literal(pattern)}, concat_ws(char(10), {groups})), char(10), -1)"
    fields = ", ".join(f"if(size(found) = {len(columns)}, found[{i}], NULL) AS {c}" for i, c in enumerate(columns))
    return (
        f"CREATE OR REPLACE VIEW {name} AS SELECT batch_id, {fields} "
        f"FROM ({lines}) LATERAL VIEW explode(array({split})) matched AS found"
    )


def create_log_view(
    spark: SparkSession, database: str, view: str, batches: Sequence[Batch], shape: str = "strict_resources"
) -> None:
    """Register ``database.view`` over the batches' logs: ``batch_id`` and the all-string columns of ``shape``.

    A line that does not match is a row of NULLs, as with :func:`parse.read_with_pattern`. Files added to a
    batch's folder are seen by the next query. Batches must not lie within one another.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(log_view_sql(f"`{database}`.`{view}`", batches, shape))
