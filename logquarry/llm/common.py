"""What the operators share: written stages, texts, byte batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.plans.workspace import shared_folder

# Texts are handed to numpy in groups of about this many bytes.
GROUP_BYTES = 4 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    Its lineage ends there, so a lost executor costs no more than the running stage.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def groups_of(
    ids: list, texts: list[bytes], limit: int = GROUP_BYTES
) -> Iterator[tuple[list, list[bytes]]]:
    """Cut parallel lists into groups of about ``limit`` bytes of text, one text at least."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield ids[at:i], texts[at:i]
            at, held = i, 0
        held += len(text)
    if at < len(texts):
        yield ids[at:], texts[at:]


def batch_lists(batch: pa.RecordBatch) -> tuple[list, list[bytes]]:
    """Ids and texts as bytes (null: empty) of a two-column batch."""
    return batch.column(0).to_pylist(), [t or b"" for t in batch.column(1).to_pylist()]
