"""What several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder, stage

__all__ = ["read_table", "scratch_folder", "slices", "stage", "texts_of"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(column: pa.Array) -> list[str]:
    """A text column as strings; a null text counts as empty."""
    return [text or "" for text in column.to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` has about ``most_bytes`` in each: a task then works on
    a bounded piece at a time, however long the texts are (a single row stays whole)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.utf8_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for row, length in enumerate(lengths):
            if held and held + length > most_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        yield batch.slice(start)
