"""Row and key counts across tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rows import row_fingerprint


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table; reads no columns."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(label).alias("table_name"), "row_count")
        for label, df in tables.items()
    ])


def layer_audit(
    tables: dict[str, tuple[DataFrame, Sequence[str] | None]], skip_nulls: bool = False, whole_rows: bool = False
) -> DataFrame:
    """``table_name, row_count, distinct_count``, by key or, with ``None``, by whole row.

    A row with nulls counts like any other; with ``skip_nulls`` it is left out of the
    distinct count, as SQL's ``count(distinct a, b)`` does.

    Rows are told apart by fingerprints of 128 bits, so 16 bytes of each are shuffled: two of 10**13
    different rows are taken for one with a chance of 2 in 10**13. ``whole_rows=True`` shuffles
    and compares the rows.
    """
    audits = []
    for label, (df, key) in tables.items():
        columns = [F.col(f"`{name}`") for name in (key or df.columns)]
        counts = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            _distinct_rows(columns, skip_nulls, key is not None or whole_rows).alias("distinct_count"),
        )
        audits.append(counts.select(F.lit(label).alias("table_name"), "row_count", "distinct_count"))
    return reduce(DataFrame.union, audits).distinct()


def _distinct_rows(columns: list[Column], skip_nulls: bool, whole: bool) -> Column:
    if whole:
        return F.count_distinct(*columns) if skip_nulls else F.count_distinct(F.struct(*columns))
    halves = row_fingerprint(columns)
    if skip_nulls:
        complete = reduce(Column.__and__, [c.isNotNull() for c in columns])
        halves = [F.when(complete, half) for half in halves]
    return F.count_distinct(*halves)
