"""Stored quality states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from ..operators.quality_state import Checked, quality_state
from ..operators.rows import in_partitions
from ..session import owned_scratch
from ..sinks.merge import finish_replacing, replace_partitions
from ..sinks.tables import save_table


def refresh_quality_state(
    spark: SparkSession,
    state_table: str,
    df: DataFrame,
    checked: Checked,
    partition_by: Sequence[str],
    changed: Sequence[Row] | None = None,
) -> DataFrame:
    """The stored state of ``df``, after its ``changed`` partitions (of all, if not named) were read.

    ``df`` is the table as it is now, stored by ``partition_by``; a changed partition may have come or gone.
    """
    if changed is None or not spark.catalog.tableExists(state_table):
        save_table(spark, quality_state(df, checked, partition_by), state_table, partition_by)
    else:
        finish_replacing(spark, state_table)
        if changed:
            with owned_scratch(spark, "quality-state"):
                again = quality_state(df.where(in_partitions(changed, partition_by)), checked, partition_by)
                replace_partitions(spark, state_table, again, changed, partition_by)
    return spark.table(state_table)
