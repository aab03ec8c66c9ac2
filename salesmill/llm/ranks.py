"""Places of rows within their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

# ``monotonically_increasing_id`` has the partition above these bits.
PARTITION_SHIFT = 33


def ranked(df: DataFrame, key: str, order: Sequence[str | Column], purpose: str) -> DataFrame:
    """``df`` with ``pos`` (0 for the first of its ``key`` by ``order``) and ``n`` (rows of that key).

    Rows are dealt out by ranges of key and order and sorted in each range, so one key may
    fill many ranges; rows that are equal in both may lie either way. What comes before a
    range is a sum over one row per key and range. ``key`` must not be null; names of ``df`` must not begin with ``__``. No rows: no rows.
    """
    by = [F.col(key), *order]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = stage(dealt.withColumn("__place", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("__place", PARTITION_SHIFT).alias("__part")
    parts = dealt.groupBy(F.col(key).alias("__of"), part).agg(F.min("__place").alias("__first"), F.count("*").alias("__rows"))
    one_key = Window.partitionBy("__of")
    before = F.sum("__rows").over(one_key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "__of", "__part",
        (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(one_key).alias("n"),
    )
    same = (F.col(key) == F.col("__of")) & (F.shiftright("__place", PARTITION_SHIFT) == F.col("__part"))
    return dealt.join(parts, same).select(*df.columns, (F.col("__place") + F.col("__shift")).alias("pos"), "n")
