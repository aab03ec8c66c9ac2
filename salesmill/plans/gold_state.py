"""The profit aggregate kept current: changed order lines change their groups, no others are read.

The stored state has the exact, unrounded sums of each group and how many lines they are of, by year
and bucket of groups. The rows that a merge removes and adds become signed sums per group; only
partitions of the state that hold such a group are rewritten, and a group without lines is gone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.money import TOTAL_AMOUNT
from ..operators.rows import in_partitions
from ..session import LAYERS, Layers, owned_scratch, stage
from ..sinks.merge import (
    ORDER_KEYS,
    finish_replacing,
    merge_silver_orders,
    note,
    noted,
    replace_partitions,
    strike,
)
from ..sinks.tables import save_table
from .gold import PROFIT_DIMENSIONS

STATE_TABLE = "profit_state"
STATE_PARTITIONS = ("year", "group_bucket")
# Noted in the state while order lines are merged that it does not count yet.
BEHIND = "salesmill.behind"
GROUP_BUCKETS = 16

# What adds up: sums, and the lines behind each of them, so that a sum of no amounts stays null.
MEASURES = ("profit_sum", "profit_lines", "sales_sum", "sales_lines", "order_count", "line_count")


def profit_state(lines: DataFrame, buckets: int = GROUP_BUCKETS) -> DataFrame:
    """Exact sums and counts of enriched order lines by the groups of the profit aggregate."""
    profit, sales = exact(lines, "profit"), exact(lines, "price")
    group = [c for c in PROFIT_DIMENSIONS if c != "year"]
    return (
        lines.withColumnRenamed("order_year", "year")
        .groupBy(*PROFIT_DIMENSIONS)
        .agg(
            _total(profit).alias("profit_sum"), F.count(profit).alias("profit_lines"),
            _total(sales).alias("sales_sum"), F.count(sales).alias("sales_lines"),
            F.count("order_id").alias("order_count"), F.count(F.lit(1)).alias("line_count"),
        )
        .withColumn("group_bucket", F.pmod(F.xxhash64(*group), F.lit(buckets)).cast("int"))
    )


def _total(amount: Column) -> Column:
    return F.coalesce(F.sum(amount.cast("decimal(26,6)")), F.lit(0)).cast("decimal(38,6)")


def profit_delta(removed: DataFrame, added: DataFrame, buckets: int = GROUP_BUCKETS) -> DataFrame:
    """What the groups change by when order lines are removed and added; unchanged groups are left out."""
    less = profit_state(removed, buckets).withColumns({m: -F.col(m) for m in MEASURES})
    change = _add_up(less.unionByName(profit_state(added, buckets)))
    return change.where(" OR ".join(f"{m} <> 0" for m in MEASURES))


def apply_profit_delta(state: DataFrame, delta: DataFrame) -> DataFrame:
    """The state after the change; groups that no line is left of are gone."""
    return _add_up(state.unionByName(delta)).where("line_count > 0")


def _add_up(states: DataFrame) -> DataFrame:
    kinds = dict(states.dtypes)
    return states.groupBy(*PROFIT_DIMENSIONS, "group_bucket").agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in MEASURES])


def profit_from_state(state: DataFrame) -> DataFrame:
    """The profit aggregate; a projection, as the state is grouped already."""
    def amount(name: str) -> Column:
        return F.when(F.col(f"{name}_lines") > 0, F.round(f"{name}_sum", 2).cast(TOTAL_AMOUNT)).alias(f"total_{name}")

    return state.select(*PROFIT_DIMENSIONS, amount("profit"), amount("sales"), "order_count")


def merge_orders_and_gold(
    spark: SparkSession,
    df: DataFrame,
    layers: Layers = LAYERS,
    keys: Sequence[str] = ORDER_KEYS,
    table_name: str = "orders_enriched",
    **options,
) -> None:
    """Merge order lines into silver and bring the gold state up to date with them.

    The first merge builds the state. If one stops between the two tables, the state is noted to be
    behind and the next merge builds it anew. ``load_profit_aggregate`` reads it.
    """
    table = f"{layers.gold}.{STATE_TABLE}"
    exists = spark.catalog.tableExists(table)
    if exists:
        finish_replacing(spark, table)
    by_delta = exists and BEHIND not in noted(spark, table)
    with owned_scratch(spark, "merge-orders"):
        deltas: list[DataFrame] = []
        if exists:
            note(spark, table, {BEHIND: "true"})
        merge_silver_orders(
            spark, df, table_name, keys, layers,
            on_change=lambda removed, added: deltas.append(stage(profit_delta(removed, added), "profit-delta")),
            **options,
        )
        if by_delta and deltas:
            _rewrite_groups(spark, table, deltas[0])
        else:
            lines = spark.table(f"{layers.silver}.{table_name}")
            save_table(spark, profit_state(lines), table, STATE_PARTITIONS)
    strike(spark, table, BEHIND)


def _rewrite_groups(spark: SparkSession, table: str, delta: DataFrame) -> None:
    state = spark.table(table)
    hit = delta.select(*STATE_PARTITIONS).distinct().collect()   # as many as the state has partitions, at most
    if hit:
        held = state.where(in_partitions(hit, STATE_PARTITIONS))
        replace_partitions(spark, table, apply_profit_delta(held, delta).select(*state.columns), hit, STATE_PARTITIONS)


def load_profit_aggregate(spark: SparkSession, layers: Layers = LAYERS) -> DataFrame:
    """The profit aggregate from its stored state."""
    return profit_from_state(spark.table(f"{layers.gold}.{STATE_TABLE}"))

