"""Quality checks kept current: what they count, by partition of the table, so that after a
load or merge only the partitions that changed are read again.

A state has rows ``measure, value, n`` beside the partition columns: how many rows and nulls a partition has,
each key it holds as a fingerprint of 128 bits, each reference as it is. Partitions add up: the
suite needs the states and the parents' keys in them, and no table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CUSTOMER_BRONZE, ORDER_BRONZE, PRODUCT_BRONZE, required_columns
from .quality import GOLD_REQUIRED, suite_of_counts
from .rows import row_fingerprint

ROWS, NULLS, KEY = "rows", "nulls", "key"


@dataclass(frozen=True)
class Checked:
    """What is checked of a table: columns that must not be null, the column that must be unique, and
    those that refer to other tables (or are referred to)."""

    required: tuple[str, ...] = ()
    key: str | None = None
    references: tuple[str, ...] = ()


# What the suite checks of the tables that it reads rows of.
CHECKED = {
    "customers": Checked(tuple(required_columns(CUSTOMER_BRONZE)), "Customer ID", ("Customer ID",)),
    "products": Checked(tuple(required_columns(PRODUCT_BRONZE)), "Product ID", ("Product ID",)),
    "orders": Checked(references=("Customer ID", "Product ID")),
    "profit_aggregate": Checked(tuple(GOLD_REQUIRED)),
}


def quality_state(df: DataFrame, checked: Checked, partition_by: Sequence[str]) -> DataFrame:
    """The state of every partition of ``df``: one pass, added up within tasks before it is shuffled."""
    one, no_value = F.lit(1).cast("bigint"), F.lit(None).cast("string")

    def counted(measure: str, value: Column, n: Column) -> Column:
        return F.struct(F.lit(measure).alias("measure"), value.alias("value"), n.alias("n"))

    nulls = sum((F.col(f"`{c}`").isNull().cast("bigint") for c in checked.required), F.lit(0).cast("bigint"))
    rows = [counted(ROWS, no_value, one), counted(NULLS, no_value, nulls)]
    if checked.key:
        halves = [F.lpad(F.hex(h), 16, "0") for h in row_fingerprint([F.col(f"`{checked.key}`")])]
        rows.append(counted(KEY, F.concat(*halves), one))
    rows += [counted(c, F.col(f"`{c}`").cast("string"), one) for c in checked.references]
    places = [F.col(f"`{c}`") for c in partition_by]
    stacked = df.select(*places, F.inline(F.array(*rows)))
    return stacked.groupBy(*places, "measure", "value").agg(F.sum("n").alias("n"))


def _of(state: DataFrame, measure: str) -> DataFrame:
    return state.where(F.col("measure") == measure)


def _count(state: DataFrame, measure: str, name: str) -> DataFrame:
    return _of(state, measure).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def _duplicates(state: DataFrame) -> DataFrame:
    keys = _of(state, KEY)
    return keys.agg((F.coalesce(F.sum("n"), F.lit(0)) - F.count_distinct("value")).alias("duplicates"))


def _orphans(child: DataFrame, parent: DataFrame, reference: str, name: str) -> DataFrame:
    """How many distinct references of the child no row of the parent has."""
    held = _of(parent, reference).select("value").where("value IS NOT NULL").distinct()
    asked = _of(child, reference).select("value").where("value IS NOT NULL").distinct()
    return asked.join(held, "value", "left_anti").agg(F.count(F.lit(1)).alias(name))


def quality_suite_of_states(
    spark: SparkSession, states: dict[str, DataFrame], tables: dict[str, DataFrame]
) -> DataFrame:
    """``quality_suite`` from the states of ``CHECKED`` tables; of ``tables`` (all that the suite checks)
    the column names alone are looked at."""
    def beside(*parts: DataFrame) -> DataFrame:
        """Counts of one row each, in one row."""
        names = [c for part in parts for c in part.columns]
        stacked = [part.select(*[F.col(c) if c in part.columns else F.lit(None).cast("bigint").alias(c) for c in names]) for part in parts]
        whole = stacked[0]
        for part in stacked[1:]:
            whole = whole.unionByName(part)
        return whole.agg(*[F.max(c).alias(c) for c in names])

    dimensions = {
        name: beside(_count(states[name], NULLS, "nulls"), _duplicates(states[name])) for name in ("customers", "products")
    }
    orphans = beside(*[
        _orphans(states["orders"], states[parent], key, parent)
        for parent, key in (("customers", "Customer ID"), ("products", "Product ID"))
    ])
    gold = _count(states["profit_aggregate"], NULLS, "nulls")
    return suite_of_counts(spark, tables, dimensions["customers"], dimensions["products"], orphans, gold)
