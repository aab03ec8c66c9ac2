"""The profit aggregate and statistics about it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact, exact_sum

# What the gold table's statistics count.
DISTINCT = {"year": "distinct_years", "category": "distinct_categories", "customer_id": "distinct_customers"}
SKETCHED = ("category", "customer_id")
LG_SKETCH = 12

# What the profit aggregate is grouped by.
PROFIT_DIMENSIONS = ("year", "category", "sub_category", "customer_id", "customer_name", "country")


def create_profit_aggregate(
    df: DataFrame, sales: str = "line_total", ordered: bool = False
) -> DataFrame:
    """Profit, sales and line count by year, category, sub-category and customer.

    A line's price is its total, so sales is its sum; ``sales="price_x_qty"`` multiplies
    by the quantity instead. Sums are exact and combined within each task first. The
    result is left unordered unless asked: a table keeps no order, and the sort would be
    a second shuffle.
    """
    amounts = {
        "line_total": lambda: exact(df, "price"),
        "price_x_qty": lambda: exact(df, "price") * F.col("quantity"),
    }
    if sales not in amounts:
        raise ValueError(f"unknown sales: {sales}")
    totals = (
        df.withColumnRenamed("order_year", "year")
        .groupBy(*PROFIT_DIMENSIONS)
        .agg(
            exact_sum(exact(df, "profit")).alias("total_profit"),
            exact_sum(amounts[sales]()).alias("total_sales"),
            F.count("order_id").alias("order_count"),
        )
    )
    return rank_gold(totals) if ordered else totals


def rank_gold(df: DataFrame) -> DataFrame:
    """Year, category, sub-category, then highest profit; the customer breaks ties."""
    return df.orderBy(
        "year", "category", "sub_category", F.desc("total_profit"),
        "customer_id", "customer_name", "country",
    )


def profit_statistics(df: DataFrame) -> DataFrame:
    """Number of lines, and total, lowest and highest profit."""
    return df.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.round(F.sum("profit"), 2).alias("total_profit"),
        F.round(F.min("profit"), 2).alias("min_profit"),
        F.round(F.max("profit"), 2).alias("max_profit"),
    )


def aggregate_statistics(df: DataFrame, approximate: float | None = None) -> DataFrame:
    """Size of the gold table and its distinct counts: exact, or with a relative standard deviation
    of ``approximate``, which needs no shuffle of the values."""
    def distinct(name: str) -> Column:
        counted = F.count_distinct(name) if approximate is None else F.approx_count_distinct(name, approximate)
        return counted.alias(DISTINCT[name])

    return df.agg(F.count(F.lit(1)).alias("total_records"), *map(distinct, DISTINCT))


def sketch_gold(df: DataFrame) -> DataFrame:
    """A row for each year: its records, and HyperLogLog sketches of its categories and customers.

    Sketches of the same size can be added up, so counts over any years need these rows only.
    """
    return df.groupBy("year").agg(
        F.count(F.lit(1)).alias("records"),
        *[F.hll_sketch_agg(name, LG_SKETCH).alias(f"{name}_sketch") for name in SKETCHED],
    )


def refresh_sketches(sketches: DataFrame, df: DataFrame, years: Sequence[int | None]) -> DataFrame:
    """``sketches`` with those of ``years`` taken anew from the gold table, of which no other year is read."""
    of_years = F.col("year").isin([y for y in years if y is not None])
    if None in years:
        of_years = F.coalesce(of_years, F.lit(False)) | F.col("year").isNull()
    kept = sketches.where(~F.coalesce(of_years, F.lit(False)))
    return kept.unionByName(sketch_gold(df.where(of_years)))


def sketched_statistics(sketches: DataFrame) -> DataFrame:
    """``aggregate_statistics`` from sketches: records and years are exact, the others within 1.6 %
    (one standard deviation)."""
    return sketches.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.count("year").alias(DISTINCT["year"]),
        *[
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch")), F.lit(0)).alias(DISTINCT[name])
            for name in SKETCHED
        ],
    )
