"""Roll-ups of the gold table.

Each is one aggregation. A limited report never sorts the whole table: each task keeps its
best rows. Group columns end every ordering, so that ties come out the same each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUSTOMER = ("customer_id", "customer_name", "country")
MEASURES = {"total_profit": "total_profit", "total_sales": "total_sales", "order_count": "order_count"}


def _rollup(
    gold: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str | Column],
    limit: int | None = None,
    measures: dict[str, str] = MEASURES,
) -> DataFrame:
    totals = gold.groupBy(*by).agg(*[F.sum(c).alias(name) for name, c in measures.items()])
    named = [c for c in order_by if isinstance(c, str)]
    ranked = totals.orderBy(*order_by, *[c for c in by if c not in named])
    return ranked if limit is None else ranked.limit(limit)


def profit_by_year(gold: DataFrame) -> DataFrame:
    return _rollup(gold, ["year"], ["year"])


def profit_by_year_category(gold: DataFrame) -> DataFrame:
    return _rollup(gold, ["year", "category"], ["year", F.desc("total_profit")])


def profit_by_customer(gold: DataFrame, limit: int | None = 20) -> DataFrame:
    return _rollup(gold, CUSTOMER, [F.desc("total_profit")], limit)


def profit_by_customer_year(gold: DataFrame, limit: int | None = 20) -> DataFrame:
    return _rollup(gold, [*CUSTOMER, "year"], ["year", F.desc("total_profit")], limit)


def profit_by_year_subcategory(gold: DataFrame, limit: int | None = 15) -> DataFrame:
    by = ["year", "category", "sub_category"]
    measures = {name: MEASURES[name] for name in ("total_profit", "order_count")}
    return _rollup(gold, by, [F.desc("total_profit")], limit, measures)


def top_categories(gold: DataFrame, limit: int | None = 5) -> DataFrame:
    measures = {"category_profit": "total_profit", "total_orders": "order_count"}
    return _rollup(gold, ["category"], [F.desc("category_profit")], limit, measures)


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "profit_by_year": profit_by_year,
    "profit_by_year_category": profit_by_year_category,
    "profit_by_customer": profit_by_customer,
    "profit_by_customer_year": profit_by_customer_year,
    "profit_by_year_subcategory": profit_by_year_subcategory,
    "top_categories": top_categories,
}
