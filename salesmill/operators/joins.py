"""Order lines to their dimensions.

No join carries a broadcast hint. Spark broadcasts a dimension when its measured size is
under ``autoBroadcastJoinThreshold`` and sorts and merges otherwise; there the fact side
of an inner, left or anti join is what adaptive execution may split, so a customer or
product holding a third of all lines is spread over many tasks. The dimension goes into
the join straight from its shuffle, because that rule only sees a join whose inputs are
bare shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns that order lines take from their dimensions.
CUSTOMER_ATTRIBUTES = ("customer_name", "country", "segment", "region")
PRODUCT_ATTRIBUTES = ("product_name", "category", "sub_category", "price_per_unit")


def join_with_customer(
    orders_df: DataFrame,
    customers_df: DataFrame,
    how: str = "left",
    attributes: tuple[str, ...] = CUSTOMER_ATTRIBUTES,
    dedup: bool = False,
) -> DataFrame:
    """Add customer attributes. ``how="inner"`` drops lines of unknown customers."""
    return _attach(orders_df, customers_df, "customer_id", attributes, how, dedup)


def join_with_product(
    orders_df: DataFrame,
    products_df: DataFrame,
    how: str = "left",
    attributes: tuple[str, ...] = PRODUCT_ATTRIBUTES,
    dedup: bool = False,
) -> DataFrame:
    """Add product attributes, on the product id alone.

    A product listed more than once yields a line per listing. ``dedup`` first drops
    listings that agree in every attribute; those that differ, in price say, remain.
    """
    return _attach(orders_df, products_df, "product_id", attributes, how, dedup)


def _attach(facts, dimension, key, attributes, how, dedup) -> DataFrame:
    rows = dimension.select(key, *attributes)
    return facts.join(rows.dropDuplicates() if dedup else rows, key, how)


def orphan_keys(
    child_df: DataFrame, parent_df: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Distinct non-null child keys the parent does not have.

    Both sides are reduced to distinct keys within each task before they are shuffled, so
    a key repeated a billion times crosses the network once per task.
    """
    child = child_df.select(F.col(f"`{child_key}`").alias(child_key)).dropna().distinct()
    parent = parent_df.select(F.col(f"`{parent_key}`").alias(child_key)).dropna().distinct()
    return child.join(parent, child_key, "left_anti")
