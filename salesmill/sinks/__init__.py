"""Layer tables: full loads and key-based merges."""

from .merge import (
    CUSTOMER_KEYS,
    ORDER_KEYS,
    ORDER_PARTITIONS,
    PRODUCT_KEYS,
    merge_silver_customers,
    merge_silver_orders,
    merge_silver_products,
    merge_table,
)
from .tables import drop_old_loads, save_bronze_table, save_gold_table, save_silver_table, save_table

__all__ = [
    "CUSTOMER_KEYS",
    "ORDER_KEYS",
    "ORDER_PARTITIONS",
    "PRODUCT_KEYS",
    "drop_old_loads",
    "merge_silver_customers",
    "merge_silver_orders",
    "merge_silver_products",
    "merge_table",
    "save_bronze_table",
    "save_gold_table",
    "save_silver_table",
    "save_table",
]
