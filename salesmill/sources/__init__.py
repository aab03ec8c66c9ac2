"""Source files and layer tables."""

from .files import load_customer_data, load_order_data, load_product_data, parse_order_dates, rejects_report
from .tables import load_bronze_table, load_gold_table, load_silver_table, register_view

__all__ = [
    "load_bronze_table",
    "load_customer_data",
    "load_gold_table",
    "load_order_data",
    "load_product_data",
    "load_silver_table",
    "parse_order_dates",
    "register_view",
    "rejects_report",
]
