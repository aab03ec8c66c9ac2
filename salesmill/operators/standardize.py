"""Bronze column names to silver ones. A column that is not there is passed over."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Source name -> silver name.
CUSTOMER_NAMES = {
    "Customer ID": "customer_id",
    "Customer Name": "customer_name",
    "Segment": "segment",
    "Country": "country",
    "City": "city",
    "State": "state",
    "Postal Code": "postal_code",
    "Region": "region",
}
PRODUCT_NAMES = {
    "Product ID": "product_id",
    "Product Name": "product_name",
    "Category": "category",
    "Sub-Category": "sub_category",
    "Price per product": "price_per_unit",
    "State": "product_state",
}
ORDER_NAMES = {
    "Order ID": "order_id",
    "Order Date": "order_date",
    "Ship Date": "ship_date",
    "Ship Mode": "ship_mode",
    "Customer ID": "customer_id",
    "Product ID": "product_id",
    "Quantity": "quantity",
    "Price": "price",
    "Discount": "discount",
    "Profit": "source_profit",
}


def standardize_customer_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(CUSTOMER_NAMES)


def standardize_product_columns(df: DataFrame, state_name: str = "product_state") -> DataFrame:
    """``state_name`` is what the product's own state is called; it never joins."""
    return df.withColumnsRenamed({**PRODUCT_NAMES, "State": state_name})


def standardize_order_columns(df: DataFrame, keep_row_id: bool = False) -> DataFrame:
    """``Row ID`` is left alone unless ``keep_row_id`` brings it along as ``row_id``."""
    extra = {"Row ID": "row_id"} if keep_row_id else {}
    return df.withColumnsRenamed({**ORDER_NAMES, **extra})
