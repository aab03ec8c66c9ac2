"""Declared layouts of the bronze, silver and gold tables.

Column names, order, types and required flags are fixed values: files and tables
written elsewhere must line up with them. A trailing ``!`` marks a required column.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def layout(columns: dict[str, str]) -> StructType:
    """Build a ``StructType`` from ``{name: type}``; ``type!`` means not nullable."""
    struct = StructType()
    for name, kind in columns.items():
        struct.add(name, kind.rstrip("!"), nullable=not kind.endswith("!"))
    return struct


def column_names(schema: StructType) -> list[str]:
    return [field.name for field in schema.fields]


def required_columns(schema: StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]


CUSTOMER_BRONZE = layout({
    "Customer ID": "string!",
    "Customer Name": "string!",
    "email": "string",
    "phone": "string",
    "address": "string",
    "Segment": "string!",
    "Country": "string!",
    "City": "string",
    "State": "string",
    "Postal Code": "string",
    "Region": "string",
})

PRODUCT_BRONZE = layout({
    "Product ID": "string!",
    "Category": "string!",
    "Sub-Category": "string!",
    "Product Name": "string!",
    "State": "string",
    "Price per product": "double!",
})

# As it stands in the source file: both dates are still text.
ORDER_BRONZE = layout({
    "Row ID": "integer!",
    "Order ID": "string!",
    "Order Date": "string!",
    "Ship Date": "string",
    "Ship Mode": "string",
    "Customer ID": "string!",
    "Product ID": "string!",
    "Quantity": "integer!",
    "Price": "double!",
    "Discount": "double",
    "Profit": "double",
})

CUSTOMER_ENRICHED = layout({
    "customer_id": "string!",
    "customer_name": "string!",
    "email": "string",
    "phone": "string",
    "address": "string",
    "segment": "string!",
    "country": "string!",
    "city": "string",
    "state": "string",
    "postal_code": "string",
    "region": "string",
    "email_domain": "string",
    "is_valid_email": "string",
})

PRODUCT_ENRICHED = layout({
    "product_id": "string!",
    "product_name": "string!",
    "category": "string!",
    "sub_category": "string!",
    "price_per_unit": "double!",
    "product_state": "string",
})

ORDER_ENRICHED = layout({
    "order_id": "string!",
    "order_date": "date!",
    "ship_date": "date",
    "ship_mode": "string",
    "order_year": "integer!",
    "order_month": "integer!",
    "order_quarter": "integer!",
    "customer_id": "string!",
    "customer_name": "string!",
    "country": "string!",
    "segment": "string",
    "region": "string",
    "product_id": "string!",
    "product_name": "string!",
    "category": "string!",
    "sub_category": "string!",
    "quantity": "integer!",
    "discount": "double",
    "price": "double!",
    "price_per_unit": "double!",
    "profit": "decimal(10,2)!",
    "days_to_ship": "integer",
})

# ``order_count`` is a bigint because that is what a count yields.
PROFIT_AGGREGATE = layout({
    "year": "integer!",
    "category": "string!",
    "sub_category": "string!",
    "customer_id": "string!",
    "customer_name": "string!",
    "country": "string!",
    "total_profit": "decimal(15,2)!",
    "total_sales": "decimal(15,2)!",
    "order_count": "long!",
})
