"""Bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cents, days_between, email_domain, email_validity
from ..functions.money import LINE_AMOUNT
from ..operators.joins import (
    CUSTOMER_ATTRIBUTES,
    PRODUCT_ATTRIBUTES,
    join_with_customer,
    join_with_product,
)
from ..operators.rows import distinct_rows
from ..operators.standardize import (
    standardize_customer_columns,
    standardize_order_columns,
    standardize_product_columns,
)
from ..schemas import ORDER_ENRICHED, column_names
from ..session import stage


def add_email_enrichment(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"email_domain": email_domain("email"), "is_valid_email": email_validity("email")}
    )


def add_date_fields(df: DataFrame) -> DataFrame:
    """Year, month and quarter of the order date."""
    ordered = F.col("order_date")
    return df.withColumns({
        "order_year": F.year(ordered),
        "order_month": F.month(ordered),
        "order_quarter": F.quarter(ordered),
    })


def calculate_days_to_ship(df: DataFrame) -> DataFrame:
    """Days from order to shipping; null while there is no ship date."""
    return df.withColumn("days_to_ship", days_between("order_date", "ship_date"))


def round_profit_to_2_decimals(df: DataFrame) -> DataFrame:
    return df.withColumn("profit", cents(F.col("source_profit")))


def enrich_customer(df: DataFrame, dedup: bool = False) -> DataFrame:
    enriched = add_email_enrichment(standardize_customer_columns(df))
    return enriched.dropDuplicates() if dedup else enriched


def enrich_product(
    df: DataFrame, dedup: bool = False, state_name: str = "product_state"
) -> DataFrame:
    enriched = standardize_product_columns(df, state_name)
    return enriched.dropDuplicates() if dedup else enriched


def enrich_order(
    orders_df: DataFrame,
    customers_df: DataFrame,
    products_df: DataFrame,
    how: str = "left",
    dedup: bool = False,
    keep_row_id: bool = False,
    product_name: bool = True,
) -> DataFrame:
    """Bronze order lines with their customer, product, calendar and profit columns.

    By default every line is kept, with nulls where a customer or product is unknown.
    ``how="inner"`` drops those lines instead. ``dedup`` makes the result distinct: lines, customers and products
    are each cut to what the result has of them and made distinct, and a line with its customer and product is then
    too. It writes the lines to the scratch folder, so it runs jobs. ``keep_row_id`` and
    ``product_name`` choose those columns.
    """
    columns = [c for c in column_names(ORDER_ENRICHED) if product_name or c != "product_name"]
    kept = [*(["row_id"] if keep_row_id else []), *columns]
    product_attributes = [a for a in PRODUCT_ATTRIBUTES if a in columns]
    lines = standardize_order_columns(orders_df, keep_row_id)
    if dedup:
        # Lines are equal if their cents are. A profit that has none is kept, to raise if its line is still there after the joins.
        fits = F.col("source_profit").try_cast(LINE_AMOUNT)
        lines = lines.withColumns({"profit": fits, "source_profit": F.when(fits.isNull(), F.col("source_profit"))})
        lines = lines.select(*[c for c in lines.columns if c in (*kept, "source_profit")])
        lines = distinct_rows(stage(lines, "order-lines"))
    lines = join_with_customer(lines, customers_df, how, tuple(CUSTOMER_ATTRIBUTES), dedup)
    lines = join_with_product(lines, products_df, how, tuple(product_attributes), dedup)
    lines = calculate_days_to_ship(add_date_fields(lines))
    if dedup:
        lines = lines.withColumn("profit", F.coalesce("profit", cents(F.col("source_profit"))))
    else:
        lines = round_profit_to_2_decimals(lines)
    return lines.select(*kept)
