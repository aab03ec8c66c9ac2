"""The layered jobs: files to bronze, bronze to silver, silver to gold, reports, checks.

Nothing is counted on the way and nothing is cached: each job reads the tables of the layer
below and runs once per table it writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import check_referential_integrity, quality_suite, validate_schema
from ..schemas import (
    CUSTOMER_BRONZE,
    CUSTOMER_ENRICHED,
    ORDER_BRONZE,
    ORDER_ENRICHED,
    PRODUCT_BRONZE,
    PRODUCT_ENRICHED,
    PROFIT_AGGREGATE,
    column_names,
)
from ..session import LAYERS, Layers, owned_scratch
from ..sinks import (
    merge_silver_customers,
    merge_silver_orders,
    merge_silver_products,
    save_bronze_table,
    save_gold_table,
)
from ..sources import (
    load_bronze_table,
    load_gold_table,
    load_silver_table,
    parse_order_dates,
    register_view,
)
from .enrich import enrich_customer, enrich_order, enrich_product
from .gold import create_profit_aggregate
from .rollups import REPORTS


def ingest_bronze(
    spark: SparkSession,
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    layers: Layers = LAYERS,
) -> None:
    """Replace the bronze tables by freshly loaded ones."""
    for name, df, schema in (
        ("customers", customers, CUSTOMER_BRONZE),
        ("products", products, PRODUCT_BRONZE),
        ("orders", orders, ORDER_BRONZE),
    ):
        validate_schema(df, column_names(schema), f"{layers.bronze}.{name}")
        save_bronze_table(spark, df, name, layers=layers)


def build_silver(
    spark: SparkSession,
    layers: Layers = LAYERS,
    check_references: bool = True,
    merge_options: dict | None = None,
    enrich_options: dict | None = None,
    parse_dates: bool = False,
) -> None:
    """Enrich the bronze tables and merge them into silver.

    References are checked on the bronze keys, before anything is joined or written; an
    order line of an unknown customer or product stops the job. ``enrich_options`` and
    ``merge_options`` go to the enrichment and the merge of ``customers``, ``products`` and
    ``orders``; ``parse_dates`` is for bronze orders whose dates are still text.

    ``HOSTED_FORM`` is the set of options for inner joins, distinct rows at each step, and
    row id and state among the keys.
    """
    with owned_scratch(spark, "silver"):
        customers_bronze = load_bronze_table(spark, "customers", layers)
        products_bronze = load_bronze_table(spark, "products", layers)
        orders_bronze = load_bronze_table(spark, "orders", layers)
        if parse_dates:
            orders_bronze = parse_order_dates(orders_bronze)

        enrich = enrich_options or {}
        customers = enrich_customer(customers_bronze, **enrich.get("customers", {}))
        products = enrich_product(products_bronze, **enrich.get("products", {}))
        order_options = enrich.get("orders", {})
        orders = enrich_order(orders_bronze, customers, products, **order_options)
        state = enrich.get("products", {}).get("state_name", "product_state")
        left_out = set() if order_options.get("product_name", True) else {"product_name"}
        for name, df, expected in (
            ("customers_enriched", customers, column_names(CUSTOMER_ENRICHED)),
            ("products_enriched", products,
             [state if c == "product_state" else c for c in column_names(PRODUCT_ENRICHED)]),
            ("orders_enriched", orders, [c for c in column_names(ORDER_ENRICHED) if c not in left_out]),
        ):
            validate_schema(df, expected, f"{layers.silver}.{name}")
        if check_references:
            for parent, key in ((customers_bronze, "Customer ID"), (products_bronze, "Product ID")):
                check_referential_integrity(orders_bronze, parent, key, key, f"orders -> {key}")

        options = merge_options or {}
        merge_silver_customers(spark, customers, layers=layers, **options.get("customers", {}))
        merge_silver_products(spark, products, layers=layers, **options.get("products", {}))
        merge_silver_orders(spark, orders, layers=layers, **options.get("orders", {}))


# Inner joins, distinct rows, row ids; order lines and products by their fuller keys.
HOSTED_FORM = {
    "check_references": False,
    "enrich_options": {
        "customers": {"dedup": True},
        "products": {"dedup": True, "state_name": "state"},
        "orders": {"how": "inner", "dedup": True, "keep_row_id": True, "product_name": False},
    },
    "merge_options": {
        "products": {"keys": ["product_id", "product_name", "state"]},
        "orders": {"keys": ["row_id", "customer_id", "order_id", "product_id"]},
    },
}


def build_gold(spark: SparkSession, layers: Layers = LAYERS) -> None:
    """Replace the profit aggregate."""
    gold = create_profit_aggregate(load_silver_table(spark, "orders_enriched", layers))
    validate_schema(gold, column_names(PROFIT_AGGREGATE), f"{layers.gold}.profit_aggregate")
    save_gold_table(spark, gold, "profit_aggregate", layers=layers)


def run_reports(spark: SparkSession, layers: Layers = LAYERS) -> dict[str, DataFrame]:
    """The roll-ups of the stored gold table, which is also registered for SQL."""
    gold = register_view(load_gold_table(spark, "profit_aggregate", layers), "profit_aggregate")
    return {name: report(gold) for name, report in REPORTS.items()}


def validate_layers(spark: SparkSession, layers: Layers = LAYERS) -> DataFrame:
    """The quality suite over the stored tables."""
    return quality_suite(
        spark,
        load_bronze_table(spark, "customers", layers),
        load_bronze_table(spark, "products", layers),
        load_bronze_table(spark, "orders", layers),
        load_silver_table(spark, "customers_enriched", layers),
        load_silver_table(spark, "products_enriched", layers),
        load_silver_table(spark, "orders_enriched", layers),
        load_gold_table(spark, "profit_aggregate", layers),
    )


def run_all(
    spark: SparkSession,
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    layers: Layers = LAYERS,
    **silver_options,
) -> DataFrame:
    """All layers in turn; returns the quality suite. Options are those of ``build_silver``.

    Safe to run again where rows are unique by their merge keys. Where they are not, the first
    load stores all of them and the second is refused, unless ``merge_options`` say which
    of them to take.
    """
    ingest_bronze(spark, customers, products, orders, layers)
    build_silver(spark, layers, **silver_options)
    build_gold(spark, layers)
    return validate_layers(spark, layers)
