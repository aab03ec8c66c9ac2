"""Whole plans built from the operators: enrichment, the gold table, its roll-ups, audits, jobs."""

from .audit import layer_audit, layer_counts
from .enrich import (
    add_date_fields,
    add_email_enrichment,
    calculate_days_to_ship,
    enrich_customer,
    enrich_order,
    enrich_product,
    round_profit_to_2_decimals,
)
from .gold import (
    aggregate_statistics,
    create_profit_aggregate,
    profit_statistics,
    rank_gold,
    refresh_sketches,
    sketch_gold,
    sketched_statistics,
)
from .gold_state import (
    apply_profit_delta,
    load_profit_aggregate,
    merge_orders_and_gold,
    profit_delta,
    profit_from_state,
    profit_state,
)
from .jobs import HOSTED_FORM, build_gold, build_silver, ingest_bronze, run_all, run_reports, validate_layers
from .quality_jobs import refresh_quality_state
from .rollups import (
    REPORTS,
    profit_by_customer,
    profit_by_customer_year,
    profit_by_year,
    profit_by_year_category,
    profit_by_year_subcategory,
    top_categories,
)

__all__ = [
    "HOSTED_FORM",
    "REPORTS",
    "add_date_fields",
    "add_email_enrichment",
    "aggregate_statistics",
    "apply_profit_delta",
    "build_gold",
    "build_silver",
    "calculate_days_to_ship",
    "create_profit_aggregate",
    "enrich_customer",
    "enrich_order",
    "enrich_product",
    "ingest_bronze",
    "layer_audit",
    "layer_counts",
    "load_profit_aggregate",
    "merge_orders_and_gold",
    "profit_by_customer",
    "profit_by_customer_year",
    "profit_by_year",
    "profit_by_year_category",
    "profit_by_year_subcategory",
    "profit_delta",
    "profit_from_state",
    "profit_state",
    "profit_statistics",
    "rank_gold",
    "refresh_quality_state",
    "refresh_sketches",
    "round_profit_to_2_decimals",
    "run_all",
    "run_reports",
    "sketch_gold",
    "sketched_statistics",
    "top_categories",
    "validate_layers",
]
