"""DataFrame operators: each takes and returns DataFrames, and runs no job unless it says so."""

from .joins import join_with_customer, join_with_product, orphan_keys
from .quality import (
    DataQualityException,
    check_null_completeness,
    check_referential_integrity,
    check_uniqueness,
    conformance_report,
    null_report,
    orphan_report,
    quality_suite,
    require_passed,
    row_preservation,
    uniqueness_report,
    validate_schema,
)
from .quality_state import CHECKED, Checked, quality_state, quality_suite_of_states
from .rows import common_values, distinct_rows, distinct_values, duplicate_keys, keep_latest, sample
from .standardize import (
    standardize_customer_columns,
    standardize_order_columns,
    standardize_product_columns,
)
from .upsert import AmbiguousSourceError, upsert

__all__ = [
    "AmbiguousSourceError",
    "CHECKED",
    "Checked",
    "DataQualityException",
    "check_null_completeness",
    "check_referential_integrity",
    "check_uniqueness",
    "common_values",
    "conformance_report",
    "distinct_rows",
    "distinct_values",
    "duplicate_keys",
    "join_with_customer",
    "join_with_product",
    "keep_latest",
    "null_report",
    "orphan_keys",
    "orphan_report",
    "quality_state",
    "quality_suite",
    "quality_suite_of_states",
    "require_passed",
    "row_preservation",
    "sample",
    "standardize_customer_columns",
    "standardize_order_columns",
    "standardize_product_columns",
    "uniqueness_report",
    "upsert",
    "validate_schema",
]
