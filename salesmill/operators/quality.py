"""Data quality: checks that raise, and the same checks as report tables.

Every check is one aggregation over the columns it needs. Counts of distinct values and
of orphans are combined within each task before the shuffle, so repeated keys are cheap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..schemas import (
    CUSTOMER_BRONZE,
    CUSTOMER_ENRICHED,
    ORDER_BRONZE,
    ORDER_ENRICHED,
    PRODUCT_BRONZE,
    PRODUCT_ENRICHED,
    PROFIT_AGGREGATE,
    column_names,
    required_columns,
)
from .joins import orphan_keys


class DataQualityException(Exception):
    """A data quality check did not pass."""


# -- pieces -----------------------------------------------------------------------------


def _nulls(name: str) -> Column:
    return F.count_if(F.col(f"`{name}`").isNull())


def _duplicates(keys: Sequence[str]) -> Column:
    """Rows beyond the first of each key. A struct, so that null counts as a value."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*[F.col(f"`{k}`") for k in keys]))


def _unknown() -> Column:
    """What a check counts that lacks a column it reads."""
    return F.lit(None).cast("long")


def _missing(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [name for name in expected if name not in df.columns]


# -- checks that raise ------------------------------------------------------------------


def validate_schema(df: DataFrame, expected_columns: Sequence[str], table_name: str) -> None:
    """Every expected column is there; others may be too. Looks at metadata only."""
    missing = _missing(df, expected_columns)
    if missing:
        raise DataQualityException(
            f"{table_name} has not its layout. Missing columns: {missing}"
        )


def check_null_completeness(
    df: DataFrame, required_columns: Sequence[str], table_name: str
) -> None:
    """No nulls in the required columns; one pass over all, and all failures reported."""
    if not required_columns:
        return
    counts = df.agg(*[_nulls(name).alias(name) for name in required_columns]).first().asDict()
    failed = [f"{name} is null in {count} row(s)" for name, count in counts.items() if count]
    if failed:
        raise DataQualityException(f"{table_name} lacks required values: {'; '.join(failed)}")


def check_uniqueness(df: DataFrame, unique_columns: Sequence[str], table_name: str) -> None:
    """The columns together identify a row."""
    duplicates = df.agg(_duplicates(unique_columns)).first()[0]
    if duplicates:
        raise DataQualityException(
            f"{table_name} repeats {', '.join(unique_columns)}: {duplicates} row(s) too many"
        )


def check_referential_integrity(
    child_df: DataFrame,
    parent_df: DataFrame,
    child_key: str,
    parent_key: str,
    relationship_name: str,
) -> None:
    """Every non-null child key is a parent key; counts distinct keys, not rows."""
    orphans = orphan_keys(child_df, parent_df, child_key, parent_key).count()
    if orphans:
        raise DataQualityException(
            f"{relationship_name}: {orphans} key(s) without a parent"
        )


# -- reports ----------------------------------------------------------------------------


def null_report(df: DataFrame, columns: Sequence[str], table_name: str) -> DataFrame:
    """``table, column_name, null_count``: one row per column, from one pass."""
    counts = df.agg(*[_nulls(name).alias(f"n{i}") for i, name in enumerate(columns)])
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("null_count"))
        for i, name in enumerate(columns)
    ]
    return counts.select(F.lit(table_name).alias("table"), F.inline(F.array(*rows)))


def uniqueness_report(df: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """``table, row_count, distinct_count, duplicates``."""
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_count")
    )
    return counts.select(
        F.lit(table_name).alias("table"),
        "row_count",
        "distinct_count",
        (F.col("row_count") - F.col("distinct_count")).alias("duplicates"),
    )


def orphan_report(
    child_df: DataFrame,
    parent_df: DataFrame,
    child_key: str,
    parent_key: str,
    relationship_name: str,
) -> DataFrame:
    """``relationship, orphans``: how many distinct child keys have no parent."""
    orphans = orphan_keys(child_df, parent_df, child_key, parent_key)
    return orphans.agg(F.count(F.lit(1)).alias("orphans")).select(
        F.lit(relationship_name).alias("relationship"), "orphans"
    )


def conformance_report(df: DataFrame, schema: StructType, table_name: str) -> DataFrame:
    """How a table lines up with its declared layout, column by column.

    ``table, column_name, expected_type, actual_type, null_violations``: the actual type
    is null for a missing column, violations are nulls in a required one. One pass.
    """
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    checked = [f.name for f in schema.fields if not f.nullable and f.name in actual]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[_nulls(c).alias(f"n{i}") for i, c in enumerate(checked)]
    )
    violations = {name: F.col(f"n{i}") for i, name in enumerate(checked)}
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(actual.get(f.name)).cast("string").alias("actual_type"),
            violations.get(f.name, F.lit(0).cast("long")).alias("null_violations"),
        )
        for f in schema.fields
    ]
    return counts.select(F.lit(table_name).alias("table"), F.inline(F.array(*rows)))


def row_preservation(before: DataFrame, after: DataFrame) -> DataFrame:
    """``rows_before, rows_after, preserved``: whether a step kept the row count.

    An enrichment that fans out over repeated dimension keys shows here.
    """
    side = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("side"), "n")
        for label, df in (("before", before), ("after", after))
    ]
    counts = reduce(DataFrame.unionByName, side).agg(
        F.sum(F.when(F.col("side") == "before", F.col("n"))).alias("rows_before"),
        F.sum(F.when(F.col("side") == "after", F.col("n"))).alias("rows_after"),
    )
    return counts.withColumn("preserved", F.col("rows_before") == F.col("rows_after"))


# -- suite ------------------------------------------------------------------------------

# The columns of the gold table that must not be null.
GOLD_REQUIRED = ("year", "category", "sub_category", "customer_id", "total_profit", "order_count")


def _verdicts(counts: DataFrame, layer: str, checks: Sequence[tuple[int, str, str, Column]]) -> DataFrame:
    """Spread one row of counts into one row per check."""
    rows = [
        F.struct(
            F.lit(number).alias("check_no"),
            F.lit(layer).alias("layer"),
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.when(violations == 0, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
            violations.cast("long").alias("violations"),
        )
        for number, check, table, violations in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def _orphans_of_all(child: DataFrame, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row: for each named parent, how many distinct keys of the child it lacks, null if
    either has no such column. The child is read once: its keys are stacked by relation."""
    known = {
        name: (parent, key) for name, (parent, key) in parents.items()
        if not _missing(child, [key]) and not _missing(parent, [key])
    }
    lacking = [_unknown().alias(name) for name in parents if name not in known]
    if not known:
        return child.sparkSession.range(1).select(*lacking)

    def keyed(name: str, key: str) -> Column:
        return F.struct(F.lit(name).alias("relation"), F.col(f"`{key}`").cast("string").alias("key"))

    stacked = child.select(F.inline(F.array(*[keyed(n, key) for n, (_, key) in known.items()])))
    held = reduce(DataFrame.unionByName, [parent.select(keyed(n, key).alias("k")).select("k.*") for n, (parent, key) in known.items()])
    orphans = stacked.where("key is not null").distinct().join(held, ["relation", "key"], "left_anti")
    return orphans.agg(*[F.count_if(F.col("relation") == name).alias(name) for name in known], *lacking)


def _schema_violations(df: DataFrame, schema: StructType) -> Column:
    return F.lit(len(_missing(df, column_names(schema))))


def quality_suite(
    spark: SparkSession,
    customers_bronze: DataFrame,
    products_bronze: DataFrame,
    orders_bronze: DataFrame,
    customers_silver: DataFrame,
    products_silver: DataFrame,
    orders_silver: DataFrame,
    profit_aggregate: DataFrame,
    rejects: DataFrame | None = None,
) -> DataFrame:
    """The fourteen checks over all layers as one table; a failed check does not stop it.

    ``check_no, layer, check, table, status, violations``. Checks of the same table share
    a scan; those of column names need none. A check that lacks a column it reads has failed,
    with null violations. With ``rejects`` (a ``rejects_report`` of the loads) one more check for each source
    follows: records and values that its load could not take.
    """
    def null_total(df: DataFrame, columns: Sequence[str]) -> Column:
        if _missing(df, columns):
            return _unknown()
        return reduce(Column.__add__, [_nulls(name) for name in columns])

    def repeated(df: DataFrame, key: str) -> Column:
        return _unknown() if _missing(df, [key]) else _duplicates([key])

    customers = customers_bronze.agg(
        null_total(customers_bronze, required_columns(CUSTOMER_BRONZE)).alias("nulls"),
        repeated(customers_bronze, "Customer ID").alias("duplicates"),
        F.count(F.lit(1)).alias("rows"),
    )
    products = products_bronze.agg(
        null_total(products_bronze, required_columns(PRODUCT_BRONZE)).alias("nulls"),
        repeated(products_bronze, "Product ID").alias("duplicates"),
        F.count(F.lit(1)).alias("rows"),
    )
    gold = profit_aggregate.agg(
        null_total(profit_aggregate, GOLD_REQUIRED).alias("nulls"), F.count(F.lit(1)).alias("rows")
    )
    orphans = _orphans_of_all(orders_bronze, {
        "customers": (customers_bronze, "Customer ID"), "products": (products_bronze, "Product ID"),
    })

    suite = suite_of_counts(spark, {
        "customers": customers_bronze, "products": products_bronze, "orders": orders_bronze,
        "customers_enriched": customers_silver, "products_enriched": products_silver, "orders_enriched": orders_silver,
        "profit_aggregate": profit_aggregate,
    }, customers, products, orphans, gold)
    return suite.unionByName(_reject_checks(rejects)) if rejects is not None else suite


def _reject_checks(rejects: DataFrame) -> DataFrame:
    # A row for each source: few enough for one task.
    number = F.row_number().over(Window.orderBy("source")) + F.lit(14)
    return rejects.groupBy("source").agg(F.sum("rejected").alias("violations")).select(
        number.alias("check_no"), F.lit("source").alias("layer"), F.lit("rejected").alias("check"), F.col("source").alias("table"),
        F.when(F.col("violations") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"), "violations",
    )


def suite_of_counts(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    customers: DataFrame,
    products: DataFrame,
    orphans: DataFrame,
    gold: DataFrame,
) -> DataFrame:
    """The fourteen checks from rows of counts: ``nulls`` and ``duplicates`` of customers and products, orphans towards
    ``customers`` and ``products``, ``nulls`` of gold. Of ``tables`` only the column names are looked at."""
    bronze, silver = "bronze", "silver"
    parts = [
        _verdicts(customers, bronze, [
            (1, "schema", "customers", _schema_violations(tables["customers"], CUSTOMER_BRONZE)),
            (4, "nulls", "customers", F.col("nulls")),
            (6, "unique", "customers", F.col("duplicates")),
        ]),
        _verdicts(products, bronze, [
            (2, "schema", "products", _schema_violations(tables["products"], PRODUCT_BRONZE)),
            (5, "nulls", "products", F.col("nulls")),
            (7, "unique", "products", F.col("duplicates")),
        ]),
        _verdicts(orphans, bronze, [
            (3, "schema", "orders", _schema_violations(tables["orders"], ORDER_BRONZE)),
            (8, "references", "orders->customers", F.col("customers")),
            (9, "references", "orders->products", F.col("products")),
        ]),
        _verdicts(spark.range(1), silver, [
            (10, "schema", "customers_enriched", _schema_violations(tables["customers_enriched"], CUSTOMER_ENRICHED)),
            (11, "schema", "products_enriched", _schema_violations(tables["products_enriched"], PRODUCT_ENRICHED)),
            (12, "schema", "orders_enriched", _schema_violations(tables["orders_enriched"], ORDER_ENRICHED)),
        ]),
        _verdicts(gold, "gold", [
            (13, "schema", "profit_aggregate", _schema_violations(tables["profit_aggregate"], PROFIT_AGGREGATE)),
            (14, "nulls", "profit_aggregate", F.col("nulls")),
        ]),
    ]
    return reduce(DataFrame.unionByName, parts)


def require_passed(report: DataFrame) -> None:
    """Raise if any check of a suite report failed, naming each; use it as a gate."""
    failed = report.where("status <> 'PASSED'").orderBy("check_no").collect()
    if failed:
        listing = "; ".join(f"{r['layer']}.{r['table']} {r['check']}: {r['violations']}" for r in failed)
        raise DataQualityException(f"{len(failed)} check(s) failed: {listing}")
