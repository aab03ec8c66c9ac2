"""Key-based merges into silver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.key_filter import rows_with_keys
from ..operators.rows import in_partitions, keep_latest
from ..operators.upsert import StagedSource, stage_source
from ..session import (
    LAYERS,
    TABLE_FORMATS,
    Layers,
    literal,
    owned_scratch,
    quoted,
    quoted_table,
    remove_file,
    scratch_folder,
)
from .tables import gather_partitions, save_table, write_load

# Merge keys and partition columns of the silver tables.
CUSTOMER_KEYS = ("customer_id", "customer_name")
PRODUCT_KEYS = ("product_id", "product_name")
ORDER_KEYS = ("customer_id", "order_id", "product_id")
ORDER_PARTITIONS = ("order_year", "order_month")

# Formats that bring a MERGE of their own.
MERGE_FORMATS = ("delta", "iceberg")
# Noted in a table while partitions of it are replaced: the folder of the rows that they get.
PENDING = "salesmill.pending"
# Noted in a table whose rows are dealt out by the hash of a key column: that column, and how many buckets.
BUCKET_BY, BUCKETS = "salesmill.bucket_by", "salesmill.buckets"
BUCKET = "key_bucket"
FILE = "__file"


def merge_silver_customers(
    spark: SparkSession,
    df: DataFrame,
    table_name: str = "customers_enriched",
    keys: Sequence[str] = CUSTOMER_KEYS,
    layers: Layers = LAYERS,
    **options,
) -> None:
    """Customers by id and name; ``keys`` may be the id alone. Options: see ``merge_table``."""
    _merge_silver(spark, df, table_name, keys, (), layers, options)


def merge_silver_products(
    spark: SparkSession,
    df: DataFrame,
    table_name: str = "products_enriched",
    keys: Sequence[str] = PRODUCT_KEYS,
    layers: Layers = LAYERS,
    **options,
) -> None:
    """Products by id and name; ``keys`` may add the product's state."""
    _merge_silver(spark, df, table_name, keys, (), layers, options)


def merge_silver_orders(
    spark: SparkSession,
    df: DataFrame,
    table_name: str = "orders_enriched",
    keys: Sequence[str] = ORDER_KEYS,
    layers: Layers = LAYERS,
    **options,
) -> None:
    """Order lines by customer, order and product, stored by year and month of the order."""
    _merge_silver(spark, df, table_name, keys, ORDER_PARTITIONS, layers, options)


def _merge_silver(spark, df, table_name, keys, partition_by, layers, options) -> None:
    stamped = df.withColumn("updated_at", F.current_timestamp())
    table = f"{layers.silver}.{table_name}"
    merge_table(spark, stamped, table, keys, partition_by, layers.table_format, **options)


def merge_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    buckets: int | None = None,
    on_change: Callable[[DataFrame, DataFrame], None] | None = None,
) -> None:
    """Upsert ``df`` into ``table``, creating it on the first load.

    On a partitioned Parquet table only partitions that hold a row to update, or get one that comes from
    another partition, are rewritten (Spark's dynamic partition overwrite); rows of
    new keys are appended to the others, whose files stay. The rows of a rewritten partition are complete in
    the scratch folder, and noted in the table, before Spark replaces its files: a merge that stops
    half way is finished by the next one, or by itself run again.

    ``buckets`` is for tables without partitions of their own: rows are dealt out by the hash of the
    first key into so many, in the partition column ``key_bucket``. A merge then looks for keys in the source's
    buckets only and rewrites those that hold one. Later merges take the number from the
    table; its first key must be among theirs.

    ``on_change`` is told, before the table changes, which of its rows go and which come; not
    on the first load, and not by formats that merge by themselves. What it needs it must write then.
    """
    if table_format not in TABLE_FORMATS:
        raise ValueError(f"table_format {table_format!r}: one of {TABLE_FORMATS}")
    exists = spark.catalog.tableExists(table)
    properties = {}
    if exists and table_format == "parquet":
        stored_as = _provider(spark, table)
        if stored_as != "parquet":
            raise ValueError(f"{table} is stored as {stored_as}; merging would damage it")
        finish_replacing(spark, table)
        properties = noted(spark, table)
    bucket_by = properties.get(BUCKET_BY) or (keys[0] if buckets and not exists and table_format == "parquet" else None)
    if bucket_by:
        if partition_by or bucket_by not in keys:
            raise ValueError(f"rows of {table} are in buckets of {bucket_by!r}: one of the keys, and no partitions beside it")
        buckets = int(properties.get(BUCKETS) or buckets)
        df = df.withColumn(BUCKET, F.pmod(F.xxhash64(quoted(bucket_by)), F.lit(buckets)).cast("int"))
        partition_by = (BUCKET,)
    with owned_scratch(spark, "merge"):
        if on_duplicate == "latest" and not (exists and table_format == "parquet"):
            df = keep_latest(df, keys, order_by)
        if not exists:
            save_table(spark, df, table, partition_by, "overwrite", table_format)
            if bucket_by:
                note(spark, table, {BUCKET_BY: bucket_by, BUCKETS: str(buckets)})
        elif table_format in MERGE_FORMATS:
            _native_merge(df, table, keys)
        else:
            target = spark.table(table)
            staged = stage_source(
                target, df, keys, partition_by, on_duplicate, order_by, co_located=partition_by if bucket_by else ()
            )
            if partition_by:
                _merge_partitions(spark, staged, target, table, list(partition_by), on_change)
            else:
                if on_change:
                    on_change(staged.removed(target), staged.added(target))
                folder = write_load(spark, staged.merge_into(target), table)
                spark.sql(f"ALTER TABLE {quoted_table(table)} SET LOCATION {literal(folder)}")


def merge_condition(table: str, keys: Sequence[str]) -> str:
    return " AND ".join(f"{quoted_table(table)}.{quoted(k)} = source.{quoted(k)}" for k in keys)


def _native_merge(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    (
        df.alias("source")
        .mergeInto(table, F.expr(merge_condition(table, keys)))
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)}").where("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else "unknown"


def noted(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted_table(table)}").collect()}


def note(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    told = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {quoted_table(table)} SET TBLPROPERTIES ({told})")


def strike(spark: SparkSession, table: str, key: str) -> None:
    spark.sql(f"ALTER TABLE {quoted_table(table)} UNSET TBLPROPERTIES IF EXISTS ({literal(key)})")


def _merge_partitions(
    spark: SparkSession,
    staged: StagedSource,
    target: DataFrame,
    table: str,
    partition_by: list[str],
    on_change: Callable[[DataFrame, DataFrame], None] | None,
) -> None:
    places = [quoted(c) for c in partition_by]
    placed = staged.rows.select(*dict.fromkeys([*map(quoted, staged.keys), *places]))
    known = rows_with_keys(placed, staged.taken, staged.keys)
    # One row per table partition at most, so this fits the driver as the catalog does.
    hit = staged.places.select(*places).union(known.select(*places)).distinct().collect()
    in_hit = in_partitions(hit, partition_by)
    affected = target.where(in_hit)
    if on_change:
        on_change(staged.removed(affected), staged.added(affected))
    if hit:
        rewritten = staged.untouched(affected).unionByName(staged.added(affected).where(in_hit))
        replace_partitions(spark, table, rewritten, hit, partition_by)
    # All rows of known keys are among the rewritten.
    new = staged.rows.where(~F.coalesce(in_hit, F.lit(False))).select(*target.columns)
    gather_partitions(new, partition_by).write.insertInto(table)


def replace_partitions(
    spark: SparkSession, table: str, rows: DataFrame, partitions: Sequence[Row], partition_by: Sequence[str]
) -> None:
    """Give each of ``partitions`` those of ``rows`` that belong to it; those that get none are dropped."""
    places = [quoted(c) for c in partition_by]
    folder = scratch_folder(spark, "rewritten")
    rows.write.parquet(f"{folder}/rows")
    filled = set(spark.read.schema(rows.schema).parquet(f"{folder}/rows").select(*places).distinct().collect())
    vacated = [p for p in partitions if p not in filled]
    emptied = spark.table(table).where(in_partitions(vacated, partition_by)).select(*places, F.col("_metadata.file_path").alias(FILE))
    emptied.distinct().write.parquet(f"{folder}/vacated")
    note(spark, table, {PENDING: folder})
    finish_replacing(spark, table)


def finish_replacing(spark: SparkSession, table: str) -> None:
    """Replace the partitions whose rows are noted in the table, if any are.

    Doing so again changes nothing, so it may stop at any point.
    """
    folder = noted(spark, table).get(PENDING)
    if not folder:
        return
    name, target = quoted_table(table), spark.table(table)
    rows = spark.read.schema(target.schema).parquet(f"{folder}/rows").select(*target.columns)
    vacated = spark.read.parquet(f"{folder}/vacated")
    places = [c for c in vacated.columns if c != FILE]
    with _overwriting_dynamically(spark):
        gather_partitions(rows, places).write.insertInto(table, overwrite=True)
    # Dropping leaves the files, and a later row of the partition would bring them back.
    for place in vacated.groupBy(*map(quoted, places)).agg(F.collect_set(FILE).alias(FILE)).collect():
        values = ", ".join(f"{quoted(c)} = {_sql_value(place[c])}" for c in places)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({values})")
        for file in place[FILE]:
            remove_file(spark, file)
    strike(spark, table, PENDING)


@contextmanager
def _overwriting_dynamically(spark: SparkSession) -> Iterator[None]:
    """An overwriting insert replaces only the partitions that it has rows for."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _sql_value(value) -> str:
    """A partition value as a typed literal."""
    if value is None:
        return "null"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    return literal(value) if isinstance(value, str) else str(value).lower()
