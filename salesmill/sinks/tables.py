"""Full loads.

A Parquet table points at a folder of its own for each load. The new rows are written
completely before the table is pointed at them, so a failed job leaves the old rows in
place and a table may be rebuilt from itself. A partition points at the load that last
wrote it, so a load's age does not tell whether it is live: leave these folders out of any
retention rule by age, and let ``drop_old_loads`` remove those nothing points at. One writer
per table at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from ..session import LAYERS, TABLE_FORMATS, Layers, literal, quoted, quoted_table


SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def save_bronze_table(
    spark: SparkSession,
    df: DataFrame,
    table_name: str,
    mode: str = "overwrite",
    layers: Layers = LAYERS,
) -> None:
    """Truncate and load."""
    save_table(spark, df, f"{layers.bronze}.{table_name}", (), mode, layers.table_format)


def save_silver_table(
    spark: SparkSession,
    df: DataFrame,
    table_name: str,
    partition_cols: Sequence[str] | None = None,
    mode: str = "overwrite",
    layers: Layers = LAYERS,
) -> None:
    """Replace a silver table as a whole; the merges keep one current instead."""
    save_table(
        spark, df, f"{layers.silver}.{table_name}", partition_cols or (), mode, layers.table_format
    )


def save_gold_table(
    spark: SparkSession,
    df: DataFrame,
    table_name: str,
    partition_cols: Sequence[str] | None = None,
    mode: str = "overwrite",
    layers: Layers = LAYERS,
    cluster_by: Sequence[str] = (),
) -> None:
    """``cluster_by``: columns that rows are stored by, within partitions; see ``save_table``."""
    save_table(
        spark, df, f"{layers.gold}.{table_name}", partition_cols or (), mode, layers.table_format, cluster_by
    )


def save_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    table_format: str = "parquet",
    cluster_by: Sequence[str] = (),
) -> None:
    """Write ``df`` to ``table`` with Spark's save modes.

    ``cluster_by`` deals rows out by ranges of these columns (after the partition's) and sorts
    them, so that each file and row group holds a narrow range and a filter on them skips the others
    by their statistics. A value of very many rows may fill several files if further columns follow it.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode {mode!r}: one of {SAVE_MODES}")
    if table_format not in TABLE_FORMATS:
        raise ValueError(f"table_format {table_format!r}: one of {TABLE_FORMATS}")
    exists = spark.catalog.tableExists(table)
    if table_format != "parquet" or mode == "append" or (exists and mode != "overwrite"):
        writer = _arranged(df, partition_by, cluster_by).write.format(table_format).mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
        return
    folder = write_load(spark, df, table, partition_by, cluster_by)
    schema = _stored_schema(df, partition_by)
    if exists and not partition_by and _can_be_pointed_at(spark, table, schema):
        spark.sql(f"ALTER TABLE {quoted_table(table)} SET LOCATION {literal(folder)}")
        return
    columns = schema.toDDL()
    layout = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    name = quoted_table(table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION {literal(folder)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _can_be_pointed_at(spark: SparkSession, table: str, schema: StructType) -> bool:
    """Whether the stored table differs in nothing but its rows."""
    described = {
        row["col_name"]: row["data_type"]
        for row in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)}").collect()
    }
    partitioned = "# Partition Information" in described
    return (
        described.get("Provider") == "parquet"
        and not partitioned
        and _stored_schema(spark.table(table), ()) == schema
    )


def gather_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one table partition together, so that it gets few, full files.

    A rebalance and no plain repartition: adaptive execution splits a partition that
    holds far more than the others instead of leaving it to one task.
    """
    return df.hint("rebalance", *map(quoted, partition_by)) if partition_by else df


def _arranged(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    if not cluster_by:
        return gather_partitions(df, partition_by)
    order = [quoted(c) for c in (*partition_by, *cluster_by)]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_load(
    spark: SparkSession, df: DataFrame, table: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> str:
    """Write ``df`` to a new folder beside the table's other loads; returns the folder."""
    database, name = table.rsplit(".", 1)
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    folder = f"{base}/{name}/load-{uuid.uuid4().hex}"
    writer = _arranged(df, partition_by, cluster_by).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return folder


def drop_old_loads(spark: SparkSession, table: str, older_than: float) -> list[str]:
    """Remove loads of ``table`` that nothing points at and that are ``older_than`` seconds.

    Live are the folders of the table and of its partitions, as the catalog has them, however
    old. What is still being written is young: let ``older_than`` exceed the longest job.
    Returns the names of the folders removed.
    """
    database, name = table.rsplit(".", 1)
    jvm = spark._jvm
    catalog = spark._jsparkSession.sessionState().catalog()
    identifier = catalog.qualifyIdentifier(
        spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(quoted_table(table))
    )
    described = catalog.getTableMetadata(identifier)
    places = [str(described.location())]
    if described.partitionColumnNames().nonEmpty():
        partitions = catalog.listPartitions(identifier, jvm.scala.Option.apply(None))
        places += [str(partitions.apply(i).location()) for i in range(partitions.size())]
    live = {part for place in places for part in place.split("/") if part.startswith("load-")}

    base = jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(database).locationUri.rstrip("/") + f"/{name}")
    store = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(base):
        return []
    dropped = []
    for found in store.listStatus(base):
        folder = found.getPath().getName()
        age = time.time() - found.getModificationTime() / 1000
        if folder.startswith("load-") and folder not in live and age >= older_than:
            store.delete(found.getPath(), True)
            dropped.append(folder)
    return sorted(dropped)


def _stored_schema(df: DataFrame, partition_by: Sequence[str]) -> StructType:
    """Nullable columns, as files hold them, with the partition columns last."""
    fields = [StructField(f.name, f.dataType) for f in df.schema.fields]
    return StructType(
        [f for f in fields if f.name not in partition_by]
        + [f for name in partition_by for f in fields if f.name == name]
    )
