"""Tables of the three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import LAYERS, Layers


def load_bronze_table(
    spark: SparkSession, table_name: str, layers: Layers = LAYERS, dedup: bool = False
) -> DataFrame:
    """A bronze table; with ``dedup`` identical rows are read once."""
    table = spark.table(f"{layers.bronze}.{table_name}")
    return table.dropDuplicates() if dedup else table


def load_silver_table(spark: SparkSession, table_name: str, layers: Layers = LAYERS) -> DataFrame:
    return spark.table(f"{layers.silver}.{table_name}")


def load_gold_table(spark: SparkSession, table_name: str, layers: Layers = LAYERS) -> DataFrame:
    return spark.table(f"{layers.gold}.{table_name}")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df
