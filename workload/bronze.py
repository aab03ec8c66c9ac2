"""Bronze customers, products and order lines derived from the given tables.

The tables are a clean star schema, so the mapping also puts in what raw sales files bring:
bad and missing addresses, products listed twice, lines of unknown customers and products,
lines not yet shipped, dates in several spellings. ``oracles.py`` states the same mapping
in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill import stage

# The increment overlaps the history: lines in between are updates, later ones new.
INCREMENT_FROM = "1998-07-01"
HISTORY_UNTIL = "1999-07-01"


# Declared, so that no job has to look into a file before a query is planned.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    domain = F.concat(F.lower("r_name"), F.lit(".com"))
    email = (
        F.when(segment == "HOUSEHOLD", F.lit(None))
        .when(segment == "MACHINERY", F.concat(F.lit("user"), text("c_custkey")))
        .when(segment == "FURNITURE", F.lit("a@b"))
        .otherwise(F.concat(F.lit("user"), text("c_custkey"), F.lit("@"), domain))
    )
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("C-"), text("c_custkey")).alias("Customer ID"),
            F.col("c_name").alias("Customer Name"),
            email.alias("email"),
            F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("555-"), text("c_custkey"))).alias("phone"),
            F.concat(text("c_custkey"), F.lit(" Main St")).alias("address"),
            segment.alias("Segment"),
            F.col("n_name").alias("Country"),
            F.concat(F.lit("CITY_"), text("c_nationkey")).alias("City"),
            F.concat(F.lit("STATE_"), text("c_nationkey")).alias("State"),
            F.concat(F.lit("100"), text("c_nationkey")).alias("Postal Code"),
            F.col("r_name").alias("Region"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """``Brand#7`` is listed again at a higher price, ``Brand#8`` again unchanged."""
    raise_by = F.explode(
        F.when(F.col("p_brand") == "Brand#7", F.array(F.lit(0.0), F.lit(10.0)))
        .when(F.col("p_brand") == "Brand#8", F.array(F.lit(0.0), F.lit(0.0)))
        .otherwise(F.array(F.lit(0.0)))
    )
    return (
        table(spark, folder, "part")
        .select("*", raise_by.alias("raise_by"))
        .select(
            F.concat(F.lit("P-"), text("p_partkey")).alias("Product ID"),
            F.col("p_type").alias("Category"),
            F.col("p_brand").alias("Sub-Category"),
            F.col("p_name").alias("Product Name"),
            F.concat(F.lit("STATE_"), F.substring("p_brand", 7, 3)).alias("State"),
            (F.col("p_retailprice") + F.col("raise_by")).alias("Price per product"),
        )
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    ordered = F.to_date("o_orderdate")
    shipped = F.when(
        ~((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")), F.to_date("l_shipdate")
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    margin = F.lit("0.05").cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    walk_in = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    unlisted = (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0.1)
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_linenumber").alias("Row ID"),
            text("l_orderkey").alias("Order ID"),
            ordered.alias("Order Date"),
            shipped.alias("Ship Date"),
            F.col("o_orderpriority").alias("Ship Mode"),
            F.when(walk_in, F.lit("WALK-IN"))
            .otherwise(F.concat(F.lit("C-"), text("o_custkey"))).alias("Customer ID"),
            F.when(unlisted, F.lit("UNLISTED"))
            .otherwise(F.concat(F.lit("P-"), text("l_partkey"))).alias("Product ID"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            F.col("l_extendedprice").alias("Price"),
            F.col("l_discount").alias("Discount"),
            (price * margin).alias("exact_profit"),
        )
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as they are after loading: dates parsed, profit a double."""
    profit = F.col("exact_profit").cast("decimal(10,2)").cast("double")
    return _lines(spark, folder).withColumn("Profit", profit).drop("exact_profit")


def exact_profit_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines whose profit still has four decimals."""
    return _lines(spark, folder).withColumnRenamed("exact_profit", "Profit")


def eighths_profit_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines whose profit is a double of whole eighths of a unit."""
    eighths = (F.col("Quantity") - 25) * 5 + F.col("`Row ID`")
    return _lines(spark, folder).withColumn("Profit", eighths / F.lit(8.0)).drop("exact_profit")


def products_with_faults(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Listings as text, ``Brand#7`` without a price that is a number; and lines of ``Brand#8`` that end after two fields."""
    listed = products(spark, folder)
    price = F.when(F.col("Sub-Category") == "Brand#7", F.lit("on request")).otherwise(F.col("Price per product").cast("string"))
    short = listed.where("`Sub-Category` = 'Brand#8'").select("Product ID", "Category")
    return listed.withColumn("Price per product", price), short


def orders_with_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as JSON text: those of 1-URGENT have a quantity in words, those of 2-HIGH a month first, and of those with
    row id 7 only the beginning is there."""
    lines = orders_as_text(spark, folder)
    mode = F.col("Ship Mode")
    changed = lines.withColumns({
        "Quantity": F.when(mode == "1-URGENT", F.lit("some")).otherwise(F.col("Quantity").cast("string")),
        "Order Date": F.when(mode == "2-HIGH", F.lit("12/31/1999")).otherwise(F.col("Order Date")),
    })
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in changed.columns]))
    return changed.select(F.when(F.col("Row ID") == 7, F.substring(record, 1, 20)).otherwise(record).alias("value"))


def with_moved_groups(increment: DataFrame) -> DataFrame:
    """A later load whose lines have another profit, and those of ``Brand#3`` another category: groups that gain,
    groups that lose lines, and groups that no line is left of."""
    moved = F.when(F.col("sub_category") == "Brand#3", F.lit("MOVED")).otherwise(F.col("category"))
    more = (F.col("profit") + F.lit("1.25").cast("decimal(3,2)")).cast("decimal(10,2)")
    return increment.withColumns({"category": moved, "profit": more})


def quoted_addresses(df: DataFrame) -> DataFrame:
    return df.withColumn("address", F.concat(F.lit('Hall "A", '), "address", F.lit('\nfloor "2"')))


def orders_as_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines of the source file as JSON arrays, ``value``, and the ``part`` each is.

    A row is a whole file's text, so groups stay small: a thousand order numbers each.
    """
    lines = orders_as_text(spark, folder)
    group = F.floor(F.col("`Order ID`").cast("bigint") / 1000)
    return lines.groupBy(group.alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in lines.columns]))).alias("value")
    )


def orders_as_text(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as they are in the source file: both dates day first, unpadded."""
    return orders(spark, folder).withColumns(
        {name: _day_first_text(F.col(f"`{name}`")) for name in ("Order Date", "Ship Date")}
    )


def order_date_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, its date spelled in good and in malformed ways."""
    day = F.to_date("o_orderdate")
    priority = F.col("o_orderpriority")
    spelled = (
        F.when(priority == "1-URGENT", F.date_format(day, "dd/MM/yyyy"))
        .when(priority == "2-HIGH", _day_first_text(day))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("31/"), F.month(day), F.lit("/"), F.year(day)))
        .when(F.col("o_orderstatus") == "P", F.lit(None))
        .otherwise(F.concat(F.dayofmonth(day), F.lit("/"), F.month(day)))
    )
    return table(spark, folder, "orders").select("o_orderkey", spelled.alias("order_date_text"))


def history_and_increment(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split enriched lines by order date into a first load and an overlapping later one.

    In the later load every line has one more piece, so updates can be told from the rest.
    Lines without a date are in the first. The enriched lines are written out first, as the silver table they stand for.
    """
    enriched = stage(enriched, "orders-enriched")
    dated = F.col("order_date")
    history = enriched.where(dated.isNull() | (dated < F.lit(HISTORY_UNTIL).cast("date")))
    increment = enriched.where(F.col("order_date") >= F.lit(INCREMENT_FROM).cast("date"))
    return history, increment.withColumn("quantity", F.col("quantity") + 1)


def _day_first_text(day: Column) -> Column:
    slash = F.lit("/")
    return F.concat(F.dayofmonth(day), slash, F.month(day), slash, F.year(day))
