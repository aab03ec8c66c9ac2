"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

import salesmill as sm
from salesmill.functions import day_first_date, day_first_parts
from salesmill.operators import distinct_values, sample
from salesmill.operators.rows import in_partitions
from salesmill.schemas import CUSTOMER_ENRICHED, ORDER_ENRICHED, PRODUCT_BRONZE, column_names

from . import bronze

ORDER_KEYS = ["customer_id", "order_id", "product_id"]


@dataclass
class Data:
    """The bronze, silver and gold frames of one test folder."""

    spark: SparkSession
    folder: str

    @cached_property
    def customers(self) -> DataFrame:
        return bronze.customers(self.spark, self.folder)

    @cached_property
    def products(self) -> DataFrame:
        return bronze.products(self.spark, self.folder)

    @cached_property
    def orders(self) -> DataFrame:
        return bronze.orders(self.spark, self.folder)

    @cached_property
    def customers_silver(self) -> DataFrame:
        return sm.enrich_customer(self.customers)

    @cached_property
    def products_silver(self) -> DataFrame:
        return sm.enrich_product(self.products)

    @cached_property
    def orders_silver(self) -> DataFrame:
        return sm.enrich_order(self.orders, self.customers_silver, self.products_silver)

    @cached_property
    def orders_inner(self) -> DataFrame:
        return sm.enrich_order(
            self.orders, self.customers_silver, self.products_silver,
            how="inner", dedup=True, keep_row_id=True, product_name=False,
        )

    @cached_property
    def gold(self) -> DataFrame:
        return sm.create_profit_aggregate(self.orders_silver)

    @cached_property
    def layers(self) -> sm.Layers:
        """Databases of this query's own, in the shared scratch folder."""
        tag = uuid.uuid4().hex[:12]
        root = sm.scratch_folder(self.spark, "workload")
        return sm.Layers(f"bronze_{tag}", f"silver_{tag}", f"gold_{tag}", root).create(self.spark)


Query = Callable[[Data], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# -- sources ----------------------------------------------------------------------------


def _write_csv(df: DataFrame, folder: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(folder)


@query
def src_customers(d: Data) -> DataFrame:
    folder = sm.scratch_folder(d.spark, "customers-csv")
    _write_csv(d.customers, folder)
    return sm.load_customer_data(d.spark, folder)


@query
def src_customers_quoted(d: Data) -> DataFrame:
    """Addresses with quotes, separators and line breaks, as a workbook saves them."""
    folder = sm.scratch_folder(d.spark, "customers-quoted")
    _write_csv(bronze.quoted_addresses(d.customers), folder)
    return sm.load_customer_data(d.spark, folder, multi_line=True)


@query
def src_customers_parquet(d: Data) -> DataFrame:
    folder = sm.scratch_folder(d.spark, "customers-parquet")
    d.customers.write.parquet(folder)
    return sm.load_customer_data(d.spark, folder, "parquet")


@query
def src_products_csv(d: Data) -> DataFrame:
    folder = sm.scratch_folder(d.spark, "products-csv")
    _write_csv(d.products, folder)
    return sm.load_product_data(d.spark, folder)


@query
def src_orders_json(d: Data) -> DataFrame:
    folder = sm.scratch_folder(d.spark, "orders-json")
    bronze.orders_as_text(d.spark, d.folder).write.json(folder)
    return sm.load_order_data(d.spark, folder)


@query
def src_orders_json_document(d: Data) -> DataFrame:
    """Documents: an array of order lines in each file, which is read whole and so may be compressed."""
    folder = sm.scratch_folder(d.spark, "orders-documents")
    bronze.orders_as_documents(d.spark, d.folder).write.partitionBy("part").option("compression", "gzip").text(folder)
    return sm.load_order_data(d.spark, folder, multi_line=True)


@query
def bronze_dedup(d: Data) -> DataFrame:
    sm.save_bronze_table(d.spark, d.products, "products", layers=d.layers)
    return sm.load_bronze_table(d.spark, "products", d.layers, dedup=True)


@query
def gold_view_sql(d: Data) -> DataFrame:
    sm.register_view(d.gold, "profit_aggregate")
    return d.spark.sql(
        """
        SELECT country, year, SUM(total_profit) AS total_profit, SUM(order_count) AS order_count
        FROM profit_aggregate
        GROUP BY country, year
        """
    )


@query
def src_rejects(d: Data) -> DataFrame:
    """What a load of bronze tables could not take, counted while they were loaded."""
    folder = sm.scratch_folder(d.spark, "faults")
    listed, short = bronze.products_with_faults(d.spark, d.folder)
    _write_csv(listed, f"{folder}/products/whole")
    _write_csv(short, f"{folder}/products/short")
    bronze.orders_with_faults(d.spark, d.folder).write.text(f"{folder}/orders")
    _write_csv(d.customers, f"{folder}/customers")

    observed = {name: Observation(name) for name in ("customers", "products", "orders")}
    loaded = {
        "customers": sm.load_customer_data(d.spark, f"{folder}/customers", rejects=observed["customers"]),
        "products": sm.load_product_data(
            d.spark, f"{folder}/products/*", corrupt_column="fault", rejects=observed["products"]
        ).where("fault IS NULL").drop("fault"),
        "orders": sm.load_order_data(
            d.spark, f"{folder}/orders", corrupt_column="fault", rejects=observed["orders"]
        ).where("fault IS NULL").drop("fault"),
    }
    sm.ingest_bronze(d.spark, **loaded, layers=d.layers)
    return sm.rejects_report(d.spark, observed)


# -- sinks and upserts --------------------------------------------------------------------


@query
def sink_overwrite(d: Data) -> DataFrame:
    sm.save_bronze_table(d.spark, d.products, "orders", layers=d.layers)
    sm.save_bronze_table(d.spark, d.orders, "orders", layers=d.layers)
    return sm.load_bronze_table(d.spark, "orders", d.layers)


@query
def sink_partitioned(d: Data) -> DataFrame:
    sm.save_gold_table(d.spark, d.gold, "profit_aggregate", ["year"], layers=d.layers)
    return sm.load_gold_table(d.spark, "profit_aggregate", d.layers)


@query
def prune_orders_year_month(d: Data) -> DataFrame:
    sm.save_silver_table(
        d.spark, d.orders_silver, "orders_enriched", sm.ORDER_PARTITIONS, layers=d.layers
    )
    stored = sm.load_silver_table(d.spark, "orders_enriched", d.layers)
    return stored.where("order_year = 1998 AND order_month = 3")


@query
def prune_gold_category(d: Data) -> DataFrame:
    """Gold stored by ranges of category: row groups of other categories are skipped by their statistics."""
    sm.save_gold_table(
        d.spark, d.gold, "profit_aggregate", layers=d.layers, cluster_by=["category", "sub_category", "customer_id"]
    )
    return sm.load_gold_table(d.spark, "profit_aggregate", d.layers).where("category = 'PROMO' AND sub_category = 'Brand#11'")


@query
def upsert_customers(d: Data) -> DataFrame:
    target = d.customers_silver.where("region <> 'ASIA'")
    source = d.customers_silver.where("region IN ('ASIA', 'EUROPE')").withColumn(
        "segment", F.concat(F.lit("NEW "), "segment")
    )
    return sm.upsert(target, source, sm.CUSTOMER_KEYS)


@query
def upsert_products(d: Data) -> DataFrame:
    target = d.products_silver.where("category <> 'PROMO'")
    source = d.products_silver.where("category IN ('PROMO', 'SMALL')").withColumn(
        "price_per_unit", F.col("price_per_unit") + 1.0
    )
    return sm.upsert(target, source, sm.PRODUCT_KEYS, "latest", source.columns)


@query
def merge_customers_table(d: Data) -> DataFrame:
    target = d.customers_silver.where("region <> 'ASIA'")
    source = d.customers_silver.where("region IN ('ASIA', 'EUROPE')").withColumn(
        "segment", F.concat(F.lit("NEW "), "segment")
    )
    sm.merge_silver_customers(d.spark, target, layers=d.layers)
    sm.merge_silver_customers(d.spark, source, layers=d.layers)
    return sm.load_silver_table(d.spark, "customers_enriched", d.layers).drop("updated_at")


@query
def merge_products_table(d: Data) -> DataFrame:
    target = d.products_silver.where("category <> 'PROMO'")
    source = d.products_silver.where("category IN ('PROMO', 'SMALL')").withColumn(
        "price_per_unit", F.col("price_per_unit") + 1.0
    )
    sm.save_silver_table(
        d.spark, target.withColumn("updated_at", F.current_timestamp()), "products_enriched", layers=d.layers
    )
    sm.merge_silver_products(
        d.spark, source, layers=d.layers, on_duplicate="latest", order_by=source.columns
    )
    return sm.load_silver_table(d.spark, "products_enriched", d.layers).drop("updated_at")


@query
def merge_customers_bucketed(d: Data) -> DataFrame:
    """The merge of ``merge_customers_table``, on a table in hash buckets of the key."""
    target = d.customers_silver.where("region <> 'ASIA'")
    source = d.customers_silver.where("region IN ('ASIA', 'EUROPE')").withColumn(
        "segment", F.concat(F.lit("NEW "), "segment")
    )
    sm.merge_silver_customers(d.spark, target, layers=d.layers, buckets=8)
    sm.merge_silver_customers(d.spark, source, layers=d.layers)
    return sm.load_silver_table(d.spark, "customers_enriched", d.layers).drop("updated_at", "key_bucket")


@query
def merge_products_bucketed(d: Data) -> DataFrame:
    target = d.products_silver.where("category <> 'PROMO'")
    source = d.products_silver.where("category IN ('PROMO', 'SMALL')").withColumn(
        "price_per_unit", F.col("price_per_unit") + 1.0
    )
    sm.merge_silver_products(d.spark, target, layers=d.layers, buckets=8)
    sm.merge_silver_products(
        d.spark, source, layers=d.layers, on_duplicate="latest", order_by=source.columns
    )
    return sm.load_silver_table(d.spark, "products_enriched", d.layers).drop("updated_at", "key_bucket")


@query
def upsert_orders(d: Data) -> DataFrame:
    history, increment = bronze.history_and_increment(d.orders_silver)
    return sm.upsert(history, increment, sm.ORDER_KEYS, "latest", increment.columns)


@query
def upsert_orders_by_row(d: Data) -> DataFrame:
    history, increment = bronze.history_and_increment(d.orders_inner)
    keys = ["row_id", *sm.ORDER_KEYS]
    return sm.upsert(history, increment, keys, "latest", increment.columns)


@query
def upsert_orders_table(d: Data) -> DataFrame:
    history, increment = bronze.history_and_increment(d.orders_silver)
    sm.save_silver_table(d.spark, history, "orders_enriched", sm.ORDER_PARTITIONS, layers=d.layers)
    sm.merge_table(
        d.spark, increment, f"{d.layers.silver}.orders_enriched", sm.ORDER_KEYS,
        sm.ORDER_PARTITIONS, on_duplicate="latest", order_by=increment.columns,
    )
    return sm.load_silver_table(d.spark, "orders_enriched", d.layers)


# -- projections and filters --------------------------------------------------------------


@query
def standardize_customers(d: Data) -> DataFrame:
    return sm.standardize_customer_columns(d.customers)


@query
def standardize_products(d: Data) -> DataFrame:
    return sm.standardize_product_columns(d.products)


@query
def standardize_orders(d: Data) -> DataFrame:
    return sm.standardize_order_columns(d.orders)


@query
def standardize_orders_row_id(d: Data) -> DataFrame:
    return sm.standardize_order_columns(d.orders, keep_row_id=True)


@query
def filter_conjunctive(d: Data) -> DataFrame:
    wanted = "`Customer ID` = 'WALK-IN' AND `Product ID` = 'UNLISTED' AND `Ship Mode` = '5-LOW'"
    return d.orders.where(wanted)


@query
def filter_in_list(d: Data) -> DataFrame:
    return d.products.where(F.col("Category").isin("ECONOMY", "PROMO"))


@query
def distinct_rows(d: Data) -> DataFrame:
    return sm.distinct_rows(sm.stage(d.products, "products"))


@query
def orders_sample(d: Data) -> DataFrame:
    shown = ["order_id", "order_date", "customer_name", "country", "category", "sub_category",
             "quantity", "price", "profit"]
    return sample(d.orders_silver, shown, shown, 10)


# -- joins ----------------------------------------------------------------------------------


@query
def join_customer_left(d: Data) -> DataFrame:
    return sm.join_with_customer(sm.standardize_order_columns(d.orders), d.customers_silver)


@query
def join_product_left(d: Data) -> DataFrame:
    return sm.join_with_product(sm.standardize_order_columns(d.orders), d.products_silver)


@query
def join_customer_inner(d: Data) -> DataFrame:
    return sm.join_with_customer(sm.standardize_order_columns(d.orders), d.customers_silver, "inner")


@query
def join_product_dedup_inner(d: Data) -> DataFrame:
    attributes = ("category", "sub_category", "price_per_unit")
    lines = sm.standardize_order_columns(d.orders)
    return sm.join_with_product(lines, d.products_silver, "inner", attributes, dedup=True)


@query
def orphan_keys(d: Data) -> DataFrame:
    return sm.orphan_keys(d.orders, d.customers, "Customer ID", "Customer ID")


@query
def join_three_way(d: Data) -> DataFrame:
    o = sm.standardize_order_columns(d.orders)
    return (
        o.join(d.customers_silver, "customer_id")
        .join(d.products_silver, "product_id", "left")
        .where("category = 'PROMO'")
        .select("order_id", "customer_id", "customer_name", "state", "product_id", "product_name",
                "category", "product_state", "price_per_unit", "quantity", "price")
    )


@query
def join_composite(d: Data) -> DataFrame:
    o = sm.standardize_order_columns(d.orders)
    p = sm.standardize_product_columns(d.products, "state")
    return (
        o.join(d.customers_silver.select("customer_id", "customer_name", "state"), "customer_id")
        .join(p, ["product_id", "state"])
        .select("order_id", "customer_id", "customer_name", "state", "product_id", "price_per_unit", "quantity")
    )


# -- aggregations ---------------------------------------------------------------------------


@query
def gold_profit(d: Data) -> DataFrame:
    return sm.create_profit_aggregate(d.orders_silver, ordered=True)


@query
def gold_profit_pxq(d: Data) -> DataFrame:
    return sm.create_profit_aggregate(d.orders_silver, "price_x_qty", ordered=True)


@query
def gold_profit_incremental(d: Data) -> DataFrame:
    """Gold after a first load and a merge, of which only the changed groups were aggregated."""
    history, increment = bronze.history_and_increment(d.orders_silver)
    changed = bronze.with_moved_groups(increment)
    sm.merge_orders_and_gold(d.spark, history, d.layers)
    sm.merge_orders_and_gold(
        d.spark, changed, d.layers, on_duplicate="latest", order_by=changed.columns
    )
    return sm.load_profit_aggregate(d.spark, d.layers)


@query
def layer_counts(d: Data) -> DataFrame:
    return sm.layer_counts({
        "bronze.customers": d.customers,
        "bronze.products": d.products,
        "bronze.orders": d.orders,
        "silver.customers_enriched": d.customers_silver,
        "silver.products_enriched": d.products_silver,
        "silver.orders_enriched": d.orders_silver,
        "gold.profit_aggregate": d.gold,
    })


@query
def profit_stats(d: Data) -> DataFrame:
    return _totals(sm.profit_statistics(d.orders_silver))


@query
def gold_stats(d: Data) -> DataFrame:
    return sm.aggregate_statistics(d.gold)


@query
def gold_stats_sketch(d: Data) -> DataFrame:
    """The exact counts, and whether those from sketches (one year's taken anew) and the approximate ones are near."""
    gold = sm.stage(d.gold, "gold")
    sketches = sm.stage(sm.sketch_gold(gold.where("year <> 1998")), "gold-sketches")
    sketched = sm.sketched_statistics(sm.refresh_sketches(sketches, gold, [1998, None]))
    exact, rough = sm.aggregate_statistics(gold), sm.aggregate_statistics(gold, approximate=0.015)
    near = [
        (F.abs(F.col(f"{side}.{name}") - F.col(f"exact.{name}")) <= 0.05 * F.col(f"exact.{name}")).alias(f"{side}_{name}_near")
        for side in ("sketched", "rough") for name in ("distinct_categories", "distinct_customers")
    ]
    # One row each; exact columns of the sketches join them.
    same = ["total_records", "distinct_years"]
    found = exact.alias("exact").join(sketched.alias("sketched"), same).join(rough.alias("rough").drop("distinct_years"), same[0])
    return found.select(*same, "exact.distinct_categories", "exact.distinct_customers", *near)


@query
def duplicate_keys(d: Data) -> DataFrame:
    return sm.duplicate_keys(d.orders, ["Customer ID", "Order ID", "Product ID"])


@query
def duplicate_keys_group_by_all(d: Data) -> DataFrame:
    return sm.duplicate_keys(d.products, ["Product ID", "Category", "Sub-Category", "Price per product"])


def _audited(d: Data) -> dict:
    return {
        "bronze_customers": (d.customers, ["Customer ID"]),
        "bronze_orders": (d.orders, None),
        "bronze_products": (d.products, ["Product ID"]),
        "silver_customers": (d.customers_silver, None),
        "silver_orders": (d.orders_silver, None),
        "silver_products": (d.products_silver, None),
    }


@query
def layer_audit(d: Data) -> DataFrame:
    return sm.layer_audit(_audited(d))


@query
def layer_audit_skip_nulls(d: Data) -> DataFrame:
    return sm.layer_audit(_audited(d), skip_nulls=True)


@query
def profit_by_cast_year(d: Data) -> DataFrame:
    lines = d.orders.withColumn("order_text", F.col("Order Date").cast("string"))
    year = F.year(F.expr("try_cast(order_text AS date)"))
    return lines.groupBy(year.alias("year")).agg(
        F.sum(F.col("Profit").cast("decimal(10,2)")).cast("decimal(20,2)").alias("profit")
    )


# -- roll-ups over gold -----------------------------------------------------------------------


def _totals(df: DataFrame) -> DataFrame:
    """Decimal width pinned, so that both engines state the same type."""
    money = [f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    return df.withColumns({name: F.col(name).cast("decimal(25,2)") for name in money})


@query
def profit_by_year(d: Data) -> DataFrame:
    return _totals(sm.profit_by_year(d.gold))


@query
def profit_by_year_category(d: Data) -> DataFrame:
    return _totals(sm.profit_by_year_category(d.gold))


@query
def profit_by_customer(d: Data) -> DataFrame:
    return _totals(sm.profit_by_customer(d.gold))


@query
def profit_by_customer_all(d: Data) -> DataFrame:
    return _totals(sm.profit_by_customer(d.gold, limit=None))


@query
def profit_by_customer_year(d: Data) -> DataFrame:
    return _totals(sm.profit_by_customer_year(d.gold))


@query
def profit_by_customer_year_all(d: Data) -> DataFrame:
    return _totals(sm.profit_by_customer_year(d.gold, limit=None))


@query
def profit_by_year_subcategory(d: Data) -> DataFrame:
    return _totals(sm.profit_by_year_subcategory(d.gold))


@query
def profit_by_year_subcategory_all(d: Data) -> DataFrame:
    return _totals(sm.profit_by_year_subcategory(d.gold, limit=None))


@query
def top_categories(d: Data) -> DataFrame:
    return _totals(sm.top_categories(d.gold))


# -- set operators ----------------------------------------------------------------------------


@query
def product_ids_intersect(d: Data) -> DataFrame:
    listed = d.products.where(F.col("Category").isin("LARGE", "SMALL"))
    return sm.common_values(d.orders.select("Product ID"), listed.select("Product ID"))


@query
def distinct_keys(d: Data) -> DataFrame:
    return distinct_values(d.orders, ["Customer ID", "Product ID"])


@query
def keep_latest(d: Data) -> DataFrame:
    return sm.keep_latest(d.orders_silver, ORDER_KEYS, d.orders_silver.columns)


# -- scalar functions -------------------------------------------------------------------------


@query
def parse_order_dates(d: Data) -> DataFrame:
    spelled = bronze.order_date_spellings(d.spark, d.folder)
    return spelled.withColumn("order_date", day_first_date("order_date_text"))


@query
def split_date_parts(d: Data) -> DataFrame:
    spelled = bronze.order_date_spellings(d.spark, d.folder)
    return spelled.withColumns(day_first_parts("order_date_text"))


@query
def email_enrichment(d: Data) -> DataFrame:
    added = sm.add_email_enrichment(d.customers)
    return added.select("Customer ID", "email", "email_domain", "is_valid_email")


@query
def date_fields(d: Data) -> DataFrame:
    lines = sm.add_date_fields(sm.standardize_order_columns(d.orders))
    return lines.select("order_id", "product_id", "order_date", "order_year", "order_month", "order_quarter")


@query
def days_to_ship(d: Data) -> DataFrame:
    lines = sm.calculate_days_to_ship(sm.standardize_order_columns(d.orders))
    return lines.select("order_id", "product_id", "order_date", "ship_date", "days_to_ship")


@query
def round_profit(d: Data) -> DataFrame:
    lines = sm.standardize_order_columns(bronze.exact_profit_lines(d.spark, d.folder))
    return sm.round_profit_to_2_decimals(lines).select("order_id", "product_id", "profit")


@query
def round_profit_double(d: Data) -> DataFrame:
    """Profits that are doubles, with half cents in eighths, which doubles hold exactly."""
    lines = sm.standardize_order_columns(bronze.eighths_profit_lines(d.spark, d.folder))
    return sm.round_profit_to_2_decimals(lines).select("order_id", "product_id", "profit")


@query
def try_cast_date(d: Data) -> DataFrame:
    spelled = bronze.order_date_spellings(d.spark, d.folder)
    return spelled.withColumns({
        "cast_date": F.expr("try_cast(order_date_text AS date)"),
        "head": F.substring("order_date_text", 1, 4),
    })


# -- enrichment -------------------------------------------------------------------------------


@query
def enrich_customers(d: Data) -> DataFrame:
    return d.customers_silver


@query
def enrich_products(d: Data) -> DataFrame:
    return d.products_silver


@query
def enrich_orders(d: Data) -> DataFrame:
    return d.orders_silver


@query
def enrich_orders_inner(d: Data) -> DataFrame:
    return d.orders_inner


# -- data quality -----------------------------------------------------------------------------


@query
def dq_schema_conformance(d: Data) -> DataFrame:
    """Silver tables against their layouts; the products are still in their bronze names."""
    return (
        sm.conformance_report(d.orders_silver, ORDER_ENRICHED, "orders_enriched")
        .unionByName(sm.conformance_report(d.customers_silver, CUSTOMER_ENRICHED, "customers_enriched"))
        .unionByName(sm.conformance_report(d.products_silver, PRODUCT_BRONZE, "products_enriched"))
    )


@query
def dq_null_counts(d: Data) -> DataFrame:
    return sm.null_report(d.orders_silver, column_names(ORDER_ENRICHED), "orders_enriched")


@query
def dq_uniqueness(d: Data) -> DataFrame:
    return (
        sm.uniqueness_report(d.customers, ["Customer ID"], "customers")
        .unionByName(sm.uniqueness_report(d.products, ["Product ID"], "products"))
        .unionByName(sm.uniqueness_report(d.orders, ["Customer ID", "Order ID", "Product ID"], "orders"))
        .unionByName(sm.uniqueness_report(d.orders_silver, ["customer_name", "category"], "orders_enriched"))
    )


@query
def dq_orphans(d: Data) -> DataFrame:
    to_customers = sm.orphan_report(d.orders, d.customers, "Customer ID", "Customer ID", "orders->customers")
    to_products = sm.orphan_report(d.orders, d.products, "Product ID", "Product ID", "orders->products")
    return to_customers.unionByName(to_products)


@query
def dq_suite(d: Data) -> DataFrame:
    return sm.quality_suite(
        d.spark, d.customers, d.products, d.orders,
        d.customers_silver, d.products_silver, d.orders_silver, d.gold,
    )


@query
def dq_suite_incremental(d: Data) -> DataFrame:
    """The suite from states, of which only those of partitions that changed since the first load were taken anew."""
    # Both are saved twice, spoilt and sound, and are much work.
    orders, gold = sm.stage(d.orders, "orders"), sm.stage(d.gold, "gold")
    tables = {
        "customers": (d.customers, "Region", ["ASIA", "EUROPE"], {"Segment": F.lit(None).cast("string")}),
        "products": (d.products, "Category", ["PROMO"], {"Product ID": F.lit("P-1")}),
        "orders": (orders, "Ship Mode", ["1-URGENT"], {"Customer ID": F.lit("NOBODY")}),
        "profit_aggregate": (gold, "year", [1998, None], {"category": F.lit(None).cast("string")}),
    }
    states, current = {}, {}
    for name, (df, place, changed, faults) in tables.items():
        in_changed = in_partitions([Row(**{place: value}) for value in changed], [place])
        spoilt = df.withColumns({c: F.when(in_changed, fault).otherwise(F.col(f"`{c}`")) for c, fault in faults.items()})
        table, state = f"{d.layers.bronze}.{name}", f"{d.layers.bronze}.{name}_state"
        sm.save_table(d.spark, spoilt, table, [place])
        sm.refresh_quality_state(d.spark, state, d.spark.table(table), sm.CHECKED[name], [place])
        sm.save_table(d.spark, df, table, [place])
        current[name] = d.spark.table(table)
        states[name] = sm.refresh_quality_state(
            d.spark, state, current[name], sm.CHECKED[name], [place], [Row(**{place: value}) for value in changed]
        )
    silver = {"customers_enriched": d.customers_silver, "products_enriched": d.products_silver, "orders_enriched": d.orders_silver}
    return sm.quality_suite_of_states(d.spark, states, current | silver)


@query
def dq_suite_missing_column(d: Data) -> DataFrame:
    """A required column, a key and a gold column are not there; all checks report."""
    return sm.quality_suite(
        d.spark, d.customers.drop("Segment"), d.products, d.orders.drop("Product ID"),
        d.customers_silver, d.products_silver, d.orders_silver, d.gold.drop("total_profit"),
    )


@query
def dq_row_preservation(d: Data) -> DataFrame:
    return sm.row_preservation(d.orders, d.orders_silver)
