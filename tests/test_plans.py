"""What the physical plans must and must not hold."""

import re
import time

import pytest
from pyspark.sql import functions as F

import salesmill as sm
from workload.queries import QUERIES, Data

FOLDER = "/root/testdata/sf0.001"
TINY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def executed(df):
    """The plan as it ran, adaptive changes included."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """Order lines of which one customer, and one product, hold a third each."""
    n = 60000
    i = F.col("id")
    lines = spark.range(0, n, 1, 8).select(
        i.cast("int").alias("Row ID"),
        i.cast("string").alias("Order ID"),
        F.expr("date_add(DATE '2020-01-01', cast(id % 900 as int))").alias("Order Date"),
        F.lit(None).cast("date").alias("Ship Date"),
        F.lit("x").alias("Ship Mode"),
        F.when(i % 3 == 0, F.lit("C-hot")).otherwise(F.concat(F.lit("C-"), i % 5000)).alias("Customer ID"),
        F.when(i % 3 == 1, F.lit("P-hot")).otherwise(F.concat(F.lit("P-"), i % 7000)).alias("Product ID"),
        F.lit(1).alias("Quantity"), F.lit(2.5).alias("Price"), F.lit(0.0).alias("Discount"),
        (i % 7 / 4.0).alias("Profit"),
    )
    ids = spark.range(0, 7000, 1, 4)
    customers = ids.select(
        F.when(ids.id == 0, F.lit("C-hot")).otherwise(F.concat(F.lit("C-"), ids.id)).alias("customer_id"),
        F.lit("n").alias("customer_name"), F.lit("c").alias("country"), F.lit("s").alias("segment"),
        F.lit("r").alias("region"), F.lit("t").alias("state"),
    )
    products = ids.select(
        F.when(ids.id == 0, F.lit("P-hot")).otherwise(F.concat(F.lit("P-"), ids.id)).alias("product_id"),
        F.lit("n").alias("product_name"), F.lit("cat").alias("category"), F.lit("sub").alias("sub_category"),
        F.lit(1.0).alias("price_per_unit"),
    )
    return lines, customers, products


def skew_joins(plan):
    return len(re.findall(r"SortMergeJoin\(skew=true\)", plan))


@pytest.mark.parametrize("dedup", [False, True])
def test_hot_keys_of_both_dimension_joins_are_split(spark, session_conf, skewed, dedup):
    session_conf(TINY)
    df = sm.enrich_order(*skewed, dedup=dedup)
    assert skew_joins(executed(df)) == 2
    assert df.count() == 60000


def test_hot_key_is_split_also_under_an_aggregation_that_reuses_the_join_partitioning(spark, session_conf, skewed):
    lines, customers, products = skewed
    session_conf(TINY)
    gold = sm.create_profit_aggregate(sm.enrich_order(lines, customers, F.broadcast(products)))
    plan = executed(gold)
    assert "BroadcastHashJoin" in plan and skew_joins(plan) == 1
    assert gold.agg(F.sum("order_count")).first()[0] == 60000


def test_hot_partition_of_an_upsert_target_is_split(spark, session_conf, skewed):
    lines, customers, products = skewed
    target = sm.stage(sm.enrich_order(lines, customers, products), "target")
    source = target.where("order_month = 3").withColumn("quantity", F.lit(9))
    session_conf(TINY)
    merged = sm.upsert(target, source, ["customer_id"], "latest", ["order_id"])
    plan = executed(merged)
    assert re.search(r"SortMergeJoin\(skew=true\) .*LeftAnti", plan)
    assert merged.count() == 60000


def test_hot_partition_of_a_written_table_is_split(spark, session_conf, layers):
    session_conf({**TINY, "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    # 2020/1 holds nearly all rows.
    rows = spark.range(0, 200000, 1, 8).select(
        "id", F.lit(2020).alias("y"), F.when(F.col("id") < 100, 2).otherwise(1).alias("m")
    )
    sm.save_silver_table(spark, rows, "t", ["y", "m"], layers=layers)
    files = sm.load_silver_table(spark, "t", layers).select("m", "_metadata.file_path").distinct()
    counts = {r["m"]: r["count"] for r in files.groupBy("m").count().collect()}
    assert counts[1] > 4 and counts[2] == 1


def test_latest_row_per_key_is_chosen_before_the_shuffle(spark, session_conf, skewed):
    plan = planned(sm.keep_latest(skewed[0], ["Customer ID"], ["Row ID"]))
    assert "partial_max" in plan and "Window" not in plan
    session_conf(TINY)
    hot = sm.keep_latest(skewed[0], ["Customer ID"], ["Row ID"]).where("`Customer ID` = 'C-hot'").collect()
    assert [r["Row ID"] for r in hot] == [59997]


def test_orphans_and_intersections_meet_as_distinct_keys(spark, skewed):
    lines, customers, _ = skewed
    orphans = planned(sm.orphan_keys(lines, customers, "Customer ID", "customer_id"))
    assert orphans.count("HashAggregate") >= 4
    common = planned(sm.common_values(lines.select("Product ID"), lines.select("Product ID")))
    assert common.count("HashAggregate") >= 4


def test_enrichment_reads_only_the_columns_it_needs(spark):
    data = Data(spark, FOLDER)
    plan = planned(sm.profit_by_year(data.gold))
    line = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan).group(1)
    assert "l_tax" not in line and "l_shipdate" not in line and "l_quantity" not in line


def test_filters_and_partitions_are_pruned_in_the_scan(spark, layers):
    stored = sm.stage(Data(spark, FOLDER).products_silver, "products")
    assert re.search(r"PushedFilters: \[.*EqualTo\(category,PROMO\)", planned(stored.where("category = 'PROMO'")))
    pruned = planned(QUERIES["prune_orders_year_month"](Data(spark, FOLDER)))
    assert re.search(r"PartitionFilters: \[isnotnull\(order_year", pruned)
    assert "InMemoryFileIndex(1 paths)" in pruned


def test_top_reports_do_not_sort_everything(spark):
    data = Data(spark, FOLDER)
    for report in (sm.profit_by_customer, sm.profit_by_customer_year, sm.profit_by_year_subcategory, sm.top_categories):
        plan = planned(report(data.gold))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_gold_is_summed_within_tasks_first_and_sorted_only_when_asked(spark):
    orders = Data(spark, FOLDER).orders_silver
    plan = planned(sm.create_profit_aggregate(orders))
    assert "partial_sum" in plan and "rangepartitioning" not in plan
    assert "rangepartitioning" in planned(sm.create_profit_aggregate(orders, ordered=True))


def test_checks_of_one_table_share_a_scan(spark, products):
    df = sm.stage(products, "products")
    assert planned(sm.null_report(df, df.columns, "products")).count("FileScan") == 1
    assert planned(sm.uniqueness_report(df, ["Product ID"], "products")).count("FileScan") == 1


def test_a_small_source_does_not_move_the_target(spark):
    target = sm.stage(Data(spark, FOLDER).orders_silver, "target")
    source = sm.stage(target.limit(5).withColumn("quantity", F.lit(9)), "source")
    merged = sm.upsert(target, source, sm.ORDER_KEYS, "latest", ["quantity"])
    plan = executed(merged)
    assert re.search(r"BroadcastHashJoin .*LeftAnti", plan) and "Exchange hashpartitioning" not in plan


def test_a_task_of_a_shuffle_gets_little(spark, session_conf):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for given, kept in (("64m", "16777216b"), ("8m", "8m")):
        session_conf({name: given})
        sm.configure(spark)
        assert spark.conf.get(name) == kept


def test_a_hot_partition_and_even_pieces_are_small(spark, session_conf, tmp_path):
    skewed, factor, pieces = (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
    )
    session_conf({skewed: "256MB", factor: "5.0", pieces: "200"})
    (tmp_path / "a").write_bytes(b"12345")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "part").write_bytes(b"123")
    size = sm.session.stored_bytes(spark, *[f"{tmp_path}/{name}" for name in ("a", "b", "none")])
    assert size == 8
    sm.configure(spark, size)
    assert (spark.conf.get(skewed), spark.conf.get(factor), spark.conf.get(pieces)) == ("25165824b", "2.0", "200")
    for stored, most in ((5 * 10**9, "597"), (10**15, "4096"), (10**6, "4096")):
        sm.configure(spark, stored)
        assert spark.conf.get(pieces) == most
    session_conf({skewed: "1000", factor: "1.5"})
    sm.configure(spark)
    assert (spark.conf.get(skewed), spark.conf.get(factor)) == ("1000", "1.5")


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = manager.getAllBlocks()
        return {blocks.apply(i).toString() for i in range(blocks.size()) if blocks.apply(i).isShuffle()}

    before = shuffled()
    kept = sm.stage(spark.range(20000).groupBy(F.pmod("id", F.lit(5000)).alias("k")).count(), "counted")
    for _ in range(100):   # they are removed by the executors, a moment later
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and kept.count() == 5000
