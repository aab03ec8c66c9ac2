"""Full loads and merges of stored tables."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import salesmill as sm

LINES = "order_id string, customer_id string, product_id string, order_year int, order_month int, quantity int"


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), LINES)


def stored(spark, layers, name="orders_enriched"):
    df = sm.load_silver_table(spark, name, layers)
    return sorted((r["order_id"], r["product_id"], r["order_year"], r["order_month"], r["quantity"]) for r in df.collect())


def partition_files(spark, layers, where):
    df = sm.load_silver_table(spark, "orders_enriched", layers).where(where)
    return {os.path.basename(r[0]) for r in df.select("_metadata.file_path").distinct().collect()}


# -- full loads ---------------------------------------------------------------------------


def test_overwrite_replaces_rows_and_layout(spark, layers, customers, products):
    sm.save_bronze_table(spark, customers, "t", layers=layers)
    sm.save_bronze_table(spark, products, "t", layers=layers)
    got = sm.load_bronze_table(spark, "t", layers)
    assert got.columns == products.columns and got.count() == 3


def test_a_table_may_be_rebuilt_from_itself(spark, layers, products):
    sm.save_bronze_table(spark, products, "t", layers=layers)
    itself = sm.load_bronze_table(spark, "t", layers)
    sm.save_bronze_table(spark, itself.union(itself), "t", layers=layers)
    assert sm.load_bronze_table(spark, "t", layers).count() == 6


def test_a_failed_load_leaves_the_old_rows(spark, layers, products):
    sm.save_bronze_table(spark, products, "t", layers=layers)
    broken = products.withColumn("State", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sm.save_bronze_table(spark, broken, "t", layers=layers)
    assert sm.load_bronze_table(spark, "t", layers).count() == 3


def test_other_save_modes(spark, layers, products):
    sm.save_gold_table(spark, products, "t", mode="error", layers=layers)
    sm.save_gold_table(spark, products, "t", mode="append", layers=layers)
    sm.save_gold_table(spark, products, "t", mode="ignore", layers=layers)
    assert sm.load_gold_table(spark, "t", layers).count() == 6
    with pytest.raises(Exception, match="already exists"):
        sm.save_gold_table(spark, products, "t", mode="error", layers=layers)


def test_partitioned_load(spark, layers, products):
    sm.save_silver_table(spark, products, "t", ["Category", "State"], layers=layers)
    got = sm.load_silver_table(spark, "t", layers)
    assert got.columns[-2:] == ["Category", "State"] and got.count() == 3
    assert spark.sql(f"SHOW PARTITIONS {layers.silver}.t").count() == 3
    assert got.where("Category = 'Garden'").count() == 1


def test_clustered_gold_skips_row_groups(spark, layers, session_conf):
    """Of a table stored by ranges of a column, few row groups can hold one of its values."""
    import pyarrow.parquet as pq

    session_conf({"spark.sql.shuffle.partitions": "6", "spark.sql.adaptive.coalescePartitions.enabled": "false"})

    rows = spark.range(20_000).selectExpr(
        "cast(id % 3 as int) as year", "concat('cat ', lpad(id * 7919 % 40, 2, '0')) as category", "id as customer_id"
    ).repartition(8)

    def holding(name, value):
        df = sm.load_gold_table(spark, name, layers)
        groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in df.inputFiles()]
        column = groups[0].schema.names.index("category")
        stats = [m.row_group(g).column(column).statistics for m in groups for g in range(m.num_row_groups)]
        return sum(s.min <= value <= s.max for s in stats), len(stats)

    for name, by in (("plain", ()), ("clustered", ("category", "customer_id"))):
        sm.save_gold_table(spark, rows, name, layers=layers, cluster_by=by)
        assert sm.load_gold_table(spark, name, layers).count() == 20_000
    assert holding("plain", "cat 05")[0] == holding("plain", "cat 05")[1] > 1
    hit, of = holding("clustered", "cat 05")
    assert hit <= 2 < of == 6
    sm.save_gold_table(spark, rows, "parts", ["year"], layers=layers, cluster_by=["category"])
    got = sm.load_gold_table(spark, "parts", layers)
    assert got.where("category = 'cat 05' AND year = 1").count() == rows.where("category = 'cat 05' AND year = 1").count()


# -- merges -------------------------------------------------------------------------------


def test_first_load_creates_a_stamped_table(spark, layers, silver):
    sm.merge_silver_customers(spark, silver[0], layers=layers)
    sm.merge_silver_products(spark, silver[1], layers=layers)
    sm.merge_silver_orders(spark, silver[2], layers=layers)
    for name in ("customers_enriched", "products_enriched", "orders_enriched"):
        got = sm.load_silver_table(spark, name, layers)
        assert got.count() == 3 and got.where("updated_at IS NULL").count() == 0
    assert spark.sql(f"SHOW PARTITIONS {layers.silver}.orders_enriched").count() == 3


def test_customers_update_and_insert(spark, layers):
    columns = ["customer_id", "customer_name", "segment"]
    sm.merge_silver_customers(spark, spark.createDataFrame([("D1", "Iris", "Consumer"), ("D3", "Olaf", "Consumer")], columns), layers=layers)
    sm.merge_silver_customers(spark, spark.createDataFrame([("D1", "Iris", "Corporate"), ("D2", "Tove", "Consumer")], columns), layers=layers)
    got = sm.load_silver_table(spark, "customers_enriched", layers)
    assert {(r["customer_id"], r["segment"]) for r in got.collect()} == {("D1", "Corporate"), ("D2", "Consumer"), ("D3", "Consumer")}
    renamed = spark.createDataFrame([("D1", "Irina", "Corporate")], columns)
    sm.merge_silver_customers(spark, renamed, layers=layers)
    assert sm.load_silver_table(spark, "customers_enriched", layers).count() == 4
    with_id_key = spark.createDataFrame([("D2", "Tova", "Corporate")], columns)
    sm.merge_silver_customers(spark, with_id_key, keys=["customer_id"], layers=layers)
    assert sm.load_silver_table(spark, "customers_enriched", layers).where("customer_name = 'Tove'").count() == 0


def test_products_update(spark, layers):
    columns = ["product_id", "product_name", "price_per_unit"]
    for price in (12.5, 14.0):
        sm.merge_silver_products(spark, spark.createDataFrame([("Q9", "Lamp", price)], columns), layers=layers)
    got = sm.load_silver_table(spark, "products_enriched", layers).collect()
    assert [r["price_per_unit"] for r in got] == [14.0]


def test_orders_merge_by_the_whole_key(spark, layers):
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P1", 2020, 1, 2)), layers=layers)
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P1", 2020, 1, 5), ("O1", "C", "P2", 2020, 1, 1)), layers=layers)
    assert stored(spark, layers) == [("O1", "P1", 2020, 1, 5), ("O1", "P2", 2020, 1, 1)]


def test_only_touched_partitions_are_rewritten(spark, layers):
    sm.merge_silver_orders(spark, lines(
        spark, ("O1", "C", "P", 2020, 1, 1), ("O2", "C", "P", 2020, 2, 1), ("O3", "C", "P", 2021, 1, 1)
    ), layers=layers)
    before = partition_files(spark, layers, "order_year = 2021 OR order_month = 2")
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", 2020, 1, 9), ("O4", "C", "P", 2022, 5, 1)), layers=layers)
    assert partition_files(spark, layers, "(order_year = 2021 OR order_month = 2)") == before
    assert stored(spark, layers) == [
        ("O1", "P", 2020, 1, 9), ("O2", "P", 2020, 2, 1), ("O3", "P", 2021, 1, 1), ("O4", "P", 2022, 5, 1)
    ]


def test_a_row_that_changes_partition_appears_once(spark, layers):
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", 2020, 1, 1), ("O2", "C", "P", 2020, 2, 1)), layers=layers)
    moved = lines(spark, ("O1", "C", "P", 2020, 3, 7))
    for _ in range(2):
        sm.merge_silver_orders(spark, moved, layers=layers)
        assert stored(spark, layers) == [("O1", "P", 2020, 3, 7), ("O2", "P", 2020, 2, 1)]
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {layers.silver}.orders_enriched").collect()}
    assert parts == {"order_year=2020/order_month=2", "order_year=2020/order_month=3"}


@pytest.fixture
def lose_the_driver(spark, monkeypatch):
    """Run a merge whose driver is lost before the n-th statement or insert; says whether it was."""

    def run(steps, merge):
        done = []

        def guarded(original, counts):
            def call(self, first, *args, **kwargs):
                if counts(first):
                    if len(done) == steps:
                        raise RuntimeError("driver lost")
                    done.append(first)
                return original(self, first, *args, **kwargs)
            return call

        writer = type(spark.range(1).write)
        monkeypatch.setattr(type(spark), "sql", guarded(type(spark).sql, lambda t: t.startswith("ALTER")))
        monkeypatch.setattr(writer, "insertInto", guarded(writer.insertInto, lambda t: True))
        try:
            merge()
        except RuntimeError:
            return True
        finally:
            monkeypatch.undo()
        return False

    return run


@pytest.mark.parametrize("steps", range(5))
def test_a_half_finished_merge_is_completed_by_the_next(spark, layers, lose_the_driver, steps):
    """Two lines change places, a third stays, a fourth is new; the driver is lost after some steps."""
    sm.merge_silver_orders(spark, lines(
        spark, ("O1", "C", "P", 2020, 1, 1), ("O2", "C", "P", 2020, 2, 1), ("O3", "C", "P", 2020, 1, 1)
    ), layers=layers)
    moved = lines(spark, ("O1", "C", "P", 2020, 2, 7), ("O2", "C", "P", 2020, 1, 7), ("O4", "C", "P", 2020, 6, 7))
    lost = lose_the_driver(steps, lambda: sm.merge_silver_orders(spark, moved, layers=layers))
    assert lost == (steps < 4)   # note, overwrite, strike the note, append
    sm.merge_silver_orders(spark, moved, layers=layers)
    assert stored(spark, layers) == [
        ("O1", "P", 2020, 2, 7), ("O2", "P", 2020, 1, 7), ("O3", "P", 2020, 1, 1), ("O4", "P", 2020, 6, 7)
    ]


@pytest.mark.parametrize("steps", range(6))
def test_a_half_finished_merge_loses_no_repeated_row(spark, layers, lose_the_driver, steps):
    """The target holds a key twice, in one partition; both rows move to another, the first is empty then."""
    table, columns = f"{layers.silver}.t", "k string, p string, v int"
    twice = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 1)], columns)
    sm.merge_table(spark, twice, table, ["k"], ["p"])
    moved = spark.createDataFrame([("a", "z", 9)], columns)
    lost = lose_the_driver(steps, lambda: sm.merge_table(spark, moved, table, ["k"], ["p"]))
    assert lost == (steps < 5)   # note, overwrite, drop a partition, strike the note, append
    sm.merge_table(spark, moved, table, ["k"], ["p"])
    assert sorted(map(tuple, spark.table(table).select("k", "p", "v").collect())) == [
        ("a", "z", 9), ("a", "z", 9), ("b", "y", 1)
    ]


def test_new_rows_leave_the_files_of_their_month(spark, layers):
    """One new line in a month of a thousand is a file of its own; an update rewrites the month."""
    month = [(f"O{k}", "C", "P", 2020, 1, k) for k in range(1000)]
    sm.merge_silver_orders(spark, lines(spark, *month), layers=layers)
    before = partition_files(spark, layers, "order_month = 1")
    sm.merge_silver_orders(spark, lines(spark, ("N1", "C", "P", 2020, 1, 5)), layers=layers)
    after = partition_files(spark, layers, "order_month = 1")
    assert before < after and len(after - before) == 1
    sm.merge_silver_orders(spark, lines(spark, ("O7", "C", "P", 2020, 1, -1)), layers=layers)
    assert not partition_files(spark, layers, "order_month = 1") & after
    got = stored(spark, layers)
    assert len(got) == 1001 and sum(q for *_, q in got) == sum(range(1000)) + 5 - 7 - 1


def test_rows_of_an_emptied_partition_do_not_come_back(spark, layers):
    """The last line leaves a month, and a partition without a date; later a new line comes to each."""
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", 2020, 1, 1), ("O2", "C", "P", None, None, 1)), layers=layers)
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", 2020, 2, 2), ("O2", "C", "P", 2020, 2, 2)), layers=layers)
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {layers.silver}.orders_enriched").collect()}
    assert parts == {"order_year=2020/order_month=2"}
    sm.merge_silver_orders(spark, lines(spark, ("O3", "C", "P", 2020, 1, 3), ("O4", "C", "P", None, None, 3)), layers=layers)
    got = sm.load_silver_table(spark, "orders_enriched", layers)
    assert sorted((r["order_id"], r["quantity"]) for r in got.collect()) == [("O1", 2), ("O2", 2), ("O3", 3), ("O4", 3)]


def test_a_published_merge_leaves_no_scratch_folder(spark, layers):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = os.listdir(shared) if os.path.exists(shared) else []
    rows = [("O1", "C", "P", 2020, 1, 1), ("O2", "C", "P", 2020, 2, 1)]
    for quantity in (1, 2):
        changed = [(*row[:-1], quantity) for row in rows] + [(f"N{quantity}", "C", "P", 2020, 3, 1)]
        sm.merge_silver_orders(spark, lines(spark, *changed), layers=layers, on_duplicate="latest", order_by=["quantity"])
        sm.merge_silver_customers(spark, spark.createDataFrame(
            [("D1", "Iris", quantity)], "customer_id string, customer_name string, size int"
        ), layers=layers, buckets=4)
    assert sorted(os.listdir(shared)) == sorted(before) and len(stored(spark, layers)) == 4


# -- tables in buckets ------------------------------------------------------------------------


def customers_of(spark, *rows):
    return spark.createDataFrame(list(rows), "customer_id string, customer_name string, segment string")


def bucket_files(spark, layers):
    df = sm.load_silver_table(spark, "customers_enriched", layers)
    return {r[0]: r[1] for r in df.select("_metadata.file_path", "key_bucket").distinct().collect()}


def test_merges_rewrite_hit_buckets_only(spark, layers):
    many = [(f"D{k}", f"name {k}", "Consumer") for k in range(200)] + [(None, "nobody", "Consumer")]
    sm.merge_silver_customers(spark, customers_of(spark, *many), layers=layers, buckets=16)
    before = bucket_files(spark, layers)
    assert set(before.values()) == set(range(16))
    # The number of buckets is the table's, whatever a later merge names.
    changes = customers_of(spark, ("D7", "name 7", "Corporate"), (None, "nobody", "Corporate"))
    sm.merge_silver_customers(spark, changes, layers=layers, buckets=3)
    after = bucket_files(spark, layers)
    hit = {before[f] for f in set(before) - set(after)}
    got = sm.load_silver_table(spark, "customers_enriched", layers)
    assert hit == {r[0] for r in got.where("customer_id = 'D7'").select("key_bucket").collect()}
    assert got.count() == 202 and got.where("segment = 'Corporate'").count() == 2
    assert got.where("customer_id = 'D7'").first().segment == "Corporate"
    with pytest.raises(ValueError, match="customer_id"):
        sm.merge_silver_customers(spark, changes, layers=layers, keys=["customer_name"])
    assert sm.load_silver_table(spark, "customers_enriched", layers).count() == 202


def test_keys_are_looked_for_in_the_buckets_of_the_source(spark, layers):
    from salesmill.operators.upsert import stage_source

    many = [(f"D{k}", f"name {k}", "Consumer") for k in range(200)]
    sm.merge_silver_customers(spark, customers_of(spark, *many), layers=layers, buckets=16)
    target = sm.load_silver_table(spark, "customers_enriched", layers)
    read = []
    original = type(target).where
    try:
        type(target).where = lambda self, condition: read.append(found := original(self, condition)) or found
        source = target.where("customer_id IN ('D7', 'D9')")
        read.clear()
        stage_source(target, source, ["customer_id"], ["key_bucket"], co_located=["key_bucket"])
    finally:
        type(target).where = original
    pruned = next(df for df in read if "key_bucket" in df.columns and "segment" in df.columns)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan
    assert len(pruned.inputFiles()) <= 2 < len(target.inputFiles())


def test_the_merge_command_names_keys_and_all_columns(spark, layers):
    """What formats with a merge of their own are given, as Spark parses it."""
    from salesmill.sinks.merge import merge_condition, _native_merge

    assert merge_condition("silver.t", ["a key", "b`"]) == "`silver`.`t`.`a key` = source.`a key` AND `silver`.`t`.`b``` = source.`b```"
    table = f"{layers.silver}.t"
    df = spark.createDataFrame([("a", 1, 2)], "k string, v int, w int")
    sm.save_table(spark, df, table)
    with pytest.raises(Exception, match="MERGE INTO TABLE") as refused:
        _native_merge(df, table, ["k"])
    assert "not supported" in str(refused.value).lower() or "UNSUPPORTED" in str(refused.value)


def test_other_formats_are_refused(spark, layers):
    with pytest.raises(ValueError, match="orc"):
        sm.Layers(table_format="orc")
    table = f"{layers.silver}.t"
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    df.write.format("orc").saveAsTable(table)
    with pytest.raises(ValueError, match="orc"):
        sm.merge_table(spark, df, table, ["k"])
    with pytest.raises(ValueError, match="orc"):
        sm.merge_table(spark, df, table, ["k"], table_format="orc")
    assert spark.table(table).count() == 1
    with pytest.raises(ValueError, match="overwrit"):
        sm.save_table(spark, df, f"{layers.silver}.u", mode="overwritten")


def test_typed_partitions_are_rewritten_singly(spark, layers):
    table, columns = f"{layers.silver}.t", "k string, day date, b boolean, v int"
    rows = lambda *r: spark.createDataFrame([(k, dt.date(2020, 1, d), b, v) for k, d, b, v in r], columns)
    sm.merge_table(spark, rows(("a", 1, True, 1), ("c", 2, False, 1)), table, ["k"], ["day", "b"])
    files = lambda where: {r[0] for r in spark.table(table).where(where).select("_metadata.file_path").collect()}
    before = files("k = 'c'")
    sm.merge_table(spark, rows(("a", 1, True, 2), ("d", 3, True, 1)), table, ["k"], ["day", "b"])
    assert files("k = 'c'") == before
    assert sorted((r.k, r.v) for r in spark.table(table).collect()) == [("a", 2), ("c", 1), ("d", 1)]


def test_old_loads_go_and_live_ones_stay(spark, layers):
    table = f"{layers.silver}.orders_enriched"
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", 2020, 1, 1), ("O2", "C", "P", 2020, 2, 1)), layers=layers)
    for quantity in (2, 3):
        sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", 2020, 1, quantity)), layers=layers)
    # Merges write into the folder that the table has.
    assert sm.drop_old_loads(spark, table, 0) == []
    assert stored(spark, layers) == [("O1", "P", 2020, 1, 3), ("O2", "P", 2020, 2, 1)]
    sm.save_silver_table(spark, lines(spark, ("O5", "C", "P", 2020, 2, 1)), "orders_enriched", sm.ORDER_PARTITIONS, layers=layers)
    assert sm.drop_old_loads(spark, table, 3600) == [] and len(sm.drop_old_loads(spark, table, 0)) == 1
    spark.catalog.refreshTable(table)
    assert stored(spark, layers) == [("O5", "P", 2020, 2, 1)]
    sm.save_bronze_table(spark, spark.range(3), "t", layers=layers)
    sm.save_bronze_table(spark, spark.range(2), "t", layers=layers)
    assert len(sm.drop_old_loads(spark, f"{layers.bronze}.t", 0)) == 1
    assert sm.load_bronze_table(spark, "t", layers).count() == 2


def test_lines_without_a_date_have_a_partition_too(spark, layers):
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", None, None, 1), ("O2", "C", "P", 2020, 2, 1)), layers=layers)
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", None, None, 3), ("O3", "C", "P", None, None, 1)), layers=layers)
    got = sm.load_silver_table(spark, "orders_enriched", layers)
    assert {(r["order_id"], r["quantity"]) for r in got.collect()} == {("O1", 3), ("O2", 1), ("O3", 1)}


def test_partitions_of_other_types(spark, layers):
    table = f"{layers.silver}.t"
    columns = "k string, region string, v int"
    first = spark.createDataFrame([("a", "North/East 1", 1), ("b", "South", 1)], columns)
    sm.merge_table(spark, first, table, ["k"], ["region"])
    sm.merge_table(spark, spark.createDataFrame([("a", "South", 2)], columns), table, ["k"], ["region"])
    assert {(r["k"], r["region"], r["v"]) for r in spark.table(table).collect()} == {("a", "South", 2), ("b", "South", 1)}


def test_refused_merge_leaves_the_table(spark, layers):
    sm.merge_silver_orders(spark, lines(spark, ("O1", "C", "P", 2020, 1, 1)), layers=layers)
    twice = lines(spark, ("O1", "C", "P", 2020, 1, 2), ("O1", "C", "P", 2020, 1, 3))
    with pytest.raises(sm.AmbiguousSourceError):
        sm.merge_silver_orders(spark, twice, layers=layers)
    assert stored(spark, layers) == [("O1", "P", 2020, 1, 1)]
    sm.merge_silver_orders(spark, twice, layers=layers, on_duplicate="latest", order_by=["quantity"])
    assert stored(spark, layers) == [("O1", "P", 2020, 1, 3)]


def test_merge_rows_share_one_stamp(spark, layers, silver):
    sm.merge_silver_orders(spark, silver[2], layers=layers)
    sm.merge_silver_orders(spark, silver[2], layers=layers)
    got = sm.load_silver_table(spark, "orders_enriched", layers)
    assert got.select("updated_at").distinct().count() == 1 and got.count() == 3


# -- jobs -----------------------------------------------------------------------------------


def test_all_layers_twice(spark, layers, customers, products, orders):
    for _ in range(2):
        report = sm.run_all(spark, customers, products, orders, layers)
        assert report.where("status = 'PASSED'").count() == 14
        sm.require_passed(report)
    reports = sm.run_reports(spark, layers)
    assert reports["profit_by_year"].first()["total_profit"] == Decimal("76.55")
    assert set(reports) == {
        "profit_by_year", "profit_by_year_category", "profit_by_customer",
        "profit_by_customer_year", "profit_by_year_subcategory", "top_categories",
    }


def test_hosted_form_twice(spark, layers, customers, products, orders):
    moved = customers.withColumn("State", F.lit("Elsewhere"))
    twice = orders.union(orders)
    for _ in range(2):
        sm.ingest_bronze(spark, customers.union(moved).limit(6), products, twice, layers)
        fewer = {**sm.HOSTED_FORM, "merge_options": {
            **sm.HOSTED_FORM["merge_options"],
            "customers": {"on_duplicate": "latest", "order_by": ["state"]},
        }}
        sm.build_silver(spark, layers, **fewer)
    got = sm.load_silver_table(spark, "orders_enriched", layers)
    assert got.count() == 3 and "row_id" in got.columns and "product_name" not in got.columns
    assert sm.load_silver_table(spark, "customers_enriched", layers).count() == 3


def test_an_orphan_stops_the_silver_job_before_it_writes(spark, layers, customers, products, orders):
    sm.ingest_bronze(spark, customers.limit(1), products, orders, layers)
    with pytest.raises(sm.DataQualityException):
        sm.build_silver(spark, layers)
    assert not spark.catalog.tableExists(f"{layers.silver}.orders_enriched")


def test_files_that_lack_a_column_are_not_ingested(spark, layers, customers, products, orders):
    with pytest.raises(sm.DataQualityException, match="Region"):
        sm.ingest_bronze(spark, customers.drop("Region"), products, orders, layers)


def test_session_and_scratch_folder(spark, session_conf, tmp_path):
    sized = sm.get_spark_session(layers=sm.Layers(root=str(tmp_path)), input_bytes=10**12)
    assert sized.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "7451"
    sized.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert {"bronze", "silver", "gold"} <= {d.name for d in spark.catalog.listDatabases()}
    shared = spark.conf.get("spark.checkpoint.dir")
    assert sm.scratch_folder(spark, "x").startswith(f"{shared}/x-")


def test_a_reload_keeps_the_table_and_changes_its_folder(spark, layers, products):
    def describe():
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {layers.bronze}.t").collect()
        return {r["col_name"]: r["data_type"] for r in rows}

    sm.save_bronze_table(spark, products, "t", layers=layers)
    first = describe()
    sm.save_bronze_table(spark, products.limit(1), "t", layers=layers)
    second = describe()
    assert first["Created Time"] == second["Created Time"] and first["Location"] != second["Location"]
    assert sm.load_bronze_table(spark, "t", layers).count() == 1
    sm.save_silver_table(spark, products, "t", ["State"], layers=layers)
    sm.save_silver_table(spark, products.limit(2), "t", layers=layers)
    assert sm.load_silver_table(spark, "t", layers).columns == products.columns


def test_formats_with_a_merge_of_their_own_get_one(spark, layers):
    """No such format is installed; Spark resolves the statement and names what it lacks."""
    table = f"{layers.silver}.t"
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    sm.save_table(spark, df, table)
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        sm.merge_table(spark, df, table, ["k"], table_format="delta")


def test_first_load_may_be_reduced_to_the_latest_rows_too(spark, layers):
    twice = lines(spark, ("O1", "C", "P", 2020, 1, 2), ("O1", "C", "P", 2020, 1, 3), (None, "C", "P", 2020, 1, 1))
    sm.merge_silver_orders(spark, twice, layers=layers, on_duplicate="latest", order_by=["quantity"])
    got = sm.load_silver_table(spark, "orders_enriched", layers)
    assert sorted(r["quantity"] for r in got.collect()) == [1, 3]
