import pytest
from pyspark.sql import functions as F

import salesmill as sm
from salesmill.schemas import CUSTOMER_BRONZE, ORDER_ENRICHED, column_names


def test_schema_check(customers):
    sm.validate_schema(customers, ["Customer ID"], "customers")
    with pytest.raises(sm.DataQualityException, match="Missing columns") as failure:
        sm.validate_schema(customers, ["Customer ID", "Loyalty", "Tier"], "customers")
    assert "Loyalty" in str(failure.value) and "Tier" in str(failure.value)


def test_null_check_reports_every_bad_column(spark):
    df = spark.createDataFrame([("C1", None, 1), (None, None, 2)], "customer_id string, name string, n int")
    sm.check_null_completeness(df, ["n"], "customers")
    sm.check_null_completeness(df, [], "customers")
    with pytest.raises(sm.DataQualityException, match="is null in") as failure:
        sm.check_null_completeness(df, ["customer_id", "name", "n"], "customers")
    assert "customer_id is null in 1" in str(failure.value) and "name is null in 2" in str(failure.value)


def test_uniqueness_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("C1", "a"), ("C1", "b"), (None, "c"), (None, "c")], "id string, v string")
    sm.check_uniqueness(df.where("v <> 'c'"), ["id", "v"], "t")
    with pytest.raises(sm.DataQualityException, match="2 row"):
        sm.check_uniqueness(df, ["id"], "t")
    assert tuple(sm.uniqueness_report(df, ["id", "v"], "t").first()) == ("t", 4, 3, 1)


def test_orphans_are_distinct_non_null_keys(spark):
    parent = spark.createDataFrame([("C1",), ("C2",), (None,)], "id string")
    child = spark.createDataFrame([("C1",), ("C9",), ("C9",), ("C8",), (None,)], "customer string")
    with pytest.raises(sm.DataQualityException, match="2 key"):
        sm.check_referential_integrity(child, parent, "customer", "id", "child->parent")
    sm.check_referential_integrity(child.where("customer = 'C1'"), parent, "customer", "id", "r")
    assert {r[0] for r in sm.orphan_keys(child, parent, "customer", "id").collect()} == {"C8", "C9"}


def test_null_report(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "`a b` string, c int")
    got = sm.null_report(df, ["a b", "c"], "t").collect()
    assert {(r["column_name"], r["null_count"]) for r in got} == {("a b", 2), ("c", 0)}


def test_conformance_report(spark, silver):
    got = {r["column_name"]: r for r in sm.conformance_report(silver[2], ORDER_ENRICHED, "o").collect()}
    assert len(got) == 22 and all(r["expected_type"] == r["actual_type"] for r in got.values())
    assert all(r["null_violations"] == 0 for r in got.values())
    changed = silver[2].drop("region").withColumn("price", F.lit(None).cast("int"))
    got = {r["column_name"]: r for r in sm.conformance_report(changed, ORDER_ENRICHED, "o").collect()}
    assert got["region"]["actual_type"] is None
    assert got["price"]["actual_type"] == "int" and got["price"]["null_violations"] == 3


def test_row_preservation(orders, silver):
    customers, products, enriched = silver
    assert tuple(sm.row_preservation(orders, enriched).first()) == (3, 3, True)
    fanned = sm.enrich_order(orders, customers, products.union(products))
    assert tuple(sm.row_preservation(orders, fanned).first()) == (3, 6, False)


def suite(spark, customers, products, orders, **changed):
    c, p = sm.enrich_customer(customers), sm.enrich_product(products)
    o = sm.enrich_order(orders, c, p)
    frames = dict(customers_bronze=customers, products_bronze=products, orders_bronze=orders,
                  customers_silver=c, products_silver=p, orders_silver=o,
                  profit_aggregate=sm.create_profit_aggregate(o))
    report = sm.quality_suite(spark, **{**frames, **changed})
    return report, {r["check_no"]: (r["status"], r["violations"]) for r in report.collect()}


def test_suite_passes_on_clean_tables(spark, customers, products, orders):
    report, got = suite(spark, customers, products, orders)
    assert got == {n: ("PASSED", 0) for n in range(1, 15)}
    sm.require_passed(report)


def test_each_check_of_the_suite_can_fail(spark, customers, products, orders):
    blank = customers.withColumn("Segment", F.lit(None).cast("string"))
    report, got = suite(
        spark, blank.union(blank), products.withColumn("Category", F.lit(None).cast("string")).union(products),
        orders.withColumn("Customer ID", F.lit("nobody")).withColumn("Product ID", F.lit("nothing")),
    )
    assert {n for n in got if got[n][0] == "FAILED"} == {4, 5, 6, 7, 8, 9, 14}
    assert (got[4][1], got[6][1], got[5][1], got[7][1], got[8][1], got[9][1]) == (6, 3, 3, 3, 1, 1)
    with pytest.raises(sm.DataQualityException, match="7 check"):
        sm.require_passed(report)


def test_schema_checks_of_the_suite_can_fail(spark, customers, products, orders):
    c, p = sm.enrich_customer(customers), sm.enrich_product(products)
    o = sm.enrich_order(orders, c, p)
    report = sm.quality_suite(
        spark, customers.drop("Region"), products.drop("State"), orders.drop("Profit", "Price"),
        c.drop("email_domain"), p.drop("product_state"), o.drop("profit"),
        sm.create_profit_aggregate(o).drop("total_sales"),
    )
    failed = {r["check_no"]: r["violations"] for r in report.where("status = 'FAILED'").collect()}
    assert failed == {1: 1, 2: 1, 3: 2, 10: 1, 11: 1, 12: 1, 13: 1}
    assert report.count() == 14


def test_checks_that_lack_a_column_report_it(spark, customers, products, orders):
    report, got = suite(spark, customers, products, orders)
    gold = sm.create_profit_aggregate(sm.enrich_order(orders, sm.enrich_customer(customers), sm.enrich_product(products)))
    report = sm.quality_suite(
        spark, customers.drop("Segment", "Customer ID"), products, orders.drop("Product ID"),
        sm.enrich_customer(customers), sm.enrich_product(products),
        sm.enrich_order(orders, sm.enrich_customer(customers), sm.enrich_product(products)), gold.drop("year"),
    )
    failed = {r["check_no"]: r["violations"] for r in report.where("status = 'FAILED'").collect()}
    assert failed == {1: 2, 3: 1, 4: None, 6: None, 8: None, 9: None, 13: 1, 14: None} and report.count() == 14


def test_references_share_a_scan_of_the_orders(spark, customers, products, orders, tmp_path):
    orders.write.parquet(str(tmp_path / "orders"))
    c, p = sm.enrich_customer(customers), sm.enrich_product(products)
    o = sm.enrich_order(orders, c, p)
    report = sm.quality_suite(
        spark, customers, products, spark.read.parquet(str(tmp_path / "orders")), c, p, o, sm.create_profit_aggregate(o)
    )
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_layout_names_are_complete():
    assert len(column_names(CUSTOMER_BRONZE)) == 11 and len(column_names(ORDER_ENRICHED)) == 22
    assert ORDER_ENRICHED["profit"].dataType.simpleString() == "decimal(10,2)"


def test_rejects_of_the_loads_are_checks_of_their_own(spark, customers, products, orders):
    silver = [sm.enrich_customer(customers), sm.enrich_product(products)]
    silver.append(sm.enrich_order(orders, *silver))
    rejects = spark.createDataFrame(
        [("products", 9, 2, None), ("products", 9, 1, "State"), ("customers", 3, 0, None)],
        "source string, records bigint, rejected bigint, field string",
    )
    given = (spark, customers, products, orders, *silver, sm.create_profit_aggregate(silver[2]))
    suite = sm.quality_suite(*given, rejects=rejects)
    assert sm.quality_suite(*given).count() == 14 and suite.count() == 16
    assert sorted(map(tuple, suite.where("check_no > 14").collect())) == [
        (15, "source", "rejected", "customers", "PASSED", 0), (16, "source", "rejected", "products", "FAILED", 3),
    ]
    with pytest.raises(sm.DataQualityException, match="source.products rejected: 3"):
        sm.require_passed(suite)
