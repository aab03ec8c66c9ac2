from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import salesmill as sm
from salesmill.schemas import (
    CUSTOMER_ENRICHED,
    ORDER_ENRICHED,
    PRODUCT_ENRICHED,
    PROFIT_AGGREGATE,
)


def same_layout(df, schema):
    assert {f.name: f.dataType for f in df.schema.fields} == {f.name: f.dataType for f in schema.fields}


def test_layouts(silver):
    for df, schema in zip(silver, (CUSTOMER_ENRICHED, PRODUCT_ENRICHED, ORDER_ENRICHED)):
        same_layout(df, schema)
    same_layout(sm.create_profit_aggregate(silver[2]), PROFIT_AGGREGATE)


def test_renaming_passes_over_missing_columns(spark):
    few = spark.createDataFrame([("C", "N", "S")], ["Customer ID", "Customer Name", "Other"])
    assert sm.standardize_customer_columns(few).columns == ["customer_id", "customer_name", "Other"]


def test_row_id_and_state_names(orders, products):
    assert "Row ID" in sm.standardize_order_columns(orders).columns
    assert "row_id" in sm.standardize_order_columns(orders, keep_row_id=True).columns
    assert "state" in sm.enrich_product(products, state_name="state").columns


def test_enriched_orders(silver):
    rows = {r["order_id"]: r for r in silver[2].collect()}
    assert len(rows) == 3
    first = rows["R-7001"]
    assert (first["customer_name"], first["country"], first["segment"]) == ("Ada Brandt", "Germany", "Consumer")
    assert (first["category"], first["sub_category"], first["price_per_unit"]) == ("Garden", "Tools", 24.5)
    assert (first["order_year"], first["order_month"], first["order_quarter"]) == (2019, 5, 2)
    assert first["profit"] == Decimal("21.40") and first["days_to_ship"] == 3
    assert rows["R-8001"]["days_to_ship"] is None


def test_unknown_customer_is_kept_by_left_and_dropped_by_inner(orders, silver):
    customers, products, _ = silver
    fewer = customers.where("customer_id <> 'K-101'")
    kept = sm.enrich_order(orders, fewer, products)
    assert kept.count() == 3 and kept.where("customer_name IS NULL").count() == 1
    assert sm.enrich_order(orders, fewer, products, how="inner").count() == 2


def test_repeated_product_fans_out_unless_deduplicated(orders, silver):
    customers, products, _ = silver
    repeated = products.union(products)
    assert sm.enrich_order(orders, customers, repeated).count() == 6
    assert sm.enrich_order(orders, customers, repeated, dedup=True).count() == 3
    dearer = products.union(products.withColumn("price_per_unit", F.col("price_per_unit") + 1))
    assert sm.enrich_order(orders, customers, dearer, dedup=True).count() == 6


def test_dedup_of_inputs_equals_dedup_after_each_join(orders, silver):
    customers, products, _ = silver
    moved = customers.withColumn("state", F.lit("Elsewhere"))
    c = customers.union(customers).union(moved)
    p = products.union(products).union(products.withColumn("price_per_unit", F.lit(1.0)))
    o = orders.union(orders).union(orders.withColumn("Profit", F.col("Profit") + 0.0001))
    got = sm.enrich_order(o, c, p, "inner", dedup=True, keep_row_id=True, product_name=False)

    lines = sm.standardize_order_columns(o, keep_row_id=True)
    step = lines.join(c.select("customer_id", "customer_name", "country", "segment", "region", "state"),
                      "customer_id").dropDuplicates()
    listings = p.select("product_id", "category", "sub_category", "price_per_unit").dropDuplicates()
    step = step.join(listings, "product_id").dropDuplicates()
    step = sm.round_profit_to_2_decimals(sm.calculate_days_to_ship(sm.add_date_fields(step)))
    want = step.select(*got.columns).dropDuplicates()   # the state and the exact profit are gone
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 6


def test_gold_values(spark):
    columns = ("order_year int, category string, sub_category string, customer_id string, customer_name string, "
               "country string, profit double, price double, quantity int, order_id string")
    df = spark.createDataFrame([
        (2023, "Garden", "Tools", "C1", "Una", "Chile", 100.0, 200.0, 2, "O1"),
        (2023, "Garden", "Tools", "C1", "Una", "Chile", 50.0, 100.0, 3, "O2"),
        (2023, "Garden", "Tools", "C1", "Una", "Chile", 0.005, 0.004, 1, None),
    ], columns)
    row = sm.create_profit_aggregate(df).first()
    assert (row["total_profit"], row["total_sales"], row["order_count"]) == (Decimal("150.01"), Decimal("300.00"), 2)
    assert sm.create_profit_aggregate(df, "price_x_qty").first()["total_sales"] == Decimal("700.00")
    with pytest.raises(ValueError):
        sm.create_profit_aggregate(df, "other")


def test_gold_order_is_year_then_group_then_highest_profit(silver):
    got = sm.create_profit_aggregate(silver[2], ordered=True).collect()
    assert [(r["year"], r["category"]) for r in got] == [
        (2019, "Garden"), (2019, "Kitchen"), (2020, "Paper")
    ]


def test_statistics(silver):
    stats = sm.profit_statistics(silver[2]).first()
    assert tuple(stats) == (3, Decimal("46.50"), Decimal("-30.05"), Decimal("55.15"))
    gold = sm.create_profit_aggregate(silver[2])
    assert tuple(sm.aggregate_statistics(gold).first()) == (3, 2, 3, 3)


def test_rollups(silver):
    gold = sm.create_profit_aggregate(silver[2])
    years = [(r["year"], r["total_profit"], r["order_count"]) for r in sm.profit_by_year(gold).collect()]
    assert years == [(2019, Decimal("76.55"), 2), (2020, Decimal("-30.05"), 1)]
    best = sm.top_categories(gold, 1).collect()
    assert [(r["category"], r["category_profit"], r["total_orders"]) for r in best] == [("Kitchen", Decimal("55.15"), 1)]
    assert [r["customer_id"] for r in sm.profit_by_customer(gold, 2).collect()] == ["K-205", "K-101"]
    assert sm.profit_by_customer(gold, None).count() == 3
    assert [r["year"] for r in sm.profit_by_customer_year(gold).collect()] == [2019, 2019, 2020]
    assert "total_sales" not in sm.profit_by_year_subcategory(gold).columns
    assert sm.profit_by_year_category(gold).count() == 3


def test_ties_at_a_limit_come_out_the_same(spark):
    columns = ("year int, category string, sub_category string, customer_id string, customer_name string, "
               "country string, total_profit decimal(15,2), total_sales decimal(15,2), order_count bigint")
    rows = [(2020, "a", "b", f"C{i:03}", "n", "x", Decimal(1), Decimal(1), 1) for i in range(100)]
    for parts in (1, 3, 8):
        gold = spark.createDataFrame(rows[::-1], columns).repartition(parts)
        assert [r["customer_id"] for r in sm.profit_by_customer(gold, 5).collect()] == [f"C{i:03}" for i in range(5)]


def test_row_operators(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, v int")
    assert {(r["k"], r["copies"]) for r in sm.duplicate_keys(df, ["k"]).collect()} == {("a", 3), (None, 2)}
    assert sm.distinct_values(df).count() == 3 and sm.distinct_values(df, ["k"]).count() == 2
    other = spark.createDataFrame([("a", 1), ("a", 1), (None, 3), ("z", 9)], "k string, v int")
    assert {tuple(r) for r in sm.common_values(df, other).collect()} == {("a", 1), (None, 3)}
    latest = sorted(map(tuple, sm.keep_latest(df, ["k"], ["v"]).collect()), key=str)
    assert latest == [("a", 2), (None, 3), (None, 3)]
    assert [r["v"] for r in sm.sample(df, ["v"], ["v"], 2).collect()] == [1, 1]
    odd = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 1, "z")], "`k.1` string, v int, `w.1` string")
    assert sorted(map(tuple, sm.keep_latest(odd, ["k.1"], ["v"]).collect()), key=str) == [("a", 1, "y"), (None, 1, "z")]


def test_latest_rows_read_their_input_once(spark, tmp_path):
    spark.range(10).selectExpr("id % 3 as k", "id as v").write.parquet(str(tmp_path / "t"))
    latest = sm.keep_latest(spark.read.parquet(str(tmp_path / "t")), ["k"], ["v"])
    assert latest._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert sorted(map(tuple, latest.collect())) == [(0, 9), (1, 7), (2, 8)]


def test_layer_audit_counts_rows_with_nulls_unless_told_not_to(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    assert tuple(sm.layer_audit({"t": (df, None)}).first()) == ("t", 3, 2)
    assert tuple(sm.layer_audit({"t": (df, None)}, skip_nulls=True).first()) == ("t", 3, 1)
    assert tuple(sm.layer_audit({"t": (df, ["k"])}).first()) == ("t", 3, 2)
    assert tuple(sm.layer_counts({"t": df}).first()) == ("t", 3)


def odd_rows(spark):
    rows = [("a", 1, 0.0), ("a", 1, -0.0), ("a", None, 1.0), (None, 1, 1.0), (None, 1, 1.0), ("", 1, float("nan"))] * 2
    rows += [(f"k{i}", i, float(i)) for i in range(50)]
    return spark.createDataFrame(rows, "k string, `v.1` int, w double")


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_distinct_rows_with_equal_fingerprints(spark, monkeypatch, bits):
    """Fingerprints cut to few bits meet by chance: rows stay distinct all the same."""
    from salesmill.operators import rows as row_operators

    whole = row_operators.row_fingerprint
    monkeypatch.setattr(
        row_operators, "row_fingerprint", lambda columns: [F.pmod(h, F.lit(1 << bits)) if bits < 63 else h for h in whole(columns)]
    )
    df = odd_rows(spark)
    got, want = (sorted(map(repr, map(tuple, x.collect()))) for x in (sm.distinct_rows(df), df.distinct()))
    assert got == want and len(want) == 54
    assert sm.distinct_rows(df.limit(0)).count() == 0


def shuffled_bytes(df):
    """Bytes that the exchanges of a query wrote when it ran."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("dataSize").value() if name == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_audits_shuffle_fingerprints_in_place_of_rows(spark):
    df = odd_rows(spark).withColumn("text", F.repeat(F.col("k"), 100))
    for skip_nulls in (False, True):
        by_print, by_row = (sm.layer_audit({"t": (df, None)}, skip_nulls, whole_rows=w) for w in (False, True))
        assert shuffled_bytes(by_print) < shuffled_bytes(by_row) / 2
        assert by_print.collect() == by_row.collect()


def test_distinct_lines_are_not_made_distinct_again_after_the_joins(spark, orders, silver):
    customers, products, _ = silver
    near = orders.withColumn("Profit", F.col("Profit") + 0.001)
    unknown = orders.limit(1).withColumns({"Customer ID": F.lit("nobody"), "Profit": F.lit(1e12)})
    lines = orders.unionByName(near).unionByName(orders).unionByName(unknown)
    dearer = products.unionByName(products.withColumn("product_state", F.lit("other")))
    plain = sm.enrich_order(lines.where("`Customer ID` <> 'nobody'"), customers, dearer, "inner").drop("product_name").distinct()
    # A profit without cents raises only if its line has a customer.
    got = sm.enrich_order(lines, customers, dearer, "inner", dedup=True, product_name=False)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() == 3
    above_joins = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in above_joins
    with pytest.raises(Exception, match="CAST|NUMERIC"):
        sm.enrich_order(lines, customers, dearer, dedup=True).collect()


@pytest.mark.parametrize("seen_from", [1, 10**9])
def test_latest_rows_of_many_move_only_where_a_key_repeats(spark, monkeypatch, seen_from):
    monkeypatch.setattr("salesmill.operators.key_filter.FILTER_FROM", seen_from)
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 100 <> 0 THEN concat('k', id % 2900) END AS `a k`", "cast(id % 7 AS int) AS v", "repeat('x', 50) AS w", "id"
    )
    by_key = {}
    for r in df.collect():
        key = r["a k"] if r["a k"] is not None else r["id"]
        by_key[key] = max(by_key.get(key, (-1,)), (r["v"], r["id"]))
    latest = sm.keep_latest(df, ["a k"], ["v", "id"])
    assert latest.columns == df.columns
    assert sorted((r["v"], r["id"]) for r in latest.collect()) == sorted(by_key.values())
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert ("Union" in plan) == (seen_from == 1)
    # Keys that do not repeat stay where they are: a fifteenth of the rows is grouped, filter's mistakes included.
    if seen_from == 1:
        assert shuffled_bytes(latest) < shuffled_bytes(df.groupBy("a k").agg(F.max(F.struct(*df.columns)))) / 2


def test_no_row_moves_where_no_key_and_no_row_repeats(spark, monkeypatch):
    monkeypatch.setattr("salesmill.operators.key_filter.FILTER_FROM", 1)
    df = spark.range(500).selectExpr("id AS k", "-0.0D AS v")
    for whole in (sm.keep_latest(df, ["k"], ["v"]), sm.distinct_rows(df)):
        assert "Aggregate" not in whole._jdf.queryExecution().optimizedPlan().toString() and whole.count() == 500
    assert {str(r["v"]) for r in sm.distinct_rows(df).collect()} == {"0.0"}
