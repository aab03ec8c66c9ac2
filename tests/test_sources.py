import datetime as dt
import json

import pytest
from pyspark.sql import Observation

import salesmill as sm
from salesmill.schemas import CUSTOMER_BRONZE, PRODUCT_BRONZE, column_names

ORDERS = [
    {"Row ID": 1, "Order ID": "A", "Order Date": "21/8/2016", "Ship Date": "25/08/2016", "Ship Mode": "First",
     "Customer ID": "C1", "Product ID": "P1", "Quantity": 7, "Price": 573.17, "Discount": 0.3, "Profit": 63.69},
    {"Row ID": 2, "Order ID": "B", "Order Date": "01/12/2016", "Ship Date": None, "Ship Mode": None,
     "Customer ID": "C2", "Product ID": "P2", "Quantity": 2, "Price": 1.5, "Discount": None, "Profit": -2.0},
    {"Row ID": 3, "Order ID": "C", "Order Date": "31/2/2016", "Ship Date": "garbage", "Ship Mode": "First",
     "Customer ID": "C3", "Product ID": "P3", "Quantity": "many", "Price": 1.5, "Discount": 0.0, "Profit": 1.0},
]


def check_orders(df):
    rows = {r["Row ID"]: r for r in df.collect()}
    assert len(rows) == 3
    assert rows[1]["Order Date"] == dt.date(2016, 8, 21)
    assert rows[1]["Ship Date"] == dt.date(2016, 8, 25)
    assert rows[2]["Order Date"] == dt.date(2016, 12, 1) and rows[2]["Ship Date"] is None
    assert rows[3]["Order Date"] is None and rows[3]["Ship Date"] is None
    assert rows[3]["Quantity"] is None and rows[3]["Price"] == 1.5
    assert dict(df.dtypes)["Order Date"] == "date"


def test_orders_from_a_document(spark, tmp_path):
    path = tmp_path / "Orders.json"
    path.write_text(json.dumps(ORDERS, indent=2))
    check_orders(sm.load_order_data(spark, str(path), multi_line=True))


def test_a_document_is_read_without_going_back_to_it(spark, tmp_path):
    path = tmp_path / "Orders.json"
    many = [{**ORDERS[0], "Row ID": i, "Price": i + 0.25, "Discount": 0.5, "Profit": -i - 0.5} for i in range(1000)]
    path.write_text(json.dumps(many, indent=2))

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")

    before = bytes_read()
    rows = sm.load_order_data(spark, str(path), multi_line=True).orderBy("Row ID").collect()
    assert bytes_read() - before < 6 * path.stat().st_size
    assert [(r["Row ID"], r["Price"], r["Profit"]) for r in rows] == [(i, i + 0.25, -i - 0.5) for i in range(1000)]


def test_documents_keep_numbers_as_they_are_spelled(spark, tmp_path):
    path = tmp_path / "Orders.json"
    path.write_text(json.dumps([{**ORDERS[0], "Order ID": "spelled"}], indent=2).replace('"spelled"', "12.50"))
    (tmp_path / "none").mkdir()
    assert sm.load_order_data(spark, str(path), multi_line=True).first()["Order ID"] == "12.50"
    (tmp_path / "none" / "Orders.json").write_text("")
    assert sm.load_order_data(spark, str(tmp_path / "none"), multi_line=True).count() == 0
    path.write_text(json.dumps(ORDERS, indent=2)[:-3])
    kept = sm.load_order_data(spark, str(path), multi_line=True, corrupt_column="corrupt")
    assert kept.where("corrupt is not null").first()["corrupt"] == path.read_text()


def test_orders_from_lines(spark, tmp_path):
    path = tmp_path / "Orders.json"
    path.write_text("\n".join(map(json.dumps, ORDERS)))
    check_orders(sm.load_order_data(spark, str(path)))


def test_products_from_csv(spark, tmp_path):
    path = tmp_path / "Products.csv"
    path.write_text(
        "Product ID,Category,Sub-Category,Product Name,State,Price per product\n"
        'P1,Garden,Tools,"Spade, 12"" ""long""",Lagos,81.88\n'
        "P2,Kitchen,Pans,Pan,,not a price\n"
    )
    df = sm.load_product_data(spark, str(path))
    assert df.columns == column_names(PRODUCT_BRONZE)
    first, second = df.orderBy("Product ID").collect()
    assert first["Product Name"] == 'Spade, 12" "long"' and first["Price per product"] == 81.88
    assert second["State"] is None and second["Price per product"] is None
    with pytest.raises(sm.DataQualityException, match="Price per product"):
        sm.check_null_completeness(df, ["Price per product"], "products")


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_customers_round_trip(spark, tmp_path, customers, file_format):
    folder = str(tmp_path / file_format)
    customers.write.option("header", True).format(file_format).save(folder)
    df = sm.load_customer_data(spark, folder, file_format)
    assert df.columns == column_names(CUSTOMER_BRONZE)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, customers.collect()))
    assert dict(df.dtypes)["Postal Code"] == "string"


def test_lines_and_documents_do_not_pass_for_each_other(spark, tmp_path):
    lines, document = tmp_path / "lines.json", tmp_path / "document.json"
    lines.write_text("\n".join(map(json.dumps, ORDERS)))
    document.write_text(json.dumps(ORDERS, indent=2))
    with pytest.raises(ValueError, match="one order per line"):
        sm.load_order_data(spark, str(lines), multi_line=True)
    with pytest.raises(Exception, match="does not fit"):
        sm.load_order_data(spark, str(document)).collect()
    kept = sm.load_order_data(spark, str(document), corrupt_column="corrupt")
    assert kept.where("corrupt is not null").count() > 0


def test_records_out_of_shape_are_loud(spark, tmp_path):
    header = ",".join(column_names(CUSTOMER_BRONZE)) + "\n"
    good = 'C1,Name,mail,1,"Long Road 1\nTown",Consumer,Land,City,State,1,West\n'
    path = tmp_path / "Customer.csv"
    path.write_text(header + good + good.replace("C1", "C2"))
    whole = sm.load_customer_data(spark, str(path), multi_line=True).orderBy("Customer ID").collect()
    assert [(r["Customer ID"], r["address"]) for r in whole] == [("C1", "Long Road 1\nTown"), ("C2", "Long Road 1\nTown")]
    with pytest.raises(Exception, match="does not fit"):
        sm.load_customer_data(spark, str(path)).collect()
    kept = sm.load_customer_data(spark, str(path), corrupt_column="corrupt")
    assert kept.where("corrupt is not null").count() == 4
    path.write_text(header + "C1,Name,mail,1,Road,Consumer,Land,City,State,1,West,surplus\n")
    with pytest.raises(Exception, match="does not fit"):
        sm.load_customer_data(spark, str(path)).collect()


def test_layer_tables_and_dedup(spark, layers, products):
    sm.save_bronze_table(spark, products.union(products), "products", layers=layers)
    assert sm.load_bronze_table(spark, "products", layers).count() == 6
    assert sm.load_bronze_table(spark, "products", layers, dedup=True).count() == 3


def test_view_is_open_to_sql(spark, products):
    sm.register_view(products, "listed_products")
    assert spark.sql("SELECT count(*) FROM listed_products WHERE Category = 'Garden'").first()[0] == 1


# -- rejected records ---------------------------------------------------------------------------


def report(df):
    return sorted(((r.source, r.records, r.field, r.rejected) for r in df.collect()), key=repr)


def test_rejects_are_counted_in_the_pass_that_loads(spark, layers, tmp_path):
    path = tmp_path / "Orders.json"
    path.write_text("\n".join([*map(json.dumps, ORDERS), '{"Row ID": 4, "Order', "[1, 2]"]))
    seen = Observation("orders")
    orders = sm.load_order_data(spark, str(path), corrupt_column="fault", rejects=seen)
    sm.save_bronze_table(spark, orders, "orders", layers=layers)
    assert report(sm.rejects_report(spark, {"orders": seen})) == sorted([
        ("orders", 5, None, 2), ("orders", 5, "Order Date", 1), ("orders", 5, "Ship Date", 1), ("orders", 5, "Quantity", 1),
    ], key=repr)
    stored = sm.load_bronze_table(spark, "orders", layers)
    assert stored.count() == 5 and stored.where("fault IS NOT NULL").count() == 2


def test_clean_and_empty_loads_reject_nothing(spark, tmp_path, customers):
    customers.write.option("header", True).csv(str(tmp_path / "csv"))
    customers.write.parquet(str(tmp_path / "parquet"))
    (tmp_path / "empty.csv").write_text(",".join(column_names(PRODUCT_BRONZE)) + "\n")
    seen = {name: Observation(name) for name in ("csv", "parquet", "none")}
    sm.load_customer_data(spark, str(tmp_path / "csv"), rejects=seen["csv"]).collect()
    sm.load_customer_data(spark, str(tmp_path / "parquet"), "parquet", rejects=seen["parquet"]).collect()
    sm.load_product_data(spark, str(tmp_path / "empty.csv"), rejects=seen["none"]).collect()
    assert report(sm.rejects_report(spark, seen)) == [("csv", 3, None, 0), ("none", 0, None, 0), ("parquet", 3, None, 0)]


def test_values_of_records_out_of_shape_are_not_counted_twice(spark, tmp_path):
    path = tmp_path / "Products.csv"
    path.write_text(
        ",".join(column_names(PRODUCT_BRONZE)) + "\nP1,a,b,c,d,cheap\nP2,a,b\nP3,a,b,c,d,1.5\nP4,a,b,c,d,cheap,more\n"
    )
    seen = Observation("products")
    rows = sm.load_product_data(spark, str(path), corrupt_column="fault", rejects=seen).collect()
    assert len(rows) == 4 and sum(r.fault is None for r in rows) == 2
    assert report(sm.rejects_report(spark, {"products": seen})) == [
        ("products", 4, "Price per product", 1), ("products", 4, None, 2),
    ]


def test_documents_are_stored_compressed(spark, monkeypatch, tmp_path):
    from workload.queries import QUERIES, Data

    folder = str(tmp_path / "documents")
    monkeypatch.setattr(sm, "scratch_folder", lambda *_: folder)
    data = Data(spark, "/root/testdata/sf0.001")
    read = QUERIES["src_orders_json_document"](data)
    assert read.count() == data.orders.count()
    documents = spark.read.text(folder).agg({"value": "count"}).first()[0]
    files = [f for f in (tmp_path / "documents").rglob("part-*")]
    assert documents == len(files) > 0 and all(f.name.endswith(".gz") for f in files)
    assert sorted(map(str, read.collect())) == sorted(map(str, data.orders.select(*read.columns).collect()))
