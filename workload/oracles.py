"""The SQL each query must agree with, for DuckDB over the same tables.

``_STEPS`` states the mapping of ``bronze.py`` and the enrichment in SQL, written apart
from the Spark code; each oracle takes the steps it needs.
"""

from __future__ import annotations

# Each step may use the ones before it.
_STEPS = {
    "bronze_customers": """
        SELECT 'C-' || c_custkey AS "Customer ID",
               c_name AS "Customer Name",
               CASE c_mktsegment
                    WHEN 'HOUSEHOLD' THEN NULL
                    WHEN 'MACHINERY' THEN 'user' || c_custkey
                    WHEN 'FURNITURE' THEN 'a@b'
                    ELSE 'user' || c_custkey || '@' || lower(r_name) || '.com' END AS email,
               CASE WHEN c_acctbal >= 0 THEN '555-' || c_custkey END AS phone,
               c_custkey || ' Main St' AS address,
               c_mktsegment AS "Segment",
               n_name AS "Country",
               'CITY_' || c_nationkey AS "City",
               'STATE_' || c_nationkey AS "State",
               '100' || c_nationkey AS "Postal Code",
               r_name AS "Region"
        FROM customer
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "bronze_products": """
        SELECT 'P-' || p_partkey AS "Product ID",
               p_type AS "Category",
               p_brand AS "Sub-Category",
               p_name AS "Product Name",
               'STATE_' || substring(p_brand, 7, 3) AS "State",
               p_retailprice + extra AS "Price per product"
        FROM (
            SELECT *, CAST(0.0 AS DOUBLE) AS extra FROM part
            UNION ALL SELECT *, CAST(10.0 AS DOUBLE) FROM part WHERE p_brand = 'Brand#7'
            UNION ALL SELECT *, CAST(0.0 AS DOUBLE) FROM part WHERE p_brand = 'Brand#8'
        ) AS listings""",
    "lines": """
        SELECT l_linenumber AS "Row ID",
               CAST(l_orderkey AS VARCHAR) AS "Order ID",
               CAST(o_orderdate AS DATE) AS "Order Date",
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL
                    ELSE CAST(l_shipdate AS DATE) END AS "Ship Date",
               o_orderpriority AS "Ship Mode",
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'WALK-IN'
                    ELSE 'C-' || o_custkey END AS "Customer ID",
               CASE WHEN l_returnflag = 'R' AND l_discount = CAST(0.1 AS DOUBLE) THEN 'UNLISTED'
                    ELSE 'P-' || l_partkey END AS "Product ID",
               CAST(l_quantity AS INTEGER) AS "Quantity",
               l_extendedprice AS "Price",
               l_discount AS "Discount",
               CAST(l_extendedprice AS DECIMAL(12,2))
                   * (CAST(0.05 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS exact_profit
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bronze_orders": """
        SELECT * EXCLUDE (exact_profit),
               CAST(CAST(exact_profit AS DECIMAL(10,2)) AS DOUBLE) AS "Profit"
        FROM lines""",
    "customers_enriched": r"""
        SELECT "Customer ID" AS customer_id, "Customer Name" AS customer_name, email, phone, address,
               "Segment" AS segment, "Country" AS country, "City" AS city, "State" AS state,
               "Postal Code" AS postal_code, "Region" AS region,
               CASE WHEN position('@' IN email) > 0
                    THEN substring(email, position('@' IN email) + 1) END AS email_domain,
               CASE WHEN regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}')
                    THEN 'Yes' ELSE 'No' END AS is_valid_email
        FROM bronze_customers""",
    "products_enriched": """
        SELECT "Product ID" AS product_id, "Product Name" AS product_name, "Category" AS category,
               "Sub-Category" AS sub_category, "Price per product" AS price_per_unit,
               "State" AS product_state
        FROM bronze_products""",
    "order_lines": """
        SELECT "Row ID" AS row_id, "Order ID" AS order_id, "Order Date" AS order_date,
               "Ship Date" AS ship_date, "Ship Mode" AS ship_mode, "Customer ID" AS customer_id,
               "Product ID" AS product_id, "Quantity" AS quantity, "Price" AS price,
               "Discount" AS discount, "Profit" AS source_profit,
               CAST(extract('year' FROM "Order Date") AS INTEGER) AS order_year,
               CAST(extract('month' FROM "Order Date") AS INTEGER) AS order_month,
               CAST(extract('quarter' FROM "Order Date") AS INTEGER) AS order_quarter,
               CAST("Ship Date" - "Order Date" AS INTEGER) AS days_to_ship,
               CAST("Profit" AS DECIMAL(10,2)) AS profit
        FROM bronze_orders""",
    "orders_enriched": """
        SELECT order_id, order_date, ship_date, ship_mode, order_year, order_month, order_quarter,
               l.customer_id, customer_name, country, segment, region,
               l.product_id, product_name, category, sub_category,
               quantity, discount, price, price_per_unit, profit, days_to_ship
        FROM order_lines AS l
        LEFT JOIN customers_enriched AS c ON l.customer_id = c.customer_id
        LEFT JOIN products_enriched AS p ON l.product_id = p.product_id""",
    "orders_inner": """
        SELECT DISTINCT row_id, order_id, order_date, ship_date, ship_mode, order_year, order_month,
               order_quarter, customer_id, customer_name, country, segment, region, product_id,
               category, sub_category, quantity, discount, price, price_per_unit, profit, days_to_ship
        FROM (
            SELECT DISTINCT l.*, customer_name, country, segment, region, c.state,
                   category, sub_category, price_per_unit
            FROM order_lines AS l
            JOIN customers_enriched AS c ON l.customer_id = c.customer_id
            JOIN (SELECT DISTINCT product_id, category, sub_category, price_per_unit
                  FROM products_enriched) AS p ON l.product_id = p.product_id
        ) AS joined""",
    "profit_aggregate": """
        SELECT order_year AS year, category, sub_category, customer_id, customer_name, country,
               CAST(sum(profit) AS DECIMAL(15,2)) AS total_profit,
               CAST(sum(CAST(price AS DECIMAL(20,6))) AS DECIMAL(15,2)) AS total_sales,
               count(order_id) AS order_count
        FROM orders_enriched
        GROUP BY ALL""",
}

ORACLES: dict[str, str] = {}


def _oracle(name: str, *steps: str, body: str) -> None:
    chosen = ",\n".join(f"{step} AS ({_STEPS[step]})" for step in _STEPS if step in steps)
    ORACLES[name] = f"WITH {chosen}\n{body}" if steps else body


_C, _P, _L, _O = "bronze_customers", "bronze_products", "lines", "bronze_orders"
_CE, _PE, _OL, _OE = "customers_enriched", "products_enriched", "order_lines", "orders_enriched"
_ORDERS = (_L, _O)
_SILVER = (_C, _P, _L, _O, _CE, _PE, _OL, _OE)
_INNER = (_C, _P, _L, _O, _CE, _PE, _OL, "orders_inner")
_GOLD = (*_SILVER, "profit_aggregate")

# -- sources and sinks ------------------------------------------------------------------

_oracle("src_customers", _C, body="SELECT * FROM bronze_customers")
_oracle("src_customers_parquet", _C, body="SELECT * FROM bronze_customers")
_oracle("src_customers_quoted", _C, body="""
    SELECT * REPLACE ('Hall "A", ' || address || chr(10) || 'floor "2"' AS address) FROM bronze_customers""")
_oracle("src_products_csv", _P, body="SELECT * FROM bronze_products")
_oracle("src_orders_json", *_ORDERS, body="SELECT * FROM bronze_orders")
ORACLES["src_orders_json_document"] = ORACLES["src_orders_json"]
_oracle("bronze_dedup", _P, body="SELECT DISTINCT * FROM bronze_products")
_oracle("gold_view_sql", *_GOLD, body="""
    SELECT country, year, CAST(sum(total_profit) AS DECIMAL(25,2)) AS total_profit,
           CAST(sum(order_count) AS BIGINT) AS order_count
    FROM profit_aggregate GROUP BY country, year""")
_oracle("src_rejects", _C, _P, *_ORDERS, body="""
    , listings AS (
        SELECT count(*) AS listed, count(*) FILTER ("Sub-Category" = 'Brand#8') AS short,
               count(*) FILTER ("Sub-Category" = 'Brand#7') AS unpriced FROM bronze_products
    ), order_faults AS (
        SELECT count(*) AS lines, count(*) FILTER ("Row ID" = 7) AS cut,
               count(*) FILTER ("Row ID" <> 7 AND "Ship Mode" = '1-URGENT') AS worded,
               count(*) FILTER ("Row ID" <> 7 AND "Ship Mode" = '2-HIGH') AS misdated FROM bronze_orders
    ), counts AS (
        SELECT 'customers' AS source, (SELECT count(*) FROM bronze_customers) AS records, 0 AS rejected, NULL AS field
        UNION ALL SELECT 'products', listed + short, short, NULL FROM listings
        UNION ALL SELECT 'products', listed + short, unpriced, 'Price per product' FROM listings
        UNION ALL SELECT 'orders', lines, cut, NULL FROM order_faults
        UNION ALL SELECT 'orders', lines, worded, 'Quantity' FROM order_faults
        UNION ALL SELECT 'orders', lines, misdated, 'Order Date' FROM order_faults
    )
    SELECT source, CAST(records AS BIGINT) AS records, CAST(rejected AS BIGINT) AS rejected, field
    FROM counts WHERE field IS NULL OR rejected > 0""")
_oracle("sink_overwrite", *_ORDERS, body="SELECT * FROM bronze_orders")
_oracle("sink_partitioned", *_GOLD, body="SELECT * FROM profit_aggregate")
_oracle("prune_gold_category", *_GOLD, body="""
    SELECT * FROM profit_aggregate WHERE category = 'PROMO' AND sub_category = 'Brand#11'""")
_oracle("prune_orders_year_month", *_SILVER, body="""
    SELECT * FROM orders_enriched WHERE order_year = 1998 AND order_month = 3""")


# -- upserts ------------------------------------------------------------------------------
# Untouched target rows, one source row for each target row it matches, unmatched source rows.


def _upsert(target: str, source: str, keys: list[str]) -> str:
    using = ", ".join(keys)
    same = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"""
    , target AS ({target}), source AS ({source})
    SELECT t.* FROM target AS t ANTI JOIN source AS s ON {same}
    UNION ALL BY NAME
    SELECT s.* FROM target AS t JOIN source AS s ON {same}
    UNION ALL BY NAME
    SELECT s.* FROM source AS s ANTI JOIN target AS t ON {same}"""


def _latest(source: str, keys: list[str], columns: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    return f"""
        SELECT * FROM ({source}) AS all_rows
        QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"""


_ORDER_KEYS = ["customer_id", "order_id", "product_id"]
_ORDER_COLUMNS = (
    "order_id order_date ship_date ship_mode order_year order_month order_quarter customer_id "
    "customer_name country segment region product_id product_name category sub_category quantity "
    "discount price price_per_unit profit days_to_ship"
).split()
_INNER_COLUMNS = ["row_id", *(c for c in _ORDER_COLUMNS if c != "product_name")]


def _history(table: str) -> str:
    return f"SELECT * FROM {table} WHERE order_date < DATE '1999-07-01' OR order_date IS NULL"


def _increment(table: str) -> str:
    return f"""SELECT * REPLACE (quantity + 1 AS quantity) FROM {table}
               WHERE order_date >= DATE '1998-07-01'"""


_oracle("upsert_customers", _C, _CE, body=_upsert(
    "SELECT * FROM customers_enriched WHERE region <> 'ASIA'",
    """SELECT * REPLACE ('NEW ' || segment AS segment) FROM customers_enriched
       WHERE region IN ('ASIA', 'EUROPE')""",
    ["customer_id", "customer_name"],
))
_oracle("upsert_products", _P, _PE, body=_upsert(
    "SELECT * FROM products_enriched WHERE category <> 'PROMO'",
    _latest(
        """SELECT * REPLACE (price_per_unit + CAST(1 AS DOUBLE) AS price_per_unit)
           FROM products_enriched WHERE category IN ('PROMO', 'SMALL')""",
        ["product_id", "product_name"],
        ["category", "sub_category", "price_per_unit", "product_state"],
    ),
    ["product_id", "product_name"],
))
ORACLES["merge_customers_table"] = ORACLES["upsert_customers"]
ORACLES["merge_products_table"] = ORACLES["upsert_products"]
ORACLES["merge_customers_bucketed"] = ORACLES["upsert_customers"]
ORACLES["merge_products_bucketed"] = ORACLES["upsert_products"]
_oracle("upsert_orders", *_SILVER, body=_upsert(
    _history("orders_enriched"),
    _latest(_increment("orders_enriched"), _ORDER_KEYS, _ORDER_COLUMNS),
    _ORDER_KEYS,
))
ORACLES["upsert_orders_table"] = ORACLES["upsert_orders"]
_oracle("upsert_orders_by_row", *_INNER, body=_upsert(
    _history("orders_inner"),
    _latest(_increment("orders_inner"), ["row_id", *_ORDER_KEYS], _INNER_COLUMNS),
    ["row_id", *_ORDER_KEYS],
))

# -- projections and filters ----------------------------------------------------------------

_oracle("standardize_customers", _C, body="""
    SELECT "Customer ID" AS customer_id, "Customer Name" AS customer_name, email, phone, address,
           "Segment" AS segment, "Country" AS country, "City" AS city, "State" AS state,
           "Postal Code" AS postal_code, "Region" AS region
    FROM bronze_customers""")
_oracle("standardize_products", _P, _PE, body="SELECT * FROM products_enriched")
_RENAMED = """"Order ID" AS order_id, "Order Date" AS order_date, "Ship Date" AS ship_date,
           "Ship Mode" AS ship_mode, "Customer ID" AS customer_id, "Product ID" AS product_id,
           "Quantity" AS quantity, "Price" AS price, "Discount" AS discount,
           "Profit" AS source_profit"""
_oracle("standardize_orders", *_ORDERS, body=f'SELECT "Row ID", {_RENAMED} FROM bronze_orders')
_oracle("standardize_orders_row_id", *_ORDERS, body=f'SELECT "Row ID" AS row_id, {_RENAMED} FROM bronze_orders')
_oracle("filter_conjunctive", *_ORDERS, body="""
    SELECT * FROM bronze_orders
    WHERE "Customer ID" = 'WALK-IN' AND "Product ID" = 'UNLISTED' AND "Ship Mode" = '5-LOW'""")
_oracle("filter_in_list", _P, body="""
    SELECT * FROM bronze_products WHERE "Category" IN ('ECONOMY', 'PROMO')""")
_oracle("distinct_rows", _P, body="SELECT DISTINCT * FROM bronze_products")
_oracle("orders_sample", *_SILVER, body="""
    SELECT order_id, order_date, customer_name, country, category, sub_category, quantity, price, profit
    FROM orders_enriched
    ORDER BY order_id NULLS FIRST, order_date NULLS FIRST, customer_name NULLS FIRST,
             country NULLS FIRST, category NULLS FIRST, sub_category NULLS FIRST,
             quantity, price, profit
    LIMIT 10""")

# -- joins ------------------------------------------------------------------------------------

_LINE = "l.* EXCLUDE (row_id, order_year, order_month, order_quarter, days_to_ship, profit)"
_ROW = 'row_id AS "Row ID"'
_oracle("join_customer_left", _C, _CE, *_ORDERS, _OL, body=f"""
    SELECT {_ROW}, {_LINE}, customer_name, country, segment, region
    FROM order_lines AS l LEFT JOIN customers_enriched AS c ON l.customer_id = c.customer_id""")
_oracle("join_product_left", _P, _PE, *_ORDERS, _OL, body=f"""
    SELECT {_ROW}, {_LINE}, product_name, category, sub_category, price_per_unit
    FROM order_lines AS l LEFT JOIN products_enriched AS p ON l.product_id = p.product_id""")
_oracle("join_customer_inner", _C, _CE, *_ORDERS, _OL, body=f"""
    SELECT {_ROW}, {_LINE}, customer_name, country, segment, region
    FROM order_lines AS l JOIN customers_enriched AS c ON l.customer_id = c.customer_id""")
_oracle("join_product_dedup_inner", _P, _PE, *_ORDERS, _OL, body=f"""
    SELECT {_ROW}, {_LINE}, category, sub_category, price_per_unit
    FROM order_lines AS l
    JOIN (SELECT DISTINCT product_id, category, sub_category, price_per_unit FROM products_enriched) AS p
      ON l.product_id = p.product_id""")
_oracle("orphan_keys", _C, *_ORDERS, body="""
    SELECT DISTINCT "Customer ID" FROM bronze_orders
    WHERE "Customer ID" IS NOT NULL AND "Customer ID" NOT IN (SELECT "Customer ID" FROM bronze_customers)""")
_oracle("join_three_way", _C, _P, *_ORDERS, _CE, _PE, _OL, body="""
    SELECT order_id, l.customer_id, customer_name, state, l.product_id, product_name, category,
           product_state, price_per_unit, quantity, price
    FROM order_lines AS l
    JOIN customers_enriched AS c ON c.customer_id = l.customer_id
    LEFT JOIN products_enriched AS p ON p.product_id = l.product_id
    WHERE category = 'PROMO'""")
_oracle("join_composite", _C, _P, *_ORDERS, _CE, _PE, _OL, body="""
    SELECT order_id, l.customer_id, customer_name, state, l.product_id, price_per_unit, quantity
    FROM order_lines AS l
    JOIN customers_enriched AS c ON c.customer_id = l.customer_id
    JOIN products_enriched AS p ON p.product_id = l.product_id AND p.product_state = c.state""")

# -- aggregations -------------------------------------------------------------------------------

_oracle("gold_profit", *_GOLD, body="SELECT * FROM profit_aggregate")
_oracle("gold_profit_pxq", *_SILVER, body="""
    SELECT order_year AS year, category, sub_category, customer_id, customer_name, country,
           CAST(sum(profit) AS DECIMAL(15,2)) AS total_profit,
           CAST(sum(CAST(price AS DECIMAL(14,2)) * quantity) AS DECIMAL(15,2)) AS total_sales,
           count(order_id) AS order_count
    FROM orders_enriched
    GROUP BY ALL""")
_oracle("layer_counts", *_GOLD, body="""
    SELECT 'bronze.customers' AS table_name, count(*) AS row_count FROM bronze_customers
    UNION ALL SELECT 'bronze.products', count(*) FROM bronze_products
    UNION ALL SELECT 'bronze.orders', count(*) FROM bronze_orders
    UNION ALL SELECT 'silver.customers_enriched', count(*) FROM customers_enriched
    UNION ALL SELECT 'silver.products_enriched', count(*) FROM products_enriched
    UNION ALL SELECT 'silver.orders_enriched', count(*) FROM orders_enriched
    UNION ALL SELECT 'gold.profit_aggregate', count(*) FROM profit_aggregate""")
_oracle("profit_stats", *_SILVER, body="""
    SELECT count(*) AS total_orders, CAST(sum(profit) AS DECIMAL(25,2)) AS total_profit,
           CAST(min(profit) AS DECIMAL(25,2)) AS min_profit, CAST(max(profit) AS DECIMAL(25,2)) AS max_profit
    FROM orders_enriched""")
_oracle("gold_stats", *_GOLD, body="""
    SELECT count(*) AS total_records, count(DISTINCT year) AS distinct_years,
           count(DISTINCT category) AS distinct_categories,
           count(DISTINCT customer_id) AS distinct_customers
    FROM profit_aggregate""")
_oracle("gold_profit_incremental", *_SILVER, body=f"""
    , moved AS (
        SELECT * REPLACE (
            CASE WHEN sub_category = 'Brand#3' THEN 'MOVED' ELSE category END AS category,
            CAST(profit + 1.25 AS DECIMAL(10,2)) AS profit)
        FROM ({_increment("orders_enriched")}) AS increment
    )""" + _upsert(
    _history("orders_enriched"), _latest("SELECT * FROM moved", _ORDER_KEYS, _ORDER_COLUMNS), _ORDER_KEYS,
).replace("SELECT t.* FROM target AS t ANTI", ", merged AS (SELECT t.* FROM target AS t ANTI", 1) + """)
    SELECT order_year AS year, category, sub_category, customer_id, customer_name, country,
           CAST(sum(profit) AS DECIMAL(15,2)) AS total_profit,
           CAST(sum(CAST(price AS DECIMAL(20,6))) AS DECIMAL(15,2)) AS total_sales,
           count(order_id) AS order_count
    FROM merged GROUP BY ALL""")
_oracle("gold_stats_sketch", *_GOLD, body="""
    SELECT count(*) AS total_records, count(DISTINCT year) AS distinct_years,
           count(DISTINCT category) AS distinct_categories, count(DISTINCT customer_id) AS distinct_customers,
           TRUE AS sketched_distinct_categories_near, TRUE AS sketched_distinct_customers_near,
           TRUE AS rough_distinct_categories_near, TRUE AS rough_distinct_customers_near
    FROM profit_aggregate""")
_oracle("duplicate_keys", *_ORDERS, body="""
    SELECT "Customer ID", "Order ID", "Product ID", count(*) AS copies
    FROM bronze_orders GROUP BY ALL HAVING count(*) > 1""")
_oracle("duplicate_keys_group_by_all", _P, body="""
    SELECT "Product ID", "Category", "Sub-Category", "Price per product", count(*) AS copies
    FROM bronze_products GROUP BY ALL HAVING count(*) > 1""")


def _audit(label: str, table: str, distinct: str) -> str:
    return f"""SELECT '{label}' AS table_name, (SELECT count(*) FROM {table}) AS row_count,
               (SELECT count(*) FROM ({distinct}) AS d) AS distinct_count"""


def _audit_all(whole_row: str) -> str:
    return " UNION ".join([
        _audit("bronze_customers", _C, f'SELECT DISTINCT "Customer ID" FROM {_C}'),
        _audit("bronze_orders", _O, whole_row.format(table=_O)),
        _audit("bronze_products", _P, f'SELECT DISTINCT "Product ID" FROM {_P}'),
        _audit("silver_customers", _CE, whole_row.format(table=_CE)),
        _audit("silver_orders", _OE, whole_row.format(table=_OE)),
        _audit("silver_products", _PE, whole_row.format(table=_PE)),
    ])


_oracle("layer_audit", *_SILVER, body=_audit_all("SELECT DISTINCT * FROM {table}"))
_oracle("layer_audit_skip_nulls", *_SILVER, body=_audit_all(
    "SELECT DISTINCT * FROM {table} WHERE COLUMNS(*) IS NOT NULL"
))
_oracle("profit_by_cast_year", *_ORDERS, body="""
    SELECT CAST(extract('year' FROM TRY_CAST(CAST("Order Date" AS VARCHAR) AS DATE)) AS INTEGER) AS year,
           CAST(sum(CAST("Profit" AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS profit
    FROM bronze_orders GROUP BY 1""")

# -- roll-ups over gold ---------------------------------------------------------------------------

_PROFIT = "CAST(sum(total_profit) AS DECIMAL(25,2))"
_SALES = "CAST(sum(total_sales) AS DECIMAL(25,2))"
_COUNT = "CAST(sum(order_count) AS BIGINT)"
_ALL3 = f"{_PROFIT} AS total_profit, {_SALES} AS total_sales, {_COUNT} AS order_count"
_WHO = "customer_id, customer_name NULLS FIRST, country NULLS FIRST"


def _rollup(name: str, by: str, measures: str, tail: str = "") -> None:
    _oracle(name, *_GOLD, body=f"SELECT {by}, {measures} FROM profit_aggregate GROUP BY {by} {tail}")


_rollup("profit_by_year", "year", _ALL3)
_rollup("profit_by_year_category", "year, category", _ALL3)
_rollup("profit_by_customer_all", "customer_id, customer_name, country", _ALL3)
_rollup("profit_by_customer", "customer_id, customer_name, country", _ALL3,
        f"ORDER BY total_profit DESC, {_WHO} LIMIT 20")
_rollup("profit_by_customer_year_all", "customer_id, customer_name, country, year", _ALL3)
_rollup("profit_by_customer_year", "customer_id, customer_name, country, year", _ALL3,
        f"ORDER BY year, total_profit DESC, {_WHO} LIMIT 20")
_TWO = f"{_PROFIT} AS total_profit, {_COUNT} AS order_count"
_rollup("profit_by_year_subcategory_all", "year, category, sub_category", _TWO)
_rollup("profit_by_year_subcategory", "year, category, sub_category", _TWO,
        "ORDER BY total_profit DESC, year, category NULLS FIRST, sub_category NULLS FIRST LIMIT 15")
_rollup("top_categories", "category", f"{_PROFIT} AS category_profit, {_COUNT} AS total_orders",
        "ORDER BY category_profit DESC, category NULLS FIRST LIMIT 5")

# -- set operators ----------------------------------------------------------------------------------

_oracle("product_ids_intersect", _P, *_ORDERS, body="""
    SELECT "Product ID" FROM bronze_orders
    INTERSECT
    SELECT "Product ID" FROM bronze_products WHERE "Category" IN ('LARGE', 'SMALL')""")
_oracle("distinct_keys", *_ORDERS, body='SELECT DISTINCT "Customer ID", "Product ID" FROM bronze_orders')
_oracle("keep_latest", *_SILVER, body=_latest("SELECT * FROM orders_enriched", _ORDER_KEYS, _ORDER_COLUMNS))

# -- scalar functions ---------------------------------------------------------------------------------

_SPELLED = """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%d/%m/%Y')
                WHEN o_orderpriority = '2-HIGH'
                    THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
                WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN o_orderpriority = '4-NOT SPECIFIED'
                    THEN '31/' || month(o_orderdate) || '/' || year(o_orderdate)
                WHEN o_orderstatus = 'P' THEN NULL
                ELSE day(o_orderdate) || '/' || month(o_orderdate) END AS order_date_text
    FROM orders"""
ORACLES["parse_order_dates"] = f"""
    SELECT *, CAST(try_strptime(order_date_text, '%d/%m/%Y') AS DATE) AS order_date
    FROM ({_SPELLED}) AS spelled"""
ORACLES["split_date_parts"] = f"""
    SELECT o_orderkey, order_date_text, day, month, year, day || '-' || month || '-' || year AS padded
    FROM (
        SELECT *, left(lpad(parts[1], 2, '0'), 2) AS day, left(lpad(parts[2], 2, '0'), 2) AS month,
               parts[3] AS year
        FROM (SELECT *, string_split(order_date_text, '/') AS parts FROM ({_SPELLED}) AS spelled) AS split
    ) AS named"""
ORACLES["try_cast_date"] = f"""
    SELECT *, TRY_CAST(order_date_text AS DATE) AS cast_date, substring(order_date_text, 1, 4) AS head
    FROM ({_SPELLED}) AS spelled"""
_oracle("email_enrichment", _C, _CE, body="""
    SELECT customer_id AS "Customer ID", email, email_domain, is_valid_email FROM customers_enriched""")
_oracle("date_fields", *_ORDERS, _OL, body="""
    SELECT order_id, product_id, order_date, order_year, order_month, order_quarter FROM order_lines""")
_oracle("days_to_ship", *_ORDERS, _OL, body="""
    SELECT order_id, product_id, order_date, ship_date, days_to_ship FROM order_lines""")
_oracle("round_profit", _L, body="""
    SELECT "Order ID" AS order_id, "Product ID" AS product_id,
           CAST(round(exact_profit, 2) AS DECIMAL(10,2)) AS profit
    FROM lines""")

_oracle("round_profit_double", _L, body="""
    SELECT "Order ID" AS order_id, "Product ID" AS product_id,
           CAST(round(((CAST("Quantity" AS DECIMAL(20,4)) - 25) * 5 + "Row ID") * 0.125, 2) AS DECIMAL(10,2)) AS profit
    FROM lines""")

# -- enrichment -----------------------------------------------------------------------------------------

_oracle("enrich_customers", _C, _CE, body="SELECT * FROM customers_enriched")
_oracle("enrich_products", _P, _PE, body="SELECT * FROM products_enriched")
_oracle("enrich_orders", *_SILVER, body="SELECT * FROM orders_enriched")
_oracle("enrich_orders_inner", *_INNER, body="SELECT * FROM orders_inner")

# -- data quality -----------------------------------------------------------------------------------------


def _conformance(table: str, layout: list[tuple[str, str, bool]], there: bool = True) -> list[str]:
    rows = []
    for name, kind, required in layout:
        nulls = f'count(*) FILTER (WHERE "{name}" IS NULL)' if required and there else "count(*) * 0"
        actual = f"'{kind}'" if there else "CAST(NULL AS VARCHAR)"
        rows.append(
            f"SELECT '{table}' AS \"table\", '{name}' AS column_name, '{kind}' AS expected_type, "
            f"{actual} AS actual_type, {nulls} AS null_violations FROM {table}"
        )
    return rows


_ORDER_TYPES = dict(
    order_date="date", ship_date="date", order_year="int", order_month="int", order_quarter="int",
    quantity="int", discount="double", price="double", price_per_unit="double",
    profit="decimal(10,2)", days_to_ship="int",
)
_ORDER_OPTIONAL = {"ship_date", "ship_mode", "segment", "region", "discount", "days_to_ship"}
_CUSTOMER_COLUMNS = (
    "customer_id customer_name email phone address segment country city state postal_code region "
    "email_domain is_valid_email"
).split()
_CUSTOMER_REQUIRED = {"customer_id", "customer_name", "segment", "country"}
_PRODUCT_LAYOUT = [
    ("Product ID", "string", True), ("Category", "string", True), ("Sub-Category", "string", True),
    ("Product Name", "string", True), ("State", "string", False), ("Price per product", "double", True),
]
_oracle("dq_schema_conformance", *_SILVER, body=" UNION ALL ".join(
    _conformance(_OE, [(c, _ORDER_TYPES.get(c, "string"), c not in _ORDER_OPTIONAL) for c in _ORDER_COLUMNS])
    + _conformance(_CE, [(c, "string", c in _CUSTOMER_REQUIRED) for c in _CUSTOMER_COLUMNS])
    + _conformance(_PE, _PRODUCT_LAYOUT, there=False)
))
_oracle("dq_null_counts", *_SILVER, body=" UNION ALL ".join(
    f"""SELECT 'orders_enriched' AS "table", '{c}' AS column_name,
        count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM orders_enriched"""
    for c in _ORDER_COLUMNS
))


def _unique(label: str, table: str, keys: str) -> str:
    return f"""SELECT '{label}' AS "table", (SELECT count(*) FROM {table}) AS row_count, count(*) AS distinct_count,
               (SELECT count(*) FROM {table}) - count(*) AS duplicates
               FROM (SELECT DISTINCT {keys} FROM {table}) AS k"""


_oracle("dq_uniqueness", *_SILVER, body=" UNION ALL ".join([
    _unique("customers", _C, '"Customer ID"'),
    _unique("products", _P, '"Product ID"'),
    _unique("orders", _O, '"Customer ID", "Order ID", "Product ID"'),
    _unique("orders_enriched", _OE, "customer_name, category"),
]))


def _orphans(key: str, parent: str) -> str:
    return f"""(SELECT count(DISTINCT "{key}") FROM bronze_orders
                WHERE "{key}" NOT IN (SELECT "{key}" FROM {parent}))"""


_oracle("dq_orphans", _C, _P, *_ORDERS, body=f"""
    SELECT 'orders->customers' AS relationship, {_orphans('Customer ID', _C)} AS orphans
    UNION ALL SELECT 'orders->products', {_orphans('Product ID', _P)}""")


def _null_rows(table: str, *columns: str) -> str:
    total = " + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in columns)
    return f"(SELECT {total} FROM {table})"


def _surplus(table: str, key: str) -> str:
    return f'(SELECT count(*) - count(DISTINCT "{key}") FROM {table})'


_CHECKS = [
    ("bronze", "schema", "customers", "0"),
    ("bronze", "schema", "products", "0"),
    ("bronze", "schema", "orders", "0"),
    ("bronze", "nulls", "customers", _null_rows(_C, "Customer ID", "Customer Name", "Segment", "Country")),
    ("bronze", "nulls", "products", _null_rows(
        _P, "Product ID", "Category", "Sub-Category", "Product Name", "Price per product")),
    ("bronze", "unique", "customers", _surplus(_C, "Customer ID")),
    ("bronze", "unique", "products", _surplus(_P, "Product ID")),
    ("bronze", "references", "orders->customers", _orphans("Customer ID", _C)),
    ("bronze", "references", "orders->products", _orphans("Product ID", _P)),
    ("silver", "schema", "customers_enriched", "0"),
    ("silver", "schema", "products_enriched", "0"),
    ("silver", "schema", "orders_enriched", "0"),
    ("gold", "schema", "profit_aggregate", "0"),
    ("gold", "nulls", "profit_aggregate", _null_rows(
        "profit_aggregate", "year", "category", "sub_category", "customer_id", "total_profit", "order_count")),
]
_oracle("dq_suite", *_GOLD, body="""
    SELECT check_no, layer, "check", "table",
           CASE WHEN violations = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, violations
    FROM (""" + " UNION ALL ".join(
    f"""SELECT {number} AS check_no, '{layer}' AS layer, '{check}' AS "check", '{table}' AS "table",
        CAST({violations} AS BIGINT) AS violations"""
    for number, (layer, check, table, violations) in enumerate(_CHECKS, 1)
) + ") AS checks")
ORACLES["dq_suite_incremental"] = ORACLES["dq_suite"]
# The same, but that three columns are missing: checks that need them fail without a count.
_MISSING = {1: "1", 3: "1", 4: "NULL", 9: "NULL", 13: "1", 14: "NULL"}
_oracle("dq_suite_missing_column", *_GOLD, body="""
    SELECT check_no, layer, "check", "table",
           CASE WHEN violations = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, violations
    FROM (""" + " UNION ALL ".join(
    f"""SELECT {number} AS check_no, '{layer}' AS layer, '{check}' AS "check", '{table}' AS "table",
        CAST({_MISSING.get(number, violations)} AS BIGINT) AS violations"""
    for number, (layer, check, table, violations) in enumerate(_CHECKS, 1)
) + ") AS checks")
_oracle("dq_row_preservation", *_SILVER, body="""
    SELECT b.n AS rows_before, a.n AS rows_after, b.n = a.n AS preserved
    FROM (SELECT count(*) AS n FROM bronze_orders) AS b, (SELECT count(*) AS n FROM orders_enriched) AS a""")
