"""The queries of ``queries`` as SQL for an independent engine.

Written from the rules, not from the plans: the raw rows of ``retail`` and every
cleaning step are stated again here. ``with_raw`` puts the raw relations a query
names in front of it.
"""

from __future__ import annotations

from shopstrata.functions.lookups import BRAND_CODES, DOMESTIC_CARRIERS, REGIONS

_BRANDS = 25


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


_CODES = ["hnk", "ce", "app", "grcy", "bpc", "spt", "toy", "bks"]
_CATEGORY_NAMES = [
    "Home and Kitchen", "Consumer Electronics", "Apparel", "Grocery",
    "Beauty and Personal Care", "Sports", "Toys", "Books",
]
_COUNTRIES = [
    "India", "Australia", "United Kingdom", "United States", "United Arab Emirates", "Singapore", "Canada",
]
_STATES = ["MH", "VIC", "ENG", "CA", "DU", "SG", "ON", "WA", "ZZ"]
_BRAND_NUMBER = "CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER)"



def _total(amount: str) -> str:
    """The exact sum of doubles, in units of 2**-60, rounded once at the end."""
    return f"CAST(CAST(sum(CAST(trunc({amount} * pow(2::DOUBLE, 60)) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2::DOUBLE, 60)"


def _totals(currency: str) -> str:
    sums = ", ".join(f"{_total(f'{a}_amount')} AS total_{b}" for a, b in (
        ("gross", "gross_amount"), ("discount", "discount_amount"), ("tax", "tax_amount"), ("net", "amount")))
    return f"date_id, {currency} AS currency, CAST(sum(quantity) AS BIGINT) AS total_quantity, {sums}"


RAW = {
    "raw_order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS item_seq, CAST(l_shipdate AS DATE) AS dt,
               o_orderdate AS order_ts, o_custkey AS customer_id, l_partkey AS product_id,
               CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'Web'
                    WHEN l_linestatus = 'O' THEN 'web' ELSE 'app' END AS channel,
               CASE substr(o_orderpriority, 1, 1)
                    WHEN '1' THEN ' SAVE10 ' WHEN '2' THEN '  ' WHEN '3' THEN 'Festive' END AS coupon_code,
               CASE l_returnflag WHEN 'A' THEN 'INR' WHEN 'N' THEN 'USD' ELSE 'AED' END AS unit_price_currency,
               CASE WHEN l_partkey % 97 = 13 THEN 'x1' WHEN l_quantity = 2 THEN 'Two'
                    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
               '$' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
               CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS discount_pct,
               l_quantity * l_tax AS tax_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_returns": """
        SELECT l_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_dt,
               strftime(l_shipdate, '%Y-%m-%d 23:00:00') AS return_ts,
               ([' damaged ', 'Wrong Item', NULL, 'late'])[CAST(l_linenumber % 4 + 1 AS INTEGER)] AS reason
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "raw_shipments": """
        SELECT l_orderkey AS order_id, l_linenumber AS shipment_id,
               strftime(l_shipdate, '%Y-%m-%d') AS order_dt,
               ([' bluedart ', 'Delhivery', 'XPRESSBEES', ' EcomExpress', 'DHL', NULL])
                   [CAST(l_suppkey % 6 + 1 AS INTEGER)] AS carrier
        FROM lineitem""",
    "raw_products": f"""
        SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS sku,
               ({_list(_CODES)})[CAST(p_partkey % 8 + 1 AS INTEGER)] AS category_code,
               CASE WHEN p_partkey % 31 = 5 THEN 'zzzz'
                    ELSE ({_list(list(BRAND_CODES)[:_BRANDS])})[{_BRAND_NUMBER}] END AS brand_code,
               split_part(p_name, ' ', 1) AS color,
               (['S', 'M', 'L', NULL])[CAST(p_size % 4 + 1 AS INTEGER)] AS "size",
               p_type AS material,
               CASE WHEN p_size = 50 THEN 'g' WHEN p_size % 7 = 0 THEN CAST(p_size * 10 AS VARCHAR)
                    ELSE CAST(p_size * 10 AS VARCHAR) || 'g' END AS weight_grams,
               CAST(p_size AS VARCHAR) || ',5' AS length_cm,
               CAST(p_size AS DOUBLE) * 0.25 AS width_cm, CAST(p_size AS DOUBLE) * 0.75 AS height_cm,
               CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 2 = 0 THEN -p_size ELSE p_size END
                   AS rating_count,
               {_BRAND_NUMBER} AS brand_number
        FROM part""",
    "raw_brands": f"""
        SELECT 'b' || CAST(n AS VARCHAR) AS brand_code,
               ' ' || substr(brand, 1, 4) || '-' || substr(brand, 5) || ' ' AS brand_name,
               (['HNK', 'CE', 'APP', 'GROCERY', 'BPC', 'SPT', 'TOYS', 'BOOKS', 'toys', NULL])
                   [CAST(n % 10 + 1 AS INTEGER)] AS category_code
        FROM (SELECT DISTINCT {_BRAND_NUMBER} AS n,
                     ({_list(list(BRAND_CODES.values())[:_BRANDS])})[{_BRAND_NUMBER}] AS brand FROM part)""",
    "raw_category": f"""
        SELECT CASE WHEN n < 8 THEN upper(code) ELSE code END AS category_code,
               CASE WHEN n < 8 THEN name ELSE upper(name) END AS category_name
        FROM (SELECT p_size % 16 AS n, ({_list(_CODES)})[CAST(p_size % 16 % 8 + 1 AS INTEGER)] AS code,
                     ({_list(_CATEGORY_NAMES)})[CAST(p_size % 16 % 8 + 1 AS INTEGER)] AS name FROM part)""",
    "raw_customers": f"""
        SELECT CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN c_custkey % 11 = 3 THEN NULL WHEN c_custkey % 11 = 4 THEN '5'
                    ELSE CAST(c_custkey + 9000000000 AS VARCHAR) || '.0' END AS phone,
               CAST(c_nationkey AS VARCHAR) AS country_code,
               ({_list(_COUNTRIES)})[CAST(c_nationkey % 7 + 1 AS INTEGER)] AS country,
               ({_list(_STATES)})[CAST(c_custkey % 9 + 1 AS INTEGER)] AS state
        FROM customer""",
    "raw_calendar": """
        SELECT d AS "date", CAST(year(d) AS INTEGER) AS "year",
               CASE WHEN o_orderkey % 2 = 0 THEN upper(dayname(d)) ELSE lower(dayname(d)) END AS day_name,
               CASE WHEN day(d) = 13 THEN NULL ELSE CAST(quarter(d) AS INTEGER) END AS "quarter",
               CAST(CASE WHEN o_orderkey % 3 = 0 THEN -weekofyear(d) ELSE weekofyear(d) END AS INTEGER)
                   AS week_of_year
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
}

_ITEM_COLUMNS = (
    "order_id, item_seq, dt, order_ts, customer_id, product_id, channel, coupon_code, "
    "unit_price_currency, quantity, unit_price, discount_pct, tax_amount"
)

CLEAN = {
    "items_all": """
        SELECT order_id, item_seq, dt, order_ts, customer_id, product_id,
               CASE channel WHEN 'web' THEN 'Website' WHEN 'app' THEN 'Mobile' ELSE channel END AS channel,
               lower(trim(coupon_code)) AS coupon_code, unit_price_currency,
               CASE WHEN quantity = 'Two' THEN 2 ELSE TRY_CAST(quantity AS INTEGER) END AS quantity,
               CAST(replace(unit_price, '$', '') AS DOUBLE) AS unit_price,
               CAST(replace(discount_pct, '%', '') AS DOUBLE) AS discount_pct, tax_amount
        FROM raw_order_items""",
    "items": f"""
        SELECT {_ITEM_COLUMNS} FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id, item_seq ORDER BY dt DESC, order_ts DESC,
                customer_id DESC, product_id DESC, channel DESC NULLS LAST, coupon_code DESC NULLS LAST,
                unit_price_currency DESC, quantity DESC NULLS LAST, unit_price DESC NULLS LAST,
                discount_pct DESC NULLS LAST, tax_amount DESC NULLS LAST) AS rn FROM items_all)
        WHERE rn = 1""",
    "sold": """
        SELECT CAST(strftime(dt, '%Y%m%d') AS INTEGER) AS date_id, dt AS transaction_date,
               order_ts AS transaction_ts, order_id AS transaction_id, customer_id, item_seq AS seq_no,
               product_id, channel, coupon_code,
               CASE WHEN coupon_code IS NOT NULL THEN 1 ELSE 0 END AS coupon_flag, unit_price_currency,
               quantity, unit_price, gross AS gross_amount, discount_pct AS discount_percent,
               ceil(gross) * (discount_pct / 100) AS discount_amount, tax_amount,
               gross - ceil(gross) * (discount_pct / 100) + tax_amount AS net_amount
        FROM (SELECT *, quantity * unit_price AS gross FROM items)""",
    "summary": f"""
        SELECT {_totals("unit_price_currency")}
        FROM sold GROUP BY 1, 2""",
    "returns_all": """
        SELECT order_id, CAST(order_dt AS DATE) AS order_dt, CAST(return_ts AS TIMESTAMP) AS return_ts,
               upper(trim(reason)) AS reason FROM raw_returns""",
    "returns": """
        SELECT order_id, order_dt, return_ts, reason FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY return_ts DESC, order_dt DESC,
                reason DESC NULLS LAST) AS rn FROM returns_all) WHERE rn = 1""",
    "shipments_all": """
        SELECT order_id, shipment_id, CAST(order_dt AS DATE) AS order_dt, upper(trim(carrier)) AS carrier,
               CAST(order_dt AS DATE) < DATE '1999-01-01' AS early FROM raw_shipments""",
    "shipments": """
        SELECT order_id, shipment_id, order_dt, carrier FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id, shipment_id
                ORDER BY order_dt DESC, carrier DESC NULLS LAST) AS rn FROM shipments_all) WHERE rn = 1""",
    "by_arrival": """
        SELECT order_id, shipment_id, order_dt, carrier, early FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id, shipment_id, early
                ORDER BY order_dt DESC, carrier DESC NULLS LAST) AS rn FROM shipments_all) WHERE rn = 1""",
    "products": f"""
        SELECT product_id, sku, upper(category_code) AS category_code,
               CASE WHEN brand_code = 'zzzz' THEN brand_code
                    ELSE ({_list(list(BRAND_CODES.values())[:_BRANDS])})[brand_number] END AS brand_code,
               color, "size", material,
               TRY_CAST(regexp_replace(weight_grams, '[^0-9]+$', '', 'g') AS INTEGER) AS weight_grams,
               CAST(replace(length_cm, ',', '.') AS DOUBLE) AS length_cm,
               floor(width_cm * 10 + 0.5) / 10 AS width_cm, floor(height_cm * 10 + 0.5) / 10 AS height_cm,
               CAST(abs(rating_count) AS INTEGER) AS rating_count
        FROM raw_products""",
    "brands": """
        SELECT regexp_replace(trim(brand_name), '[^a-zA-Z0-9]', '', 'g') AS brand_code,
               trim(brand_name) AS brand_name,
               CASE category_code WHEN 'GROCERY' THEN 'GRCY' WHEN 'BOOKS' THEN 'BKS' WHEN 'TOYS' THEN 'TOY'
                    ELSE category_code END AS category_code FROM raw_brands""",
    "category": """
        SELECT upper(category_code) AS category_code, max(category_name) AS category_name
        FROM raw_category GROUP BY 1""",
    "customers": """
        SELECT customer_id, coalesce(split_part(phone, '.', 1), 'Not Available') AS phone,
               country_code, country, state
        FROM raw_customers WHERE customer_id IS NOT NULL""",
    "calendar": """
        SELECT "date", "year", upper(substr(day_name, 1, 1)) || lower(substr(day_name, 2)) AS day_name,
               coalesce('Q' || "quarter" || '-' || "year", '') AS "quarter",
               coalesce('Week' || abs(week_of_year) || '-' || "year", '') AS week_of_year
        FROM (SELECT *, row_number() OVER (PARTITION BY "date" ORDER BY "year" DESC, day_name DESC,
                  "quarter" DESC NULLS LAST, week_of_year DESC) AS rn FROM raw_calendar) WHERE rn = 1""",
}

RELATIONS = {**RAW, **CLEAN}


def with_raw(query: str) -> str:
    """Put every relation the query needs, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name, body in RELATIONS.items():
            if name in words and name not in needed:
                visit(body)
                needed.append(name)

    visit(query)
    if query.lstrip().startswith("WITH "):
        query = query.lstrip().removeprefix("WITH ")
        return "WITH " + ",\n".join([*(f"{name} AS ({RELATIONS[name]})" for name in needed), query])
    ctes = ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in needed)
    return f"WITH {ctes}\n{query}" if ctes else query


_LATER_WINS = """
    SELECT order_id, shipment_id, order_dt, carrier{extra} FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id, shipment_id ORDER BY early {direction}) AS pick
        FROM by_arrival) WHERE pick = 1"""

_SHIPMENT_FLAGS = f"""
    , CASE WHEN carrier IN ({", ".join(f"'{c}'" for c in DOMESTIC_CARRIERS)})
           THEN 'Domestic' ELSE 'International' END AS carrier_group,
      dayofweek(order_dt) IN (0, 6) AS is_weekend_shipment"""

_REGION_ROWS = ", ".join(
    f"('{country}', '{state}', '{region}')"
    for country, states in REGIONS.items() for state, region in states.items()
)

_SUMMARY = "SELECT * FROM summary"

_QUERIES = {
    "scan_csv_header": "SELECT * FROM raw_customers",
    "scan_csv_schema": "SELECT * EXCLUDE (brand_number) FROM raw_products",
    "lineage_columns": """
        SELECT 'lineitem.parquet' AS source_table, count(*) AS row_count, count(*) AS stamped_count
        FROM lineitem""",
    "schema_infer_persist": """
        SELECT order_id, shipment_id, CAST(order_dt AS DATE) AS order_dt, carrier FROM raw_shipments""",
    "rescued_data": """
        SELECT order_id, item_seq, dt, CAST(order_ts AS DATE) AS order_ts, customer_id, product_id, coupon_code,
               unit_price_currency, TRY_CAST(quantity AS INTEGER) AS quantity, unit_price, discount_pct, tax_amount,
               CASE WHEN dt < DATE '1999-01-01' THEN
                        CASE WHEN TRY_CAST(quantity AS INTEGER) IS NULL
                             THEN '{"quantity":"' || quantity || '"}' END
                    WHEN TRY_CAST(quantity AS INTEGER) IS NULL
                        THEN '{"quantity":"' || quantity || '","channel":"' || channel || '"}'
                    ELSE '{"channel":"' || channel || '"}' END AS _rescued_data
        FROM raw_order_items""",
    "stream_ingest_append": "SELECT * FROM raw_order_items",
    "stream_resume": """
        SELECT event_id, ts, user_id, event_type, value, props,
               CAST(CASE WHEN ts < middle THEN 0 ELSE 1 END AS BIGINT) AS ingest_batch
        FROM events, (SELECT min(ts) + to_seconds(datesub('second', min(ts), max(ts)) // 2) AS middle FROM events)""",
    "stream_table_scan": "SELECT * FROM lineitem",
    "stream_dedup": "SELECT DISTINCT * FROM lineitem",
    "stream_dedup_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "stream_dedup_bounded": """
        SELECT * FROM events UNION ALL
        SELECT -1 - event_id, * EXCLUDE (event_id) FROM events
        WHERE ts > (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAYS FROM events)""",
    "silver_clean_then_dirty": "SELECT * FROM items",
    "silver_batch_cuts": "SELECT *, unnest(['one', 'several']) AS cut FROM items",
    "stream_first_arrival": _LATER_WINS.format(extra="", direction="DESC"),
    "stream_upsert_latest": "SELECT * FROM shipments",
    "upsert_unconditional": _LATER_WINS.format(extra="", direction="DESC"),
    "upsert_settled": _LATER_WINS.format(extra="", direction="DESC"),
    "change_feed_rows": """
        SELECT order_id, shipment_id, order_dt, carrier, 'insert' AS _change_type, CAST(0 AS BIGINT) AS _commit_version
        FROM by_arrival WHERE NOT early
        UNION ALL
        SELECT n.order_id, n.shipment_id, n.order_dt, n.carrier,
               CASE WHEN o.order_id IS NULL THEN 'insert' ELSE 'update_postimage' END, 1
        FROM by_arrival n LEFT JOIN by_arrival o
             ON n.order_id = o.order_id AND n.shipment_id = o.shipment_id AND NOT o.early
        WHERE n.early
        UNION ALL
        SELECT o.order_id, o.shipment_id, o.order_dt, o.carrier, 'update_preimage', 1
        FROM by_arrival n JOIN by_arrival o
             ON n.order_id = o.order_id AND n.shipment_id = o.shipment_id AND NOT o.early
        WHERE n.early""",
    "change_feed_latest": _LATER_WINS.format(extra=_SHIPMENT_FLAGS, direction="ASC"),
    "overwrite_merge_schema": """
        SELECT product_id, sku, material, CAST(NULL AS INTEGER) AS rating_count FROM raw_products""",
    "overwrite_replace_schema": "SELECT * FROM calendar",
    "value_map": """
        SELECT 'brand' AS kind, brand_code AS code, count(*) AS n FROM products GROUP BY 2
        UNION ALL
        SELECT 'category', category_code, count(*) FROM brands GROUP BY 2""",
    "distinct_by_category": """
        SELECT DISTINCT category_code, brand_code FROM raw_products
        WHERE category_code IN ('hnk', 'ce', 'app', 'grcy', 'bpc', 'spt', 'toy', 'bks')""",
    "duplicate_report": """
        SELECT order_id, shipment_id, count(*) AS "count" FROM raw_shipments GROUP BY 1, 2 HAVING count(*) > 1""",
    "null_key_report": "SELECT * FROM raw_customers WHERE customer_id IS NULL",
    "min_max_report": """
        SELECT count(*) AS row_count, min(order_dt) AS min_order_dt, max(order_dt) AS max_order_dt,
               min(return_ts) AS min_return_ts, max(return_ts) AS max_return_ts FROM returns_all""",
    "dedup_latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
                l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "silver_brands": "SELECT * FROM brands",
    "silver_category": "SELECT * FROM category",
    "silver_calendar": "SELECT * FROM calendar",
    "silver_products": "SELECT * FROM products",
    "silver_customers": "SELECT * FROM customers",
    "silver_order_items": "SELECT * FROM items",
    "silver_returns": "SELECT * FROM returns",
    "silver_shipments": "SELECT * FROM shipments",
    "dim_products_join": """
        SELECT p.product_id, p.sku, p.category_code, coalesce(b.category_name, 'Not Available') AS category_name,
               p.brand_code, coalesce(b.brand_name, 'Not Available') AS brand_name, p.color, p."size", p.material,
               p.weight_grams, p.length_cm, p.width_cm, p.height_cm, p.rating_count
        FROM products p LEFT JOIN (
            SELECT x.brand_code, x.brand_name, y.category_name
            FROM brands x JOIN category y ON x.category_code = y.category_code) b
        ON p.brand_code = b.brand_code""",
    "dim_customers_region": f"""
        SELECT c.country, c.state, c.customer_id, c.phone, c.country_code, coalesce(m.region, 'Other') AS region
        FROM customers c LEFT JOIN (VALUES {_REGION_ROWS}) AS m(country, state, region)
        ON c.country = m.country AND c.state = m.state""",
    "dim_date": """
        SELECT *, CAST(strftime("date", '%Y%m%d') AS INTEGER) AS date_id, monthname("date") AS month_name,
               CASE WHEN dayofweek("date") IN (0, 6) THEN 1 ELSE 0 END AS is_weekend FROM calendar""",
    "gold_order_items": "SELECT * FROM sold",
    "gold_returns": """
        SELECT *, CAST(strftime(order_dt, '%Y%m%d') AS INTEGER) AS date_id,
               CAST(date_diff('day', order_dt, CAST(return_ts AS DATE)) AS INTEGER) AS return_days,
               CASE WHEN date_diff('day', order_dt, CAST(return_ts AS DATE)) <= 15 THEN 1 ELSE 0 END AS within_policy,
               CASE WHEN date_diff('day', order_dt, CAST(return_ts AS DATE)) > 15 THEN 1 ELSE 0 END AS is_late_return
        FROM returns""",
    "gold_shipments": f"SELECT order_id, shipment_id, order_dt, carrier {_SHIPMENT_FLAGS} FROM shipments",
    "daily_summary_full": _SUMMARY,
    "daily_summary_clustered": _SUMMARY,
    "daily_summary_incremental": _SUMMARY,
    "daily_summary_restated": f"""
        WITH first AS (
            SELECT * REPLACE (CASE WHEN product_id % 13 <> 0 THEN unit_price_currency END AS unit_price_currency) FROM sold),
        second AS (
            SELECT * REPLACE (CASE WHEN transaction_id % 5 = 0 THEN quantity + 3 ELSE quantity END AS quantity,
                              CASE WHEN transaction_id % 5 = 0 THEN tax_amount + 0.25 ELSE tax_amount END AS tax_amount)
            FROM first),
        start AS (SELECT max(transaction_date) - INTERVAL 30 DAYS AS d FROM first),
        used AS (
            SELECT first.* FROM first, start WHERE transaction_date < d
            UNION ALL SELECT second.* FROM second, start WHERE transaction_date >= d)
        SELECT {_totals("unit_price_currency")} FROM used GROUP BY date_id, unit_price_currency""",
    "daily_summary_topk": f"{_SUMMARY} ORDER BY date_id DESC, currency LIMIT 10",
}

ORACLES = {name: with_raw(sql) for name, sql in _QUERIES.items()}
