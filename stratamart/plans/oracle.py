"""Plain SQL with the results that the registered queries must have."""

from __future__ import annotations

_ORDER_LINES = """order_lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey, l_suppkey, l_extendedprice, l_quantity, o_custkey, o_orderdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_RAW_PRODUCTS = """raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS ProductID, p_name AS ProductName,
    CASE WHEN p_partkey % 16 = 3 THEN lower(p_type) WHEN p_partkey % 16 = 5 THEN upper(p_type) ELSE p_type END AS Category,
    CASE WHEN p_partkey % 17 = 4 THEN 'N/A' ELSE split_part(p_name, ' ', 2) END AS SubCategory,
    CASE WHEN p_partkey % 19 = 6 THEN '' ELSE p_brand END AS Brand,
    CASE WHEN p_partkey % 31 = 8 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR)
         WHEN p_partkey % 37 = 9 THEN '0'
         WHEN p_partkey % 41 = 10 THEN '1-2'
         ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS CostPrice
  FROM part)"""

_RAW_CUSTOMERS = """raw_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS CustomerID,
    split_part(c_name, '#', 1) AS FirstName, split_part(c_name, '#', 2) AS LastName,
    CASE WHEN c_custkey % 17 = 1 THEN 'none' ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS Email,
    CASE WHEN c_custkey % 16 = 2 THEN 'N/A'
         WHEN c_custkey % 5 = 1 THEN '(555)' || substr(digits, 1, 3) || '-' || substr(digits, 4, 4)
         WHEN c_custkey % 5 = 2 THEN '555.' || digits || 'x19'
         WHEN c_custkey % 29 = 3 THEN substr(digits, 1, 6)
         ELSE '555' || digits END AS Phone,
    CASE WHEN c_custkey % 19 = 3 THEN '' ELSE c_mktsegment END AS City,
    CASE WHEN c_custkey % 13 = 4 THEN ' st' ELSE 'NT' END AS State,
    CASE WHEN c_custkey % 43 = 5 THEN '1994-13-31 00:00:00' ELSE '1994-12-31 00:00:00' END AS LastUpdated
  FROM (SELECT *, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS digits FROM customer))"""

_RAW_ORDERS = (
    _ORDER_LINES
    + """, one_line AS (
  SELECT * FROM order_lines
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1),
raw_orders AS (
  SELECT CAST(id AS VARCHAR) AS OrderID,
    CAST(CASE WHEN id % 23 = 1 THEN o_custkey + 1000000000 ELSE o_custkey END AS VARCHAR) AS CustomerID,
    CAST(CASE WHEN id % 29 = 2 THEN l_partkey + 1000000000 ELSE l_partkey END AS VARCHAR) AS ProductID,
    CASE WHEN id % 43 = 3 THEN '1998-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS OrderDate,
    CASE WHEN id % 31 = 4 THEN '0' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS Quantity,
    CASE WHEN id % 37 = 5 THEN '' ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) END AS UnitPrice,
    CASE WHEN id % 41 = 6 THEN 'unknown' ELSE 'ST' || lpad(CAST(l_suppkey % 10 + 1 AS VARCHAR), 3, '0') END AS StoreCode
  FROM one_line)"""
)


def _scrub(column: str) -> str:
    words = "'n/a', 'null', 'none', 'nan', '', '<na>', 'na', 'undefined', 'unknown'"
    return f"CASE WHEN lower(trim({column})) IN ({words}) THEN NULL ELSE trim({column}) END"


def _number(column: str, kind: str) -> str:
    return f"TRY_CAST(nullif(regexp_replace({_scrub(column)}, '[^0-9.\\-]', '', 'g'), '') AS {kind})"


def _phone(column: str) -> str:
    digits = f"regexp_replace({_scrub(column)}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({digits}) BETWEEN 10 AND 15 THEN {digits} END"


_FLAGGED_PRODUCTS = (
    _RAW_PRODUCTS
    + f""", cast_products AS (
  SELECT {_number('ProductID', 'INTEGER')} AS ProductID, {_scrub('ProductName')} AS ProductName,
    upper(substr({_scrub('Category')}, 1, 1)) || lower(substr({_scrub('Category')}, 2)) AS Category,
    {_scrub('SubCategory')} AS SubCategory, {_scrub('Brand')} AS Brand, {_number('CostPrice', 'DECIMAL(10,2)')} AS CostPrice
  FROM raw_products),
flagged_products AS (
  SELECT *, coalesce(ProductID IS NULL OR ProductName IS NULL OR Category IS NULL OR SubCategory IS NULL
    OR Brand IS NULL OR CostPrice IS NULL OR CostPrice <= 0, true) AS _IsRejected
  FROM cast_products)"""
)

_FLAGGED_CUSTOMERS = (
    _RAW_CUSTOMERS
    + f""", cast_customers AS (
  SELECT {_number('CustomerID', 'INTEGER')} AS CustomerID, {_scrub('FirstName')} AS FirstName, {_scrub('LastName')} AS LastName,
    {_scrub('Email')} AS Email, {_phone('Phone')} AS Phone, {_scrub('City')} AS City, upper(trim({_scrub('State')})) AS State,
    TRY_CAST({_scrub('LastUpdated')} AS TIMESTAMP) AS LastUpdated
  FROM raw_customers),
flagged_customers AS (
  SELECT *, (CustomerID IS NULL OR FirstName IS NULL OR LastName IS NULL OR Email IS NULL OR Phone IS NULL
    OR City IS NULL OR State IS NULL OR LastUpdated IS NULL) AS _IsRejected
  FROM cast_customers)"""
)

_CAST_ORDERS = (
    _RAW_ORDERS
    + f""", cast_orders AS (
  SELECT {_number('OrderID', 'BIGINT')} AS OrderID, {_number('CustomerID', 'INTEGER')} AS CustomerID,
    {_number('ProductID', 'INTEGER')} AS ProductID, TRY_CAST({_scrub('OrderDate')} AS DATE) AS OrderDate,
    {_number('Quantity', 'INTEGER')} AS Quantity, {_number('UnitPrice', 'DECIMAL(10,2)')} AS UnitPrice,
    {_scrub('StoreCode')} AS StoreCode
  FROM raw_orders),
orphan_orders AS (
  SELECT o.*, o.CustomerID IS NOT NULL AND c.c_custkey IS NULL AS CustomerID_orphan,
    o.ProductID IS NOT NULL AND p.ProductID IS NULL AS ProductID_orphan
  FROM cast_orders o
  LEFT JOIN customer c ON o.CustomerID = c.c_custkey
  LEFT JOIN (SELECT ProductID FROM flagged_products WHERE NOT _IsRejected) p ON o.ProductID = p.ProductID)"""
)

_FLAGGED_ORDERS = (
    _FLAGGED_PRODUCTS
    + ", "
    + _CAST_ORDERS
    + """, flagged_orders AS (
  SELECT OrderID, CustomerID, ProductID, OrderDate, Quantity, UnitPrice, StoreCode,
    coalesce(OrderID IS NULL OR CustomerID IS NULL OR ProductID IS NULL OR OrderDate IS NULL OR Quantity IS NULL
      OR UnitPrice IS NULL OR StoreCode IS NULL OR Quantity <= 0 OR UnitPrice <= 0
      OR CustomerID_orphan OR ProductID_orphan, true) AS _IsRejected
  FROM orphan_orders)"""
)

_RATE_NAMES = ("EUR", "GBP", "INR", "JPY", "CAD", "AUD", "CNY")

_WIDE_RATES = (
    "wide_rates AS (\n  SELECT RateDate,\n    "
    + ",\n    ".join(
        f"CASE WHEN (m + {i}) % 9 <> 0 THEN CAST(CAST(500000 + ((m * 7 + {i * 13}) % 89) * 1000000 + {250000 * i} + 1 "
        f"AS DECIMAL(12,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(12,6)) END AS {name}"
        for i, name in enumerate(_RATE_NAMES)
    )
    + """
  FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS RateDate,
          (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS m FROM orders))"""
)

_RATES = (
    _WIDE_RATES
    + """, rates AS (
  SELECT 'USD' AS BaseCurrency, TargetCurrency, ExchangeRate, RateDate
  FROM (UNPIVOT wide_rates ON EUR, GBP, INR, JPY, CAD, AUD, CNY INTO NAME TargetCurrency VALUE ExchangeRate))"""
)

_STORES = """stores(StoreCode, LocalCurrency) AS (VALUES
  ('ST001', 'USD'), ('ST002', 'USD'), ('ST003', 'EUR'), ('ST004', 'GBP'), ('ST005', 'INR'),
  ('ST006', 'INR'), ('ST007', 'JPY'), ('ST008', 'CAD'), ('ST009', 'AUD'), ('ST010', 'CNY'))"""

_HISTORY = """history AS (
  SELECT CAST(c_custkey AS INTEGER) AS CustomerID, split_part(c_name, '#', 1) AS FirstName,
    split_part(c_name, '#', 2) AS LastName, 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS Email,
    '555' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS Phone, c_mktsegment AS City, 'NT' AS State,
    TIMESTAMP '1994-12-31' AS _SCD_EffectiveStartDate,
    CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '1998-06-15' END AS _SCD_EffectiveEndDate,
    c_custkey % 4 <> 0 AS _SCD_IsCurrent
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS INTEGER), split_part(c_name, '#', 1), split_part(c_name, '#', 2),
    'c' || CAST(c_custkey AS VARCHAR) || '@example.com', '555' || lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 'MOVED', 'NT',
    TIMESTAMP '1998-06-15', NULL, true
  FROM customer WHERE c_custkey % 4 = 0)"""

_DIMENSIONS = (
    _HISTORY
    + """, dim_customer AS (
  SELECT CAST(row_number() OVER (ORDER BY CustomerID, _SCD_EffectiveStartDate) AS INTEGER) AS CustomerSK, * FROM history),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY ProductID) AS INTEGER) AS ProductSK, ProductID, ProductName, Category,
    SubCategory, Brand, CostPrice
  FROM flagged_products WHERE NOT _IsRejected)"""
)

_FACT = f"""{_FLAGGED_ORDERS}, {_DIMENSIONS}, {_RATES}, {_STORES}, sold AS (
  SELECT o.*, c.CustomerSK, p.ProductSK, p.CostPrice, coalesce(s.LocalCurrency, 'USD') AS LocalCurrency
  FROM flagged_orders o
  LEFT JOIN dim_customer c ON o.CustomerID = c.CustomerID AND o.OrderDate >= CAST(c._SCD_EffectiveStartDate AS DATE)
    AND (c._SCD_EffectiveEndDate IS NULL OR o.OrderDate < CAST(c._SCD_EffectiveEndDate AS DATE))
  LEFT JOIN dim_product p ON o.ProductID = p.ProductID
  LEFT JOIN stores s ON o.StoreCode = s.StoreCode
  WHERE NOT o._IsRejected),
priced AS (
  SELECT sold.*, coalesce(CAST(r.ExchangeRate AS DOUBLE), 1.0::DOUBLE) AS Rate
  FROM sold ASOF LEFT JOIN rates r ON sold.LocalCurrency = r.TargetCurrency AND sold.OrderDate >= r.RateDate),
fact AS (
  SELECT OrderID, CAST(strftime(OrderDate, '%Y%m%d') AS INTEGER) AS DateSK, CustomerSK, ProductSK, StoreCode, LocalCurrency,
    Quantity, UnitPrice, Rate AS ExchangeRate, CAST(Quantity * UnitPrice AS DECIMAL(21,2)) AS LineTotalLocal,
    round(CAST(Quantity * UnitPrice AS DOUBLE) / Rate, 2) AS LineTotalBaseCurrency,
    round(CAST(Quantity * CostPrice AS DOUBLE) / Rate, 2) AS LineCostBaseCurrency
  FROM priced),
fact_sales AS (
  SELECT *, round(LineTotalBaseCurrency - LineCostBaseCurrency, 2) AS GrossMarginBaseCurrency FROM fact)"""

_DAYS = """days AS (
  SELECT CAST(d AS DATE) AS day
  FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) + INTERVAL 1 DAY AS hi FROM orders) b,
    generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS g(d))"""

_SUM_REVENUE = "CAST(sum(CAST(LineTotalBaseCurrency AS DECIMAL(18,2))) AS DOUBLE) AS TotalRevenueUSD"
_SUM_MARGIN = "CAST(sum(CAST(GrossMarginBaseCurrency AS DECIMAL(18,2))) AS DOUBLE) AS TotalMarginUSD"
_SUM_QUANTITY = "CAST(sum(fact_sales.Quantity) AS BIGINT) AS TotalQuantity"

_BATCHES = """first_batch AS (
  SELECT user_id, event_type, ts FROM events WHERE ts < TIMESTAMP '2024-01-16'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) = 1),
second_batch AS (
  SELECT user_id, event_type, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) = 1)"""

_VERSION = """sha256(coalesce({0}.event_type, '')) AS _SCD_RecordHash, {0}.ts AS _SCD_EffectiveStartDate"""

_USERS = f"""WITH {_BATCHES}
SELECT a.user_id, a.event_type, {_VERSION.format('a')},
  CASE WHEN b.event_type <> a.event_type THEN b.ts END AS _SCD_EffectiveEndDate,
  coalesce(b.event_type = a.event_type, true) AS _SCD_IsCurrent
FROM first_batch a LEFT JOIN second_batch b ON a.user_id = b.user_id
UNION ALL
SELECT b.user_id, b.event_type, {_VERSION.format('b')}, NULL, true
FROM second_batch b LEFT JOIN first_batch a ON a.user_id = b.user_id
WHERE a.user_id IS NULL OR a.event_type <> b.event_type"""

_OPEN_VERSION = f"""{_VERSION.format('e')}, CAST(NULL AS TIMESTAMP) AS _SCD_EffectiveEndDate, true AS _SCD_IsCurrent"""

_MANY_BATCHES = """WITH latest AS (
  SELECT user_id, event_type, ts, CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN 3 WHEN ts >= TIMESTAMP '2024-01-16' THEN 2
    WHEN ts >= TIMESTAMP '2024-01-08' THEN 1 ELSE 0 END AS batch
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, batch ORDER BY ts DESC, event_type) = 1),
changes AS (
  SELECT * FROM latest
  QUALIFY coalesce(event_type, '') IS DISTINCT FROM lag(coalesce(event_type, '')) OVER (PARTITION BY user_id ORDER BY batch))
SELECT user_id, event_type, sha256(coalesce(event_type, '')) AS _SCD_RecordHash, ts AS _SCD_EffectiveStartDate,
  lead(ts) OVER w AS _SCD_EffectiveEndDate, lead(batch) OVER w IS NULL AS _SCD_IsCurrent
FROM changes WINDOW w AS (PARTITION BY user_id ORDER BY batch)"""

_ORDERS_BY_YEAR = """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS order_count,
  CAST(sum(o_custkey) AS BIGINT) AS customer_sum, max(o_orderpriority) AS last_priority
FROM orders WHERE {} GROUP BY 1"""

ORACLE_SQL: dict[str, str] = {
    "dedupe_orders": f"""WITH {_ORDER_LINES}
SELECT id AS OrderID, l_partkey, l_suppkey, l_extendedprice FROM order_lines
QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""",
    "distinct_rows": f"""WITH {_RAW_PRODUCTS}
SELECT DISTINCT * FROM (
  SELECT * FROM raw_products UNION ALL SELECT * FROM raw_products WHERE CAST(ProductID AS BIGINT) % 50 = 0)""",
    "clean_products": f"WITH {_FLAGGED_PRODUCTS} SELECT * FROM flagged_products WHERE NOT _IsRejected",
    "rejects_products": f"WITH {_FLAGGED_PRODUCTS} SELECT * FROM flagged_products WHERE _IsRejected",
    "clean_customers": f"WITH {_FLAGGED_CUSTOMERS} SELECT * FROM flagged_customers",
    "clean_orders": f"WITH {_FLAGGED_ORDERS} SELECT * FROM flagged_orders",
    "ref_integrity_orders": f"""WITH {_FLAGGED_ORDERS}
SELECT CustomerID_orphan, ProductID_orphan, count(*) AS order_count FROM orphan_orders GROUP BY 1, 2""",
    "phone_scrub": f"""WITH {_RAW_CUSTOMERS}
SELECT CustomerID, Phone AS RawPhone, {_phone('Phone')} AS Phone FROM raw_customers""",
    "null_flags": f"""WITH {_FLAGGED_PRODUCTS}
SELECT ProductID, SubCategory IS NULL OR Brand IS NULL AS _IsRejected FROM cast_products""",
    "record_hashes": f"""WITH {_FLAGGED_CUSTOMERS}
SELECT CustomerID, sha256(concat_ws('||', coalesce(FirstName, ''), coalesce(LastName, ''), coalesce(Email, ''),
  coalesce(Phone, ''), coalesce(City, ''), coalesce(State, ''))) AS _SCD_RecordHash FROM cast_customers""",
    "record_hashes_exact": f"""WITH {_FLAGGED_CUSTOMERS}
SELECT CustomerID, sha256(concat({", ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in ("FirstName", "LastName", "Email", "Phone", "City", "State"))})) AS _SCD_RecordHash
FROM cast_customers""",
    "flatten_events": """SELECT event_id AS event_event_id, user_id AS event_actor_user_id, event_type AS event_actor_event_type,
  CAST(json_extract(props, '$.k') AS INTEGER) AS props_k FROM events""",
    "payload_keys": """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS payload_key, count(*) AS event_count
FROM events GROUP BY 1""",
    "flatten_lines": """SELECT l_orderkey AS line_order, l_linenumber AS line_number, 'price' AS amounts_kind,
  l_extendedprice AS amounts_value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem""",
    "unpivot_rates": f"""WITH {_WIDE_RATES}
SELECT strftime(RateDate, '%Y-%m-%d') AS RateDate, 'USD' AS BaseCurrency, TargetCurrency,
  CAST(ExchangeRate AS DOUBLE) AS ExchangeRate
FROM wide_rates UNPIVOT INCLUDE NULLS (ExchangeRate FOR TargetCurrency IN (EUR, GBP, INR, JPY, CAD, AUD, CNY))""",
    "scd2_first_load": f"""WITH latest AS (
  SELECT user_id, event_type, ts FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) = 1)
SELECT e.user_id, e.event_type, {_OPEN_VERSION} FROM latest e""",
    "scd2_users": _USERS,
    "scd2_table": _USERS,
    "scd2_many_batches": _MANY_BATCHES,
    "stream_history_changes": _MANY_BATCHES,
    "late_closures": f"""WITH {_BATCHES}
SELECT count(*) AS late_closures FROM first_batch a JOIN second_batch b ON a.user_id = b.user_id
WHERE a.event_type <> b.event_type""",
    "pit_customer": f"""WITH {_HISTORY}
SELECT o_orderkey AS OrderID, CAST(o_custkey AS INTEGER) AS CustomerID, CAST(o_orderdate AS DATE) AS OrderDate, h.City
FROM orders LEFT JOIN history h ON o_custkey = h.CustomerID
  AND CAST(o_orderdate AS DATE) >= CAST(h._SCD_EffectiveStartDate AS DATE)
  AND (h._SCD_EffectiveEndDate IS NULL OR CAST(o_orderdate AS DATE) < CAST(h._SCD_EffectiveEndDate AS DATE))""",
    "pit_overlaps": f"""WITH {_HISTORY}, spans AS (
  SELECT CustomerID, City, CAST(_SCD_EffectiveStartDate AS DATE) AS a, CAST(_SCD_EffectiveEndDate AS DATE) AS b FROM history
  UNION ALL
  SELECT CAST(c_custkey AS INTEGER), 'AWAY', CAST(t.a AS DATE), CAST(t.b AS DATE) FROM customer,
    (VALUES ('1995-03-01', '1995-09-01'), ('1998-06-01', '1998-07-01')) t(a, b) WHERE c_custkey % 3 = 0),
met AS (
  SELECT o_orderkey AS OrderID, CAST(o_custkey AS INTEGER) AS CustomerID, CAST(o_orderdate AS DATE) AS OrderDate, City
  FROM orders LEFT JOIN spans ON o_custkey = CustomerID AND o_orderdate >= a AND (b IS NULL OR o_orderdate < b)
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY a DESC, City) = 1)
SELECT * FROM met UNION ALL SELECT * FROM met WHERE OrderID % 5 = 0""",
    "latest_file": """SELECT p_brand, count(*) AS part_count,
  CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS price FROM part GROUP BY 1""",
    "dirt_share": """WITH picked AS (
  SELECT l_linestatus, l_orderkey, CAST('0x' || substr(md5(
    concat_ws('|', concat_ws('-', l_orderkey, l_linenumber, l_partkey), 'price')), 1, 8) AS BIGINT) % 10000 < 600 AS dirty
  FROM lineitem)
SELECT l_linestatus, count(*) AS line_count, count(*) FILTER (dirty) AS dirty_count,
  CAST(sum(CASE WHEN dirty THEN l_orderkey ELSE 0 END) AS BIGINT) AS dirty_keys,
  round(count(*) FILTER (dirty) / count(*), 2) AS dirty_share
FROM picked GROUP BY 1""",
    "current_customer": f"""WITH {_HISTORY}
SELECT o_orderkey AS OrderID, CAST(o_custkey AS INTEGER) AS CustomerID, CAST(o_orderdate AS DATE) AS OrderDate, h.City
FROM orders LEFT JOIN history h ON o_custkey = h.CustomerID AND h._SCD_IsCurrent""",
    "asof_fx": f"""WITH {_RATES}, {_STORES}, dated AS (
  SELECT o_orderkey AS OrderID, s.LocalCurrency, CAST(o_orderdate AS DATE) AS OrderDate
  FROM orders JOIN stores s ON s.StoreCode = 'ST' || lpad(CAST(o_custkey % 10 + 1 AS VARCHAR), 3, '0'))
SELECT OrderID, LocalCurrency, OrderDate, coalesce(CAST(r.ExchangeRate AS DOUBLE), 1.0::DOUBLE) AS ExchangeRate
FROM dated ASOF LEFT JOIN rates r ON dated.LocalCurrency = r.TargetCurrency AND dated.OrderDate >= r.RateDate""",
    "dim_customer": f"WITH {_FLAGGED_PRODUCTS}, {_DIMENSIONS} SELECT * FROM dim_customer",
    "dim_product": f"WITH {_FLAGGED_PRODUCTS}, {_DIMENSIONS} SELECT * FROM dim_product",
    "dim_date": f"""WITH {_DAYS}
SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS DateSK, strftime(day, '%Y-%m-%d') AS CalendarDate, year(day) AS "Year",
  quarter(day) AS "Quarter", month(day) AS "Month", monthname(day) AS MonthName, day(day) AS "Day",
  isodow(day) AS DayOfWeek, dayname(day) AS DayName, isodow(day) >= 6 AS IsWeekend, week(day) AS WeekOfYear
FROM days""",
    "fact_sales": f"WITH {_FACT} SELECT * FROM fact_sales",
    "agg_daily_store": f"""WITH {_FACT}, {_DAYS}
SELECT strftime(day, '%Y-%m-%d') AS CalendarDate, StoreCode, count(DISTINCT OrderID) AS TotalOrders, {_SUM_QUANTITY},
  {_SUM_REVENUE}, {_SUM_MARGIN}
FROM fact_sales LEFT JOIN days ON DateSK = CAST(strftime(day, '%Y%m%d') AS INTEGER) GROUP BY 1, 2""",
    "agg_category": f"""WITH {_FACT}
SELECT Category, SubCategory, {_SUM_QUANTITY}, {_SUM_REVENUE}, {_SUM_MARGIN}
FROM fact_sales LEFT JOIN dim_product USING (ProductSK) GROUP BY 1, 2""",
    "revenue_total": """SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity FROM lineitem""",
    "landed_csv": _ORDERS_BY_YEAR.format("true"),
    "mixed_headers": """SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) <> 1995 OR o_orderdate IS NULL THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderdate IS NULL OR year(o_orderdate) <= 1998""",
    "csv_folder": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority FROM orders""",
    "unregistered_files": _ORDERS_BY_YEAR.format("year(o_orderdate) > 1997"),
    "rate_documents": f"""WITH {_RATES}
SELECT BaseCurrency, TargetCurrency, ExchangeRate, RateDate, ExchangeRate IS NULL AS _IsRejected
FROM (SELECT 'USD' AS BaseCurrency, *
  FROM wide_rates UNPIVOT INCLUDE NULLS (ExchangeRate FOR TargetCurrency IN (EUR, GBP, INR, JPY, CAD, AUD, CNY)))""",
    "upsert_watermark": "SELECT CAST(user_id AS VARCHAR) AS dataset, max(ts) AS watermark FROM events GROUP BY 1",
    "schema_evolve": """SELECT p_partkey, p_name, NULL AS p_brand, NULL AS p_size FROM part WHERE p_size <= 25
UNION ALL SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_size > 25""",
    "partitioned_table": "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders",
    "month_replaced": """SELECT o_orderkey, CASE WHEN month = 199506 AND o_orderkey % 7 <> 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice, month
FROM (SELECT *, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month FROM orders)""",
    "evolve_overwrite": "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders",
    "incremental_scan": "SELECT event_id, user_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-16'",
    "catalog_preview": """SELECT 'region' AS table_name, least(count(*), 50) AS preview_rows FROM region
UNION ALL SELECT 'nation', least(count(*), 50) FROM nation
UNION ALL SELECT 'customer', least(count(*), 50) FROM customer
UNION ALL SELECT 'part', least(count(*), 50) FROM part""",
    "stream_landing": """SELECT o_orderstatus, count(*) AS order_count, CAST(sum(o_custkey) AS BIGINT) AS customer_sum
FROM orders GROUP BY 1""",
    "stream_history": f"""WITH latest AS (
  SELECT user_id, event_type, ts FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) = 1)
SELECT e.user_id, e.event_type, {_OPEN_VERSION} FROM latest e""",
    "run_summary": """WITH log AS (
  SELECT CAST(user_id AS VARCHAR) AS pipeline_run_id, event_type AS layer, 'dataset-' || CAST(event_id % 4 AS VARCHAR) AS dataset,
    CASE event_id % 3 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    CAST(floor(value) AS BIGINT) AS records_in, CAST(floor(value / 2) AS BIGINT) AS records_out,
    CASE WHEN event_id % 5 = 0 THEN 1 END AS records_rejected, ts AS event_timestamp
  FROM events)
SELECT pipeline_run_id, layer, dataset,
  arg_max(status, (event_timestamp, status <> 'STARTED', status)) AS final_status,
  CAST(sum(records_in) AS BIGINT) AS records_in, CAST(sum(records_out) AS BIGINT) AS records_out,
  CAST(sum(records_rejected) AS BIGINT) AS records_rejected, count(*) AS events,
  round((epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 1e6::DOUBLE, 1) AS duration_seconds
FROM log GROUP BY 1, 2, 3""",
    "latest_rejects": """SELECT event_id, 'run-' || strftime(ts, '%Y-%m-%d') AS _AdfPipelineRunId FROM events
WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)""",
    "reject_profile": f"""WITH {_FLAGGED_ORDERS}, {_FLAGGED_CUSTOMERS}, flags AS (
  SELECT 'products' AS dataset, _IsRejected FROM flagged_products
  UNION ALL SELECT 'customers', _IsRejected FROM flagged_customers
  UNION ALL SELECT 'orders', _IsRejected FROM flagged_orders)
SELECT dataset, count(*) AS row_count, count(*) FILTER (WHERE _IsRejected) AS rejected_count,
  round(count(*) FILTER (WHERE _IsRejected) / count(*)::DOUBLE, 4) AS reject_ratio
FROM flags GROUP BY 1""",
    "dirty_products": """SELECT p_partkey, CASE WHEN p_partkey % 17 = 3 THEN NULL ELSE p_brand END AS p_brand,
  CASE WHEN p_partkey % 13 = 2 THEN lower(p_type) ELSE p_type END AS category FROM part""",
    "repeated_orders": """SELECT o_orderpriority, count(*) + count(*) FILTER (WHERE o_orderkey % 67 = 0) AS order_count
FROM orders GROUP BY 1""",
    "customer_changes": """SELECT c_custkey, c_name, 'MOVED' AS c_mktsegment FROM customer WHERE c_custkey % 7 = 0
UNION ALL
SELECT row_number() OVER (ORDER BY c_name) + (SELECT max(c_custkey) FROM customer), c_name, c_mktsegment
FROM customer WHERE c_custkey % 10 = 0""",
    "product_snapshot": """SELECT CAST(p_partkey AS VARCHAR) AS ProductID, p_name AS ProductName FROM part
UNION ALL
SELECT CAST(p_partkey + (SELECT max(p_partkey) + 1 FROM part) AS VARCHAR), p_name FROM part WHERE p_partkey % 4 = 0""",
    "key_pool": "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS ProductID FROM lineitem",
    "layers_city_sales": f"""WITH {_FACT}, {_FLAGGED_CUSTOMERS}, moved AS (
  SELECT CustomerID FROM cast_customers
  WHERE CustomerID % 4 = 0 AND Email IS NOT NULL AND Phone IS NOT NULL AND LastUpdated IS NOT NULL)
SELECT CASE WHEN m.CustomerID IS NOT NULL AND o.OrderDate >= DATE '1998-06-15' THEN 'MOVED' ELSE c.City END AS City,
  LocalCurrency, count(*) AS TotalOrders, {_SUM_QUANTITY}, {_SUM_REVENUE}
FROM fact_sales JOIN flagged_orders o ON fact_sales.OrderID = o.OrderID
JOIN flagged_customers c ON o.CustomerID = c.CustomerID AND NOT c._IsRejected
LEFT JOIN moved m ON m.CustomerID = c.CustomerID
GROUP BY 1, 2""",
}

_PARTIES = f"""{_FLAGGED_PRODUCTS}, {_FLAGGED_CUSTOMERS}, moved_customers AS (
  SELECT *, (FirstName IS NULL OR LastName IS NULL OR Email IS NULL OR Phone IS NULL OR State IS NULL OR LastUpdated IS NULL) AS _IsRejectedNow
  FROM cast_customers WHERE CustomerID % 4 = 0),
versions AS (
  SELECT c.CustomerID, c.City, 'run-1' AS run, m.CustomerID IS NULL AS is_current, TIMESTAMP '1994-12-31' AS since
  FROM flagged_customers c LEFT JOIN moved_customers m ON c.CustomerID = m.CustomerID AND NOT m._IsRejectedNow WHERE NOT c._IsRejected
  UNION ALL
  SELECT CustomerID, 'MOVED', 'run-2', true, TIMESTAMP '1998-06-15' FROM moved_customers WHERE NOT _IsRejectedNow),
rejects AS (
  SELECT 'products' AS dataset, CAST(ProductID AS BIGINT) AS record_key, run
  FROM flagged_products, (SELECT unnest(['run-1', 'run-2']) AS run) WHERE _IsRejected
  UNION ALL SELECT 'customers', CustomerID, 'run-1' FROM flagged_customers WHERE _IsRejected
  UNION ALL SELECT 'customers', CustomerID, 'run-2' FROM moved_customers WHERE _IsRejectedNow),
done AS (
  SELECT 'run-1' AS run, 'bronze' AS layer, 'products' AS dataset, count(*) AS n_in, count(*) AS n_out, NULL::BIGINT AS n_bad FROM raw_products
  UNION ALL SELECT 'run-2', 'bronze', 'products', 0, 0, NULL
  UNION ALL SELECT 'run-1', 'bronze', 'customers', count(*), count(*), NULL FROM raw_customers
  UNION ALL SELECT 'run-2', 'bronze', 'customers', count(*), count(*), NULL FROM moved_customers
  UNION ALL SELECT run, 'silver', 'products', count(*), count(*) FILTER (WHERE NOT _IsRejected), count(*) FILTER (WHERE _IsRejected)
    FROM flagged_products, (SELECT unnest(['run-1', 'run-2']) AS run) GROUP BY run
  UNION ALL SELECT 'run-1', 'silver', 'customers', count(*), count(*) FILTER (WHERE NOT _IsRejected), count(*) FILTER (WHERE _IsRejected) FROM flagged_customers
  UNION ALL SELECT 'run-2', 'silver', 'customers', count(*), count(*) FILTER (WHERE NOT _IsRejectedNow), count(*) FILTER (WHERE _IsRejectedNow) FROM moved_customers),
log AS (
  SELECT run AS pipeline_run_id, layer, dataset, 'SUCCESS' AS status, n_in AS records_in, n_out AS records_out, n_bad AS records_rejected FROM done
  UNION ALL SELECT run, layer, dataset, 'STARTED', NULL, NULL, NULL FROM done)"""

ORACLE_SQL |= {
    "layer_rejects": f"WITH {_PARTIES} SELECT dataset, record_key, run AS _AdfPipelineRunId FROM rejects",
    "layer_log": f"WITH {_PARTIES} SELECT * FROM log",
    "layer_profile": f"""WITH {_PARTIES}
SELECT 'bronze' AS layer, 'products' AS table_name, count(*) AS row_count FROM raw_products
UNION ALL SELECT 'bronze', 'customers', (SELECT count(*) FROM raw_customers) + (SELECT count(*) FROM moved_customers)
UNION ALL SELECT 'silver', 'products', count(*) FROM flagged_products WHERE NOT _IsRejected
UNION ALL SELECT 'silver', 'customers', count(*) FROM versions
UNION ALL SELECT 'silver', dataset || '_rejected_records', count(*) FROM rejects GROUP BY dataset
UNION ALL SELECT 'audit', 'pipeline_execution_log', count(*) FROM log
UNION ALL SELECT 'audit', 'silver_watermark', 1""",
    "layer_increment": f"""WITH {_PARTIES}
SELECT CustomerID, City, run AS _AdfPipelineRunId, is_current AS _SCD_IsCurrent, true AS mark_stands FROM versions""",
    "failed_dataset": """SELECT dataset, status, CASE WHEN status = 'SUCCESS' THEN (SELECT count(*) FROM part) END AS records_in,
  CASE WHEN status = 'FAILED' THEN 2000 END::INTEGER AS error_chars, 'silver failed for 1 dataset(s)' AS raised
FROM (VALUES ('broken', 'STARTED'), ('broken', 'FAILED'), ('sound', 'STARTED'), ('sound', 'SUCCESS')) v(dataset, status)""",
    "audit_columns": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  CAST(NULL AS DECIMAL(10,2)) AS o_discount, 'orders.csv' AS _SourceFile, 'run-2' AS _AdfPipelineRunId, true AS stamped,
  11 AS n_columns
FROM orders""",
    "published_gold": f"""WITH {_PARTIES}
SELECT 'customer' AS kind, CAST(row_number() OVER (ORDER BY CustomerID, since) AS INTEGER) AS sk, CustomerID AS id, City AS name, since FROM versions
UNION ALL
SELECT 'product', CAST(row_number() OVER (ORDER BY ProductID) AS INTEGER), ProductID, ProductName, NULL FROM flagged_products WHERE NOT _IsRejected""",
}

# The same results by another way of joining.
ORACLE_SQL |= {"pit_periods": ORACLE_SQL["pit_customer"], "asof_fx_periods": ORACLE_SQL["asof_fx"]}
