"""The same warehouse written as plain SQL for DuckDB: the independent oracle that the
Spark plans are compared with.

Each named block is one CTE; :func:`with_blocks` puts the blocks a query needs (with
their dependencies, in order) in front of its final SELECT. Comparison form of the
output (see ``functions.columns.canonical``): decimals as exact text of eight decimals,
integers as BIGINT, dates and timestamps as ISO text.
"""

from __future__ import annotations

import re

from ledgerstar.functions.columns import NULL_KEY_TOKEN
from ledgerstar.plans import roles as R
from ledgerstar.plans.dimensions import STATUS_NAMES
from ledgerstar.plans.marts import ATTAINMENT, SEGMENTS


def dbl(x: str) -> str:
    """Exact decimal -> correctly rounded double (through its text)."""
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"({dbl(a)} / nullif({dbl(b)}, 0))"


def skey(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY_TOKEN}')" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def d_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


NET = "(CAST(order_quantity AS DECIMAL(10,0)) * unit_price * (1 - unit_price_discount))"


def _cents(c: str) -> str:
    return f"CAST(CAST(floor({c} * 100 + 0.5) AS BIGINT) AS VARCHAR)"


LINE_ID = ("md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
           "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
           + ", ".join(_cents(c) for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
           + ", l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR)))")

B: dict[str, str] = {}

B["detail"] = f"""
SELECT l_orderkey AS sales_order_id,
       {LINE_ID} AS sales_order_detail_id,
       l_partkey AS product_id,
       CAST(floor(l_discount * 100 + 0.5) AS INTEGER) AS special_offer_id,
       CAST(l_quantity AS INTEGER) AS order_quantity,
       CAST(CAST(((CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * 200 + CAST(l_quantity AS BIGINT))
                  // (2 * CAST(l_quantity AS BIGINT))) AS DECIMAL(19,0)) * 0.0001 AS DECIMAL(19,4)) AS unit_price,
       CAST(l_discount AS DECIMAL(5,4)) AS unit_price_discount,
       CAST(l_shipdate AS DATE) AS modified_date
FROM lineitem"""

B["totals"] = f"""
SELECT sales_order_id, sum({NET}) AS order_net_total, count(*) AS order_line_count FROM detail GROUP BY sales_order_id"""

B["header0"] = """
SELECT o.o_orderkey AS sales_order_id, 1 AS revision_number, CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(o.o_orderdate AS DATE) + 12 AS due_date,
       CASE WHEN o.o_orderstatus <> 'O' THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 15 AS INTEGER) END AS ship_date,
       CASE o.o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 3 WHEN 'F' THEN 5 END AS order_status,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS online_order_flag,
       'SO' || CAST(o.o_orderkey AS VARCHAR) AS sales_order_number,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'PO' || CAST(o.o_orderkey AS VARCHAR) END AS purchase_order_number,
       'AN-' || CAST(o.o_custkey AS VARCHAR) AS account_number,
       o.o_custkey AS customer_id,
       CASE WHEN o.o_orderkey % 3 = 0 THEN o.o_orderkey % (SELECT count(*) FROM supplier) END AS sales_person_id,
       CAST(o.o_custkey % 5 AS INTEGER) AS territory_id,
       o.o_custkey AS bill_to_address_id,
       CASE WHEN o.o_orderkey % 4 <> 0 THEN o.o_custkey END AS ship_to_address_id,
       CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS ship_method_id,
       CAST(NULL AS INTEGER) AS credit_card_id,
       CASE WHEN o.o_orderkey % 9 < 4 THEN o.o_orderkey END AS currency_rate_id,
       CAST(round(coalesce(t.order_net_total, 0), 2) AS DECIMAL(19,2)) AS sub_total,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 7 AS INTEGER) AS modified_date
FROM orders o LEFT JOIN totals t ON o.o_orderkey = t.sales_order_id"""

B["header1"] = """
SELECT *, CAST(round(sub_total * CAST(0.08 AS DECIMAL(3,2)), 2) AS DECIMAL(19,2)) AS tax_amount,
          CAST(round(sub_total * CAST(0.025 AS DECIMAL(4,3)), 2) AS DECIMAL(19,2)) AS freight_amount
FROM header0"""

B["header"] = """
SELECT sales_order_id, revision_number, order_date, due_date, ship_date, order_status, online_order_flag,
       sales_order_number, purchase_order_number, account_number, customer_id, sales_person_id, territory_id,
       bill_to_address_id, ship_to_address_id, ship_method_id, credit_card_id, currency_rate_id, sub_total,
       tax_amount, freight_amount, CAST(sub_total + tax_amount + freight_amount AS DECIMAL(19,2)) AS total_due,
       modified_date
FROM header1"""

B["reason_pairs"] = """
SELECT sales_order_id, CAST(sales_reason_id AS INTEGER) AS sales_reason_id, modified_date FROM (
  SELECT o_orderkey AS sales_order_id, unnest(range(1, CAST(o_orderkey % 4 AS BIGINT) + 1)) AS sales_reason_id,
         CAST(o_orderdate AS DATE) AS modified_date
  FROM orders WHERE o_orderkey % 4 > 0)"""

B["reasons"] = f"""
SELECT sales_reason_id, {lst(R.REASON_NAMES)}[sales_reason_id] AS sales_reason_name,
       {lst(R.REASON_TYPES)}[sales_reason_id] AS reason_type, DATE '1995-01-01' AS modified_date
FROM (SELECT DISTINCT sales_reason_id FROM reason_pairs)"""

# ------------------------------------------------------------------ products
B["prod_base"] = f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice,
       CAST(list_position({lst(R.CATEGORY_TYPES)}, p_type) AS INTEGER) AS category_id,
       CAST(substr(p_brand, 7, 10) AS INTEGER) AS brand_num
FROM part WHERE p_partkey % 97 <> 0"""

_runs = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(R.PRODUCT_RUNS, start=1))
B["prod_runs"] = f"""
SELECT r.run, b.product_id, b.product_name,
       'PN-' || CAST(b.product_id AS VARCHAR) || CASE WHEN r.run >= 3 AND b.product_id % 11 = 0 THEN '-R' ELSE '' END
         AS product_number,
       CAST(round(CAST(b.p_retailprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(1,1)), 0) AS INTEGER) AS standard_cost,
       CAST(round(CAST(b.p_retailprice AS DECIMAL(12,2))
                  * CASE WHEN r.run >= 2 AND b.product_id % 7 = 0 THEN CAST(1.1 AS DECIMAL(2,1))
                         ELSE CAST(1.0 AS DECIMAL(2,1)) END, 0) AS INTEGER) AS list_price,
       b.category_id * 100 + b.brand_num AS subcategory_id,
       r.run_date AS modified_date
FROM prod_base b CROSS JOIN (VALUES {_runs}) r(run, run_date)"""

B["prod_current"] = "SELECT * FROM prod_runs WHERE run = 3"

B["snap_product"] = """
SELECT product_id, product_name, product_number, standard_cost, list_price, subcategory_id, modified_date,
       CAST(modified_date AS TIMESTAMP) AS version_from,
       CASE WHEN run = 1 THEN CASE WHEN product_id % 7 = 0 THEN TIMESTAMP '1997-01-01'
                                   WHEN product_id % 11 = 0 THEN TIMESTAMP '1999-01-01' END
            WHEN run = 2 THEN CASE WHEN product_id % 11 = 0 THEN TIMESTAMP '1999-01-01' END END AS version_to
FROM prod_runs
WHERE run = 1 OR (run = 2 AND product_id % 7 = 0) OR (run = 3 AND product_id % 11 = 0)"""

B["subcat"] = f"""
SELECT DISTINCT CAST(list_position({lst(R.CATEGORY_TYPES)}, p_type) AS INTEGER) * 100
                + CAST(substr(p_brand, 7, 10) AS INTEGER) AS product_subcategory_id,
       CAST(list_position({lst(R.CATEGORY_TYPES)}, p_type) AS INTEGER) AS product_category_id,
       p_brand AS product_subcategory_name
FROM part"""

B["cat"] = f"""
SELECT DISTINCT CAST(list_position({lst(R.CATEGORY_TYPES)}, p_type) AS INTEGER) AS product_category_id,
       p_type AS product_category_name
FROM part"""

B["dim_product"] = f"""
SELECT {skey('v.product_id', ts_text('v.version_from'))} AS sk_product,
       v.product_id, v.product_name, v.product_number, v.standard_cost, v.list_price,
       sc.product_subcategory_name AS subcategory_name, c.product_category_name AS category_name,
       CASE WHEN v.version_from = min(v.version_from) OVER (PARTITION BY v.product_id)
            THEN TIMESTAMP '1900-01-01' ELSE v.version_from END AS valid_from,
       coalesce(v.version_to, TIMESTAMP '9999-12-31') AS valid_to,
       v.version_to IS NULL AS is_current, v.modified_date
FROM snap_product v
LEFT JOIN subcat sc ON v.subcategory_id = sc.product_subcategory_id
LEFT JOIN cat c ON sc.product_category_id = c.product_category_id
UNION ALL
SELECT '-1', -1, 'Unknown', 'Unknown', 0, 0, 'Unknown', 'Unknown', TIMESTAMP '1900-01-01', TIMESTAMP '9999-12-31',
       true, NULL"""


def _yearly(value: str, base: str, step: str) -> str:
    last = R.HISTORY_YEARS - 1
    return f"""
SELECT p_partkey AS product_id, make_date({R.HISTORY_START_YEAR} + k, 1, 1) AS start_date,
       CASE WHEN k < {last} THEN make_date({R.HISTORY_START_YEAR + 1} + k, 1, 1) END AS end_date,
       CAST(round(CAST(p_retailprice AS DECIMAL(12,2))
                  * (CAST({base} AS DECIMAL(3,2)) + CAST({step} AS DECIMAL(3,2)) * CAST(k AS INTEGER)), 0) AS INTEGER)
         AS {value},
       make_date({R.HISTORY_START_YEAR} + k, 1, 1) AS modified_date
FROM part CROSS JOIN range(0, {R.HISTORY_YEARS}) r(k) WHERE p_partkey % 10 <> 0"""


B["cost_hist"] = _yearly("standard_cost", "0.50", "0.02")
B["price_hist"] = _yearly("list_price", "1.00", "0.01")

B["cost_iv"] = """
SELECT product_id, standard_cost, start_date AS valid_from, coalesce(end_date, DATE '9999-12-31') AS valid_to,
       false AS is_fallback_cost FROM cost_hist
UNION ALL
SELECT p.product_id, p.standard_cost, DATE '1900-01-01', DATE '9999-12-31', true FROM prod_current p
WHERE NOT EXISTS (SELECT 1 FROM cost_hist h WHERE h.product_id = p.product_id)"""

B["price_iv"] = """
SELECT product_id, list_price, start_date AS valid_from, coalesce(end_date, DATE '9999-12-31') AS valid_to,
       false AS is_fallback_price FROM price_hist
UNION ALL
SELECT p.product_id, p.list_price, DATE '1900-01-01', DATE '9999-12-31', true FROM prod_current p
WHERE NOT EXISTS (SELECT 1 FROM price_hist h WHERE h.product_id = p.product_id)"""

# ------------------------------------------------------------------ customers
_seg = ", ".join(f"'{s}'" for s in R.RESELLER_SEGMENTS)
_cruns = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(R.CUSTOMER_RUNS, start=1))
B["cust_runs"] = f"""
SELECT r.run, c_custkey AS customer_id,
       CASE WHEN NOT (c_mktsegment IN ({_seg})) THEN c_custkey END AS person_id,
       CASE WHEN c_mktsegment IN ({_seg}) THEN c_custkey END AS store_id,
       CAST(CASE WHEN r.run >= 2 AND c_custkey % 13 = 0 THEN (c_custkey + 1) % 5 ELSE c_custkey % 5 END AS INTEGER)
         AS territory_id,
       r.run_date AS modified_date
FROM customer CROSS JOIN (VALUES {_cruns}) r(run, run_date)"""

B["snap_customer"] = f"""
SELECT customer_id, person_id, store_id, territory_id, modified_date,
       CAST(modified_date AS TIMESTAMP) AS version_from,
       CASE WHEN run = 1 AND customer_id % 13 = 0 THEN TIMESTAMP '{R.CUSTOMER_RUNS[1]}' END AS version_to
FROM cust_runs WHERE run = 1 OR customer_id % 13 = 0"""

B["persons"] = """
SELECT c_custkey AS business_entity_id, split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name FROM customer"""

B["stores"] = f"""
SELECT c_custkey AS business_entity_id, 'Store ' || c_name AS store_name FROM customer
WHERE c_mktsegment IN ({_seg})"""

_full = "trim(coalesce(pn.first_name, '') || ' ' || coalesce(pn.last_name, ''))"
B["dim_customer"] = f"""
SELECT {skey('v.customer_id', ts_text('v.version_from'))} AS sk_customer,
       v.customer_id, v.person_id, v.store_id, v.territory_id,
       CASE WHEN v.store_id IS NOT NULL THEN 'Reseller' WHEN v.person_id IS NOT NULL THEN 'Individual'
            ELSE 'Unknown' END AS customer_type,
       {_full} AS customer_name, s.store_name,
       coalesce(nullif(s.store_name, ''), nullif({_full}, ''), 'Unknown') AS customer_display_name,
       CASE WHEN v.version_from = min(v.version_from) OVER (PARTITION BY v.customer_id)
            THEN TIMESTAMP '1900-01-01' ELSE v.version_from END AS valid_from,
       coalesce(v.version_to, TIMESTAMP '9999-12-31') AS valid_to,
       v.version_to IS NULL AS is_current, v.modified_date
FROM snap_customer v
LEFT JOIN persons pn ON v.person_id = pn.business_entity_id
LEFT JOIN stores s ON v.store_id = s.business_entity_id
UNION ALL
SELECT '-1', -1, NULL, NULL, NULL, 'Unknown', 'Unknown', 'Unknown', 'Unknown', TIMESTAMP '1900-01-01',
       TIMESTAMP '9999-12-31', true, NULL"""

# ------------------------------------------------------------------ places, people, small dims
B["addr_raw"] = """
SELECT c_custkey AS address_id, '  ' || c_name || ' ' AS address_line1, '' AS address_line2,
       'City ' || CAST(c_nationkey AS VARCHAR) AS city, c_nationkey AS state_province_id,
       lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
       DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS modified_date
FROM customer
UNION ALL
SELECT c_custkey, '  ' || c_name || ' ', '',
       'City ' || CAST(c_nationkey AS VARCHAR) || CASE WHEN c_custkey % 3 = 0 THEN ' North' ELSE '' END,
       c_nationkey, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0'),
       DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END
FROM customer"""

B["stg_address"] = """
SELECT address_id, address_line1, address_line2, city, state_province_id, postal_code, modified_date FROM (
  SELECT address_id, nullif(trim(address_line1), '') AS address_line1, nullif(trim(address_line2), '') AS address_line2,
         nullif(trim(city), '') AS city, state_province_id, nullif(trim(postal_code), '') AS postal_code,
         modified_date,
         row_number() OVER (PARTITION BY address_id ORDER BY modified_date DESC, city DESC) AS rn
  FROM addr_raw) WHERE rn = 1"""

B["provinces"] = """
SELECT n_nationkey AS state_province_id, CAST(n_nationkey AS VARCHAR) AS state_province_code,
       n_name AS state_province_name, CAST(n_regionkey AS VARCHAR) AS country_region_code FROM nation"""

B["countries"] = "SELECT CAST(r_regionkey AS VARCHAR) AS country_region_code, r_name AS country_region_name FROM region"

B["dim_geography"] = """
SELECT a.address_id AS sk_geography, a.address_id, a.address_line1, a.address_line2, a.city, a.postal_code,
       sp.state_province_code, sp.state_province_name AS state_name, cr.country_region_code,
       cr.country_region_name AS country_name, a.modified_date
FROM stg_address a
LEFT JOIN provinces sp ON a.state_province_id = sp.state_province_id
LEFT JOIN countries cr ON sp.country_region_code = cr.country_region_code
UNION ALL
SELECT -1, -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL"""

B["dim_order_status"] = f"""
SELECT {skey('order_status', 'online_order_flag')} AS sk_order_status, order_status AS status_id,
       CASE order_status {" ".join(f"WHEN {k} THEN '{v}'" for k, v in STATUS_NAMES.items())}
            ELSE 'Unknown' END AS status_name,
       CASE WHEN online_order_flag = 1 THEN 'Online' WHEN online_order_flag = 0 THEN 'Reseller'
            ELSE 'Unknown' END AS sales_channel
FROM (SELECT DISTINCT order_status, online_order_flag FROM header)
UNION ALL SELECT '-1', -1, 'Unknown', 'Unknown'"""

B["dim_currency"] = f"""
SELECT code AS sk_currency, code AS currency_code, name AS currency_name, DATE '1995-01-01' AS modified_date FROM (
  SELECT {lst(R.CURRENCY_CODES)}[r_regionkey + 1] AS code, {lst(R.CURRENCY_NAMES)}[r_regionkey + 1] AS name FROM region)
UNION ALL SELECT '-1', '-1', 'Unknown', NULL"""

B["dim_sales_reason"] = """
SELECT sales_reason_id AS sk_sales_reason, sales_reason_id, sales_reason_name, reason_type, modified_date FROM reasons
UNION ALL SELECT -1, -1, 'Unknown', 'Unknown', NULL"""

B["employees"] = """
SELECT s_suppkey AS business_entity_id,
       CASE WHEN s_suppkey % 10 = 9 THEN 'Buyer' ELSE 'Sales Representative' END AS job_title,
       CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       CASE WHEN s_suppkey % 3 = 0 THEN 'M' ELSE 'S' END AS marital_status,
       make_date(1990 + CAST(s_suppkey % 5 AS INTEGER), 1, 1) AS hire_date,
       DATE '1995-01-01' AS modified_date
FROM supplier"""

B["dim_salesperson"] = """
SELECT e.business_entity_id AS sk_salesperson, e.business_entity_id AS salesperson_id,
       trim(coalesce(split_part(s.s_name, '#', 1), '') || ' ' || coalesce(split_part(s.s_name, '#', 2), ''))
         AS salesperson_name,
       e.job_title, e.gender, e.marital_status, e.hire_date,
       CAST(100000 + 1000 * (s.s_suppkey % 50) AS DECIMAL(19,2)) AS sales_quota,
       CAST(0 AS DECIMAL(19,2)) AS bonus, CAST(0.01 AS DECIMAL(19,2)) AS commission_percent,
       e.modified_date
FROM employees e LEFT JOIN supplier s ON e.business_entity_id = s.s_suppkey
WHERE e.job_title LIKE '%Sales%'
UNION ALL
SELECT -1, -1, 'Unknown / Online', 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL"""

B["dim_ship_method"] = """
SELECT id AS sk_ship_method, id AS ship_method_id, substr(o_orderpriority, 3, 40) AS ship_method_name,
       id * 2 AS ship_base, id AS ship_rate, DATE '1995-01-01' AS modified_date FROM (
  SELECT o_orderpriority, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id
  FROM (SELECT DISTINCT o_orderpriority FROM orders))
UNION ALL SELECT -1, -1, 'Unknown', 0, 0, NULL"""

B["dim_special_offer"] = """
SELECT special_offer_id AS sk_special_offer, special_offer_id,
       CAST(special_offer_id * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(19,2)) AS discount_percent,
       CASE WHEN special_offer_id = 0 THEN 'No Discount' ELSE 'Volume Discount' END AS offer_type,
       CASE WHEN special_offer_id = 0 THEN 'No Discount' ELSE 'Reseller' END AS offer_category,
       DATE '1995-01-01' AS start_date, CAST(NULL AS DATE) AS end_date, special_offer_id AS min_qty
FROM (SELECT DISTINCT special_offer_id FROM detail)
UNION ALL SELECT -1, -1, 0, 'Unknown', 'Unknown', NULL, NULL, NULL"""

B["dim_territory"] = """
SELECT r_regionkey AS sk_territory, r_regionkey AS territory_id, r_name AS territory_name,
       CAST(r_regionkey AS VARCHAR) AS country_region_code,
       CASE WHEN r_regionkey < 2 THEN 'West' ELSE 'East' END AS territory_group,
       DATE '1995-01-01' AS modified_date
FROM region
UNION ALL SELECT -1, -1, 'Unknown', 'Unknown', 'Unknown', NULL"""

B["spine"] = f"""
SELECT CAST(DATE '{R.DATE_SPINE_START}' + CAST(i AS INTEGER) AS DATE) AS d FROM range({R.DATE_SPINE_DAYS}) t(i)"""

B["dim_date"] = f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_date, d AS date_actual,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
       strftime(d, '%Y-%m') AS year_month, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
       strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_name_short, dayofweek(d) IN (0, 6) AS is_weekend
FROM spine WHERE d <= DATE '{R.DATE_SPINE_END}'
UNION ALL
SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"""

B["quota_hist"] = f"""
SELECT s_suppkey AS business_entity_id,
       make_date(1995 + CAST(q // 4 AS INTEGER), CAST(q % 4 AS INTEGER) * 3 + 1, 1) AS quota_date,
       CAST(100000 + 1000 * (s_suppkey % 50) AS DECIMAL(19,2)) AS sales_quota
FROM supplier CROSS JOIN range(0, {R.QUOTA_QUARTERS}) r(q) WHERE (s_suppkey + q) % 5 <> 0"""

# ------------------------------------------------------------------ facts
# Keys are resolved in long form: every (order, role, natural key) asks one table of all dimension
# members, with their validity, and the answers are turned back into columns.
B["members"] = """
SELECT 'customer' AS role, CAST(customer_id AS VARCHAR) AS nk, CAST(valid_from AS DATE) AS lo, CAST(valid_to AS DATE) AS hi, sk_customer AS sk FROM dim_customer
UNION ALL SELECT 'seller', CAST(salesperson_id AS VARCHAR), DATE '-infinity', DATE 'infinity', CAST(sk_salesperson AS VARCHAR) FROM dim_salesperson
UNION ALL SELECT 'territory', CAST(territory_id AS VARCHAR), DATE '-infinity', DATE 'infinity', CAST(sk_territory AS VARCHAR) FROM dim_territory
UNION ALL SELECT 'shipping', CAST(ship_method_id AS VARCHAR), DATE '-infinity', DATE 'infinity', CAST(sk_ship_method AS VARCHAR) FROM dim_ship_method
UNION ALL SELECT 'status', sk_order_status, DATE '-infinity', DATE 'infinity', sk_order_status FROM dim_order_status
UNION ALL SELECT 'place', CAST(address_id AS VARCHAR), DATE '-infinity', DATE 'infinity', CAST(sk_geography AS VARCHAR) FROM dim_geography
UNION ALL SELECT 'day', CAST(date_actual AS VARCHAR), DATE '-infinity', DATE 'infinity', CAST(sk_date AS VARCHAR) FROM dim_date
UNION ALL SELECT 'currency', currency_code, DATE '-infinity', DATE 'infinity', sk_currency FROM dim_currency"""

_ASKS = [("sk_customer", "customer", "CAST(customer_id AS VARCHAR)"), ("sk_salesperson", "seller", "CAST(sales_person_id AS VARCHAR)"),
         ("sk_currency", "currency", "'USD'"), ("sk_territory", "territory", "CAST(territory_id AS VARCHAR)"),
         ("sk_ship_method", "shipping", "CAST(ship_method_id AS VARCHAR)"),
         ("sk_order_status", "status", skey("order_status", "online_order_flag")),
         ("sk_bill_to_geography", "place", "CAST(bill_to_address_id AS VARCHAR)"),
         ("sk_ship_to_geography", "place", "CAST(ship_to_address_id AS VARCHAR)"),
         ("sk_order_date", "day", "CAST(order_date AS VARCHAR)"), ("sk_due_date", "day", "CAST(due_date AS VARCHAR)"),
         ("sk_ship_date", "day", "CAST(ship_date AS VARCHAR)")]
_TEXT_KEYS = {"sk_customer", "sk_currency", "sk_order_status"}
B["asked"] = ("\nSELECT sales_order_id, order_date, unnest(["
              + ", ".join(f"{{'col': '{c}', 'role': '{r}', 'nk': {e}}}" for c, r, e in _ASKS) + "]) AS ask FROM header")
B["answers"] = ("\nSELECT sales_order_id, "
                + ", ".join(f"coalesce(max(CASE WHEN ask.col = '{c}' THEN sk END), '-1') AS {c}" if c in _TEXT_KEYS else
                            f"CAST(coalesce(max(CASE WHEN ask.col = '{c}' THEN sk END), '-1') AS INTEGER) AS {c}" for c, _, _ in _ASKS)
                + " FROM asked LEFT JOIN members ON ask.role = members.role AND ask.nk = members.nk"
                  " AND order_date >= lo AND order_date < hi GROUP BY sales_order_id")
B["hdr_keys"] = "\nSELECT header.*, answers.* EXCLUDE (sales_order_id) FROM header JOIN answers USING (sales_order_id)"

# The three histories of a product as one list of starts per kind; the last start on or before the order
# date is taken and dropped again when its range has ended.
B["lines_dated"] = f"""
SELECT detail.*, {NET} AS net, CAST(order_quantity AS DECIMAL(10,0)) * unit_price AS gross, order_date AS sold_on
FROM detail JOIN header USING (sales_order_id)"""
B["sold_version"] = """
SELECT sales_order_id AS o, sales_order_detail_id AS l, CASE WHEN sold_on < valid_to THEN sk_product END AS version,
       CASE WHEN sold_on < valid_to THEN standard_cost END AS version_cost
FROM lines_dated ASOF JOIN dim_product ON lines_dated.product_id = dim_product.product_id AND sold_on >= valid_from"""
B["sold_cost"] = """
SELECT sales_order_id AS o, sales_order_detail_id AS l, CASE WHEN sold_on < valid_to THEN standard_cost END AS interval_cost,
       CASE WHEN sold_on < valid_to THEN is_fallback_cost END AS fallback
FROM lines_dated ASOF JOIN cost_iv ON lines_dated.product_id = cost_iv.product_id AND sold_on >= valid_from"""
B["sold_price"] = """
SELECT sales_order_id AS o, sales_order_detail_id AS l, CASE WHEN sold_on < valid_to THEN list_price END AS listed
FROM lines_dated ASOF JOIN price_iv ON lines_dated.product_id = price_iv.product_id AND sold_on >= valid_from"""
B["costed"] = f"""
SELECT x.*, version, listed, coalesce(interval_cost, version_cost, 0) AS cost_each, coalesce(fallback, true) AS fell_back,
       {ratio('net', 'order_net_total')} AS part
FROM lines_dated x JOIN totals USING (sales_order_id)
LEFT JOIN sold_version v ON v.o = sales_order_id AND v.l = sales_order_detail_id
LEFT JOIN sold_cost c ON c.o = sales_order_id AND c.l = sales_order_detail_id
LEFT JOIN sold_price p ON p.o = sales_order_id AND p.l = sales_order_detail_id"""
B["fct_line"] = f"""
SELECT {skey('sales_order_id', 'sales_order_detail_id')} AS sk_sales_order_line,
       hdr_keys.* EXCLUDE (modified_date), k.* EXCLUDE (sales_order_id, modified_date, unit_price_discount, order_quantity),
       coalesce(version, '-1') AS sk_product,
       CASE WHEN special_offer_id IN (SELECT special_offer_id FROM dim_special_offer) THEN special_offer_id ELSE -1 END AS sk_special_offer,
       currency_rate_id IS NOT NULL AS is_multicurrency_order, order_quantity AS order_qty, unit_price_discount AS discount_pct,
       gross AS gross_amount, gross * unit_price_discount AS discount_amount, net AS net_amount,
       cost_each AS unit_standard_cost, cost_each * order_quantity AS total_cost, fell_back AS is_fallback_cost,
       net - cost_each * order_quantity AS gross_margin, listed AS list_price_at_order_date,
       CASE WHEN listed > 0 THEN 1.0 - {dbl('unit_price')} / CAST(listed AS DOUBLE) ELSE 0.0 END AS effective_discount_pct,
       {dbl('freight_amount')} * part AS allocated_freight, {dbl('tax_amount')} * part AS allocated_tax,
       part AS line_share_of_order, k.modified_date AS source_modified_date
FROM costed k JOIN hdr_keys USING (sales_order_id)"""

B["rollup"] = f"""
SELECT sales_order_id, count(*) AS line_count, sum(order_quantity) AS total_qty,
       count(DISTINCT product_id) AS distinct_products, sum({NET}) AS computed_subtotal
FROM detail GROUP BY sales_order_id"""

B["fct_order"] = f"""
SELECT {skey('h.sales_order_id')} AS sk_sales_order, h.sales_order_id, h.sales_order_number,
       h.purchase_order_number, h.account_number, h.sk_customer, h.sk_salesperson, h.sk_territory,
       h.sk_ship_method, h.sk_order_status, h.sk_currency, h.sk_bill_to_geography, h.sk_ship_to_geography,
       h.currency_rate_id, h.currency_rate_id IS NOT NULL AS is_multicurrency_order,
       h.sk_order_date, h.sk_due_date, h.sk_ship_date,
       h.sub_total AS subtotal, h.tax_amount, h.freight_amount AS freight, h.total_due,
       r.line_count, r.total_qty, r.distinct_products, r.computed_subtotal,
       round(h.sub_total - r.computed_subtotal, 2) AS subtotal_variance,
       date_diff('day', h.order_date, h.ship_date) AS days_to_ship,
       date_diff('day', h.order_date, h.due_date) AS days_promised,
       CASE WHEN h.ship_date IS NULL THEN NULL WHEN h.ship_date <= h.due_date THEN true ELSE false END
         AS is_shipped_on_time,
       h.online_order_flag, h.revision_number, h.modified_date AS source_modified_date
FROM hdr_keys h LEFT JOIN rollup r ON h.sales_order_id = r.sales_order_id"""

B["fct_quota"] = f"""
SELECT {skey('q.business_entity_id', d_text('q.quota_date'))} AS sk_sales_quota,
       coalesce(s.sk_salesperson, -1) AS sk_salesperson, coalesce(d.sk_date, -1) AS sk_quota_date,
       q.business_entity_id AS salesperson_id, q.quota_date, q.sales_quota AS quota_amount
FROM quota_hist q
LEFT JOIN dim_salesperson s ON q.business_entity_id = s.salesperson_id
LEFT JOIN dim_date d ON q.quota_date = d.date_actual"""

B["bridge"] = f"""
SELECT {skey('p.sales_order_id', 'p.sales_reason_id')} AS sk_order_sales_reason, p.sales_order_id,
       coalesce(r.sk_sales_reason, -1) AS sk_sales_reason, c.reason_count,
       1.0 / CAST(c.reason_count AS DOUBLE) AS allocation_factor
FROM reason_pairs p
LEFT JOIN (SELECT sales_order_id, count(*) AS reason_count FROM reason_pairs GROUP BY sales_order_id) c
       ON p.sales_order_id = c.sales_order_id
LEFT JOIN dim_sales_reason r ON p.sales_reason_id = r.sales_reason_id"""

# ------------------------------------------------------------------ marts
# A calendar day from its integer key, and the quarter label by arithmetic on the key.
_DAY = "CASE WHEN {k} > 0 THEN make_date({k} // 10000, {k} // 100 % 100, {k} % 100) END"
_QUARTER = "CASE WHEN {k} > 0 THEN CAST({k} // 10000 AS VARCHAR) || '-Q' || CAST(({k} // 100 % 100 + 2) // 3 AS VARCHAR) END"

B["client_facts"] = f"""
SELECT sk_customer AS client, count(DISTINCT sales_order_id) AS n, sum(total_due) AS spent,
       min({_DAY.format(k='sk_order_date')}) AS first_day, max({_DAY.format(k='sk_order_date')}) AS last_day
FROM fct_order GROUP BY client"""

# One row per client and measure, placed within the measure; the fifth follows from the place by arithmetic:
# the first (clients mod 5) fifths hold one client more.
B["client_places"] = """
SELECT client, what, row_number() OVER (PARTITION BY what ORDER BY v NULLS FIRST, client) - 1 AS place, count(*) OVER (PARTITION BY what) AS total
FROM (SELECT client, 'R' AS what, CAST(date_diff('day', last_day, (SELECT max(last_day) FROM client_facts)) AS DECIMAL(38,4)) AS v FROM client_facts
      UNION ALL SELECT client, 'F', CAST(n AS DECIMAL(38,4)) FROM client_facts
      UNION ALL SELECT client, 'M', CAST(spent AS DECIMAL(38,4)) FROM client_facts)"""

B["client_fifths"] = """
SELECT client, max(CASE WHEN what = 'R' THEN 6 - fifth END) AS r, max(CASE WHEN what = 'F' THEN fifth END) AS f, max(CASE WHEN what = 'M' THEN fifth END) AS m
FROM (SELECT client, what, CASE WHEN place < total % 5 * (total // 5 + 1) THEN place // (total // 5 + 1) + 1
                                ELSE total % 5 + (place - total % 5 * (total // 5 + 1)) // (total // 5) + 1 END AS fifth
      FROM client_places) GROUP BY client"""

# Segments as a rule table: bounds of both scores, the first rule that fits counts.
_RULES = [(4, 5, 4, 5), (4, 5, 2, 5), (4, 5, 1, 5), (3, 5, 3, 5), (1, 2, 4, 5), (1, 5, 1, 5)]
B["segment_rules"] = "\nSELECT * FROM (VALUES " + ", ".join(
    f"({i}, {a}, {b}, {c}, {d}, '{SEGMENTS[i]}')" for i, (a, b, c, d) in enumerate(_RULES)) + ") rules(prio, r0, r1, f0, f1, segment)"

B["client_segments"] = """
SELECT client, arg_min(segment, prio) AS segment FROM client_fifths JOIN segment_rules ON r BETWEEN r0 AND r1 AND f BETWEEN f0 AND f1 GROUP BY client"""

B["mart_rfm"] = """
SELECT x.client AS sk_customer, w.customer_id, w.customer_type, w.customer_display_name, w.territory_id,
       date_diff('day', last_day, (SELECT max(last_day) FROM client_facts)) AS recency_days, n AS frequency_orders, spent AS monetary_total,
       first_day AS first_order_date, last_day AS last_order_date, r AS r_score, f AS f_score, m AS m_score, r + f + m AS rfm_score,
       CAST(100 * r + 10 * f + m AS VARCHAR) AS rfm_cell, segment AS rfm_segment,
       coalesce((SELECT sum(net_amount) FROM fct_line z WHERE z.sk_customer = x.client), 0) AS lifetime_revenue,
       coalesce((SELECT sum(gross_margin) FROM fct_line z WHERE z.sk_customer = x.client), 0) AS lifetime_margin
FROM client_facts x NATURAL JOIN client_fifths NATURAL JOIN client_segments LEFT JOIN dim_customer w ON w.sk_customer = x.client
WHERE x.client <> '-1'"""

B["item_sums"] = """
SELECT sk_product AS item, sum(net_amount) AS sold, sum(gross_margin) AS earned, sum(order_qty) AS pieces, count(*) AS n
FROM fct_line GROUP BY item HAVING item <> '-1'"""

# Place and running revenue of a product by comparison with every product that sells at least as much.
B["item_places"] = """
SELECT a.item, count(*) AS place, sum(b.sold) AS upto FROM item_sums a JOIN item_sums b
  ON b.sold > a.sold OR b.sold = a.sold AND b.item <= a.item GROUP BY a.item"""

_SHARE = ratio("upto", "(SELECT sum(sold) FROM item_sums)")
B["mart_pareto"] = f"""
SELECT item AS sk_product, w.product_id, w.product_name, w.subcategory_name, w.category_name, sold AS revenue, earned AS margin,
       {ratio('earned', 'sold')} AS margin_pct, pieces AS units_sold, n AS line_count, place AS revenue_rank,
       {_SHARE} AS cumulative_revenue_pct,
       ['A', 'B', 'C'][1 + CAST({_SHARE} > 0.80 AS INTEGER) + CAST({_SHARE} > 0.95 AS INTEGER)] AS abc_class
FROM item_sums JOIN item_places USING (item) LEFT JOIN dim_product w ON w.sk_product = item"""

# Sales and quotas in one list, told apart by which amount is filled.
B["seller_entries"] = f"""
SELECT sk_salesperson AS seller, {_QUARTER.format(k='sk_order_date')} AS q, net_amount, gross_margin, sales_order_id, NULL AS quota FROM fct_line
UNION ALL
SELECT sk_salesperson, {_QUARTER.format(k='sk_quota_date')}, NULL, NULL, NULL, quota_amount FROM fct_quota"""

B["seller_quarters"] = """
SELECT seller, q, sum(quota) AS quota, coalesce(sum(net_amount), 0) AS sold, coalesce(sum(gross_margin), 0) AS earned,
       count(DISTINCT sales_order_id) AS n, bool_or(sales_order_id IS NOT NULL) AS any_sale
FROM seller_entries WHERE seller <> -1 GROUP BY seller, q"""

B["mart_quota"] = f"""
SELECT seller AS sk_salesperson, w.salesperson_id, w.salesperson_name, q AS year_quarter,
       CASE WHEN any_sale THEN CAST(split_part(q, '-Q', 1) AS INTEGER) END AS year,
       CASE WHEN any_sale THEN CAST(split_part(q, '-Q', 2) AS INTEGER) END AS quarter,
       quota AS quota_amount, sold AS actual_revenue, earned AS actual_margin, n AS orders,
       sold - coalesce(quota, 0) AS variance_to_quota, {ratio('sold', 'quota')} AS attainment_pct,
       ['{ATTAINMENT[0]}', '{ATTAINMENT[2]}', '{ATTAINMENT[1]}'][CASE WHEN quota IS NULL THEN 1 ELSE 2 + CAST(sold >= quota AS INTEGER) END] AS attainment_status
FROM seller_quarters LEFT JOIN dim_salesperson w ON w.sk_salesperson = seller"""


# ------------------------------------------------------------------ assembly
_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str) -> list[str]:
    words = set(_NAME.findall(B[name]))
    return [b for b in B if b != name and b in words]


def with_blocks(final: str) -> str:
    """Prefix ``final`` with the CTE blocks it references, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for n in B:
        if re.search(rf"\b{n}\b", final):
            visit(n)
    if not order:
        return final
    ctes = ",\n".join(f"{n} AS ({B[n]}\n)" for n in order)
    return f"WITH {ctes}\n{final}"


def canonical_select(cols: dict[str, str], source: str, where: str = "", extra: str = "") -> str:
    """``SELECT`` in comparison form; ``cols`` maps output name -> kind, where kind is one
    of i (integer), m (decimal), f (double), d (date), t (timestamp), s (text), b (bool)
    or ``expr:<kind>:<sql>`` for a computed column."""
    out = []
    for name, kind in cols.items():
        expr = name
        if kind.startswith("expr:"):
            _, kind, expr = kind.split(":", 2)
        if kind == "i":
            out.append(f"CAST({expr} AS BIGINT) AS {name}")
        elif kind == "m":
            out.append(f"CAST(CAST({expr} AS DECIMAL(38,8)) AS VARCHAR) AS {name}")
        elif kind == "f":
            out.append(f"CAST({expr} AS DOUBLE) AS {name}")
        elif kind == "d":
            out.append(f"{d_text(expr)} AS {name}")
        elif kind == "t":
            out.append(f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name}")
        else:
            out.append(f"{expr} AS {name}")
    sql = f"SELECT {', '.join(out)} FROM {source}"
    if where:
        sql += f" WHERE {where}"
    if extra:
        sql += f" {extra}"
    return with_blocks(sql)
