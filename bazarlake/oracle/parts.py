"""Building blocks: rounding rules in integer arithmetic, and the common table expressions."""

from __future__ import annotations

import re

TS = "TIMESTAMP '2024-01-01 00:00:00'"
RUN = "'20240101T000000Z'"


def half_up(numerator: str, denominator: str) -> str:
    """Rounded quotient of non-negative integers, NULL for a zero denominator."""
    return f"((2 * ({numerator}) + ({denominator})) // nullif(2 * ({denominator}), 0))"


def whole_hundredths(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


def mean2(x: str) -> str:
    return f"CAST({half_up(f'sum({whole_hundredths(x)})', f'count({x})')} AS DOUBLE) / 100"


def mean2_money(x: str) -> str:
    return f"CAST({mean2(x)} AS DECIMAL(18,2))"


def rate_pct(condition: str) -> str:
    return f"CAST({half_up(f'10000 * count(*) FILTER ({condition})', 'count(*)')} AS DOUBLE) / 100"


def tristate_pct(condition: str) -> str:
    return f"CAST({half_up(f'10000 * count(*) FILTER ({condition})', f'count({condition})')} AS DOUBLE) / 100"


def share_pct(part: str, whole: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"CAST({half_up(f'{100 * scale} * CAST({part} AS HUGEINT)', whole)} AS DOUBLE) / {scale}"


def norm(x: str) -> str:
    return f"lower(trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g')))"


def capitalised(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({x}, ' '),"
        " lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"
    )


def city(x: str) -> str:
    return capitalised(norm(x))


def zip5(x: str) -> str:
    return f"lpad(regexp_replace(trim({x}), '\\.0$', ''), 5, '0')"


def ts(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMP)"


def date_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def band_hash(*columns: str) -> str:
    return "sha256(" + " || '||' || ".join(columns) + ")"


def first_row(source: str, keys: str, order: str, columns: str) -> str:
    ordered = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordered}) AS rn"
        f" FROM ({source})) WHERE rn = 1"
    )


STATUSES = "('created','approved','invoiced','processing','shipped','delivered','unavailable','canceled')"

CTES: dict[str, str] = {}

# ---------------------------------------------------------------- the nine feeds as text

_STAMP = "'%Y-%m-%d %H:%M:%S'"


def _later(days: str, hours: int = 0) -> str:
    return f"strftime(o_orderdate + INTERVAL 1 DAY * ({days}) + INTERVAL {hours} HOUR, {_STAMP})"


def _cents(x: str) -> str:
    return f"CAST(CAST(({x}) / 100.0 AS DECIMAL(18,2)) AS VARCHAR)"


CTES["a_orders"] = """
SELECT o.*, CAST(2 + o_orderkey % 20 + 3 * (s % 4) AS INTEGER) AS days,
  CASE WHEN o_orderkey % 40 = 0 THEN 'canceled' WHEN o_orderkey % 41 = 1 THEN 'lost'
       WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN ' Shipped ' ELSE 'Delivered' END AS status
FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""

_ORDER_ROW = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'C' || o_orderkey AS customer_id, status AS order_status,
  CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-date' ELSE {_later('0')} END AS order_purchase_timestamp,
  {_later('0', 1)} AS order_approved_at, {_later('2')} AS order_delivered_carrier_date,
  CASE WHEN status = 'Delivered' THEN {_later('days')} END AS order_delivered_customer_date,
  {_later('24')} AS order_estimated_delivery_date
FROM a_orders"""
CTES["f_orders"] = f"{_ORDER_ROW} UNION ALL {_ORDER_ROW} WHERE o_orderkey % 500 = 3"

CTES["f_customers"] = """
SELECT 'C' || o_orderkey AS customer_id, 'U' || (o_custkey * 10 + o_orderkey % 10) AS customer_unique_id,
  (37 * c_nationkey) || CASE WHEN o_orderkey % 10 = 0 THEN '.0' ELSE '' END AS customer_zip_code_prefix,
  'cidade  ' || n_name AS customer_city, ' n' || c_nationkey AS customer_state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

CTES["f_order_items"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
  CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
  strftime(l_shipdate, {_STAMP}) AS shipping_limit_date,
  {_cents("CASE WHEN l_quantity = 17 THEN 0 ELSE floor(l_extendedprice / 10) END")} AS price,
  CAST(CASE WHEN l_quantity = 13 THEN -1 ELSE CAST(l_quantity AS BIGINT) END AS VARCHAR) AS freight_value
FROM lineitem"""

CTES["a_payments"] = """
SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS total, CASE WHEN o_orderkey % 67 = 0 THEN -1 ELSE 1 END AS sign
FROM orders"""
CTES["f_order_payments"] = f"""
SELECT CAST(k AS VARCHAR) AS order_id, CAST(seq AS VARCHAR) AS payment_sequential,
  ['CREDIT_CARD', 'boleto', 'voucher', 'debit_card'][CAST((k + seq) % 4 AS INTEGER) + 1] AS payment_type,
  CAST(installments AS VARCHAR) AS payment_installments, {_cents('amount * sign')} AS payment_value
FROM (
  SELECT k, sign, 1 AS seq, 1 + k % 10 AS installments, CASE WHEN k % 5 = 0 THEN total // 2 ELSE total END AS amount FROM a_payments
  UNION ALL SELECT k, sign, 2, 1 + k % 10, total - total // 2 FROM a_payments WHERE k % 5 = 0
  UNION ALL SELECT k, sign, 1, 2 + k % 10, CASE WHEN k % 5 = 0 THEN total // 2 ELSE total END FROM a_payments WHERE k % 53 = 0)"""

CTES["f_order_reviews"] = f"""
SELECT review_id, CAST(o_orderkey AS VARCHAR) AS order_id, review_score, CAST(NULL AS VARCHAR) AS review_comment_title,
  ' ' || o_orderpriority || ' ' AS review_comment_message,
  {_later('40')} AS review_creation_date, {_later('41')} AS review_answer_timestamp
FROM (
  SELECT *, 'R' || CASE WHEN o_orderkey % 60 = 7 THEN o_orderkey - 1 ELSE o_orderkey END AS review_id,
    CASE WHEN o_orderkey % 101 = 0 THEN 'x'
         WHEN status = 'Delivered' AND days > 24 THEN CAST(1 + o_orderkey % 3 AS VARCHAR)
         ELSE CAST(3 + (o_orderkey // 7) % 3 AS VARCHAR) END AS review_score
  FROM a_orders WHERE o_orderkey % 11 <> 0
  UNION ALL
  SELECT *, 'S' || o_orderkey, CAST(5 - o_orderkey % 4 AS VARCHAR) FROM a_orders WHERE o_orderkey % 50 <= 3)"""

CTES["f_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_partkey % 50 <> 0 THEN ' ' || p_type END AS product_category_name,
  CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
  CASE WHEN p_partkey % 40 = 0 THEN 'n/a' ELSE CAST(length(p_name) * 10 AS VARCHAR) END AS product_description_lenght,
  CAST(p_size AS VARCHAR) AS product_photos_qty, CAST(p_size * 100 AS VARCHAR) AS product_weight_g,
  CAST(p_size + 10 AS VARCHAR) AS product_length_cm, CAST(p_size + 5 AS VARCHAR) AS product_height_cm,
  CAST(p_size + 8 AS VARCHAR) AS product_width_cm
FROM part"""

CTES["f_sellers"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(37 * s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
  'cidade  ' || n_name AS seller_city, ' n' || s_nationkey AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTES["f_category_translation"] = """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) || '_en' AS product_category_name_english
FROM part WHERE p_type <> 'PROMO'"""

CTES["f_geolocation"] = f"""
SELECT CAST(37 * n_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
  {_cents('CASE WHEN j = 3 OR n_nationkey = 24 THEN 5000 ELSE -3000 + 140 * n_nationkey + j END')} AS geolocation_lat,
  {_cents('-7000 + 150 * n_nationkey + j')} AS geolocation_lng,
  CASE WHEN j = 1 THEN 'vila ' ELSE 'cidade  ' END || n_name AS geolocation_city, ' n' || n_nationkey AS geolocation_state
FROM nation, range(4) r(j)"""

FEED_COLUMNS = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city geolocation_state",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
    "order_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "order_reviews": "review_id order_id review_score review_comment_title review_comment_message"
    " review_creation_date review_answer_timestamp",
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at"
    " order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
    "products": "product_id product_category_name product_name_lenght product_description_lenght product_photos_qty"
    " product_weight_g product_length_cm product_height_cm product_width_cm",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "category_translation": "product_category_name product_category_name_english",
}

for _feed, _columns in FEED_COLUMNS.items():
    _text = " || '||' || ".join(f"coalesce({c}, '∅')" for c in _columns.split())
    CTES[f"bronze_{_feed}"] = (
        f"SELECT *, '{_feed}.csv' AS source_file, {TS} AS ingestion_timestamp_utc, {RUN} AS pipeline_run_id,"
        f" sha256({_text}) AS record_hash FROM f_{_feed}"
    )

# ---------------------------------------------------------------- silver

LINEAGE = "source_file, ingestion_timestamp_utc, pipeline_run_id, record_hash"

CTES["l_customers"] = first_row(
    f"""SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
      {zip5('customer_zip_code_prefix')} AS customer_zip_code_prefix, {city('customer_city')} AS customer_city,
      upper(trim(customer_state)) AS customer_state, {LINEAGE} FROM bronze_customers WHERE trim(customer_id) <> ''""",
    "customer_id",
    "customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, record_hash",
    "* EXCLUDE (rn)",
)
CTES["l_sellers"] = first_row(
    f"""SELECT trim(seller_id) AS seller_id, {zip5('seller_zip_code_prefix')} AS seller_zip_code_prefix,
      {city('seller_city')} AS seller_city, upper(trim(seller_state)) AS seller_state, {LINEAGE}
      FROM bronze_sellers WHERE trim(seller_id) <> ''""",
    "seller_id",
    "seller_zip_code_prefix, seller_city, seller_state, record_hash",
    "* EXCLUDE (rn)",
)
CTES["l_category_translation"] = first_row(
    f"""SELECT {norm('product_category_name')} AS product_category_name,
      {norm('product_category_name_english')} AS product_category_name_english, {LINEAGE}
      FROM bronze_category_translation WHERE {norm('product_category_name')} <> ''""",
    "product_category_name",
    "product_category_name_english, record_hash",
    "* EXCLUDE (rn)",
)
_DOUBLES = ", ".join(
    f"TRY_CAST(product_{m} AS DOUBLE) AS product_{m}" for m in ("weight_g", "length_cm", "height_cm", "width_cm")
)
CTES["l_products"] = first_row(
    f"""SELECT trim(product_id) AS product_id, {norm('product_category_name')} AS product_category_name,
      TRY_CAST(product_name_lenght AS INTEGER) AS product_name_length,
      TRY_CAST(product_description_lenght AS INTEGER) AS product_description_length,
      TRY_CAST(product_photos_qty AS INTEGER) AS product_photos_qty, {_DOUBLES}, {LINEAGE}
      FROM bronze_products WHERE trim(product_id) <> ''""",
    "product_id",
    "product_category_name, product_name_length, record_hash",
    "* EXCLUDE (rn)",
)
CTES["orders_typed"] = f"""
SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, {norm('order_status')} AS order_status,
  {ts('order_purchase_timestamp')} AS order_purchase_timestamp, {ts('order_approved_at')} AS order_approved_at,
  {ts('order_delivered_carrier_date')} AS order_delivered_carrier_date,
  {ts('order_delivered_customer_date')} AS order_delivered_customer_date,
  {ts('order_estimated_delivery_date')} AS order_estimated_delivery_date, {LINEAGE}
FROM bronze_orders"""


def _reasons(*rules: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {test} THEN '{reason}' END" for reason, test in rules)
    return f"concat_ws('; ', {cases})"


ORDER_REASONS = _reasons(
    ("order_id ausente", "coalesce(order_id, '') = ''"),
    ("customer_id ausente", "coalesce(customer_id, '') = ''"),
    ("data de compra inválida ou ausente", "order_purchase_timestamp IS NULL"),
    ("status de pedido inválido", f"order_status NOT IN {STATUSES}"),
)
ITEM_REASONS = _reasons(
    ("order_id ausente", "coalesce(order_id, '') = ''"),
    ("order_item_id inválido", "order_item_id IS NULL"),
    ("product_id ausente", "coalesce(product_id, '') = ''"),
    ("seller_id ausente", "coalesce(seller_id, '') = ''"),
    ("preço inválido", "coalesce(price, -1) < 0"),
    ("frete inválido", "coalesce(freight_value, -1) < 0"),
)
CTES["orders_judged"] = f"SELECT *, {ORDER_REASONS} AS quarantine_reason FROM orders_typed"
CTES["l_quarantine_orders"] = "SELECT * FROM orders_judged WHERE quarantine_reason <> ''"
CTES["l_orders"] = first_row(
    "SELECT * EXCLUDE (quarantine_reason) FROM orders_judged WHERE quarantine_reason = ''",
    "order_id",
    "customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,"
    " order_delivered_customer_date, order_estimated_delivery_date, record_hash",
    "* EXCLUDE (rn)",
)
CTES["items_typed"] = f"""
SELECT trim(order_id) AS order_id, TRY_CAST(order_item_id AS INTEGER) AS order_item_id, trim(product_id) AS product_id,
  trim(seller_id) AS seller_id, {ts('shipping_limit_date')} AS shipping_limit_date,
  TRY_CAST(price AS DECIMAL(18,2)) AS price, TRY_CAST(freight_value AS DECIMAL(18,2)) AS freight_value, {LINEAGE}
FROM bronze_order_items"""
CTES["items_judged"] = f"SELECT *, {ITEM_REASONS} AS quarantine_reason FROM items_typed"
CTES["l_quarantine_order_items"] = "SELECT * FROM items_judged WHERE quarantine_reason <> ''"
CTES["l_order_items"] = first_row(
    "SELECT * EXCLUDE (quarantine_reason) FROM items_judged WHERE quarantine_reason = ''",
    "order_id, order_item_id",
    "seller_id, product_id, price, freight_value, shipping_limit_date, record_hash",
    "* EXCLUDE (rn)",
)
for _entity in (
    "customers",
    "sellers",
    "category_translation",
    "products",
    "orders",
    "quarantine_orders",
    "order_items",
    "quarantine_order_items",
):
    CTES[f"silver_{_entity}"] = f"SELECT * EXCLUDE ({LINEAGE}) FROM l_{_entity}"

CTES["payments_typed"] = first_row(
    f"""SELECT trim(order_id) AS order_id, TRY_CAST(payment_sequential AS INTEGER) AS payment_sequential,
      {norm('payment_type')} AS payment_type, TRY_CAST(payment_installments AS INTEGER) AS payment_installments,
      TRY_CAST(payment_value AS DECIMAL(18,2)) AS payment_value
      FROM f_order_payments WHERE trim(order_id) <> '' AND TRY_CAST(payment_value AS DECIMAL(18,2)) >= 0""",
    "order_id, payment_sequential",
    "payment_type, payment_installments, payment_value",
    "* EXCLUDE (rn)",
)
CTES["silver_payments_order_agg"] = """
SELECT order_id, CAST(sum(payment_value) AS DECIMAL(28,2)) AS payment_total_value, count(*) AS payment_record_count,
  max(payment_installments) AS max_payment_installments,
  array_to_string(list_sort(list(DISTINCT payment_type)), '|') AS payment_types
FROM payments_typed GROUP BY order_id"""

_REVIEW_TS = ", ".join(
    f"try_strptime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ("review_creation_date", "review_answer_timestamp")
)
CTES["reviews_typed"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY review_id
  ORDER BY review_answer_timestamp DESC NULLS LAST, order_id, review_score) AS rn FROM (
    SELECT trim(review_id) AS review_id, trim(order_id) AS order_id, TRY_CAST(review_score AS INTEGER) AS review_score,
      trim(review_comment_title) AS review_comment_title, trim(review_comment_message) AS review_comment_message,
      %s
    FROM f_order_reviews WHERE trim(order_id) <> '' AND TRY_CAST(review_score AS INTEGER) BETWEEN 1 AND 5)) WHERE rn = 1""" % _REVIEW_TS
CTES["silver_reviews_order_agg"] = f"""
SELECT order_id, {mean2('review_score')} AS review_score_avg, min(review_score) AS review_score_min,
  max(review_score) AS review_score_max, count(*) AS review_count, max(review_creation_date) AS latest_review_creation_date
FROM reviews_typed GROUP BY order_id"""

CTES["geolocation_typed"] = f"""
SELECT * FROM (SELECT {zip5('geolocation_zip_code_prefix')} AS zip_code_prefix, TRY_CAST(geolocation_lat AS DOUBLE) AS latitude,
  TRY_CAST(geolocation_lng AS DOUBLE) AS longitude, {city('geolocation_city')} AS geolocation_city,
  upper(trim(geolocation_state)) AS geolocation_state FROM f_geolocation)
WHERE zip_code_prefix <> '' AND latitude BETWEEN -35 AND 6 AND longitude BETWEEN -75 AND -30"""
CTES["silver_geolocation_zip_agg"] = """
SELECT zip_code_prefix, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
  arg_min(geolocation_city, geolocation_city || chr(1) || geolocation_state) AS geolocation_city,
  arg_min(geolocation_state, geolocation_city || chr(1) || geolocation_state) AS geolocation_state,
  count(*) AS geolocation_record_count
FROM geolocation_typed GROUP BY zip_code_prefix"""

_RATIO = (
    "((2 * CAST(freight_value * 100 AS HUGEINT) * 1000000000000 + CAST(price * 100 AS HUGEINT))"
    " // nullif(2 * CAST(price * 100 AS HUGEINT), 0))"
)
CTES["item_metrics"] = f"""
SELECT order_id, CAST(sum(price) AS DECIMAL(28,2)) AS product_total_value,
  CAST(sum(freight_value) AS DECIMAL(28,2)) AS freight_total_value,
  CAST(sum(price + freight_value) AS DECIMAL(29,2)) AS gmv_total_value, count(*) AS order_item_count,
  count(DISTINCT product_id) AS distinct_product_count, count(DISTINCT seller_id) AS distinct_seller_count,
  CAST(CAST({half_up(f'sum({_RATIO})', f'100000000 * count({_RATIO})')} AS DOUBLE) / 10000 AS DECIMAL(18,4))
    AS avg_freight_to_price_ratio,
  arg_min(seller_id, order_item_id) AS primary_seller_id
FROM silver_order_items GROUP BY order_id"""
CTES["order_items_agg"] = "SELECT * EXCLUDE (primary_seller_id) FROM item_metrics"
CTES["order_primary_seller"] = (
    "SELECT order_id, primary_seller_id, distinct_seller_count AS seller_count FROM item_metrics"
)
CTES["seller_origin"] = """
SELECT seller_id AS primary_seller_id, seller_zip_code_prefix, seller_city, seller_state,
  latitude AS seller_latitude_geo, longitude AS seller_longitude_geo
FROM silver_sellers LEFT JOIN silver_geolocation_zip_agg ON seller_zip_code_prefix = zip_code_prefix"""
CTES["customer_destination"] = """
SELECT zip_code_prefix AS customer_zip_code_prefix_geo, latitude AS customer_latitude_geo,
  longitude AS customer_longitude_geo FROM silver_geolocation_zip_agg"""


def _days(a: str, b: str) -> str:
    return f"round((epoch({b}) - epoch({a})) / 86400.0, 2)"


_BOUGHT, _GOT, _DUE = "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"
CTES["silver_order_service_base"] = f"""
SELECT o.order_id, o.customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, order_status,
  order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
  order_estimated_delivery_date, i.* EXCLUDE (order_id, primary_seller_id), p.* EXCLUDE (order_id), r.* EXCLUDE (order_id),
  {_days(_BOUGHT, _GOT)} AS actual_delivery_days,
  CASE WHEN {_GOT} IS NOT NULL AND {_DUE} IS NOT NULL THEN greatest(0.0::DOUBLE, {_days(_DUE, _GOT)}) END AS delivery_delay_days,
  CASE WHEN {_GOT} IS NOT NULL AND {_DUE} IS NOT NULL THEN greatest(0.0::DOUBLE, {_days(_GOT, _DUE)}) END AS delivery_early_days,
  order_status = 'delivered' AS is_delivered, {_GOT} > {_DUE} AS is_delivery_late, {_GOT} <= {_DUE} AS is_delivery_on_time,
  review_score_avg <= 2 AS is_low_review, 'marketplace_web' AS sales_channel
FROM silver_orders o LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
  LEFT JOIN item_metrics i ON o.order_id = i.order_id
  LEFT JOIN silver_payments_order_agg p ON o.order_id = p.order_id
  LEFT JOIN silver_reviews_order_agg r ON o.order_id = r.order_id"""

_SINE_LAT = "sin((radians(customer_latitude_geo) - radians(seller_latitude_geo)) / 2)"
_SINE_LNG = "sin((radians(customer_longitude_geo) - radians(seller_longitude_geo)) / 2)"
CTES["order_places"] = f"""
SELECT b.*, primary_seller_id, seller_count, seller_zip_code_prefix, seller_city, seller_state, seller_latitude_geo,
  seller_longitude_geo, customer_latitude_geo, customer_longitude_geo,
  CASE WHEN seller_latitude_geo IS NOT NULL AND customer_latitude_geo IS NOT NULL THEN
    round(2 * 6371.0 * asin(sqrt(least(1.0::DOUBLE, pow({_SINE_LAT}, 2)
      + cos(radians(seller_latitude_geo)) * cos(radians(customer_latitude_geo)) * pow({_SINE_LNG}, 2)))), 2) END
    AS seller_customer_distance_km
FROM silver_order_service_base b LEFT JOIN order_primary_seller USING (order_id) LEFT JOIN seller_origin USING (primary_seller_id)
  LEFT JOIN customer_destination ON customer_zip_code_prefix = customer_zip_code_prefix_geo"""
CTES["silver_order_service"] = """
SELECT *,
  CASE WHEN seller_customer_distance_km IS NULL THEN 'not_available' WHEN seller_customer_distance_km < 100 THEN 'under_100_km'
    WHEN seller_customer_distance_km < 500 THEN '100_to_499_km' WHEN seller_customer_distance_km < 1000 THEN '500_to_999_km'
    WHEN seller_customer_distance_km < 2000 THEN '1000_to_1999_km' ELSE '2000_km_or_more' END AS distance_band,
  CASE WHEN is_delivery_late IS NULL THEN 'not_evaluated' WHEN is_delivery_late THEN 'late'
    WHEN delivery_early_days >= 3 THEN 'early_3_days_or_more' ELSE 'on_time' END AS delivery_performance_band,
  CASE WHEN review_score_avg IS NULL THEN 'not_reviewed' WHEN review_score_avg <= 2 THEN 'low_1_2'
    WHEN review_score_avg = 3 THEN 'neutral_3' ELSE 'high_4_5' END AS review_band
FROM order_places"""

# ---------------------------------------------------------------- gold

CTES["dim_date"] = """
SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(full_date) AS INTEGER) AS year,
  CAST(month(full_date) AS INTEGER) AS month_number, strftime(full_date, '%B') AS month_name,
  strftime(full_date, '%Y-%m') AS year_month, CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week_number,
  strftime(full_date, '%A') AS day_of_week_name, dayofweek(full_date) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT CAST(unnest([order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
  order_delivered_customer_date, order_estimated_delivery_date]) AS DATE) AS full_date FROM silver_order_service)
WHERE full_date IS NOT NULL"""
CTES["customer_metrics"] = f"""
SELECT customer_unique_id, count(DISTINCT order_id) AS lifetime_order_count,
  CAST(sum(gmv_total_value) AS DECIMAL(38,2)) AS lifetime_gmv, {mean2_money('gmv_total_value')} AS lifetime_avg_ticket,
  min(order_purchase_timestamp) AS first_order_timestamp, max(order_purchase_timestamp) AS last_order_timestamp
FROM silver_order_service WHERE customer_unique_id IS NOT NULL GROUP BY 1"""
CTES["customer_reference"] = """
SELECT customer_unique_id, customer_city, customer_state, customer_zip_code_prefix FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp DESC NULLS LAST, order_id DESC) AS rn
  FROM silver_order_service WHERE customer_unique_id IS NOT NULL) WHERE rn = 1"""
CTES["dim_customer"] = """
SELECT *, lifetime_order_count > 1 AS is_repeat_customer,
  CASE WHEN lifetime_gmv < 100 THEN 'under_100' WHEN lifetime_gmv < 300 THEN '100_to_299'
    WHEN lifetime_gmv < 600 THEN '300_to_599' ELSE '600_or_more' END AS customer_value_band
FROM customer_metrics LEFT JOIN customer_reference USING (customer_unique_id)"""
CTES["dim_product"] = """
SELECT product_id, p.product_category_name, coalesce(product_category_name_english, 'not_available') AS product_category_name_english,
  product_name_length, product_description_length, product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
FROM silver_products p LEFT JOIN silver_category_translation c ON p.product_category_name = c.product_category_name"""
CTES["seller_metrics"] = """
SELECT seller_id, count(DISTINCT order_id) AS lifetime_order_count,
  CAST(sum(price) AS DECIMAL(28,2)) AS lifetime_product_revenue, CAST(sum(freight_value) AS DECIMAL(28,2)) AS lifetime_freight_value
FROM silver_order_items GROUP BY 1"""
CTES["dim_seller"] = """
SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, coalesce(lifetime_order_count, 0) AS lifetime_order_count,
  CAST(coalesce(lifetime_product_revenue, 0) AS DECIMAL(28,2)) AS lifetime_product_revenue,
  CAST(coalesce(lifetime_freight_value, 0) AS DECIMAL(28,2)) AS lifetime_freight_value
FROM silver_sellers LEFT JOIN seller_metrics USING (seller_id)"""
CTES["dim_location"] = """
SELECT location_role, zip_code_prefix, city, state, latitude, longitude FROM (
  SELECT *, row_number() OVER (PARTITION BY location_role, zip_code_prefix, city, state ORDER BY latitude NULLS FIRST, longitude NULLS FIRST) AS rn
  FROM (SELECT 'customer' AS location_role, customer_zip_code_prefix AS zip_code_prefix, customer_city AS city, customer_state AS state,
      customer_latitude_geo AS latitude, customer_longitude_geo AS longitude FROM silver_order_service
    UNION ALL SELECT 'seller', seller_zip_code_prefix, seller_city, seller_state, seller_latitude_geo, seller_longitude_geo
    FROM silver_order_service) WHERE zip_code_prefix IS NOT NULL) WHERE rn = 1"""
CTES["dim_service_band"] = f"""
SELECT DISTINCT {band_hash('distance_band', 'delivery_performance_band', 'review_band')} AS service_band_key,
  distance_band, delivery_performance_band, review_band FROM silver_order_service"""
CTES["fact_order_service"] = f"""
SELECT order_id, {date_key(_BOUGHT)} AS purchase_date_key, {date_key(_GOT)} AS delivery_date_key, customer_unique_id,
  customer_zip_code_prefix, primary_seller_id AS seller_id, b.service_band_key, order_status, order_item_count,
  distinct_product_count, distinct_seller_count, product_total_value, freight_total_value, gmv_total_value,
  payment_total_value, payment_record_count, max_payment_installments, payment_types, review_score_avg, review_count,
  actual_delivery_days, delivery_delay_days, delivery_early_days, is_delivered, is_delivery_late, is_delivery_on_time,
  seller_count, seller_customer_distance_km, distance_band, delivery_performance_band, review_band, sales_channel
FROM silver_order_service LEFT JOIN dim_service_band b USING (distance_band, delivery_performance_band, review_band)"""
CTES["fact_order_item_sales"] = f"""
SELECT i.order_id, order_item_id, {date_key(_BOUGHT)} AS purchase_date_key, customer_unique_id, customer_zip_code_prefix,
  product_id, i.seller_id, shipping_limit_date, price AS product_price, freight_value,
  CAST(price + freight_value AS DECIMAL(19,2)) AS item_gmv,
  CAST(CAST((2 * CAST(freight_value * 100 AS BIGINT) * 10000 + CAST(price * 100 AS BIGINT)) // nullif(2 * CAST(price * 100 AS BIGINT), 0)
    AS DOUBLE) / 10000 AS DECIMAL(18,4)) AS freight_to_price_ratio,
  order_status, is_delivery_late, is_delivery_on_time, review_score_avg, seller_customer_distance_km, distance_band, sales_channel
FROM silver_order_items i JOIN silver_order_service o ON i.order_id = o.order_id"""
_LOW = "review_score_avg <= 2"
CTES["mart_logistics_performance"] = f"""
SELECT seller_id, count(DISTINCT order_id) AS delivered_order_count, CAST(sum(gmv_total_value) AS DECIMAL(38,2)) AS gmv_total_value,
  {mean2('actual_delivery_days')} AS avg_delivery_days, {rate_pct('is_delivery_late')} AS late_delivery_rate_pct,
  {mean2('delivery_delay_days')} AS avg_delay_days, {mean2_money('freight_total_value')} AS avg_freight_value,
  {mean2('review_score_avg')} AS avg_review_score, {rate_pct(_LOW)} AS low_review_rate_pct
FROM fact_order_service WHERE order_status = 'delivered' AND is_delivery_late IS NOT NULL GROUP BY seller_id"""
CTES["seller_risk"] = """
SELECT *, CASE WHEN late_delivery_rate_pct >= 20 OR avg_review_score < 3.5 THEN 'high'
  WHEN late_delivery_rate_pct >= 10 OR avg_review_score < 4.0 THEN 'medium' ELSE 'low' END AS service_risk_level
FROM mart_logistics_performance"""


def ranked(lead: str) -> str:
    return f"""SELECT *, CAST(row_number() OVER (ORDER BY {lead}, gmv_total_value DESC NULLS LAST, late_delivery_rate_pct DESC,
      seller_id NULLS LAST) AS INTEGER) AS priority_rank FROM seller_risk"""


CTES["mart_service_risk"] = ranked("CASE service_risk_level WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END")
CTES["mart_service_risk_by_label"] = ranked("service_risk_level DESC")
CTES["mart_customer_experience"] = f"""
SELECT distance_band, is_delivery_late, count(DISTINCT order_id) AS delivered_order_count,
  {mean2('actual_delivery_days')} AS avg_delivery_days, {mean2_money('freight_total_value')} AS avg_freight_value,
  {mean2('review_score_avg')} AS avg_review_score, {rate_pct(_LOW)} AS low_review_rate_pct
FROM fact_order_service WHERE order_status = 'delivered' GROUP BY 1, 2"""
CTES["mart_monthly_operations"] = f"""
SELECT strftime(strptime(CAST(purchase_date_key AS VARCHAR), '%Y%m%d'), '%Y-%m') AS purchase_year_month,
  count(DISTINCT order_id) AS order_count, CAST(sum(gmv_total_value) AS DECIMAL(38,2)) AS gmv_total_value,
  {mean2_money('gmv_total_value')} AS avg_ticket_value, {mean2('actual_delivery_days')} AS avg_delivery_days,
  {rate_pct('is_delivery_late')} AS late_delivery_rate_pct, {mean2('review_score_avg')} AS avg_review_score
FROM fact_order_service WHERE purchase_date_key IS NOT NULL GROUP BY 1"""


def _needed(sql: str, found: list[str]) -> None:
    for name in CTES:
        if name not in found and re.search(rf"(?<![\w.']){name}(?![\w'])", sql):
            _needed(CTES[name], found)
            if name not in found:
                found.append(name)


def statement(sql: str) -> str:
    """The query with exactly the table expressions it refers to, in dependency order."""
    found: list[str] = []
    _needed(sql, found)
    if not found:
        return sql
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in found) + "\n" + sql
