"""The expected result of each query as one DuckDB statement."""

from __future__ import annotations

from bazarlake.functions.lineage import BRONZE_LINEAGE, GOLD_LINEAGE, SILVER_LINEAGE
from bazarlake.lake import LAYERS
from bazarlake.oracle.parts import (
    FEED_COLUMNS,
    RUN,
    STATUSES,
    TS,
    capitalised,
    city,
    mean2,
    mean2_money,
    norm,
    rate_pct,
    share_pct,
    statement,
    tristate_pct,
    ts,
    zip5,
)
from bazarlake.plans import glossary as g
from bazarlake.plans import quality as q

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- sources, sinks, lineage

SQL["src_csv_text"] = "SELECT * FROM f_orders"
_ORDER_NUMBER = "CAST(trim(order_id) AS BIGINT)"
SQL["src_csv_checked"] = f"""
SELECT CASE WHEN {_ORDER_NUMBER} % 97 = 1 THEN 'too many fields' WHEN {_ORDER_NUMBER} % 89 = 1 THEN 'too few fields'
            WHEN {_ORDER_NUMBER} % 83 = 1 THEN 'unbalanced quotes' ELSE 'accepted' END AS verdict,
       count(*) AS record_count,
       count(CASE WHEN {_ORDER_NUMBER} % 97 = 1 OR {_ORDER_NUMBER} % 89 = 1 OR {_ORDER_NUMBER} % 83 <> 1 THEN order_status END)
         AS status_count
FROM f_orders GROUP BY 1"""
SQL["src_table"] = "SELECT * FROM f_products"
SQL["src_sql_table"] = "SELECT order_id, order_item_id, seller_id, price FROM f_order_items"

_FEED_COUNTS = " UNION ALL ".join(
    f"SELECT '{feed}.csv' AS source_file, 'bronze_{feed}' AS table_name, count(*) AS row_count FROM f_{feed}"
    for feed in FEED_COLUMNS
)
SQL["src_local_rows"] = _FEED_COUNTS
SQL["sink_overwrite"] = "SELECT 'silver_orders' AS table_name, count(*) AS row_count FROM silver_orders"
SQL["bronze_lineage"] = (
    "SELECT order_id, order_item_id, source_file, ingestion_timestamp_utc, pipeline_run_id FROM bronze_order_items"
)
SQL["record_hash"] = "SELECT order_id, record_hash FROM bronze_orders"
SQL["ingest_bronze"] = f"SELECT table_name, row_count FROM ({_FEED_COUNTS})"
SQL["silver_lineage"] = (
    f"SELECT seller_id, {RUN} AS silver_pipeline_run_id, {TS} AS silver_processed_timestamp_utc FROM silver_sellers"
)
SQL["gold_lineage"] = (
    f"SELECT product_id, {RUN} AS gold_pipeline_run_id, {TS} AS gold_processed_timestamp_utc FROM dim_product"
)
SQL["layer_manifest_gate"] = f"SELECT source_file, row_count, 'present' AS status FROM ({_FEED_COUNTS})"

# ---------------------------------------------------------------- cleaning expressions and filters

SQL["normalize_text"] = (
    f"SELECT product_id, {norm('product_category_name')} AS product_category_name FROM f_products"
)
SQL["normalize_city"] = (
    f"SELECT geolocation_zip_code_prefix, {city('geolocation_city')} AS geolocation_city FROM f_geolocation"
)
SQL["clean_id"] = (
    "SELECT review_id, trim(review_comment_message) AS review_comment_message FROM f_order_reviews"
)
SQL["clean_state"] = "SELECT customer_id, upper(trim(customer_state)) AS customer_state FROM f_customers"
SQL["zip5"] = (
    f"SELECT customer_id, {zip5('customer_zip_code_prefix')} AS customer_zip_code_prefix FROM f_customers"
)
SQL["cast_numeric"] = """
SELECT product_id, TRY_CAST(product_description_lenght AS INTEGER) AS as_int, TRY_CAST(product_weight_g AS DOUBLE) AS as_double,
  TRY_CAST(product_length_cm AS DECIMAL(18,2)) AS as_money FROM f_products"""
SQL["try_cast_score"] = (
    "SELECT review_id, order_id, TRY_CAST(review_score AS INTEGER) AS review_score FROM f_order_reviews"
)
SQL["parse_timestamp"] = f"""
SELECT order_id, {ts('order_purchase_timestamp')} AS order_purchase_timestamp, {ts('order_approved_at')} AS order_approved_at
FROM f_orders"""
SQL["try_parse_timestamp"] = (
    "SELECT order_id, try_strptime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp FROM f_orders"
)
SQL["rename_columns"] = "SELECT product_id, product_name_lenght AS product_name_length FROM f_products"
SQL["project_qualified"] = """
SELECT i.*, o.customer_id, o.order_status FROM silver_order_items i JOIN silver_orders o ON i.order_id = o.order_id"""
SQL["literal_column"] = "SELECT order_id, 'marketplace_web' AS sales_channel FROM silver_orders"
SQL["coalesce_default"] = """
SELECT product_id, coalesce(product_category_name_english, 'not_available') AS product_category_name_english,
  coalesce(product_description_length, 0) AS product_description_length
FROM silver_products LEFT JOIN silver_category_translation USING (product_category_name)"""
SQL["fill_null_strings"] = (
    "SELECT product_id, coalesce(product_category_name, 'not_available') AS product_category_name FROM f_products"
)
SQL["drop_column"] = "SELECT seller_id, seller_zip_code_prefix, seller_state FROM f_sellers"
SQL["filter_nonblank_key"] = (
    "SELECT product_id, product_category_name FROM f_products WHERE product_category_name <> ''"
)
SQL["filter_range"] = f"SELECT * FROM ({SQL['try_cast_score']}) WHERE review_score BETWEEN 1 AND 5"
SQL["filter_nonnegative"] = """
SELECT * FROM (SELECT order_id, payment_sequential, TRY_CAST(payment_value AS DECIMAL(18,2)) AS payment_value FROM f_order_payments)
WHERE payment_value >= 0"""
SQL["filter_domain"] = f"SELECT order_id, order_status FROM orders_typed WHERE order_status NOT IN {STATUSES}"
SQL["filter_bool_tri"] = """
SELECT order_id, is_delivered, is_delivery_late FROM silver_order_service_base
WHERE is_delivered = true AND is_delivery_late IS NOT NULL"""
SQL["having_min_volume"] = """
SELECT seller_id, count(DISTINCT order_id) AS order_count FROM silver_order_items GROUP BY 1 HAVING count(DISTINCT order_id) >= 20"""

# ---------------------------------------------------------------- silver and gold: the table itself

for _table in (
    "silver_customers",
    "silver_sellers",
    "silver_category_translation",
    "silver_products",
    "silver_orders",
    "silver_order_items",
    "payments_typed",
    "silver_payments_order_agg",
    "reviews_typed",
    "silver_reviews_order_agg",
    "geolocation_typed",
    "silver_geolocation_zip_agg",
    "order_items_agg",
    "order_primary_seller",
    "seller_origin",
    "customer_destination",
    "customer_metrics",
    "customer_reference",
    "seller_metrics",
    "dim_date",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "dim_location",
    "dim_service_band",
    "fact_order_service",
    "fact_order_item_sales",
    "mart_logistics_performance",
    "mart_service_risk",
    "mart_service_risk_by_label",
    "mart_customer_experience",
    "mart_monthly_operations",
):
    SQL[_table] = f"SELECT * FROM {_table}"
_BARE = "SELECT * EXCLUDE (source_file, ingestion_timestamp_utc, pipeline_run_id, record_hash) FROM"
SQL["orders_typed"] = f"{_BARE} orders_typed"
SQL["items_typed"] = f"{_BARE} items_typed"
SQL["quarantine_orders"] = "SELECT * FROM l_quarantine_orders"
SQL["quarantine_order_items"] = "SELECT * FROM l_quarantine_order_items"
SQL["order_service_base"] = "SELECT * FROM silver_order_service_base"
SQL["order_service"] = "SELECT * FROM silver_order_service"

for _column in (
    "actual_delivery_days",
    "delivery_delay_days",
    "delivery_early_days",
    "is_delivered",
    "is_delivery_late",
    "is_delivery_on_time",
    "is_low_review",
):
    SQL[_column] = f"SELECT order_id, {_column} FROM silver_order_service_base"
SQL["seller_customer_distance_km"] = "SELECT order_id, seller_customer_distance_km FROM silver_order_service"
SQL["distance_band"] = "SELECT order_id, seller_customer_distance_km, distance_band FROM silver_order_service"
SQL["delivery_performance_band"] = (
    "SELECT order_id, delivery_early_days, delivery_performance_band FROM silver_order_service"
)
SQL["review_band"] = "SELECT order_id, review_score_avg, review_band FROM silver_order_service"

# ---------------------------------------------------------------- business queries

_ON_TIME = f"{tristate_pct('is_delivery_on_time')} AS on_time_delivery_rate_pct"
_LATE = f"{tristate_pct('is_delivery_late')} AS late_delivery_rate_pct"
_LOW = f"{tristate_pct('review_score_avg <= 2')} AS low_review_rate_pct"

SQL["kpi_overview"] = f"""
SELECT count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_unique_id) AS total_customers,
  count(DISTINCT seller_id) AS total_reference_sellers, CAST(sum(gmv_total_value) AS DECIMAL(38,2)) AS gmv_total_value,
  {mean2_money('gmv_total_value')} AS avg_ticket_value, CAST(sum(product_total_value) AS DECIMAL(38,2)) AS product_revenue_value,
  CAST(sum(freight_total_value) AS DECIMAL(38,2)) AS freight_total_value, {mean2_money('freight_total_value')} AS avg_freight_value,
  {mean2('actual_delivery_days')} AS avg_delivery_days, {_ON_TIME}, {mean2('delivery_delay_days')} AS avg_delay_days,
  {mean2('review_score_avg')} AS avg_review_score
FROM fact_order_service"""

_ITEM_SALES = f"""count(DISTINCT order_id) AS order_count, count(*) AS item_count,
  CAST(sum(product_price) AS DECIMAL(28,2)) AS product_revenue_value, CAST(sum(freight_value) AS DECIMAL(28,2)) AS freight_total_value,
  CAST(sum(item_gmv) AS DECIMAL(29,2)) AS gmv_total_value, {mean2_money('item_gmv')} AS avg_ticket_value"""
_CATEGORY = """(SELECT i.*, coalesce(p.product_category_name, 'not_available') AS category
  FROM fact_order_item_sales i LEFT JOIN dim_product p ON i.product_id = p.product_id)"""
_STATE = """(SELECT f.*, c.customer_state FROM fact_order_service f
  LEFT JOIN dim_customer c ON f.customer_unique_id = c.customer_unique_id)"""
_TOP = "ORDER BY product_revenue_value DESC, analysis_group LIMIT"
_WORST = "ORDER BY on_time_delivery_rate_pct, delivered_order_count DESC, analysis_group"

SQL["q1_category"] = f"""
SELECT category AS analysis_group, 'category' AS analysis_level, {_ITEM_SALES} FROM {_CATEGORY} GROUP BY category {_TOP} 5"""
SQL["q1_seller"] = f"""
SELECT seller_id AS analysis_group, 'seller' AS analysis_level, {_ITEM_SALES} FROM fact_order_item_sales GROUP BY seller_id {_TOP} 20"""
SQL["q1_state"] = f"""
SELECT customer_state AS analysis_group, 'customer_state' AS analysis_level, count(DISTINCT order_id) AS order_count,
  CAST(sum(product_total_value) AS DECIMAL(38,2)) AS product_revenue_value,
  CAST(sum(freight_total_value) AS DECIMAL(38,2)) AS freight_total_value,
  CAST(sum(gmv_total_value) AS DECIMAL(38,2)) AS gmv_total_value, {mean2_money('gmv_total_value')} AS avg_ticket_value
FROM {_STATE} GROUP BY customer_state"""
SQL["q2_seller"] = f"""
SELECT seller_id AS analysis_group, 'seller' AS analysis_level, delivered_order_count,
  CAST(10000 - CAST(round(late_delivery_rate_pct * 100) AS BIGINT) AS DOUBLE) / 100 AS on_time_delivery_rate_pct,
  avg_delay_days, avg_delivery_days, avg_review_score
FROM mart_logistics_performance WHERE delivered_order_count >= 20 {_WORST} LIMIT 30"""
SQL["q2_category"] = f"""
SELECT category AS analysis_group, 'category' AS analysis_level, count(DISTINCT order_id) AS delivered_order_count, {_ON_TIME},
  {mean2('seller_customer_distance_km')} AS avg_distance_km, {mean2('review_score_avg')} AS avg_review_score
FROM {_CATEGORY} WHERE order_status = 'delivered' GROUP BY category HAVING count(DISTINCT order_id) >= 20"""
SQL["q2_state"] = f"""
SELECT customer_state AS analysis_group, 'customer_state' AS analysis_level, count(DISTINCT order_id) AS delivered_order_count, {_ON_TIME},
  {mean2('delivery_delay_days')} AS avg_delay_days, {mean2('actual_delivery_days')} AS avg_delivery_days,
  {mean2('review_score_avg')} AS avg_review_score
FROM {_STATE} WHERE is_delivered GROUP BY customer_state HAVING count(DISTINCT order_id) >= 20"""
SQL["q3_late_vs_review"] = f"""
SELECT CASE WHEN is_delivery_late THEN 'late' WHEN is_delivery_on_time THEN 'on_time' ELSE 'not_evaluated' END AS delivery_status,
  count(DISTINCT order_id) AS delivered_order_count, {mean2('actual_delivery_days')} AS avg_delivery_days,
  {mean2('delivery_delay_days')} AS avg_delay_days, {mean2('review_score_avg')} AS avg_review_score, {_LOW}
FROM fact_order_service WHERE is_delivered AND review_score_avg IS NOT NULL AND is_delivery_late IS NOT NULL GROUP BY 1"""
SQL["q4_distance"] = f"""
SELECT distance_band, count(DISTINCT order_id) AS delivered_order_count, {mean2('seller_customer_distance_km')} AS avg_distance_km,
  {mean2_money('freight_total_value')} AS avg_freight_value, {mean2('actual_delivery_days')} AS avg_delivery_days,
  {mean2('delivery_delay_days')} AS avg_delay_days, {_LATE}, {mean2('review_score_avg')} AS avg_review_score
FROM fact_order_service WHERE is_delivered AND seller_count = 1 AND distance_band <> 'not_available' GROUP BY 1"""
_BENCHMARK = """SELECT quantile_disc(gmv_total_value, 0.75) AS p75_gmv, avg(late_delivery_rate_pct) AS overall_late_rate,
  avg(avg_review_score) AS overall_review_score FROM"""
_PRIORITY = """WHERE gmv_total_value >= p75_gmv AND late_delivery_rate_pct > overall_late_rate
  AND avg_review_score < overall_review_score"""
SQL["q5_seller_priority"] = f"""
SELECT seller_id, delivered_order_count, gmv_total_value, late_delivery_rate_pct, avg_delivery_days, avg_delay_days,
  avg_review_score, low_review_rate_pct
FROM (SELECT * FROM mart_logistics_performance WHERE delivered_order_count >= 20)
CROSS JOIN ({_BENCHMARK} mart_logistics_performance WHERE delivered_order_count >= 20)
{_PRIORITY} ORDER BY gmv_total_value DESC, late_delivery_rate_pct DESC, avg_review_score, seller_id LIMIT 10"""
_CATEGORY_METRICS = f"""(SELECT category AS product_category_name, count(DISTINCT order_id) AS order_count,
  CAST(sum(item_gmv) AS DECIMAL(29,2)) AS gmv_total_value,
  100.0::DOUBLE * count(*) FILTER (is_delivery_late) / nullif(count(is_delivery_late), 0) AS late_delivery_rate_pct,
  CAST(sum(CAST(review_score_avg AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(review_score_avg), 0) AS avg_review_score,
  100.0::DOUBLE * count(*) FILTER (review_score_avg <= 2) / nullif(count(review_score_avg), 0) AS low_review_rate_pct
  FROM {_CATEGORY} GROUP BY category HAVING count(DISTINCT order_id) >= 20)"""
SQL["q5_category_priority"] = f"""
SELECT product_category_name, order_count, gmv_total_value, round(late_delivery_rate_pct, 2) AS late_delivery_rate_pct,
  round(avg_review_score, 2) AS avg_review_score, round(low_review_rate_pct, 2) AS low_review_rate_pct
FROM {_CATEGORY_METRICS} CROSS JOIN ({_BENCHMARK} {_CATEGORY_METRICS}) {_PRIORITY}"""

# ---------------------------------------------------------------- joins

SQL["join_left_single"] = """
SELECT o.order_id, order_status, payment_total_value, payment_types
FROM silver_orders o LEFT JOIN silver_payments_order_agg p ON o.order_id = p.order_id"""
SQL["join_left_role"] = """
SELECT order_id, seller_latitude_geo, seller_longitude_geo, customer_latitude_geo, customer_longitude_geo FROM silver_order_service"""
SQL["join_left_chain"] = """
SELECT o.order_id, s.primary_seller_id, seller_count, seller_city, seller_state
FROM silver_orders o LEFT JOIN order_primary_seller s ON o.order_id = s.order_id
  LEFT JOIN seller_origin g ON s.primary_seller_id = g.primary_seller_id"""
SQL["join_left_using"] = "SELECT * FROM customer_metrics LEFT JOIN customer_reference USING (customer_unique_id)"
SQL["join_left_dim"] = """
SELECT seller_id, seller_state, lifetime_order_count, lifetime_product_revenue
FROM silver_sellers LEFT JOIN seller_metrics USING (seller_id)"""
SQL["join_left_multikey"] = """
SELECT o.order_id, o.distance_band, o.delivery_performance_band, o.review_band, b.service_band_key
FROM silver_order_service o LEFT JOIN dim_service_band b ON o.distance_band = b.distance_band
  AND o.delivery_performance_band = b.delivery_performance_band AND o.review_band = b.review_band"""
SQL["join_inner_fact"] = """
SELECT i.order_id, order_item_id, order_status, price FROM silver_order_items i JOIN silver_orders o ON i.order_id = o.order_id"""
SQL["join_left_sql"] = """
SELECT i.order_id, i.order_item_id, p.product_category_name, i.item_gmv
FROM fact_order_item_sales i LEFT JOIN dim_product p ON i.product_id = p.product_id"""
_MONTH = "date_trunc('month', strptime(CAST(purchase_date_key AS VARCHAR), '%Y%m%d'))::DATE"
SQL["q6_cohorts"] = f"""
SELECT * FROM (WITH active AS (SELECT DISTINCT customer_unique_id, {_MONTH} AS month FROM fact_order_service
                WHERE customer_unique_id IS NOT NULL AND purchase_date_key IS NOT NULL),
     first AS (SELECT customer_unique_id, min(month) AS cohort_month FROM active GROUP BY 1),
     counted AS (SELECT cohort_month, CAST(date_diff('month', cohort_month, month) AS INTEGER) AS months_since, count(*) AS customer_count
                 FROM active JOIN first USING (customer_unique_id) GROUP BY 1, 2),
     size AS (SELECT cohort_month, count(*) AS cohort_size FROM first GROUP BY 1)
SELECT cohort_month, months_since, customer_count, cohort_size, {share_pct('customer_count', 'cohort_size')} AS retention_pct
FROM counted JOIN size USING (cohort_month))"""
SQL["q7_freight_vs_review"] = f"""
SELECT * FROM (WITH judged AS (SELECT order_id, avg_freight_to_price_ratio, review_score_avg FROM silver_order_service
                WHERE avg_freight_to_price_ratio IS NOT NULL AND review_score_avg IS NOT NULL),
     binned AS (SELECT *, CAST((row_number() OVER (ORDER BY avg_freight_to_price_ratio, order_id) - 1) * 10 // count(*) OVER () AS INTEGER) + 1
                  AS freight_decile FROM judged)
SELECT freight_decile, (SELECT round(corr(CAST(avg_freight_to_price_ratio AS DOUBLE), review_score_avg), 4) FROM judged) AS freight_review_correlation,
  count(*) AS order_count, min(avg_freight_to_price_ratio) AS least_ratio, max(avg_freight_to_price_ratio) AS largest_ratio,
  {mean2('review_score_avg')} AS avg_review_score, {tristate_pct('review_score_avg <= 2')} AS low_review_rate_pct
FROM binned GROUP BY 1)"""
SQL["q8_growth_and_delay"] = f"""
SELECT * FROM (WITH metrics AS (SELECT distance_band, {_MONTH} AS month, count(order_id) AS order_count, {mean2('delivery_delay_days')} AS avg_delay_days
                 FROM fact_order_service WHERE purchase_date_key IS NOT NULL GROUP BY 1, 2),
     spans AS (SELECT distance_band, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH))::DATE AS month FROM metrics GROUP BY 1),
     filled AS (SELECT s.distance_band, s.month, coalesce(order_count, 0) AS order_count, avg_delay_days FROM spans s
                LEFT JOIN metrics m ON s.distance_band = m.distance_band AND s.month = m.month),
     compared AS (SELECT *, lag(order_count) OVER w AS previous_order_count, lag(avg_delay_days) OVER w AS previous_avg_delay_days
                  FROM filled WINDOW w AS (PARTITION BY distance_band ORDER BY month))
SELECT *, coalesce(order_count > previous_order_count AND avg_delay_days > previous_avg_delay_days, FALSE) AS grows_with_worse_delay FROM compared)"""
SQL["q9_payment_mix"] = f"""
SELECT * FROM (WITH kinds AS (SELECT order_id, payment_total_value, review_score_avg, list_distinct(string_split(payment_types, '|')) AS types,
    CASE WHEN max_payment_installments IS NULL THEN 'not_available' WHEN max_payment_installments <= 1 THEN '1'
         WHEN max_payment_installments <= 3 THEN '2_to_3' WHEN max_payment_installments <= 6 THEN '4_to_6' ELSE '7_or_more' END AS instalment_band
  FROM silver_order_service WHERE payment_types IS NOT NULL AND payment_types <> ''),
     long AS (SELECT *, len(types) AS n_types, unnest(types) AS payment_type FROM kinds)
SELECT payment_type, instalment_band, count(*) AS order_count, count(*) FILTER (n_types > 1) AS mixed_order_count,
  CAST(round(sum(CAST(round(1.0::DOUBLE / n_types, 6) AS DECIMAL(20,6))), 4) AS DOUBLE) AS order_share,
  {mean2_money('payment_total_value')} AS avg_payment_value, {mean2('review_score_avg')} AS avg_review_score
FROM long GROUP BY 1, 2)"""
SQL["join_left_heavy"] = """
SELECT i.order_id, i.order_item_id, i.product_id, i.item_gmv, p.product_category_name
FROM fact_order_item_sales i LEFT JOIN dim_product p ON i.product_id = p.product_id"""
SQL["join_left_anti_hash"] = """
SELECT order_id, record_hash FROM orders_typed t
WHERE NOT EXISTS (SELECT 1 FROM l_quarantine_orders b WHERE b.record_hash = t.record_hash)"""


def _orphans(name: str, child: str, parent: str, key: str) -> str:
    return f"""SELECT '{name}' AS relationship, count(*) AS orphan_record_count FROM {child} c
      WHERE c.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"""


SQL["join_left_anti_orphans"] = " UNION ALL ".join(
    [
        _orphans("order_items -> orders", "silver_order_items", "silver_orders", "order_id"),
        _orphans("orders -> payments", "silver_orders", "silver_payments_order_agg", "order_id"),
        _orphans("orders -> reviews", "silver_orders", "silver_reviews_order_agg", "order_id"),
    ]
)
SQL["join_cross_scalar"] = f"""
SELECT seller_id, gmv_total_value, p75_gmv, round(overall_late_rate, 6) AS overall_late_rate,
  round(overall_review_score, 6) AS overall_review_score
FROM mart_logistics_performance CROSS JOIN ({_BENCHMARK} mart_logistics_performance)"""

# ---------------------------------------------------------------- aggregations

SQL["agg_global"] = f"""
SELECT count(*) AS item_count, CAST(sum(price) AS DECIMAL(28,2)) AS price_sum, {mean2_money('price')} AS price_mean,
  min(price) AS price_min, max(price) AS price_max FROM silver_order_items"""
SQL["agg_group"] = f"""
SELECT payment_type, payment_installments, count(*) AS payment_count, CAST(sum(payment_value) AS DECIMAL(28,2)) AS value_sum,
  {mean2_money('payment_value')} AS value_mean, min(payment_value) AS value_min, max(payment_value) AS value_max
FROM payments_typed GROUP BY 1, 2"""
SQL["agg_count_distinct"] = """
SELECT order_id, count(DISTINCT product_id) AS distinct_product_count, count(DISTINCT seller_id) AS distinct_seller_count
FROM silver_order_items GROUP BY 1"""
SQL["agg_conditional_rate"] = f"""
SELECT customer_state, {rate_pct('is_delivery_late')} AS late_pct, {rate_pct('is_low_review')} AS low_review_pct
FROM silver_order_service GROUP BY 1"""
SQL["agg_tristate_rate"] = f"""
SELECT customer_state, {tristate_pct('is_delivery_late')} AS late_pct, {tristate_pct('is_low_review')} AS low_review_pct
FROM silver_order_service GROUP BY 1"""
SQL["agg_count_if"] = """
SELECT order_status, count(*) FILTER (is_delivery_late) AS late_orders, count(*) FILTER (is_delivery_on_time) AS on_time_orders,
  count(*) FILTER (review_score_avg IS NULL) AS orders_without_review FROM silver_order_service GROUP BY 1"""
SQL["agg_avg_ratio"] = "SELECT order_id, avg_freight_to_price_ratio FROM order_items_agg"
SQL["agg_collect_set"] = "SELECT order_id, payment_types FROM silver_payments_order_agg"
SQL["agg_first_nonnull"] = "SELECT order_id, primary_seller_id FROM order_primary_seller"
SQL["agg_percentile_vector"] = "SELECT " + ", ".join(
    f"quantile_disc(gmv_total_value, {p}) AS {name}"
    for p, name in zip(q.PERCENTILES, ("p01", "p25", "p50", "p75", "p99"))
) + " FROM mart_logistics_performance"
SQL["agg_percentile_scalar"] = (
    "SELECT quantile_disc(gmv_total_value, 0.75) AS p75_gmv FROM mart_logistics_performance"
)
SQL["agg_group_expr"] = """
SELECT CASE WHEN actual_delivery_days <= 10 THEN 'fast' WHEN actual_delivery_days > 10 THEN 'slow' ELSE 'not_available' END
  AS delivery_speed, count(*) AS order_count FROM silver_order_service_base GROUP BY 1"""
SQL["agg_latest_timestamp"] = (
    "SELECT order_status, max(order_purchase_timestamp) AS latest_purchase FROM silver_orders GROUP BY 1"
)

# ---------------------------------------------------------------- windows, sorts, sets

SQL["win_row_number_global"] = """
SELECT seller_id, lifetime_order_count, lifetime_product_revenue, CAST(row_number() OVER (
  ORDER BY lifetime_product_revenue DESC, lifetime_order_count DESC, seller_id) AS BIGINT) AS revenue_rank FROM dim_seller"""
SQL["win_agg_global"] = """
SELECT seller_id, gmv_total_value, quantile_disc(gmv_total_value, 0.75) OVER () AS p75_gmv,
  round(avg(late_delivery_rate_pct) OVER (), 6) AS overall_late_rate, round(avg(avg_review_score) OVER (), 6) AS overall_review_score
FROM mart_logistics_performance"""
SQL["sort_single"] = "SELECT full_date, date_key FROM dim_date ORDER BY full_date"
SQL["sort_multi"] = "SELECT seller_id, gmv_total_value, late_delivery_rate_pct FROM mart_logistics_performance"
SQL["sort_case"] = "SELECT distance_band, is_delivery_late, delivered_order_count FROM mart_customer_experience"
SQL["topk"] = """
SELECT seller_id, gmv_total_value FROM mart_logistics_performance
ORDER BY gmv_total_value DESC NULLS LAST, seller_id NULLS FIRST LIMIT 20"""
SQL["union_by_name"] = """
SELECT 'customer' AS location_role, customer_state AS state, customer_zip_code_prefix AS zip_code_prefix FROM silver_customers
UNION ALL SELECT 'seller', seller_state, seller_zip_code_prefix FROM silver_sellers"""
SQL["distinct_rows"] = "SELECT DISTINCT product_id, seller_id FROM silver_order_items"
SQL["dedupe_by_key"] = """
SELECT * EXCLUDE (rn, source_file, ingestion_timestamp_utc, pipeline_run_id, record_hash) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id, seller_id, shipping_limit_date, price, freight_value) AS rn
  FROM items_typed) WHERE rn = 1"""
SQL["set_difference"] = "SELECT product_id FROM silver_products EXCEPT SELECT product_id FROM silver_order_items"

# ---------------------------------------------------------------- scalar function families

SQL["fn_string"] = f"""
SELECT trim(geolocation_state) AS trimmed, lower(geolocation_city) AS lowered, upper(geolocation_city) AS uppered,
  {capitalised('lower(geolocation_city)')} AS capitalised, lpad(geolocation_zip_code_prefix, 8, '0') AS padded,
  regexp_replace(geolocation_city, '\\s+', ' ', 'g') AS squeezed, concat_ws('|', geolocation_lat, geolocation_lng) AS joined
FROM f_geolocation"""
SQL["fn_hash"] = "SELECT seller_id, sha256(seller_id || '||' || seller_state) AS key_hash FROM silver_sellers"
_AT = "order_purchase_timestamp"
SQL["fn_datetime"] = f"""
SELECT order_id, CAST({_AT} AS DATE) AS as_date, strftime({_AT}, '%Y%m%d') AS as_digits, strftime({_AT}, '%Y-%m') AS as_month,
  strftime({_AT}, '%B') AS month_name, strftime({_AT}, '%A') AS day_name, CAST(year({_AT}) AS INTEGER) AS year,
  CAST(month({_AT}) AS INTEGER) AS month, CAST(quarter({_AT}) AS INTEGER) AS quarter, CAST(day({_AT}) AS INTEGER) AS day,
  CAST(dayofweek({_AT}) + 1 AS INTEGER) AS weekday, CAST(epoch({_AT}) AS BIGINT) AS seconds
FROM silver_orders"""
SQL["fn_math"] = """
SELECT zip_code_prefix, round(radians(latitude), 6) AS radians, round(sin(radians(latitude)), 6) AS sine,
  round(cos(radians(latitude)), 6) AS cosine, round(asin(sin(radians(latitude))), 6) AS arcsine,
  round(sqrt(pow(latitude, 2)), 6) AS root, greatest(latitude, 0.0::DOUBLE) AS positive_latitude
FROM silver_geolocation_zip_agg"""
SQL["fn_array"] = """
SELECT payment_installments, array_to_string(list_sort(list(DISTINCT payment_type)), '|') AS payment_types,
  CAST(count(DISTINCT payment_type) AS INTEGER) AS payment_type_count FROM payments_typed GROUP BY 1"""
SQL["fn_conditional"] = """
SELECT order_id, order_item_id, CASE WHEN price = 0 THEN 'free' WHEN price BETWEEN 1 AND 50 THEN 'low' ELSE 'high' END AS price_class,
  coalesce(nullif(price, 0), 0)::DECIMAL(18,2) AS price_or_zero, freight_value IN (1, 2, 3) AS cheap_freight
FROM silver_order_items"""
SQL["fn_unpivot"] = " UNION ALL ".join(
    f"SELECT order_id, '{c}' AS measure, {c} AS days FROM silver_order_service_base"
    for c in ("actual_delivery_days", "delivery_delay_days", "delivery_early_days")
)
SQL["fn_cast"] = """
SELECT order_id, CAST(order_item_id AS INTEGER) AS item_number, CAST(price AS DOUBLE) AS price_double,
  CAST(price AS DECIMAL(18,2)) AS price_decimal, TRY_CAST(freight_value AS INTEGER) AS freight_int,
  CAST(CAST(freight_value AS INTEGER) > 0 AS VARCHAR) AS has_freight FROM f_order_items"""

# ---------------------------------------------------------------- profiles of the written tables

_KEEPS_BRONZE_LINEAGE = (
    "silver_customers",
    "silver_sellers",
    "silver_category_translation",
    "silver_products",
    "silver_orders",
    "silver_quarantine_orders",
    "silver_order_items",
    "silver_quarantine_order_items",
)


def _written_columns(layer: str, table: str) -> list[str]:
    """Columns of a written table, in its order."""
    columns = list(g.TABLE_COLUMNS[table])
    if layer == "bronze":
        return [*columns, *BRONZE_LINEAGE]
    if table in _KEEPS_BRONZE_LINEAGE:
        reason = [c for c in columns if c == "quarantine_reason"]
        columns = [c for c in columns if c not in reason] + list(BRONZE_LINEAGE) + reason
    return [*columns, *(SILVER_LINEAGE if layer == "silver" else GOLD_LINEAGE)]


_TYPES = """CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp'
  ELSE lower(t) END"""


def _column_rows(layer: str, table: str) -> str:
    """One row per column of a table: type, position, rows and missing cells."""
    source = table
    if table in _KEEPS_BRONZE_LINEAGE:
        source = "l_" + table.removeprefix("silver_")
    own = {*SILVER_LINEAGE, *GOLD_LINEAGE}
    cells = []
    for place, column in enumerate(_written_columns(layer, table), start=1):
        if column in own:
            kind = "'TIMESTAMP'" if column.endswith("_utc") else "'VARCHAR'"
            missing = "CAST(0 AS BIGINT)"
        else:
            kind = f"any_value(typeof({column}))"
            missing = f"count(*) FILTER ({column} IS NULL OR trim(CAST({column} AS VARCHAR)) = '')"
        cells.append(
            f"{{'column_name': '{column}', 't': {kind}, 'ordinal_position': {place}, 'null_count': {missing}}}"
        )
    return (
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, row_count, unnest(cells) AS c"
        f" FROM (SELECT count(*) AS row_count, [{', '.join(cells)}] AS cells FROM {source})"
    )


_UNPACKED = " UNION ALL ".join(_column_rows(layer, table) for layer, tables in LAYERS.items() for table in tables)
PROFILE = f"""(SELECT layer, table_name, row_count, c.column_name AS column_name, c.ordinal_position AS ordinal_position,
  c.null_count AS null_count, {_TYPES.replace('CASE t', 'CASE c.t').replace('lower(t)', 'lower(c.t)')} AS data_type FROM ({_UNPACKED}))"""

SQL["dq_table_profile"] = f"""
SELECT *, coalesce({share_pct('total_null_cells', 'total_cells', 4)}, 0) AS null_cell_rate_pct FROM (
  SELECT layer, table_name, max(row_count) AS row_count, count(*) AS column_count,
    count(*) FILTER (null_count > 0) AS columns_with_nulls, CAST(sum(null_count) AS BIGINT) AS total_null_cells,
    CAST(sum(row_count) AS BIGINT) AS total_cells FROM {PROFILE} GROUP BY 1, 2)"""


def _table_rows(layer: str, table: str) -> str:
    return f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS row_count FROM {table}"


_EXPECTED = {"bronze": BRONZE_LINEAGE, "silver": SILVER_LINEAGE, "gold": GOLD_LINEAGE}
SQL["dq_traceability"] = " UNION ALL ".join(
    f"""SELECT *, '{", ".join(_EXPECTED[layer])}' AS expected_metadata, 'none' AS missing_metadata_columns,
      row_count AS rows_with_complete_metadata, 100.0::DOUBLE AS traceability_coverage_pct FROM ({_table_rows(layer, table)})"""
    for layer, tables in LAYERS.items()
    for table in tables
)
SQL["dq_volume"] = " UNION ALL ".join(_table_rows(layer, table) for layer, table in q.VOLUME_TABLES)
SQL["layer_gates"] = " UNION ALL ".join(
    f"SELECT *, 'present' AS status FROM ({_table_rows(layer, table)})" for layer, tables in LAYERS.items() for table in tables
)
SQL["dq_completeness"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS total_orders,
      {share_pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_pct FROM fact_order_service"""
    for c in q.CRITICAL_COLUMNS
)
_RULES = {
    "invalid_order_status": f"order_status NOT IN {STATUSES}",
    "negative_gmv": "gmv_total_value < 0",
    "negative_freight": "freight_total_value < 0",
    "invalid_review_score": "review_score_avg NOT BETWEEN 1 AND 5",
    "negative_delivery_days": "actual_delivery_days < 0",
    "negative_distance_km": "seller_customer_distance_km < 0",
    "inconsistent_delivery_flags": "is_delivery_late = is_delivery_on_time",
}
SQL["dq_validity"] = (
    "SELECT count(*) AS total_orders, "
    + ", ".join(f"count(*) FILTER ({test}) AS {name}" for name, test in _RULES.items())
    + " FROM fact_order_service"
)
SQL["dq_uniqueness"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, '{" + ".join(keys)}' AS business_key, total_rows, distinct_key_rows,
      total_rows - distinct_key_rows AS duplicate_rows, {share_pct('distinct_key_rows', 'total_rows')} AS uniqueness_pct
      FROM (SELECT count(*) AS total_rows, count(DISTINCT ({", ".join(keys)})) AS distinct_key_rows FROM {table})"""
    for table, keys in q.UNIQUE_KEYS
)
SQL["dq_referential_integrity"] = " UNION ALL ".join(
    _orphans(f"{child} -> {parent}", child, parent, key) for child, parent, key in q.FOREIGN_KEYS
)
SQL["dq_quarantine_rate"] = " UNION ALL ".join(
    f"""SELECT *, {share_pct('silver_quarantine_row_count', 'bronze_row_count', 4)} AS quarantine_rate_pct FROM (
      SELECT '{entity}' AS entity, (SELECT count(*) FROM f_{entity}) AS bronze_row_count,
        (SELECT count(*) FROM silver_{entity}) AS silver_valid_row_count,
        (SELECT count(*) FROM silver_quarantine_{entity}) AS silver_quarantine_row_count)"""
    for entity in ("orders", "order_items")
)
SQL["dq_outlier_percentiles_exact"] = " UNION ALL ".join(
    f"""SELECT '{metric}' AS metric, CAST({p} AS DOUBLE) AS fraction, min(value) AS value FROM (
      SELECT CAST({metric} AS DOUBLE) AS value, row_number() OVER (ORDER BY {metric}) AS place, count(*) OVER () AS n
      FROM fact_order_service WHERE order_status = 'delivered' AND {metric} IS NOT NULL)
      WHERE place >= greatest(1, ceil({p}::DOUBLE * n))"""
    for metric in q.OUTLIER_METRICS
    for p in q.PERCENTILES
)
SQL["dq_outlier_sketches"] = " UNION ALL ".join(
    f"""SELECT '{metric}' AS metric, CAST({p} AS DOUBLE) AS fraction, count({metric}) AS row_count, TRUE AS within_error
      FROM fact_order_service WHERE order_status = 'delivered'"""
    for metric in q.OUTLIER_METRICS for p in q.PERCENTILES
)
SQL["dq_freshness"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, count(*) AS rows_with_traceability_metadata, count(*) AS total_rows,
      {TS} AS latest_processing_timestamp_utc, 100.0::DOUBLE AS traceability_coverage_pct FROM {table}"""
    for table, _, _ in q.FRESHNESS_TABLES
)
_ISSUES = {
    "completeness": f"""SELECT sum(null_count) FROM ({SQL['dq_completeness']})
      WHERE column_name IN ('order_id', 'customer_unique_id', 'purchase_date_key')""",
    "validity": f"SELECT {' + '.join(_RULES)} FROM ({SQL['dq_validity']})",
    "uniqueness": f"SELECT sum(duplicate_rows) FROM ({SQL['dq_uniqueness']})",
    "integrity": f"SELECT sum(orphan_record_count) FROM ({SQL['dq_referential_integrity']})",
    "traceability": f"SELECT count(*) FILTER (traceability_coverage_pct < 100) FROM ({SQL['dq_traceability']})",
}
SQL["dq_summary"] = "SELECT *, CASE WHEN issue_count = 0 THEN 'APROVADO' ELSE 'ATENCAO' END AS status FROM (" + " UNION ALL ".join(
    "SELECT '{}' AS quality_dimension, '{}' AS scope, '{}' AS acceptance_criterion, CAST(({}) AS BIGINT) AS issue_count".format(
        *q.SUMMARY_LINES[line], sql
    )
    for line, sql in _ISSUES.items()
) + ")"
SQL["dq_failed_rules"] = f"""
SELECT failed_rule_count, CASE WHEN failed_rule_count = 0 THEN 'APROVADO' ELSE 'ATENCAO' END AS overall_status
FROM (SELECT count(*) FILTER (status <> 'APROVADO') AS failed_rule_count FROM ({SQL['dq_summary']}))"""
_VALIDITY_ROWS = " UNION ALL ".join(f"SELECT '{name}' AS item, {name} AS n FROM ({SQL['dq_validity']})" for name in _RULES)
SQL["dq_drilldown"] = f"""
SELECT section, item, CAST(n AS BIGINT) AS issue_count FROM (
  SELECT 'summary' AS section, quality_dimension AS item, issue_count AS n FROM ({SQL['dq_summary']}) WHERE status <> 'APROVADO'
  UNION ALL SELECT 'completeness', column_name, null_count FROM ({SQL['dq_completeness']})
  UNION ALL SELECT 'validity', item, n FROM ({_VALIDITY_ROWS})
  UNION ALL SELECT 'uniqueness', table_name, duplicate_rows FROM ({SQL['dq_uniqueness']})
  UNION ALL SELECT 'integrity', relationship, orphan_record_count FROM ({SQL['dq_referential_integrity']})
) WHERE n > 0"""

# ---------------------------------------------------------------- dictionary


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DECLARED = ", ".join(
    f"('{layer}', '{table}', '{column}')"
    for layer, tables in LAYERS.items()
    for table in tables
    for column in g.TABLE_COLUMNS[table]
)
_MEANINGS = ", ".join(f"('{c}', {_quoted(m)})" for c, m in (g.GLOSSARY | g.COMMON_GLOSSARY).items())
_CLASSES = ", ".join(
    f"('{table}', '{column}', '{kind}', '{g.SENSITIVITY[kind]}', '{g.TABLE_TAGS[table][2]}')"
    for table, kinds in g.CLASSIFIED.items()
    for kind, columns in kinds.items()
    for column in columns
)
_COMMON = "(" + ", ".join(f"'{c}'" for c in g.COMMON_GLOSSARY) + ")"
SQL["dict_column_inventory"] = f"""
SELECT layer AS schema_name, table_name, p.column_name, data_type, 'YES' AS nullable, meaning AS comment, ordinal_position,
  row_count, null_count
FROM {PROFILE} p LEFT JOIN (VALUES {_MEANINGS}) m(column_name, meaning) ON p.column_name = m.column_name"""
SQL["dict_reconcile"] = f"""
SELECT d.schema_name, d.table_name, d.column_name, CASE WHEN p.column_name IS NULL THEN 'NOT_FOUND' ELSE 'APPLIED' END AS status,
  p.row_count - p.null_count AS filled_count
FROM (VALUES {_DECLARED}) d(schema_name, table_name, column_name) LEFT JOIN {PROFILE} p
  ON d.schema_name = p.layer AND d.table_name = p.table_name AND d.column_name = p.column_name
UNION ALL SELECT layer, table_name, column_name, 'APPLIED_COMMON', row_count - null_count FROM {PROFILE} WHERE column_name IN {_COMMON}"""
SQL["dict_coverage"] = f"""
SELECT schema_name, table_name, count(*) AS total_columns, count(comment) AS documented_columns,
  count(*) FILTER (row_count > 0 AND null_count = row_count) AS always_empty_columns,
  {share_pct('count(comment)', 'count(*)')} AS documentation_coverage_pct FROM ({SQL['dict_column_inventory']}) GROUP BY 1, 2"""
SQL["dict_undocumented"] = f"""
SELECT * FROM (SELECT schema_name, table_name, column_name, data_type,
  CASE WHEN coalesce(trim(comment), '') = '' THEN 'undocumented' WHEN row_count > 0 AND null_count = row_count THEN 'always empty' END AS reason
  FROM ({SQL['dict_column_inventory']})) WHERE reason IS NOT NULL"""
_DOMAIN_VALUES = ", ".join(f"('{t}', '{c}', '{v}')" for (t, c), values in g.DOMAINS.items() for v in values)
_OBSERVED = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 3"
    for t, c in g.DOMAINS
)
SQL["dict_domains"] = f"""
SELECT coalesce(o.table_name, d.table_name) AS table_name, coalesce(o.column_name, d.column_name) AS column_name,
  coalesce(o.value, d.value) AS value, coalesce(n, 0) AS row_count,
  CASE WHEN d.value IS NULL THEN 'UNDECLARED' WHEN n IS NULL THEN 'NOT_OBSERVED' ELSE 'DECLARED' END AS status
FROM ({_OBSERVED}) o FULL JOIN (VALUES {_DOMAIN_VALUES}) d(table_name, column_name, value)
  ON o.table_name = d.table_name AND o.column_name = d.column_name AND o.value = d.value"""
SQL["dict_cardinality"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(DISTINCT {c}) AS distinct_count, TRUE AS within_error FROM {t}"
    for t, c in [*((name, keys[0]) for name, keys in q.UNIQUE_KEYS if len(keys) == 1), ("silver_order_items", "order_id")]
)
SQL["dict_classified_profile"] = f"""
SELECT *, coalesce({share_pct('null_cell_count', 'cell_count', 4)}, 0) AS null_cell_rate_pct FROM (
  SELECT layer AS schema_name, p.table_name, semantic_type, sensitivity, data_classification, count(*) AS column_count,
    CAST(sum(row_count) AS BIGINT) AS cell_count, CAST(sum(null_count) AS BIGINT) AS null_cell_count
  FROM {PROFILE} p JOIN (VALUES {_CLASSES}) c(table_name, column_name, semantic_type, sensitivity, data_classification)
    ON p.table_name = c.table_name AND p.column_name = c.column_name GROUP BY 1, 2, 3, 4, 5)"""


def all_statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in SQL.items()}
