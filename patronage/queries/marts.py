"""Queries over the dimensions, facts and customer marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators import history
from ..operators.rules import with_segment
from ..oracle import cents, ratio
from ..operators.ranking import bounded_median
from ..plans import gold, silver
from ..session import shared_dir
from ..sources.calendar import calendar_of
from ..sources.sample_tables import FIRST_RUN, ML_CUTOFF, SECOND_RUN, SampleTables
from .registry import register

PERSON = "customer_unique_id"


def known_orders(t: SampleTables) -> DataFrame:
    return t.orders.join(t.customers.select("customer_id", PERSON), "customer_id")


def review_dim(t: SampleTables) -> DataFrame:
    return silver.dim_review(t.review_heads, t.orders, t.customers)


def products_dim(t: SampleTables) -> DataFrame:
    return silver.dim_product(t.products, t.category_translation)


def paid_orders(t: SampleTables) -> DataFrame:
    return known_orders(t).select("order_id", PERSON).join(silver.payments_per_order(t.payments), "order_id", "left")


def facts(t: SampleTables) -> gold.Facts:
    orders = known_orders(t)
    return gold.Facts(t.customers, orders, gold.order_values(t.items, orders), review_dim(t), paid_orders(t))


def base(t: SampleTables) -> DataFrame:
    f = facts(t)
    return gold.customer_base(f, gold.run_constants(f.orders, ML_CUTOFF))


def placed(t: SampleTables) -> DataFrame:
    return gold.with_positions(base(t))


def profile(t: SampleTables) -> DataFrame:
    return gold.customer_360(placed(t))


def features(t: SampleTables, of: DataFrame) -> DataFrame:
    orders = known_orders(t)
    values = gold.order_values(t.items, orders)
    return gold.clv_features(of, gold.category_diversity(t.items, products_dim(t), orders),
                             gold.preferred_payment(paid_orders(t)), gold.value_after(values, ML_CUTOFF))


def segmented(of: DataFrame) -> DataFrame:
    return with_segment(gold.rfm_features(of))


PROFILE = ("customer_unique_id:s customer_state:s customer_city:s total_orders:i total_gmv:d avg_order_value:d "
           "total_freight_paid:d first_order_date:s last_order_date:s tenure_days:i days_since_last_order:i "
           "avg_review_score:d pct_negative_reviews:d avg_delivery_delta_days:d pct_late_deliveries:d is_churned:i "
           "customer_health_score:d health_tier:s")

register("customer_360", PROFILE, "SELECT * FROM g_360")(profile)

register("rfm_features", "customer_unique_id:s recency_days:i frequency:i monetary:d recency_score:i frequency_score:i "
         "monetary_score:i rfm_score:s rfm_segment:s", "SELECT * FROM g_rfm")(lambda t: segmented(placed(t)))

register("rfm_features_as_coded", "customer_unique_id:s recency_score:i frequency_score:i monetary_score:i", """
SELECT customer_unique_id, ntile(5) OVER (ORDER BY days_since_last_order DESC, customer_unique_id) AS recency_score,
       ntile(5) OVER (ORDER BY total_orders DESC, customer_unique_id DESC) AS frequency_score,
       ntile(5) OVER (ORDER BY total_gmv DESC, customer_unique_id DESC) AS monetary_score
FROM g_base""")(lambda t: gold.rfm_features(placed(t), "as_coded"))

register("clv_features", "customer_unique_id:s avg_order_value:d order_frequency_per_month:d tenure_months:d "
         "total_categories_purchased:i avg_review_score:d avg_delivery_delta:d pct_late:d customer_state:s "
         "days_since_last_order:i preferred_payment_type:s actual_gmv_post_cutoff:d", "SELECT * FROM g_clv")(
    lambda t: features(t, base(t)))

register("run_constants", "as_of_date:s ml_cutoff_date:s churn_window_days:i", "SELECT * FROM g_const")(
    lambda t: gold.run_constants(t.orders, ML_CUTOFF))

register("order_values", "order_id:s customer_unique_id:s order_gmv:d order_freight:d", "SELECT * FROM s_values")(
    lambda t: gold.order_values(t.items, known_orders(t)))

register("customer_values", "customer_unique_id:s total_gmv:d total_freight_paid:d", """
SELECT customer_unique_id, sum(order_gmv) AS total_gmv, sum(order_freight) AS total_freight_paid FROM s_values GROUP BY 1
""")(lambda t: gold.customer_values(gold.order_values(t.items, known_orders(t))))

register("customer_orders", "customer_unique_id:s total_orders:i first_order_date:s last_order_date:s "
         "avg_delivery_delta_days:d pct_late_deliveries:d", "SELECT * FROM g_orders")(
    lambda t: gold.customer_orders(known_orders(t)))

register("customer_reviews", "customer_unique_id:s review_mean:d pct_negative_reviews:d", "SELECT * FROM g_reviews")(
    lambda t: gold.customer_reviews(review_dim(t)))

register("payments_per_order", "order_id:s customer_unique_id:s total_payment_value:d payment_type_primary:s "
         "payment_installments_max:i payment_methods_count:i", "SELECT * FROM s_paid")(paid_orders)

register("preferred_payment", "customer_unique_id:s preferred_payment_type:s",
         "SELECT customer_unique_id, preferred_payment_type FROM g_clv")(
    lambda t: gold.preferred_payment(paid_orders(t)))

register("category_diversity", "customer_unique_id:s total_categories_purchased:i", """
SELECT customer_unique_id, count(DISTINCT category) AS total_categories_purchased
FROM c_items JOIN s_orders USING (order_id) JOIN s_products USING (product_id) GROUP BY 1""")(
    lambda t: gold.category_diversity(t.items, products_dim(t), known_orders(t)))

register("value_after_cutoff", "customer_unique_id:s actual_gmv_post_cutoff:d", """
SELECT customer_unique_id, sum(order_gmv) AS actual_gmv_post_cutoff FROM s_values
WHERE order_purchase_timestamp >= TIMESTAMP '2001-01-01' GROUP BY 1""")(
    lambda t: gold.value_after(gold.order_values(t.items, known_orders(t)), ML_CUTOFF))

register("review_median", "median_review:d", "SELECT round(quantile_cont(review_mean, 0.5), 6) AS median_review FROM g_reviews")(
    lambda t: bounded_median(gold.customer_reviews(review_dim(t)), "review_mean")
    .withColumnRenamed("median", "median_review"))

register("sentiment_skeleton", "review_id:s order_id:s customer_unique_id:s review_score:i review_creation_date:s", """
SELECT review_id, order_id, customer_unique_id, review_score, review_creation_date FROM s_reviews""")(
    lambda t: gold.sentiment_skeleton(review_dim(t)))


# -- silver --------------------------------------------------------------------

register("order_columns", "order_id:s order_purchase_date_sk:i is_delivered:i is_canceled:i delivery_delta_days:i "
         "is_late:i approval_delay_hours:i", """
SELECT order_id, coalesce(CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS INTEGER), 19000101) AS order_purchase_date_sk,
       CASE WHEN order_status = 'delivered' THEN 1 ELSE 0 END AS is_delivered,
       CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END AS is_canceled,
       date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS delivery_delta_days,
       CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS is_late,
       date_diff('hour', order_purchase_timestamp, order_approved_at) AS approval_delay_hours
FROM c_orders""")(lambda t: silver.order_columns(t.orders))

register("fact_order_items", "order_id:s order_item_id:i customer_unique_id:s product_id:s seller_id:s "
         "product_known:i seller_known:i price:d freight_value:d gmv:d freight_ratio:d shipping_limit_date:s", f"""
SELECT i.order_id, i.order_item_id, o.customer_unique_id, i.product_id, i.seller_id,
       CASE WHEN p.product_id IS NULL THEN 0 ELSE 1 END AS product_known,
       CASE WHEN s.seller_id IS NULL THEN 0 ELSE 1 END AS seller_known,
       price, freight_value, price + freight_value AS gmv,
       CASE WHEN price + freight_value > 0 THEN {ratio(cents('freight_value'), cents('price + freight_value'), 4)}
            ELSE 0 END AS freight_ratio, shipping_limit_date
FROM c_items i JOIN s_orders o USING (order_id) LEFT JOIN c_products p USING (product_id)
LEFT JOIN c_sellers s USING (seller_id)""")(
    lambda t: silver.fact_order_items(t.numbered_items, known_orders(t), products_dim(t), silver.dim_seller(t.sellers))
    .withColumn("product_known", F.when(F.col("product_sk").isNull(), 0).otherwise(1))
    .withColumn("seller_known", F.when(F.col("seller_sk").isNull(), 0).otherwise(1)))

register("dim_product", "product_id:s product_category_name:s product_category_name_english:s product_name_length:i "
         "product_description_length:i product_photos_qty:i product_weight_g:d product_volume_cm3:d", """
SELECT product_id, product_category_name, category AS product_category_name_english,
       TRY_CAST(product_name_lenght AS INTEGER) AS product_name_length,
       TRY_CAST(product_description_lenght AS INTEGER) AS product_description_length,
       TRY_CAST(product_photos_qty AS INTEGER) AS product_photos_qty, product_weight_g,
       product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
FROM s_products""")(products_dim)

register("dim_seller", "seller_id:s seller_zip_code_prefix:s seller_city:s seller_state:s", "SELECT * FROM c_sellers")(
    lambda t: silver.dim_seller(t.sellers))

register("dim_review", "review_id:s order_id:s customer_unique_id:s review_score:i review_comment_title:s has_comment:i "
         "review_creation_date:s response_delay_days:i message_length:i", """
SELECT review_id, order_id, customer_unique_id, review_score, nullif(trim(review_comment_title), '') AS review_comment_title,
       CASE WHEN length(rtrim(m, ' ')) > 0 THEN 1 ELSE 0 END AS has_comment, review_creation_date,
       date_diff('day', review_creation_date, review_answer_timestamp) AS response_delay_days, length(m) AS message_length
FROM (SELECT r.*, nullif(trim(d.text), '') AS m FROM s_reviews r LEFT JOIN documents d USING (doc_id))""")(
    lambda t: silver.dim_review(t.reviews, t.orders, t.customers)
    .withColumn("message_length", F.length("review_comment_message")))


@register("dim_date", "date_sk:i full_date:s year:i quarter:i month:i month_name:s week_of_year:i day_of_month:i "
          "day_name:s is_weekend:i is_holiday:i holiday_name:s fiscal_year:i fiscal_quarter:i", """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date, year(d) AS year, quarter(d) AS quarter,
       month(d) AS month, monthname(d) AS month_name, weekofyear(d) AS week_of_year, day(d) AS day_of_month,
       dayname(d) AS day_name, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN h.name IS NULL THEN 0 ELSE 1 END AS is_holiday, h.name AS holiday_name, year(d) AS fiscal_year,
       quarter(d) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate))
             + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
LEFT JOIN (VALUES (1, 1, 'New Year''s Day'), (4, 21, 'Tiradentes'), (5, 1, 'Labour Day'), (9, 7, 'Independence Day'),
           (10, 12, 'Nossa Sra. Aparecida'), (11, 2, 'All Souls'' Day'), (11, 15, 'Republic Day'),
           (12, 25, 'Christmas Day')) h(m, dd, name) ON h.m = month(d) AND h.dd = day(d)
UNION ALL
SELECT 19000101, DATE '1900-01-01', 1900, 1, 1, 'Unknown', 1, 1, 'Unknown', 0, 0, 'UNKNOWN_DATE', 1900, 1""")
def calendar(t: SampleTables) -> DataFrame:
    first, last = F.date_trunc("year", F.min("o_orderdate")), F.date_trunc("year", F.max("o_orderdate"))
    return calendar_of(t.read("orders").agg(
        F.to_date(first).alias("start"),
        F.date_sub(F.add_months(F.to_date(last), 12), 1).alias("end")))


def versions(t: SampleTables) -> DataFrame:
    first = history.first_versions(t.customers, FIRST_RUN)
    return history.scd2_merge(first, t.moved_customers, SECOND_RUN)


register("customer_versions", "customer_unique_id:s customer_id:s customer_zip_code_prefix:s customer_city:s "
         "customer_state:s valid_from:s valid_to:s is_current:i", "SELECT * FROM s_versions")(versions)

@register("customer_versions_stored", "customer_unique_id:s customer_id:s customer_zip_code_prefix:s customer_city:s "
          "customer_state:s valid_from:s valid_to:s is_current:i", "SELECT * FROM s_versions")
def stored_versions(t: SampleTables) -> DataFrame:
    """The dimension as three loads leave it in its folder; the third finds nothing new."""
    path = f"{shared_dir(t.spark)}/dim-customer-{uuid.uuid4().hex}"
    for snapshot, day in ((t.customers, FIRST_RUN), (t.moved_customers, SECOND_RUN), (t.moved_customers, "2000-06-01")):
        found = history.load_versions(snapshot, path, day)
    return found


register("customer_versions_rerun", "customer_unique_id:s customer_state:s valid_from:s valid_to:s is_current:i",
         "SELECT * FROM s_versions")(lambda t: history.scd2_merge(versions(t), t.moved_customers, "2000-06-01"))

register("fact_orders", "order_id:s customer_unique_id:s customer_id:s order_status:s order_purchase_timestamp:s "
         "customer_state:s valid_from:s total_payment_value:d payment_type_primary:s payment_installments_max:i "
         "payment_methods_count:i order_purchase_date_sk:i is_late:i delivery_delta_days:i", """
SELECT o.order_id, o.customer_unique_id, o.customer_id, o.order_status, o.order_purchase_timestamp, v.customer_state,
       v.valid_from, p.total_payment_value, p.payment_type_primary, p.payment_installments_max, p.payment_methods_count,
       CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER) AS order_purchase_date_sk,
       CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS is_late,
       date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS delivery_delta_days
FROM s_orders o JOIN s_paid p USING (order_id) JOIN (
  SELECT order_id, customer_state, valid_from FROM (
    SELECT o.order_id, d.customer_state, d.valid_from, row_number() OVER (PARTITION BY o.order_id ORDER BY
             CASE WHEN CAST(o.order_purchase_timestamp AS DATE) >= d.valid_from AND (d.valid_to IS NULL
                    OR CAST(o.order_purchase_timestamp AS DATE) < d.valid_to) THEN 0 ELSE 1 END, d.valid_from) AS rn
    FROM s_orders o JOIN s_versions d USING (customer_unique_id)) WHERE rn = 1) v USING (order_id)""")(
    lambda t: silver.fact_orders(t.orders, t.moved_customers, versions(t), t.payments,
                                 ("customer_sk", "customer_state", "valid_from")))

register("unresolved_orders", "order_id:s", """
SELECT order_id FROM c_orders WHERE customer_id NOT IN (SELECT customer_id FROM c_customers WHERE customer_city <> 'MACHINERY')
""")(lambda t: silver.unresolved_orders(
    t.orders, known_orders(t).join(t.customers.where(F.col("customer_city") != "MACHINERY").select(PERSON), PERSON,
                                   "left_semi")))
