"""DuckDB SQL for the registered queries: shared table expressions and composition."""

from __future__ import annotations

import re

from .sources.sample_tables import LEXICON, SAMPLE_BOOSTERS, SAMPLE_NEGATORS


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """Integer numerator / integer denominator, rounded half away from zero, as DOUBLE."""
    n, d, p = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10 ** digits
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST(sign({n}) * sign({d}) * ((2 * abs({n}) * {p} + abs({d})) // (2 * abs({d})))"
            f" AS DOUBLE) / {p}::DOUBLE END)")


def cents(money: str) -> str:
    return f"CAST(({money}) * 100 AS HUGEINT)"


TABLES: dict[str, str] = {}


def table(name: str, sql: str) -> None:
    TABLES[name] = sql.strip()


def compose(sql: str) -> str:
    """Prefix ``sql`` with the table expressions it uses, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[a-z]_\w+", text):
            if word in TABLES and word not in ordered:
                visit(TABLES[word])
                if word not in ordered:
                    ordered.append(word)

    visit(sql)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name]})" for name in ordered) + "\n" + sql


TYPES = {"s": "VARCHAR", "i": "BIGINT", "d": "DOUBLE"}


def finish(sql: str, columns: str) -> str:
    """``sql`` with its columns cast to the declared output types."""
    casts = ", ".join(f"CAST({name} AS {TYPES[kind]}) AS {name}"
                      for name, kind in (c.split(":") for c in columns.split()))
    return compose(f"SELECT {casts} FROM (\n{sql.strip()}\n) AS result")


# -- raw tables under canonical names ------------------------------------------

table("c_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
       CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix, c_mktsegment AS customer_city, n_name AS customer_state
FROM customer JOIN nation ON n_nationkey = c_nationkey""")

table("c_moved_customers", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
       CAST(n_nationkey AS VARCHAR) AS customer_zip_code_prefix, c_mktsegment AS customer_city, n_name AS customer_state
FROM customer JOIN nation
  ON n_nationkey = CASE WHEN c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END""")

table("c_orders", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'shipped' WHEN 'O' THEN 'canceled' END AS order_status,
       o_orderdate AS order_purchase_timestamp,
       o_orderdate + to_hours(CAST(o_orderkey % 48 AS INTEGER)) AS order_approved_at,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(2) END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(3 + (o_orderkey * 7) % 40 AS INTEGER)) END
         AS order_delivered_customer_date,
       o_orderdate + to_days(30) AS order_estimated_delivery_date
FROM orders""")

table("c_items", """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                          l_extendedprice, l_discount, l_tax) AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
       l_shipdate AS shipping_limit_date,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS price,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS freight_value
FROM lineitem""")

table("c_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
       CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
       CASE WHEN p_partkey % 30 = 0 THEN 'n/a' ELSE CAST(p_size * 10 AS VARCHAR) END AS product_description_lenght,
       CAST(p_partkey % 7 AS VARCHAR) AS product_photos_qty, p_retailprice AS product_weight_g,
       CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_partkey % 30 + 1 AS DOUBLE) AS product_height_cm,
       CASE WHEN p_partkey % 20 <> 0 THEN CAST(p_partkey % 40 AS DOUBLE) END AS product_width_cm
FROM part""")

table("c_translation", """
SELECT DISTINCT p_type AS product_category_name, upper(p_type) AS product_category_name_english
FROM part WHERE p_type <> 'PROMO'""")

table("c_sellers", """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
       s_name AS seller_city, n_name AS seller_state
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")

table("c_payments", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
       1 + o_orderkey % 12 AS payment_installments,
       CASE WHEN o_orderkey % 20 = 0
            THEN CAST(((CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) + 1) // 2) AS DECIMAL(14,0)) / 100
            ELSE CAST(o_totalprice AS DECIMAL(12,2)) END::DECIMAL(12,2) AS payment_value
FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 2, 'voucher', 1 + o_orderkey % 12,
       (CAST(o_totalprice AS DECIMAL(12,2))
        - CAST(((CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) + 1) // 2) AS DECIMAL(14,0)) / 100)::DECIMAL(12,2)
FROM orders WHERE o_orderkey % 20 = 0""")

table("c_review_ids", """
SELECT 'R' || o_orderkey AS review_id, o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL
SELECT 'R' || (o_orderkey - 1), o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 100 = 2""")

table("c_review_heads", """
SELECT review_id, CAST(o_orderkey AS VARCHAR) AS order_id, 1 + o_orderkey % 5 AS review_score,
       CASE o_orderkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' ok ' END AS review_comment_title,
       o_orderdate + to_days(CAST(35 + o_orderkey % 10 AS INTEGER)) AS review_creation_date,
       o_orderdate + to_days(CAST(37 + o_orderkey % 10 AS INTEGER)) AS review_answer_timestamp,
       CASE WHEN trim(d.text) <> '' THEN 'text' WHEN d.text IS NOT NULL THEN '' END AS review_comment_message, r.doc_id
FROM (SELECT *, CASE WHEN o_orderkey % 2 <> 0 THEN o_orderkey % (SELECT count(*) FROM documents) END AS doc_id FROM c_review_ids) r
LEFT JOIN documents d USING (doc_id)""")

table("c_scores", """
SELECT CAST(k AS VARCHAR) AS customer_unique_id,
       CASE WHEN k % 11 <> 0 THEN CAST((k * 37) % 1000 AS DECIMAL(10,4)) / 1000 END::DECIMAL(6,4) AS churn_probability,
       clv AS clv_predicted_6m,
       CAST(round(clv * 0.8, 2) AS DECIMAL(14,2)) AS clv_ci_lower,
       CAST(round(clv * 1.2, 2) AS DECIMAL(14,2)) AS clv_ci_upper,
       CASE WHEN k % 3 <> 0 THEN CAST((k * 53) % 2001 - 1000 AS DECIMAL(10,4)) / 1000 END::DECIMAL(6,4) AS avg_sentiment_score,
       CASE WHEN k % 4 <> 0 THEN CAST((k * 17) % 3000 AS DECIMAL(10,1)) / 10 END::DECIMAL(10,1) AS expected_next_purchase_days,
       k % 5 AS km_cluster
FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 <> 0
             THEN (CAST((c_custkey * 91) % 4000 AS DECIMAL(10,2)) / 100)::DECIMAL(14,2) END AS clv FROM customer)""")

# -- silver --------------------------------------------------------------------

table("s_orders", """
SELECT o.*, c.customer_unique_id FROM c_orders o JOIN c_customers c USING (customer_id)""")

table("s_products", """
SELECT p.*, coalesce(t.product_category_name_english, 'UNKNOWN') AS category
FROM c_products p LEFT JOIN c_translation t USING (product_category_name)""")

table("s_reviews", """
SELECT * REPLACE (nullif(trim(review_comment_message), '') AS review_comment_message) FROM (
  SELECT r.*, o.customer_unique_id, row_number() OVER (
           PARTITION BY r.review_id ORDER BY r.review_creation_date DESC, r.order_id ASC) AS rn
  FROM c_review_heads r JOIN s_orders o USING (order_id) WHERE r.review_score BETWEEN 1 AND 5)
WHERE rn = 1""")

table("s_paid", """
SELECT o.order_id, o.customer_unique_id, p.total_payment_value, p.payment_type_primary, p.payment_installments_max,
       p.payment_methods_count
FROM s_orders o LEFT JOIN (
  SELECT order_id, sum(payment_value) AS total_payment_value, max(payment_installments) AS payment_installments_max,
         count(DISTINCT payment_type) AS payment_methods_count,
         arg_min(payment_type, payment_sequential) AS payment_type_primary
  FROM c_payments GROUP BY order_id) p USING (order_id)""")

table("s_values", """
SELECT i.order_id, o.customer_unique_id, o.order_purchase_timestamp, sum(price + freight_value) AS order_gmv,
       sum(freight_value) AS order_freight
FROM c_items i JOIN s_orders o USING (order_id) GROUP BY ALL""")

table("s_versions", """
SELECT c.customer_unique_id, c.customer_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state,
       DATE '1998-01-01' AS valid_from,
       CASE WHEN m.customer_state <> c.customer_state THEN DATE '2000-01-01' END AS valid_to,
       CASE WHEN m.customer_state <> c.customer_state THEN 0 ELSE 1 END AS is_current
FROM c_customers c JOIN (SELECT customer_unique_id, customer_state FROM c_moved_customers) m USING (customer_unique_id)
UNION ALL
SELECT m.customer_unique_id, m.customer_id, m.customer_zip_code_prefix, m.customer_city, m.customer_state,
       DATE '2000-01-01', NULL, 1
FROM c_moved_customers m JOIN c_customers c USING (customer_unique_id) WHERE m.customer_state <> c.customer_state""")

# -- gold ----------------------------------------------------------------------

table("g_const", """
SELECT CAST(max(order_purchase_timestamp) AS DATE) AS as_of_date, DATE '2001-01-01' AS ml_cutoff_date,
       180 AS churn_window_days FROM c_orders""")

table("g_orders", f"""
SELECT customer_unique_id, count(*) AS total_orders,
       CAST(min(order_purchase_timestamp) AS DATE) AS first_order_date,
       CAST(max(order_purchase_timestamp) AS DATE) AS last_order_date,
       {ratio('sum(delta)', 'count(delta)', 2)} AS avg_delivery_delta_days,
       {ratio('sum(late)', 'count(*)', 4)} AS pct_late_deliveries
FROM (SELECT *, date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                          CAST(order_delivered_customer_date AS DATE)) AS delta,
             CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late
      FROM s_orders) GROUP BY 1""")

table("g_reviews", f"""
SELECT customer_unique_id, {ratio('sum(millionths)', 'count(*) * 1000000', 6)} AS review_mean,
       {ratio('count(*) FILTER (WHERE millionths <= 2000000)', 'count(*)', 4)} AS pct_negative_reviews
FROM (SELECT order_id, customer_unique_id,
             CAST(round({ratio('sum(review_score)', 'count(*)', 6)} * 1000000) AS BIGINT) AS millionths
      FROM s_reviews GROUP BY 1, 2) GROUP BY 1""")

table("g_base", f"""
SELECT c.customer_unique_id, c.customer_state, c.customer_city, o.total_orders,
       coalesce(v.total_gmv, 0) AS total_gmv, coalesce(v.total_freight_paid, 0) AS total_freight_paid,
       {ratio(cents('coalesce(v.total_gmv, 0)'), 'o.total_orders * 100', 2)} AS avg_order_value,
       o.first_order_date, o.last_order_date,
       date_diff('day', o.first_order_date, o.last_order_date) AS tenure_days,
       date_diff('day', o.last_order_date, k.as_of_date) AS days_since_last_order,
       r.review_mean, CAST(r.review_mean AS DECIMAL(4,2)) AS avg_review_score, r.pct_negative_reviews,
       o.avg_delivery_delta_days, o.pct_late_deliveries,
       CASE WHEN date_diff('day', o.last_order_date, k.as_of_date) > 180 THEN 1 ELSE 0 END AS is_churned
FROM c_customers c JOIN g_orders o USING (customer_unique_id)
LEFT JOIN (SELECT customer_unique_id, sum(order_gmv) AS total_gmv, sum(order_freight) AS total_freight_paid
           FROM s_values GROUP BY 1) v USING (customer_unique_id)
LEFT JOIN g_reviews r USING (customer_unique_id) CROSS JOIN g_const k""")

table("g_360", f"""
SELECT *, CASE WHEN customer_health_score >= 75 THEN 'High' WHEN customer_health_score >= 50 THEN 'Medium' ELSE 'Low' END
          AS health_tier
FROM (SELECT *, {ratio('10 * (4 * (rr - 1) + 4 * (rm - 1) + 2 * (rs - 1))', 'n - 1', 1)} AS customer_health_score
FROM (SELECT b.*, count(*) OVER () AS n,
             rank() OVER (ORDER BY days_since_last_order DESC) AS rr,
             rank() OVER (ORDER BY total_gmv ASC) AS rm,
             rank() OVER (ORDER BY coalesce(review_mean, CAST((SELECT quantile_cont(review_mean, 0.5) FROM g_reviews)
                                            AS DECIMAL(4,2))) ASC) AS rs
      FROM g_base b))""")

table("g_rfm", """
SELECT customer_unique_id, days_since_last_order AS recency_days, total_orders AS frequency, total_gmv AS monetary,
       recency_score, frequency_score, monetary_score,
       CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR) AS rfm_score,
       CASE WHEN recency_score = 5 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
            WHEN recency_score >= 4 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Loyal'
            WHEN recency_score >= 4 AND frequency_score < 3 THEN 'Potential Loyalist'
            WHEN recency_score <= 2 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'At Risk'
            WHEN recency_score <= 2 AND monetary_score >= 4 THEN 'Can''t Lose'
            WHEN recency_score = 1 AND frequency_score = 1 AND monetary_score = 1 THEN 'Lost'
            WHEN recency_score <= 2 AND frequency_score <= 2 THEN 'Hibernating'
            WHEN frequency_score >= 3 AND monetary_score <= 2 THEN 'Frequent Low-Spender'
            WHEN recency_score = 3 THEN 'Needs Attention' END AS rfm_segment
FROM (SELECT *, ntile(5) OVER (ORDER BY days_since_last_order DESC, customer_unique_id) AS recency_score,
             ntile(5) OVER (ORDER BY total_orders ASC, customer_unique_id) AS frequency_score,
             ntile(5) OVER (ORDER BY total_gmv ASC, customer_unique_id) AS monetary_score
      FROM g_base)""")

table("g_clv", f"""
SELECT b.customer_unique_id, b.avg_order_value,
       CASE WHEN tenure_days > 0 THEN {ratio('total_orders * 30', 'tenure_days', 4)} END AS order_frequency_per_month,
       {ratio('tenure_days', '30', 2)} AS tenure_months,
       coalesce(d.n, 0) AS total_categories_purchased, avg_review_score,
       avg_delivery_delta_days AS avg_delivery_delta, pct_late_deliveries AS pct_late, customer_state,
       days_since_last_order, p.payment_type_primary AS preferred_payment_type,
       coalesce(a.gmv, 0) AS actual_gmv_post_cutoff
FROM g_base b
LEFT JOIN (SELECT o.customer_unique_id, count(DISTINCT s.category) AS n
           FROM c_items i JOIN s_orders o USING (order_id) LEFT JOIN s_products s USING (product_id) GROUP BY 1) d
  USING (customer_unique_id)
LEFT JOIN (SELECT customer_unique_id, payment_type_primary, row_number() OVER (
             PARTITION BY customer_unique_id ORDER BY n DESC, v DESC, payment_type_primary) AS rn
           FROM (SELECT customer_unique_id, payment_type_primary, count(*) AS n, sum(coalesce(total_payment_value, 0)) AS v
                 FROM s_paid WHERE payment_type_primary IS NOT NULL GROUP BY 1, 2)) p
  ON p.customer_unique_id = b.customer_unique_id AND p.rn = 1
LEFT JOIN (SELECT customer_unique_id, sum(order_gmv) AS gmv FROM s_values
           WHERE order_purchase_timestamp >= TIMESTAMP '2001-01-01' GROUP BY 1) a
  ON a.customer_unique_id = b.customer_unique_id""")

# -- scores, actions, views ----------------------------------------------------

table("g_scored", f"""
SELECT p.*, s.churn_probability, s.avg_sentiment_score, s.expected_next_purchase_days, s.clv_predicted_6m,
       s.clv_ci_lower, s.clv_ci_upper, s.km_cluster, r.recency_score, r.frequency_score, r.monetary_score, r.rfm_score,
       r.rfm_segment,
       CASE WHEN s.clv_predicted_6m IS NULL THEN 0 ELSE {ratio('(2 * q.rk + q.ties - 1) * 50', 'q.n', 8)} END AS clv_percentile
FROM g_360 p JOIN c_scores s USING (customer_unique_id) JOIN g_rfm r USING (customer_unique_id)
LEFT JOIN (SELECT customer_unique_id, rank() OVER (ORDER BY clv_predicted_6m) AS rk,
                  count(*) OVER (PARTITION BY clv_predicted_6m) AS ties, count(*) OVER () AS n
           FROM c_scores WHERE clv_predicted_6m IS NOT NULL) q USING (customer_unique_id)""")

table("g_queue", """
SELECT customer_unique_id, action_type,
       CASE action_type WHEN 'RETENTION_CAMPAIGN' THEN 'HIGH' WHEN 'MONITOR' THEN 'LOW' ELSE 'MED' END AS priority,
       churn_probability, clv_predicted_6m AS clv_predicted,
       CASE action_type
         WHEN 'RETENTION_CAMPAIGN' THEN 'Churn risk ' || cs || ' ≥ 0.60; CLV ' || vs || ' at ' || ps
           || ' (≥ 50th) — high-value customer, premium retention warranted'
         WHEN 'REACTIVATION' THEN 'Churn risk ' || cs || ' ≥ 0.60; CLV ' || vs || ' at ' || ps
           || ' (< 50th) — lower-value at-risk, cost-efficient reactivation'
         WHEN 'VIP_UPGRADE' THEN 'Segment: ' || rfm_segment || ' (in [''Champions'']); CLV ' || vs || ' at ' || ps
           || ' (≥ 90th) — VIP candidate for loyalty programme or account manager'
         ELSE 'No high-priority conditions met — churn=' || cs || ', segment=' || rfm_segment || ', CLV ' || vs || ' at '
           || ps || ', health=' || health_tier END AS trigger_reason,
       TIMESTAMP '2001-08-02' AS created_at
FROM (SELECT *, coalesce(printf('%.3f', CAST(churn_probability AS DOUBLE)), 'N/A') AS cs,
             coalesce('R$' || printf('%.2f', CAST(clv_predicted_6m AS DOUBLE)), 'NULL') AS vs,
             printf('%.0f', clv_percentile) || 'th pct' AS ps,
             CASE WHEN churn_probability >= 0.6 AND clv_percentile >= 50 THEN 'RETENTION_CAMPAIGN'
                  WHEN churn_probability >= 0.6 AND clv_percentile < 50 THEN 'REACTIVATION'
                  WHEN rfm_segment = 'Champions' AND clv_percentile >= 90 THEN 'VIP_UPGRADE'
                  ELSE 'MONITOR' END AS action_type
      FROM g_scored)""")

table("g_health", """
SELECT s.*, CASE WHEN s.days_since_last_order <= 30 THEN '0-30 days' WHEN s.days_since_last_order <= 90 THEN '31-90 days'
                 WHEN s.days_since_last_order <= 180 THEN '91-180 days' ELSE '180+ days' END AS recency_band,
       CASE WHEN recency_score >= 4 THEN 'High' WHEN recency_score = 3 THEN 'Medium' ELSE 'Low' END AS recency_tier,
       CASE WHEN frequency_score >= 4 THEN 'High' WHEN frequency_score = 3 THEN 'Medium' ELSE 'Low' END AS frequency_tier,
       CASE WHEN monetary_score >= 4 THEN 'High' WHEN monetary_score = 3 THEN 'Medium' ELSE 'Low' END AS monetary_tier,
       c.actual_gmv_post_cutoff, c.preferred_payment_type, c.total_categories_purchased,
       q.action_type AS latest_action_type, q.priority AS latest_action_priority, q.trigger_reason AS latest_action_reason,
       q.created_at AS latest_action_date, k.as_of_date
FROM g_scored s LEFT JOIN g_clv c USING (customer_unique_id) LEFT JOIN g_queue q USING (customer_unique_id)
CROSS JOIN g_const k""")

table("g_signals", f"""
SELECT *, CASE WHEN is_churned = 1 AND churn_probability > 0.4 THEN 'Rule + model agree: churned'
               WHEN is_churned = 1 THEN 'Rule-based: no order in 180+ days'
               WHEN churn_probability > 0.4 THEN 'Model-flagged: at risk' ELSE 'Active' END AS churn_driver_summary,
       CASE WHEN db >= sb AND db >= rb AND db >= mb AND db > 3000 THEN 'Delivery experience'
            WHEN sb >= rb AND sb >= mb AND sb > 3000 THEN 'Low satisfaction'
            WHEN rb >= mb THEN 'Lapsed / inactive' ELSE 'Low historical value' END AS primary_driver,
       {ratio('''360 * CAST(coalesce(churn_probability * 10000, is_churned * 10000) AS BIGINT) + 360 * (10000 - mb)
              + 5000 * least(coalesce(days_since_last_order, 0), 360)''', '90000', 1)} AS urgency_score
FROM (SELECT *, CAST(round(coalesce(pct_late_deliveries, 0) * 10000) AS BIGINT) AS db,
             coalesce(10000 - CAST(avg_review_score * 100 AS BIGINT) * 20, 5000) AS sb,
             coalesce(10000 - (recency_score - 1) * 2500, 5000) AS rb,
             coalesce(10000 - (monetary_score - 1) * 2500, 5000) AS mb
      FROM g_health WHERE is_churned = 1 OR churn_probability > 0.4)""")


def mean(value: str, digits: int, scale: int = 2) -> str:
    """Average of a column with at most ``scale`` digits, in integer arithmetic."""
    whole = f"CAST(round(({value}) * {10 ** scale}) AS HUGEINT)"
    return ratio(f"sum({whole})", f"count({value}) * {10 ** scale}", digits)


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Percent of two money or count columns."""
    return f"coalesce({ratio(cents(part) + ' * 100', cents(whole), digits)}, 0)"


table("g_geo", f"""
SELECT s.*, {pct('total_gmv', 'sum(total_gmv) OVER ()')} AS pct_of_total_gmv,
       {pct('customer_count', 'sum(customer_count) OVER ()')} AS pct_of_total_customers,
       CASE WHEN total_gmv / sum(total_gmv) OVER () < 0.02 THEN 'Other' ELSE customer_state END AS dashboard_state_label
FROM (SELECT coalesce(customer_state, 'UNKNOWN') AS customer_state, count(*) AS customer_count, sum(total_gmv) AS total_gmv,
             {mean('avg_delivery_delta_days', 2)} AS avg_delivery_delta_days,
             {mean('pct_late_deliveries * 100', 2)} AS pct_late_deliveries,
             {ratio('sum(is_churned) * 100', 'count(*)', 2)} AS churn_rate_pct,
             {mean('customer_health_score', 2)} AS avg_health_score, {mean('avg_review_score', 2)} AS avg_review_score
      FROM g_360 GROUP BY 1) s""")


# -- texts ---------------------------------------------------------------------

def cleaned(text: str) -> str:
    """The cleaning steps; without back references each repeated mark and letter is its own step."""
    def replace(value: str, pattern: str, kept: str) -> str:
        return f"regexp_replace({value}, '{pattern}', '{kept}', 'g')"

    value = f"nfc_normalize({text})"
    for pattern in (r"https?://\S+|www\.\S+", r"<[^>]+>", r"&[a-zA-Z]+;|&#\d+;", r"[\r\n\t]+",
                    r"(?i)r\$\s?\d{1,3}(?:\.\d{3})*(?:,\d{2})?", r"\b\d{6,}\b"):
        value = replace(value, pattern, " ")
    for mark, pattern in (("!", "!"), ("?", r"\?"), (".", r"\.")):
        value = replace(value, pattern + "{3,}", mark * 2)
    for code in [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("À"), ord("ÿ") + 1)]:
        value = replace(value, chr(code) + "{4,}", chr(code) * 3)
    value = replace(value, r"\s{2,}", " ")
    return f"nullif({replace(value, '^\\s+|\\s+$', '')}, '')"


def compound(source: str, key: str, text: str, lexicon: dict[str, str], negators: tuple[str, ...],
             boosters: dict[str, str]) -> str:
    """Compound score per text of ``source``, tokens in order, the three words before each looked up."""
    words = "VALUES " + ", ".join(f"('{w}', CAST({v} AS DECIMAL(8,6)))" for w, v in lexicon.items())
    terms = ", ".join(f"'{n}'" for n in negators)

    def boost(word: str) -> str:
        return "CASE " + " ".join(f"WHEN {word} = '{t}' THEN CAST({v} AS DECIMAL(8,6))" for t, v in boosters.items()) + " ELSE 0 END"

    strength = " + ".join(f"CAST(({boost(f'w{d}')}) * CAST({f} AS DECIMAL(3,2)) AS DECIMAL(12,8))"
                          for d, f in ((1, 1), (2, 0.95), (3, 0.9)))
    turns = " + ".join(f"CASE WHEN w{d} IN ({terms}) THEN 1 ELSE 0 END" for d in (1, 2, 3))
    lags = ", ".join(f"lag(word, {d}) OVER (PARTITION BY {key} ORDER BY place) AS w{d}" for d in (1, 2, 3))
    return f"""(SELECT {key}, round(t / sqrt(t * t + 15), 4) AS compound_score FROM (
  SELECT {key}, CAST(s + sign(s) * emphasis AS DOUBLE) AS t FROM (
    SELECT {key}, max(emphasis) AS emphasis, coalesce(sum(CAST(CAST(valence + CASE WHEN valence < 0 THEN -1 ELSE 1 END * ({strength})
             AS DECIMAL(12,8)) * CASE ({turns}) WHEN 0 THEN 1 WHEN 1 THEN -0.74 WHEN 2 THEN 0.5476 ELSE -0.405224 END
             AS DECIMAL(30,12))), 0) AS s
    FROM (SELECT {key}, emphasis, word, {lags} FROM (
            SELECT {key}, emphasis, place, regexp_replace(raw, '^[[:punct:]]+|[[:punct:]]+$', '', 'g') AS word FROM (
              SELECT {key}, CAST(least(len(regexp_extract_all({text}, '!')), 4) * 0.292
                       + CASE WHEN len(regexp_extract_all({text}, '[?]')) <= 1 THEN 0
                              WHEN len(regexp_extract_all({text}, '[?]')) <= 3 THEN len(regexp_extract_all({text}, '[?]')) * 0.18
                              ELSE 0.96 END AS DECIMAL(8,6)) AS emphasis,
                     unnest(string_split_regex(lower({text}), '\\s+')) AS raw,
                     generate_subscripts(string_split_regex(lower({text}), '\\s+'), 1) AS place
              FROM {source} WHERE {text} IS NOT NULL)))
    LEFT JOIN ({words}) lexicon(word, valence) USING (word) GROUP BY 1)))"""


# -- reviews with the scores of their texts --------------------------------------

table("d_scores", compound(f"(SELECT doc_id, {cleaned('text')} AS body FROM documents)", "doc_id", "body", LEXICON, SAMPLE_NEGATORS,
                           SAMPLE_BOOSTERS))

table("g_sent", """
SELECT review_id, order_id, customer_unique_id, review_score, review_comment_message, review_creation_date, compound_score,
       CASE WHEN compound_score >= 0.05 THEN 'positive' WHEN compound_score <= -0.05 THEN 'negative'
            WHEN compound_score IS NOT NULL THEN 'neutral' END AS sentiment_label
FROM s_reviews LEFT JOIN d_scores USING (doc_id)""")
