"""Queries that explore the raw tables and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..oracle import cents, mean, pct, ratio
from ..plans import explore, gold
from ..plans.views import state_with_delivery
from ..sources.files import row_counts
from ..sources.sample_tables import ML_CUTOFF, SampleTables
from . import marts as m
from .dashboards import health
from .registry import register
from .store import scored_reviews, stored_marts

PERSON = "customer_unique_id"

register("table_row_counts", "table_name:s row_count:i", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in (
        ("customers", "c_customers"), ("sellers", "c_sellers"), ("products", "c_products"),
        ("category_translation", "c_translation"), ("orders", "c_orders"), ("items", "c_items"),
        ("payments", "c_payments"), ("reviews", "c_review_heads"))))(
    lambda t: row_counts({"customers": t.customers, "sellers": t.sellers, "products": t.products,
                          "category_translation": t.category_translation, "orders": t.orders, "items": t.items,
                          "payments": t.payments, "reviews": t.review_heads}))


def shared_people(t: SampleTables) -> DataFrame:
    """Customers where the ids that differ only above their last two digits belong to one person."""
    return t.customers.withColumn(PERSON, F.concat(F.lit("P"), F.when(
        F.col("customer_id").cast("int") % 5 == 0, F.col("customer_id").cast("int") % 100).otherwise(
        F.col("customer_id").cast("int")).cast("string")))


PEOPLE_SQL = """(SELECT customer_id, customer_city, customer_state, 'P' || CASE WHEN CAST(customer_id AS INT) % 5 = 0
    THEN CAST(customer_id AS INT) % 100 ELSE CAST(customer_id AS INT) END AS customer_unique_id FROM c_customers)"""
PER_PERSON_SQL = f"(SELECT customer_unique_id, count(DISTINCT customer_id) AS id_count FROM {PEOPLE_SQL} GROUP BY 1)"

register("identity_summary", "id_records:i distinct_ids:i distinct_people:i dedup_rate_pct:d", f"""
SELECT *, {ratio('(id_records - distinct_people) * 100', 'id_records', 2)} AS dedup_rate_pct
FROM (SELECT count(*) AS id_records, count(DISTINCT customer_id) AS distinct_ids,
             count(DISTINCT customer_unique_id) AS distinct_people FROM {PEOPLE_SQL})""")(
    lambda t: explore.identity_summary(shared_people(t)))

register("id_multiplicity", "id_count:i customer_count:i pct_of_customers:d", f"""
SELECT id_count, customer_count, {pct('customer_count', 'sum(customer_count) OVER ()', 3)} AS pct_of_customers
FROM (SELECT id_count, count(*) AS customer_count FROM {PER_PERSON_SQL} GROUP BY 1)""")(
    lambda t: explore.id_multiplicity(shared_people(t)))

register("most_ids", "customer_unique_id:s id_count:i customer_ids:s", f"""
SELECT customer_unique_id, count(DISTINCT customer_id) AS id_count,
       string_agg(customer_id, ' | ' ORDER BY customer_id) AS customer_ids
FROM {PEOPLE_SQL} GROUP BY 1 HAVING count(DISTINCT customer_id) > 1 ORDER BY id_count DESC, customer_unique_id LIMIT 10""")(
    lambda t: explore.most_ids(shared_people(t)))

register("listed_ids", "customer_unique_id:s id_count:i customer_id:s", f"""
SELECT DISTINCT customer_unique_id, id_count, customer_id FROM {PEOPLE_SQL} JOIN (
  SELECT customer_unique_id, count(DISTINCT customer_id) AS id_count FROM {PEOPLE_SQL} GROUP BY 1
  HAVING count(DISTINCT customer_id) > 1 ORDER BY id_count DESC, customer_unique_id LIMIT 10) USING (customer_unique_id)""")(
    lambda t: explore.listed_ids(shared_people(t)))

register("orders_of_repeated_ids", "id_records:i orders_placed:i", f"""
SELECT count(DISTINCT c.customer_id) AS id_records, count(DISTINCT o.order_id) AS orders_placed
FROM {PEOPLE_SQL} c JOIN {PER_PERSON_SQL} d ON d.customer_unique_id = c.customer_unique_id AND d.id_count > 1
LEFT JOIN c_orders o ON o.customer_id = c.customer_id""")(
    lambda t: explore.orders_of_repeated_ids(shared_people(t), t.orders))

register("monthly_volume", "month:s order_count:i total_price:d", """
SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, count(DISTINCT o.order_id) AS order_count,
       sum(i.price) AS total_price FROM c_orders o LEFT JOIN c_items i USING (order_id) GROUP BY 1""")(
    lambda t: explore.monthly_volume(t.orders, t.items))

register("split_sizes", "split:s order_count:i customer_id_count:i", """
SELECT CASE WHEN order_purchase_timestamp < TIMESTAMP '2001-01-01' THEN 'TRAIN' ELSE 'TEST' END AS split,
       count(*) AS order_count, count(DISTINCT customer_id) AS customer_id_count FROM c_orders GROUP BY 1""")(
    lambda t: explore.split_sizes(t.orders, ML_CUTOFF))

register("order_value_stats", "avg_order_value:d min_order_value:d max_order_value:d total_orders:i avg_items_per_order:i "
         "max_items_per_order:i zero_value_orders:i p10_order_value:d median_order_value:d p90_order_value:d", f"""
SELECT {mean('order_total', 2)} AS avg_order_value, min(order_total) AS min_order_value, max(order_total) AS max_order_value,
       count(*) AS total_orders, sum(item_count) // count(*) AS avg_items_per_order, max(item_count) AS max_items_per_order,
       count(*) FILTER (WHERE order_total <= 0) AS zero_value_orders,
       {", ".join(f"round(quantile_cont(CAST(order_total AS DOUBLE), {q}), 4) AS {n}_order_value"
                  for n, q in (('p10', 0.1), ('median', 0.5), ('p90', 0.9)))}
FROM (SELECT o.order_id, sum(price) AS order_total, count(*) AS item_count FROM c_orders o JOIN c_items USING (order_id)
      WHERE order_status NOT IN ('canceled', 'unavailable') GROUP BY 1)""")(
    lambda t: explore.order_value_stats(t.orders, t.items))

register("review_scores", "review_score:i review_count:i with_text:i pct_with_text:d pct_of_all_reviews:d", f"""
SELECT *, {ratio('with_text * 100', 'review_count', 1)} AS pct_with_text,
       {pct('review_count', 'sum(review_count) OVER ()', 1)} AS pct_of_all_reviews
FROM (SELECT review_score, count(*) AS review_count, count(nullif(rtrim(review_comment_message, ' '), '')) AS with_text FROM c_review_heads GROUP BY 1)
""")(lambda t: explore.review_scores(t.review_heads))

DELIVERED_SQL = """(SELECT *, date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS delta,
    CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late
    FROM s_orders WHERE order_status = 'delivered')"""

register("score_by_delay", "review_score:i avg_delivery_delta_days:i order_count:i", f"""
SELECT review_score, trunc(avg(delta)) AS avg_delivery_delta_days, count(*) AS order_count
FROM c_review_heads JOIN {DELIVERED_SQL} USING (order_id) GROUP BY 1""")(
    lambda t: explore.score_by_delay(t.review_heads, t.orders))

register("delivery_overall", "avg_delta_days:i pct_late:d orders:i", f"""
SELECT trunc(avg(delta)) AS avg_delta_days, {ratio('sum(late) * 100', 'count(*)', 4)} AS pct_late, count(*) AS orders
FROM {DELIVERED_SQL}""")(lambda t: explore.delivery_overall(t.orders))

STATE_DELIVERY_SQL = f"""(SELECT customer_state, count(*) AS orders, trunc(avg(delta)) AS avg_delta_days,
       {ratio('sum(late) * 100', 'count(*)', 4)} AS pct_late
FROM {DELIVERED_SQL} JOIN c_customers USING (customer_id) GROUP BY 1 HAVING count(*) >= 100)"""


def state_delivery(t: SampleTables) -> DataFrame:
    return explore.delivery_by_state(t.orders, t.customers)


register("delivery_by_state", "customer_state:s orders:i avg_delta_days:i pct_late:d", f"SELECT * FROM {STATE_DELIVERY_SQL}")(
    state_delivery)

register("extreme_delivery_states", "customer_state:s avg_delta_days:i side:s", f"""
SELECT * FROM (SELECT customer_state, avg_delta_days, 'best' AS side FROM {STATE_DELIVERY_SQL}
               ORDER BY avg_delta_days, customer_state LIMIT 5)
UNION ALL SELECT * FROM (SELECT customer_state, avg_delta_days, 'worst' FROM {STATE_DELIVERY_SQL}
               ORDER BY avg_delta_days DESC, customer_state LIMIT 5)""")(
    lambda t: explore.extreme_delivery_states(state_delivery(t)))

register("order_count_distribution", "order_count:i customer_count:i order_count_label:s pct_of_customers:d", f"""
SELECT *, CASE WHEN order_count = 5 THEN '5+' ELSE CAST(order_count AS VARCHAR) END AS order_count_label,
       {pct('customer_count', 'sum(customer_count) OVER ()')} AS pct_of_customers
FROM (SELECT least(n, 5) AS order_count, count(*) AS customer_count
      FROM (SELECT customer_unique_id, count(DISTINCT order_id) AS n FROM c_customers LEFT JOIN c_orders USING (customer_id)
            GROUP BY 1) GROUP BY 1)""")(lambda t: explore.order_count_distribution(t.customers, t.orders))

register("value_by_frequency", "order_count_bucket:i customers:i avg_item_price:d avg_order_value:d", f"""
SELECT least(n, 5) AS order_count_bucket, count(DISTINCT customer_unique_id) AS customers,
       {ratio(cents('sum(price)'), 'count(*) * 100', 2)} AS avg_item_price,
       {ratio(cents('sum(price)'), 'count(DISTINCT order_id) * 100', 2)} AS avg_order_value
FROM s_orders JOIN (SELECT customer_unique_id, count(*) AS n FROM s_orders GROUP BY 1) USING (customer_unique_id)
JOIN c_items USING (order_id) GROUP BY 1""")(lambda t: explore.value_by_frequency(m.known_orders(t), t.items))

register("churn_baseline", "total_customers:i churned_by_definition:i avg_days_since_last_order:d churn_rate_pct:d", f"""
SELECT count(*) AS total_customers, sum(c) AS churned_by_definition,
       {ratio('sum(idle)', 'count(*)', 4)} AS avg_days_since_last_order, {ratio('sum(c) * 100', 'count(*)', 2)} AS churn_rate_pct
FROM (SELECT idle, CASE WHEN idle >= 180 THEN 1 ELSE 0 END AS c
      FROM (SELECT date_diff('day', last_order_date, as_of_date) AS idle FROM g_orders CROSS JOIN g_const))""")(
    lambda t: explore.churn_baseline(m.known_orders(t), gold.run_constants(t.orders, ML_CUTOFF)))

PRICES_SQL = "(SELECT customer_unique_id, sum(price) AS total_gmv FROM s_orders JOIN c_items USING (order_id) GROUP BY 1)"
CURVE_SQL = f"""(SELECT customer_unique_id, row_number() OVER w AS place,
       {pct('sum(total_gmv) OVER (w ROWS UNBOUNDED PRECEDING)', 'sum(total_gmv) OVER ()', 4)} AS cum_gmv_pct,
       {ratio('row_number() OVER w * 100', 'count(*) OVER ()', 4)} AS cum_customer_pct
FROM {PRICES_SQL} WINDOW w AS (ORDER BY total_gmv DESC, customer_unique_id))"""


def curve(t: SampleTables) -> DataFrame:
    return explore.pareto(explore.customer_prices(m.known_orders(t), t.items))


register("pareto_curve", "customer_unique_id:s place:i cum_gmv_pct:d cum_customer_pct:d", f"SELECT * FROM {CURVE_SQL}")(curve)

register("pareto_top_share", "top_share_pct:d",
         f"SELECT max(cum_gmv_pct) AS top_share_pct FROM {CURVE_SQL} WHERE cum_customer_pct <= 20")(
    lambda t: explore.top_share(curve(t)))

register("payment_methods", "payment_type:s transactions:i orders:i total_value:d avg_value:d pct_of_transactions:d", f"""
SELECT *, {pct('transactions', 'sum(transactions) OVER ()', 1)} AS pct_of_transactions
FROM (SELECT payment_type, count(*) AS transactions, count(DISTINCT order_id) AS orders, sum(payment_value) AS total_value,
             {ratio(cents('sum(payment_value)'), 'count(*) * 100', 2)} AS avg_value FROM c_payments GROUP BY 1)""")(
    lambda t: explore.payment_methods(t.payments))

register("installments", "installments_bucket:i transaction_count:i bucket_label:s", """
SELECT least(payment_installments, 10) AS installments_bucket, count(*) AS transaction_count,
       CASE WHEN least(payment_installments, 10) = 10 THEN '10+' ELSE CAST(least(payment_installments, 10) AS VARCHAR) END AS bucket_label
FROM c_payments GROUP BY 1, 3""")(lambda t: explore.installments(t.payments))

STATES = "customer_state:s customers:i orders:i total_gmv:d pct_of_customers:d pct_of_gmv:d"
STATES_SQL = f"""(SELECT *, {pct('customers', 'sum(customers) OVER ()')} AS pct_of_customers,
       {pct('total_gmv', 'sum(total_gmv) OVER ()')} AS pct_of_gmv
FROM (SELECT customer_state, count(DISTINCT customer_unique_id) AS customers, count(DISTINCT order_id) AS orders,
             sum(price) AS total_gmv
      FROM c_customers LEFT JOIN c_orders USING (customer_id) LEFT JOIN c_items USING (order_id) GROUP BY 1))"""

register("state_summary", STATES, f"SELECT * FROM {STATES_SQL}")(
    lambda t: explore.state_summary(t.customers, t.orders, t.items))

register("state_summary_with_delivery", STATES + " avg_delta_days:i pct_late:d", f"""
SELECT s.*, d.avg_delta_days, d.pct_late FROM {STATES_SQL} s LEFT JOIN {STATE_DELIVERY_SQL} d USING (customer_state)""")(
    lambda t: state_with_delivery(explore.state_summary(t.customers, t.orders, t.items), state_delivery(t)))

FRAME = ("order_count", "total_gmv", "avg_item_price", "avg_review_score", "avg_delivery_delta", "pct_late")
FRAME_SQL = f"""(SELECT customer_unique_id, count(*) AS order_count, coalesce(sum(price), 0) AS total_gmv,
       {ratio(cents('sum(price)'), 'sum(lines) * 100', 2)} AS avg_item_price,
       {ratio('sum(score)', 'sum(reviews)', 4)} AS avg_review_score,
       {ratio('sum(delta)', 'count(delta)', 4)} AS avg_delivery_delta, {ratio('sum(late)', 'count(*)', 4)} AS pct_late
FROM {DELIVERED_SQL} LEFT JOIN (SELECT order_id, sum(price) AS price, count(*) AS lines FROM c_items GROUP BY 1) USING (order_id)
LEFT JOIN (SELECT order_id, sum(review_score) AS score, count(*) AS reviews FROM c_review_heads GROUP BY 1) USING (order_id)
GROUP BY 1)"""


def frame(t: SampleTables) -> DataFrame:
    return explore.correlation_frame(m.known_orders(t), t.items, t.review_heads.withColumn(
        "review_score", F.col("review_score").cast("int")))


register("correlation_frame", "customer_unique_id:s " + " ".join(
    f"{c}:{'i' if c == 'order_count' else 'd'}" for c in FRAME), f"SELECT * FROM {FRAME_SQL}")(frame)

PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation "
    f"FROM {FRAME_SQL}" for i, a in enumerate(FRAME) for b in FRAME[i + 1:])


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("correlation", F.round("correlation", 6))


register("correlation_pairs", "feature_1:s feature_2:s correlation:d", PAIRS_SQL)(
    lambda t: rounded(explore.correlation_pairs(frame(t), FRAME)))

register("strong_pairs", "feature_1:s feature_2:s correlation:d", f"SELECT * FROM ({PAIRS_SQL}) WHERE abs(correlation) >= 0.6")(
    lambda t: rounded(explore.strong_pairs(explore.correlation_pairs(frame(t), FRAME))))

CHURN_FEATURES = ("days_since_last_order", "total_orders", "total_gmv", "total_freight_paid", "avg_order_value",
                  "avg_review_score", "pct_negative_reviews", "avg_sentiment_score", "avg_delivery_delta_days",
                  "pct_late_deliveries", "total_categories_purchased")

register("correlation_with_churn", "feature:s correlation:d", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(is_churned AS DOUBLE)), 6) AS correlation FROM g_health"
    for c in CHURN_FEATURES))(
    lambda t: rounded(explore.correlation_with(health(t), "is_churned", CHURN_FEATURES)))

KINDS = ("RETENTION_CAMPAIGN", "REACTIVATION", "VIP_UPGRADE", "MONITOR")


def crossed(name: str, row: str, source) -> None:
    counts = ", ".join(f"count(*) FILTER (WHERE latest_action_type = '{k}') AS {k}" for k in KINDS)
    register(name, f"{row}:s " + " ".join(f"{k}:i" for k in KINDS), f"SELECT {row}, {counts} FROM g_health GROUP BY 1")(
        lambda t: explore.cross_tab(source(t), row, "latest_action_type", KINDS))


crossed("action_by_priority", "latest_action_priority", health)
crossed("action_by_segment", "rfm_segment", health)
crossed("action_by_health_tier", "health_tier", health)
crossed("action_by_state", "customer_state", health)

SEGMENTS = {"Champions": "champions", "Loyal": "loyal", "Potential Loyalist": "potential_loyalist", "At Risk": "at_risk",
            "Can't Lose": "cant_lose", "Lost": "lost", "Hibernating": "hibernating", "Frequent Low-Spender": "frequent_low_spender",
            "Needs Attention": "needs_attention"}


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


register("segment_by_cluster", "km_cluster:i " + " ".join(f"{c}:i" for c in SEGMENTS.values()), "SELECT km_cluster, " + ", ".join(
    f"count(*) FILTER (WHERE rfm_segment = {literal(s)}) AS {c}" for s, c in SEGMENTS.items()) + " FROM g_scored GROUP BY 1")(
    lambda t: explore.cross_tab(stored_marts(t).rfm, "km_cluster", "rfm_segment", list(SEGMENTS)).toDF("km_cluster", *SEGMENTS.values()))

LABELS = ("positive", "neutral", "negative")


register("sentiment_by_score", "review_score:i positive:i neutral:i negative:i", "SELECT review_score, " + ", ".join(
    f"count(*) FILTER (WHERE sentiment_label = '{x}') AS {x}" for x in LABELS) + " FROM g_sent GROUP BY 1")(
    lambda t: explore.cross_tab(scored_reviews(t), "review_score", "sentiment_label", LABELS))


PROFILED = {"churn_probability": 4, "clv_predicted_6m": 2, "customer_health_score": 2, "total_orders": 0, "total_gmv": 2,
            "avg_order_value": 2, "avg_review_score": 2, "avg_sentiment_score": 4, "days_since_last_order": 0}

register("action_profile", "latest_action_type:s " + " ".join(f"{c}:d" for c in PROFILED),
         "SELECT latest_action_type, " + ", ".join(f"{mean(c, 2, s)} AS {c}" for c, s in PROFILED.items())
         + " FROM g_health GROUP BY 1")(lambda t: explore.group_profile(health(t), "latest_action_type", PROFILED))

register("segment_churn", "rfm_segment:s customers:i churn_rate_pct:d", f"""
SELECT rfm_segment, count(*) AS customers, {ratio('sum(is_churned) * 100', 'count(*)', 1)} AS churn_rate_pct
FROM g_health GROUP BY 1""")(lambda t: health(t).groupBy("rfm_segment").agg(
    F.count(F.lit(1)).alias("customers"), m.fx.ratio(F.sum("is_churned") * 100, F.count(F.lit(1)), 1).alias("churn_rate_pct")))

COMPARED = {"avg_order_value": 2, "days_since_last_order": 0, "tenure_months": 2, "total_categories_purchased": 0,
            "avg_delivery_delta": 2, "pct_late": 4}

register("repurchase_comparison", "feature:s non_repurchaser:d repurchaser:d ratio:d", f"""
SELECT feature, non_repurchaser, repurchaser,
       {ratio('round(repurchaser * 10000)', 'round(non_repurchaser * 10000)', 2)} AS ratio FROM (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {mean(f'CASE WHEN actual_gmv_post_cutoff = 0 THEN {c} END', 4, s)} AS non_repurchaser,
        {mean(f'CASE WHEN actual_gmv_post_cutoff > 0 THEN {c} END', 4, s)} AS repurchaser FROM g_clv"""
    for c, s in COMPARED.items()) + ")")(lambda t: explore.repurchase_comparison(stored_marts(t).clv, COMPARED))

register("action_counts", "action_type:s n:i pct:d", f"""
SELECT *, {pct('n', 'sum(n) OVER ()')} AS pct FROM (SELECT action_type, count(*) AS n FROM g_queue GROUP BY 1)""")(
    lambda t: explore.value_counts(stored_marts(t).queue, "action_type"))

register("top_reasons", "action_type:s trigger_reason:s n:i place:i group_size:i pct:d", f"""
SELECT *, {ratio('n * 100', 'group_size', 1)} AS pct
FROM (SELECT action_type, trigger_reason, n, row_number() OVER (PARTITION BY action_type ORDER BY n DESC, trigger_reason) AS place,
             sum(n) OVER (PARTITION BY action_type) AS group_size
      FROM (SELECT action_type, trigger_reason, count(*) AS n FROM g_queue GROUP BY 1, 2)) WHERE place <= 5""")(
    lambda t: explore.top_values(stored_marts(t).queue, "action_type", "trigger_reason"))

register("top_customers_per_state", "customer_state:s customer_unique_id:s total_gmv:d place:i", """
SELECT * FROM (SELECT customer_state, customer_unique_id, total_gmv, row_number() OVER (
    PARTITION BY customer_state ORDER BY total_gmv DESC, customer_unique_id) AS place FROM g_360) WHERE place <= 5""")(
    lambda t: explore.top_rows(stored_marts(t).profile, "customer_state", [F.desc("total_gmv"), F.asc(PERSON)]))

DESCRIBED = ("total_orders", "total_gmv", "avg_order_value", "tenure_days", "customer_health_score")



def described(t: SampleTables):
    profile = stored_marts(t).profile
    rounded = {c: F.round(c, 4) for c in ("mean", "std", "q25", "median", "q75")}
    return explore.describe(profile, DESCRIBED).join(explore.quartiles(profile, DESCRIBED), "feature", "left").withColumns(rounded)


register("profile_description", "feature:s count:i mean:d std:d min:d max:d q25:d median:d q75:d", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, min({c}) AS min, max({c}) AS max, "
    + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 4) AS {name}" for name, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)))
    + " FROM g_360" for c in DESCRIBED))(described)

register("reason_words", "word:s n:i", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(trigger_reason), '[^\\p{L}\\p{N}]+')) AS word FROM g_queue)
WHERE word <> '' GROUP BY 1""")(lambda t: explore.word_counts(stored_marts(t).queue, "trigger_reason"))

CHECKED = {"orders": ("c_orders", ("order_id", "customer_id", "order_delivered_customer_date")),
           "items": ("c_items", ("order_id", "product_id", "seller_id")),
           "payments": ("c_payments", ("order_id",)),
           "reviews": ("c_review_heads", ("order_id", "review_comment_message")),
           "customers": ("c_customers", ("customer_unique_id",)),
           "products": ("c_products", ("product_category_name",))}

register("null_profile", "column_checked:s null_count:i pct_of_table:d status:s",
         "SELECT column_checked, null_count, pct_of_table, CASE WHEN null_count = 0 THEN 'OK' WHEN optional THEN 'INFO' "
         "ELSE 'INVESTIGATE' END AS status FROM ("
         + " UNION ALL ".join(
             f"SELECT '{name}.{c}' AS column_checked, {c in explore.OPTIONAL} AS optional, count(*) - count({v}) AS null_count, "
             f"{ratio(f'(count(*) - count({v})) * 100', 'count(*)', 2)} AS pct_of_table FROM {source}"
             for name, (source, columns) in CHECKED.items() for c in columns
             for v in [f"nullif({c}, '')" if c == "review_comment_message" else c]) + ")")(
    lambda t: explore.null_profile({
        "orders": (t.orders, CHECKED["orders"][1]), "items": (t.items, CHECKED["items"][1]),
        "payments": (t.payments, CHECKED["payments"][1]), "reviews": (t.review_heads, CHECKED["reviews"][1]),
        "customers": (t.customers, CHECKED["customers"][1]), "products": (t.products, CHECKED["products"][1])}))
