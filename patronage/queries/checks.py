"""Queries for the data-quality jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import measures, quality
from ..oracle import cents, mean, ratio
from ..plans import gold, silver
from ..sources.files import row_counts
from ..sources.sample_tables import SampleTables
from . import marts as m
from .dashboards import geo, health
from .registry import register
from .store import scored_reviews, stored_marts

CHECK = "check_name:s value:d status:s"
EXPECTED = {"nations": 25}


def check_sql(one: str, **status: str) -> str:
    """Rows (check_name, value, status) from a one-row SELECT; status maps a column to its condition or INFO."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS check_name, CAST({c} AS DOUBLE) AS value, "
        + ("'INFO'" if rule == "INFO" else f"CASE WHEN {c} IS NULL THEN 'N/A' WHEN {rule} THEN 'OK' ELSE 'FAIL' END")
        + f" AS status FROM ({one})" for c, rule in status.items())


COUNTED = {"nations": "nation", "orders": "c_orders", "customers": "c_customers", "sellers": "c_sellers", "products": "c_products",
           "items": "c_items", "payments": "c_payments", "reviews": "c_review_heads", "category_translation": "c_translation"}
ROW_COUNT_SQL = " UNION ALL ".join(
    f"SELECT 'rows_{name}' AS check_name, CAST(count(*) AS DOUBLE) AS value, "
    + (f"CASE WHEN count(*) = {EXPECTED[name]} THEN 'OK' ELSE 'FAIL' END" if name in EXPECTED else "'INFO'") + f" AS status FROM {source}"
    for name, source in COUNTED.items())


def raw_row_counts(t: SampleTables) -> DataFrame:
    tables = {"nations": t.read("nation"), "orders": t.orders, "customers": t.customers, "sellers": t.sellers, "products": t.products,
              "items": t.items, "payments": t.payments, "reviews": t.review_heads, "category_translation": t.category_translation}
    return quality.row_count_checks(row_counts(tables, EXPECTED))


register("check_row_counts", CHECK, ROW_COUNT_SQL)(raw_row_counts)

VERSION_SQL = check_sql("""
SELECT (SELECT count(*) FROM (SELECT customer_unique_id FROM s_versions WHERE is_current = 1 GROUP BY 1 HAVING count(*) > 1))
         AS customers_with_two_open_versions,
       (SELECT count(*) FROM s_versions a JOIN s_versions b ON a.customer_unique_id = b.customer_unique_id
          AND a.valid_from < b.valid_from AND coalesce(a.valid_to, DATE '9999-12-31') > b.valid_from) AS overlapping_versions""",
                        customers_with_two_open_versions="customers_with_two_open_versions = 0",
                        overlapping_versions="overlapping_versions = 0")
register("check_versions", CHECK, VERSION_SQL)(lambda t: quality.version_checks(m.versions(t)))

ORPHAN_SQL = check_sql("""
SELECT (SELECT count(*) FROM s_orders WHERE customer_unique_id NOT IN (SELECT customer_unique_id FROM s_versions)) AS orphan_orders,
       (SELECT count(*) FROM c_items WHERE order_id NOT IN (SELECT order_id FROM s_orders)) AS orphan_items,
       (SELECT count(*) FROM s_reviews WHERE customer_unique_id IS NULL) AS reviews_missing_customer,
       (SELECT count(*) FROM c_items WHERE product_id NOT IN (SELECT product_id FROM c_products)) AS items_missing_product,
       (SELECT count(*) FROM c_items WHERE seller_id NOT IN (SELECT seller_id FROM c_sellers)) AS items_missing_seller""",
                       orphan_orders="orphan_orders = 0", orphan_items="orphan_items = 0",
                       reviews_missing_customer="reviews_missing_customer = 0", items_missing_product="INFO",
                       items_missing_seller="INFO")


def orphans(t: SampleTables) -> DataFrame:
    return quality.orphan_checks(m.known_orders(t), t.items, m.review_dim(t), m.versions(t), t.products, t.sellers)


register("check_orphans", CHECK, ORPHAN_SQL)(orphans)

register("multi_review_orders", "order_id:s review_count:i",
         "SELECT order_id, count(*) AS review_count FROM s_reviews GROUP BY 1 HAVING count(*) > 1")(
    lambda t: quality.multi_review_orders(m.review_dim(t)))

register("most_reviewed_orders", "order_id:s review_count:i", """
SELECT order_id, count(*) AS review_count FROM s_reviews GROUP BY 1 HAVING count(*) > 1
ORDER BY review_count DESC, order_id LIMIT 10""")(lambda t: quality.most_reviewed_orders(m.review_dim(t)))

PAYMENT_SQL = check_sql("""
SELECT count(*) AS payment_differences FROM s_paid JOIN (
  SELECT order_id, sum(payment_value) AS raw_total FROM c_payments GROUP BY 1) USING (order_id)
WHERE abs(coalesce(total_payment_value, 0) - coalesce(raw_total, 0)) > 0.01""", payment_differences="payment_differences = 0")
register("check_payments", CHECK, PAYMENT_SQL)(lambda t: quality.payment_checks(m.paid_orders(t), t.payments))


register("payment_differences", "order_id:s total_payment_value:d raw_total:d", """
SELECT order_id, total_payment_value, raw_total FROM s_paid JOIN (
  SELECT order_id, sum(payment_value) AS raw_total FROM c_payments WHERE payment_type <> 'voucher' GROUP BY 1) USING (order_id)
WHERE abs(total_payment_value - raw_total) > 0.01""")(
    lambda t: quality.payment_differences(m.paid_orders(t), t.payments.where(F.col("payment_type") != "voucher")))

DATE_SQL = check_sql(f"""
SELECT (SELECT count(*) FROM c_orders WHERE order_purchase_timestamp IS NULL) AS orders_on_unknown_date, sum(late) AS late_orders, count(*) AS delivered_with_dates,
       {ratio('sum(late) * 100', 'count(*)', 2)} AS pct_late
FROM (SELECT CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late
      FROM c_orders WHERE order_delivered_customer_date IS NOT NULL)""", orders_on_unknown_date="orders_on_unknown_date = 0",
                     late_orders="INFO",
                     delivered_with_dates="INFO", pct_late="INFO")
register("check_order_dates", CHECK, DATE_SQL)(lambda t: quality.order_date_checks(silver.order_columns(t.orders)))

MART_SQL = check_sql("""
SELECT (SELECT count(*) FROM g_360) AS rows_profile, (SELECT count(*) FROM g_rfm) AS rows_rfm,
       (SELECT count(*) FROM g_clv) AS rows_clv, (SELECT count(*) FROM c_customers) AS rows_customers,
       (SELECT count(*) FROM g_const WHERE as_of_date <> (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS as_of_mismatch,
       (SELECT count(*) FROM g_const) AS run_constant_rows""", rows_profile="rows_profile = rows_customers", rows_rfm="rows_rfm = rows_customers",
                     rows_clv="rows_clv = rows_customers", rows_customers="INFO", as_of_mismatch="as_of_mismatch = 0",
                     run_constant_rows="run_constant_rows = 1")


def marts(t: SampleTables) -> DataFrame:
    s = stored_marts(t)
    return quality.mart_checks(s.profile, s.rfm, s.clv, t.customers, s.constants, t.orders)


register("check_marts", CHECK, MART_SQL)(marts)

SCORE_SQL = check_sql("""
SELECT min(customer_health_score) AS min_health, max(customer_health_score) AS max_health,
       count(*) FILTER (WHERE customer_health_score NOT BETWEEN 0 AND 100) AS health_out_of_range,
       count(DISTINCT health_tier) AS health_tiers, min(recency_score) AS min_recency, max(recency_score) AS max_recency,
       min(frequency_score) AS min_frequency, max(frequency_score) AS max_frequency, min(monetary_score) AS min_monetary,
       max(monetary_score) AS max_monetary FROM g_scored""", min_health="min_health >= 0", max_health="max_health <= 100",
                      health_out_of_range="health_out_of_range = 0", health_tiers="INFO", min_recency="min_recency = 1",
                      max_recency="max_recency = 5", min_frequency="min_frequency = 1", max_frequency="max_frequency = 5",
                      min_monetary="min_monetary = 1", max_monetary="max_monetary = 5")
register("check_scores", CHECK, SCORE_SQL)(lambda t: quality.score_checks(stored_marts(t).profile, stored_marts(t).rfm))

register("health_tier_distribution", "health_tier:s customer_count:i",
         "SELECT health_tier, count(*) AS customer_count FROM g_360 GROUP BY 1")(
    lambda t: quality.tier_distribution(stored_marts(t).profile))

FEATURE_SQL = check_sql(f"""
SELECT sum(c.actual_gmv_post_cutoff) AS post_cutoff_gmv, sum(b.total_gmv) AS total_gmv,
       {ratio(cents('sum(c.actual_gmv_post_cutoff)') + ' * 100', cents('sum(b.total_gmv)'), 2)} AS pct_post_cutoff,
       count(*) FILTER (WHERE c.preferred_payment_type IS NULL) AS missing_payment_type,
       count(*) FILTER (WHERE c.order_frequency_per_month IS NULL AND first_order_date <> last_order_date) AS missing_frequency
FROM g_clv c JOIN g_base b USING (customer_unique_id)""", post_cutoff_gmv="INFO", total_gmv="INFO", pct_post_cutoff="INFO",
                        missing_payment_type="missing_payment_type = 0", missing_frequency="missing_frequency = 0")
register("check_features", CHECK, FEATURE_SQL)(lambda t: quality.feature_checks(stored_marts(t).clv, stored_marts(t).profile))

RECONCILE_SQL = check_sql("""
SELECT count(*) FILTER (WHERE abs(b.total_gmv - v.gmv) > 0.01) AS gmv_differences,
       count(*) FILTER (WHERE abs(b.total_freight_paid - v.freight) > 0.01) AS freight_differences,
       (SELECT count(*) - count(DISTINCT review_id) FROM s_reviews) AS sentiment_row_gap
FROM g_base b JOIN (SELECT customer_unique_id, sum(price + freight_value) AS gmv, sum(freight_value) AS freight
                    FROM c_items JOIN s_orders USING (order_id) GROUP BY 1) v USING (customer_unique_id)""",
                          gmv_differences="gmv_differences = 0", freight_differences="freight_differences = 0",
                          sentiment_row_gap="sentiment_row_gap = 0")


def reconciled(t: SampleTables) -> DataFrame:
    reviews = m.review_dim(t)
    return quality.reconciliation_checks(stored_marts(t).profile, t.items, m.known_orders(t),
                                         gold.sentiment_skeleton(reviews), reviews)


register("check_reconciliation", CHECK, RECONCILE_SQL)(reconciled)

COVERED = ("churn_probability", "avg_sentiment_score", "expected_next_purchase_days", "clv_predicted_6m", "rfm_segment",
           "km_cluster")


def _coverage_sql(column: str, source: str) -> str:
    return (f"SELECT '{column}' AS column_name, count({column}) AS populated, count(*) AS total, "
            f"{ratio(f'count({column}) * 100', 'count(*)', 2)} AS pct_populated FROM {source}")


COVERAGE_SQL = " UNION ALL ".join(
    [_coverage_sql(c, "g_scored") for c in COVERED]
    + [_coverage_sql("compound_score", "(SELECT * FROM g_sent WHERE review_comment_message IS NOT NULL)")])


def covered(t: SampleTables) -> DataFrame:
    s = stored_marts(t)
    return quality.prediction_coverage(s.profile, s.clv, s.rfm, scored_reviews(t))


register("prediction_coverage", "column_name:s populated:i total:i pct_populated:d", COVERAGE_SQL)(covered)

BOUNDS = quality.PREDICTION_BOUNDS
RANGE_SQL = check_sql(
    "SELECT " + ", ".join(f"{f}({c}) AS {f}_{c}" for c in BOUNDS for f in ("min", "max")) + " FROM g_scored",
    **{f"min_{c}": f"min_{c} >= {low}" for c, (low, _) in BOUNDS.items()},
    **{f"max_{c}": "TRUE" if high is None else f"max_{c} <= {high}" for c, (_, high) in BOUNDS.items()})
register("prediction_ranges", CHECK, RANGE_SQL)(
    lambda t: quality.prediction_ranges(health(t)))

AGREEMENT_SQL = check_sql(f"""
SELECT {ratio('sum(is_churned)', 'count(*)', 4)} AS rule_churn_rate, {mean('churn_probability', 4, 4)} AS mean_churn_probability,
       {ratio('count(*) FILTER (WHERE is_churned = CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END)', 'count(*)', 4)}
         AS agreement FROM g_scored WHERE churn_probability IS NOT NULL""", rule_churn_rate="INFO",
                          mean_churn_probability="INFO", agreement="INFO")
register("rule_model_agreement", CHECK, AGREEMENT_SQL)(lambda t: quality.rule_model_agreement(stored_marts(t).profile))

SEGMENT_SQL = f"""
SELECT rfm_segment, n, {ratio('n * 100', 'sum(n) OVER ()', 1)} AS pct, 'OK' AS status
FROM (SELECT rfm_segment, count(*) AS n FROM g_rfm GROUP BY 1)"""
register("segment_distribution", "rfm_segment:s n:i pct:d status:s", SEGMENT_SQL)(
    lambda t: quality.segment_distribution(stored_marts(t).rfm))

DRIFT_SQL = f"""SELECT 'churn_rate' AS check_name, v AS value, CASE WHEN abs(v - 0.7118) > 0.05 THEN 'WARN' ELSE 'OK' END AS status
FROM (SELECT {ratio('sum(is_churned)', 'count(*)', 4)} AS v FROM g_360)"""
register("churn_rate_drift", CHECK, DRIFT_SQL)(lambda t: quality.drift_check(stored_marts(t).profile, 0.7118))

JOBS = {"row_counts": ROW_COUNT_SQL, "multiple_reviews": """
SELECT 'orders_with_several_reviews' AS check_name, CAST(count(*) AS DOUBLE) AS value, 'INFO' AS status
FROM (SELECT order_id FROM s_reviews GROUP BY 1 HAVING count(*) > 1)""",
        "coverage": f"SELECT 'pct_' || column_name AS check_name, CAST(pct_populated AS DOUBLE) AS value, 'INFO' AS status FROM ({COVERAGE_SQL})",
        "ranges": RANGE_SQL,
        "segments": f"SELECT 'pct_' || rfm_segment AS check_name, CAST(pct AS DOUBLE) AS value, status FROM ({SEGMENT_SQL})",
        "readiness": "SELECT 'dashboard' AS check_name, CAST(count(*) AS DOUBLE) AS value, 'PASS' AS status FROM g_health",
        "versions": VERSION_SQL, "orphans": ORPHAN_SQL, "payments": PAYMENT_SQL, "order_dates": DATE_SQL, "marts": MART_SQL,
        "scores": SCORE_SQL, "features": FEATURE_SQL, "reconciliation": RECONCILE_SQL, "agreement": AGREEMENT_SQL,
        "drift": DRIFT_SQL}


@register("quality_report", "job:s " + CHECK, " UNION ALL ".join(
    f"SELECT '{job}' AS job, check_name, value, status FROM ({sql})" for job, sql in JOBS.items()))
def quality_report(t: SampleTables) -> DataFrame:
    s = stored_marts(t)
    return quality.combined({
        "row_counts": raw_row_counts(t), "multiple_reviews": quality.multi_review_check(m.review_dim(t)),
        "coverage": quality.share_checks(covered(t), "column_name", "pct_populated", F.lit("INFO")),
        "ranges": quality.prediction_ranges(health(t)),
        "segments": quality.share_checks(quality.segment_distribution(s.rfm), "rfm_segment", "pct", F.col("status")),
        "readiness": measures.readiness(health(t), s.queue, geo(t)).select(
            F.lit("dashboard").alias("check_name"), F.col("customers").cast("double").alias("value"), "status"),
        "versions": quality.version_checks(m.versions(t)), "orphans": orphans(t),
        "payments": quality.payment_checks(m.paid_orders(t), t.payments),
        "order_dates": quality.order_date_checks(silver.order_columns(t.orders)), "marts": marts(t),
        "scores": quality.score_checks(s.profile, s.rfm), "features": quality.feature_checks(s.clv, s.profile),
        "reconciliation": reconciled(t), "agreement": quality.rule_model_agreement(s.profile),
        "drift": quality.drift_check(s.profile, 0.7118)})
