"""Queries over the views: customer health, churn signals, geography, dashboard tables and measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import actions, measures, rollups
from ..oracle import cents, mean, pct, ratio
from ..plans import gold, views
from ..sources.sample_tables import SampleTables
from . import marts as m
from .registry import register
from .store import build_marts, scored_reviews, stored_marts

HEALTH = (m.PROFILE + " recency_band:s churn_probability:d avg_sentiment_score:d expected_next_purchase_days:d "
          "rfm_score:s rfm_segment:s km_cluster:i recency_tier:s frequency_tier:s monetary_tier:s clv_predicted_6m:d "
          "clv_ci_lower:d clv_ci_upper:d actual_gmv_post_cutoff:d preferred_payment_type:s total_categories_purchased:i "
          "latest_action_type:s latest_action_priority:s latest_action_reason:s latest_action_date:s as_of_date:s")


def health(t: SampleTables):
    return stored_marts(t).health


def signals(t: SampleTables):
    return views.churn_signals(health(t))


def geo(t: SampleTables):
    return views.geo_performance(stored_marts(t).profile)


register("customer_health_from_raw", HEALTH, "SELECT * FROM g_health")(lambda t: build_marts(t).health)

register("customer_health", HEALTH, "SELECT * FROM g_health")(health)

register("churn_signals", "customer_unique_id:s is_churned:i churn_probability:d rfm_segment:s latest_action_type:s "
         "churn_driver_summary:s primary_driver:s urgency_score:d", "SELECT * FROM g_signals")(signals)

register("most_urgent_customers", "customer_unique_id:s urgency_score:d primary_driver:s",
         "SELECT * FROM g_signals ORDER BY urgency_score DESC, customer_unique_id LIMIT 500")(
    lambda t: views.most_urgent(signals(t)))

register("geo_performance", "customer_state:s customer_count:i total_gmv:d pct_of_total_gmv:d pct_of_total_customers:d "
         "avg_delivery_delta_days:d pct_late_deliveries:d churn_rate_pct:d avg_health_score:d avg_review_score:d "
         "dashboard_state_label:s as_of_date:s", "SELECT * FROM g_geo CROSS JOIN g_const")(
    lambda t: views.geo_performance(stored_marts(t).profile, stored_marts(t).constants))

register("state_metrics", "customer_state:s customer_count:i total_gmv:d total_freight_paid:d avg_order_value:d "
         "avg_delivery_delta:d avg_pct_late:d avg_review_score:d churned_count:i freight_ratio:d churn_rate:d "
         "pct_of_total_gmv:d pct_of_customers:d", f"""
SELECT *, {ratio(cents('total_freight_paid'), cents('total_gmv'), 4)} AS freight_ratio,
       {ratio('churned_count', 'customer_count', 4)} AS churn_rate,
       {pct('total_gmv', 'sum(total_gmv) OVER ()')} AS pct_of_total_gmv,
       {pct('customer_count', 'sum(customer_count) OVER ()')} AS pct_of_customers
FROM (SELECT customer_state, count(*) AS customer_count, sum(total_gmv) AS total_gmv,
             sum(total_freight_paid) AS total_freight_paid, {mean('avg_order_value', 2)} AS avg_order_value,
             {mean('avg_delivery_delta_days', 2)} AS avg_delivery_delta, {mean('pct_late_deliveries', 4, 4)} AS avg_pct_late,
             {mean('avg_review_score', 2)} AS avg_review_score, sum(is_churned) AS churned_count
      FROM g_360 GROUP BY 1)""")(lambda t: views.state_metrics(stored_marts(t).profile))

register("top_cities", "customer_city:s customer_state:s customer_count:i total_gmv:d", """
SELECT customer_city, customer_state, count(*) AS customer_count, sum(total_gmv) AS total_gmv FROM g_360
GROUP BY 1, 2 ORDER BY total_gmv DESC, 1, 2 LIMIT 15""")(lambda t: views.top_cities(stored_marts(t).profile))

register("state_pareto", "customer_state:s total_gmv:d place:i cumulative_gmv_pct:d", f"""
SELECT customer_state, total_gmv, row_number() OVER w AS place,
       {pct('sum(total_gmv) OVER w', 'sum(total_gmv) OVER ()')} AS cumulative_gmv_pct
FROM g_geo WINDOW w AS (ORDER BY total_gmv DESC, customer_state)""")(lambda t: views.state_pareto(geo(t)))

register("monthly_gmv", "order_month:s monthly_gmv:d order_count:i", """
SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month, sum(order_gmv) AS monthly_gmv,
       count(*) AS order_count FROM s_values GROUP BY 1""")(
    lambda t: views.monthly_gmv(gold.order_values(t.items, m.known_orders(t))))

register("sentiment_trend", "review_month:s avg_compound:d review_count:i", f"""
SELECT CAST(date_trunc('month', review_creation_date) AS DATE) AS review_month,
       {mean('compound_score', 4, 4)} AS avg_compound, count(*) AS review_count
FROM g_sent WHERE compound_score IS NOT NULL GROUP BY 1""")(lambda t: views.sentiment_trend(scored_reviews(t)))

register("rfm_cells", "recency_score:i monetary_score:i frequency_score:i rfm_segment:s customer_count:i avg_gmv:d "
         "avg_recency_days:d avg_churn_prob:d avg_health_score:d", f"""
SELECT recency_score, monetary_score, frequency_score, rfm_segment, count(*) AS customer_count,
       {mean('total_gmv', 2)} AS avg_gmv, {ratio('sum(days_since_last_order)', 'count(*)', 2)} AS avg_recency_days,
       {mean('churn_probability', 4, 4)} AS avg_churn_prob, {mean('customer_health_score', 2)} AS avg_health_score
FROM g_scored GROUP BY 1, 2, 3, 4""")(lambda t: views.rfm_cells(stored_marts(t).rfm, stored_marts(t).profile))

BANDS_SQL = """(SELECT customer_unique_id, clv_predicted_6m, clv_ci_lower, clv_ci_upper,
       ntile(100) OVER (ORDER BY clv_predicted_6m, customer_unique_id) AS clv_percentile_rank
FROM c_scores WHERE clv_predicted_6m IS NOT NULL)"""

register("clv_bands", "customer_unique_id:s clv_predicted_6m:d clv_ci_lower:d clv_ci_upper:d clv_percentile_rank:i",
         f"SELECT * FROM {BANDS_SQL}")(lambda t: views.clv_bands(stored_marts(t).clv))

register("clv_bands_lowest", "customer_unique_id:s clv_predicted_6m:d clv_percentile_rank:i",
         f"SELECT * FROM {BANDS_SQL} ORDER BY clv_predicted_6m, customer_unique_id LIMIT 5000")(
    lambda t: views.lowest_bands(views.clv_bands(stored_marts(t).clv)))

register("clv_band_profile", "clv_percentile_rank:i customers:i ci_lower:d point_estimate:d ci_upper:d", f"""
SELECT clv_percentile_rank, count(*) AS customers, {mean('clv_ci_lower', 2)} AS ci_lower,
       {mean('clv_predicted_6m', 2)} AS point_estimate, {mean('clv_ci_upper', 2)} AS ci_upper
FROM {BANDS_SQL} GROUP BY 1""")(lambda t: views.clv_band_profile(views.clv_bands(stored_marts(t).clv)))

RESIDUALS = "customer_unique_id:s actual_gmv_post_cutoff:d clv_predicted_6m:d residual:d rfm_segment:s customer_state:s"
RESIDUALS_SQL = """SELECT customer_unique_id, actual_gmv_post_cutoff, clv_predicted_6m,
       clv_predicted_6m - actual_gmv_post_cutoff AS residual, rfm_segment, customer_state
FROM g_health WHERE clv_predicted_6m IS NOT NULL"""


def residuals(t: SampleTables):
    s = stored_marts(t)
    return views.clv_residuals(s.clv, s.profile, s.rfm)


register("clv_residuals", RESIDUALS, RESIDUALS_SQL)(residuals)

register("clv_largest_actuals", RESIDUALS,
         RESIDUALS_SQL + " ORDER BY actual_gmv_post_cutoff DESC, customer_unique_id LIMIT 3000")(
    lambda t: views.largest_actuals(residuals(t)))

QUADRANT_SQL = """CASE WHEN coalesce(churn_probability, 0) >= 0.6 AND clv_predicted_6m >= 0.93 THEN 'Retain'
     WHEN clv_predicted_6m >= 0.93 THEN 'Grow' WHEN churn_probability >= 0.6 THEN 'Reactivate' ELSE 'Monitor' END"""

register("clv_quadrants", "quadrant:s customer_count:i avg_churn:d avg_clv:d total_gmv:d", f"""
SELECT {QUADRANT_SQL} AS quadrant, count(*) AS customer_count, {mean('churn_probability', 4, 4)} AS avg_churn,
       {mean('clv_predicted_6m', 2)} AS avg_clv, sum(total_gmv) AS total_gmv FROM g_scored GROUP BY 1""")(
    lambda t: views.clv_quadrants(health(t)))

register("dashboard_columns", "customer_unique_id:s clv_band:s clv_band_sort:i churn_bucket:s churn_bucket_sort:i "
         "is_churn_risk:i clv_churn_quadrant:s priority_sort:i", f"""
SELECT customer_unique_id,
       CASE WHEN clv_predicted_6m IS NULL THEN 'No CLV' WHEN clv_predicted_6m = 0 THEN 'R$0'
            WHEN clv_predicted_6m <= 1 THEN 'R$0.01–1' WHEN clv_predicted_6m <= 5 THEN 'R$1–5'
            WHEN clv_predicted_6m <= 20 THEN 'R$5–20' WHEN clv_predicted_6m <= 100 THEN 'R$20–100' ELSE 'R$100+' END AS clv_band,
       CASE WHEN clv_predicted_6m IS NULL THEN 0 WHEN clv_predicted_6m = 0 THEN 1 WHEN clv_predicted_6m <= 1 THEN 2
            WHEN clv_predicted_6m <= 5 THEN 3 WHEN clv_predicted_6m <= 20 THEN 4 WHEN clv_predicted_6m <= 100 THEN 5
            ELSE 6 END AS clv_band_sort,
       CASE WHEN p < 0.1 THEN '0.0–0.1' WHEN p < 0.2 THEN '0.1–0.2' WHEN p < 0.3 THEN '0.2–0.3' WHEN p < 0.4 THEN '0.3–0.4'
            WHEN p < 0.5 THEN '0.4–0.5' WHEN p < 0.6 THEN '0.5–0.6' WHEN p < 0.7 THEN '0.6–0.7' WHEN p < 0.8 THEN '0.7–0.8'
            WHEN p < 0.9 THEN '0.8–0.9' ELSE '0.9–1.0' END AS churn_bucket,
       least(floor(p * 10) + 1, 10) AS churn_bucket_sort, CASE WHEN p >= 0.6 THEN 1 ELSE 0 END AS is_churn_risk,
       {QUADRANT_SQL} AS clv_churn_quadrant,
       CASE latest_action_priority WHEN 'HIGH' THEN 1 WHEN 'MED' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END AS priority_sort
FROM (SELECT *, coalesce(churn_probability, 0) AS p FROM g_health)""")(lambda t: views.dashboard_columns(health(t)))

TIMELINE = ("customer_unique_id:s order_id:s order_date:s total_order_gmv:d delivery_delta_days:i review_score:d "
            "compound_score:d sentiment_label:s days_from_start:i")
TIMELINE_SQL = """SELECT o.customer_unique_id, o.order_id, CAST(o.order_purchase_timestamp AS DATE) AS order_date,
       v.order_gmv AS total_order_gmv,
       date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) AS delivery_delta_days,
       r.review_score, r.compound_score, CASE WHEN r.compound_score >= 0.05 THEN 'positive'
            WHEN r.compound_score <= -0.05 THEN 'negative' WHEN r.compound_score IS NOT NULL THEN 'neutral' END AS sentiment_label,
       date_diff('day', DATE '2016-09-01', CAST(o.order_purchase_timestamp AS DATE)) AS days_from_start
FROM s_orders o JOIN s_values v USING (order_id) LEFT JOIN {reviews} r USING (order_id)"""

register("order_timeline", TIMELINE, TIMELINE_SQL.format(reviews="g_sent"))(
    lambda t: views.order_timeline(m.known_orders(t), gold.order_values(t.items, m.known_orders(t)), scored_reviews(t)))

register("order_timeline_one_row", TIMELINE, TIMELINE_SQL.format(
    reviews=f"(SELECT order_id, {mean('review_score', 4)} AS review_score, {mean('compound_score', 4, 4)} AS compound_score "
            "FROM g_sent GROUP BY 1)"))(
    lambda t: views.order_timeline(m.known_orders(t), gold.order_values(t.items, m.known_orders(t)), scored_reviews(t), True))

register("compound_histogram", "bucket_order:i compound_bucket:s review_count:i", """
SELECT bucket_order, CASE bucket_order WHEN 1 THEN '-1.0 to -0.6' WHEN 2 THEN '-0.6 to -0.3' WHEN 3 THEN '-0.3 to -0.05'
       WHEN 4 THEN '-0.05 to 0.05' WHEN 5 THEN '0.05 to 0.3' WHEN 6 THEN '0.3 to 0.6' ELSE '0.6 to 1.0' END AS compound_bucket,
       count(*) AS review_count
FROM (SELECT CASE WHEN compound_score < -0.6 THEN 1 WHEN compound_score < -0.3 THEN 2 WHEN compound_score < -0.05 THEN 3
             WHEN compound_score <= 0.05 THEN 4 WHEN compound_score <= 0.3 THEN 5 WHEN compound_score <= 0.6 THEN 6 ELSE 7 END
             AS bucket_order FROM g_sent WHERE compound_score IS NOT NULL) GROUP BY 1""")(
    lambda t: views.compound_histogram(scored_reviews(t)))

register("sarcasm_candidates", "review_id:s review_score:i compound_score:d",
         "SELECT * FROM g_sent WHERE review_score = 1 AND compound_score > 0.3")(
    lambda t: scored_reviews(t).where(m.fx.sarcasm()))


@register("unexpected_customers", "customer_unique_id:s churn_probability:d clv_predicted_6m:d rfm_segment:s customer_state:s", """
SELECT customer_unique_id, churn_probability, clv_predicted_6m, rfm_segment, customer_state FROM g_scored
WHERE churn_probability >= (SELECT quantile_cont(CAST(churn_probability AS DOUBLE), 0.95) FROM c_scores)
  AND clv_predicted_6m <= (SELECT quantile_cont(CAST(clv_predicted_6m AS DOUBLE), 0.2) FROM c_scores)""")
def unexpected(t: SampleTables):
    h = health(t)
    limits = measures.exact_percentiles(h, "churn_probability", {"churn_p95": "0.95"}).crossJoin(
        measures.exact_percentiles(h, "clv_predicted_6m", {"clv_p20": "0.2"}))
    return views.unexpected_customers(h, limits)


# -- actions -------------------------------------------------------------------

register("clv_percentiles", "customer_unique_id:s clv_percentile:d", "SELECT * FROM g_scored")(
    lambda t: actions.clv_percentiles(t.customer_scores()))

QUEUE = ("customer_unique_id:s action_type:s priority:s churn_probability:d clv_predicted:d trigger_reason:s created_at:s")

register("action_queue", QUEUE, "SELECT * FROM g_queue")(lambda t: stored_marts(t).queue)

register("action_queue_overridden", "customer_unique_id:s action_type:s", """
SELECT customer_unique_id, CASE WHEN churn_probability >= 0 AND clv_percentile >= 70 THEN 'RETENTION_CAMPAIGN'
       WHEN churn_probability >= 0 AND clv_percentile < 70 THEN 'REACTIVATION'
       WHEN rfm_segment = 'Champions' AND clv_percentile >= 80 THEN 'VIP_UPGRADE' ELSE 'MONITOR' END AS action_type
FROM g_scored""")(lambda t: actions.assign_actions(
    health(t), actions.with_overrides(actions.DEFAULT_CONFIG, churn_threshold=0, clv_percentile=70, vip_percentile=80)))

register("latest_actions", "customer_unique_id:s latest_action_type:s latest_action_priority:s",
         "SELECT customer_unique_id, action_type AS latest_action_type, priority AS latest_action_priority FROM g_queue")(
    lambda t: actions.latest_actions(stored_marts(t).queue.unionByName(
        stored_marts(t).queue.withColumns({"created_at": F.expr("created_at - interval 30 days"),
                                           "action_type": F.lit("MONITOR")}))))

register("run_log", "churn_threshold_used:d clv_percentile_used:d vip_percentile_used:d write_mode:s "
         "n_retention_campaign:i n_reactivation:i n_vip_upgrade:i n_monitor:i n_priority_high:i n_priority_med:i "
         "n_priority_low:i n_total:i n_customers_in:i n_customers_unmatched:i", """
SELECT 0.6 AS churn_threshold_used, 50 AS clv_percentile_used, 90 AS vip_percentile_used, 'TRUNCATE_INSERT' AS write_mode,
       count(*) FILTER (WHERE action_type = 'RETENTION_CAMPAIGN') AS n_retention_campaign,
       count(*) FILTER (WHERE action_type = 'REACTIVATION') AS n_reactivation,
       count(*) FILTER (WHERE action_type = 'VIP_UPGRADE') AS n_vip_upgrade,
       count(*) FILTER (WHERE action_type = 'MONITOR') AS n_monitor,
       count(*) FILTER (WHERE priority = 'HIGH') AS n_priority_high, count(*) FILTER (WHERE priority = 'MED') AS n_priority_med,
       count(*) FILTER (WHERE priority = 'LOW') AS n_priority_low, count(*) AS n_total, count(*) AS n_customers_in,
       0 AS n_customers_unmatched FROM g_queue""")(
    lambda t: actions.run_log(stored_marts(t).queue, stored_marts(t).profile))

MEDIAN_SQL = "(SELECT quantile_cont(CAST(clv_predicted_6m AS DOUBLE), 0.5) FROM c_scores)"

register("rule_validation", "action_type:s total:i high_churn:i low_churn:i above_median:i upto_median:i expected:i", f"""
SELECT action_type, count(*) AS total, count(*) FILTER (WHERE hi) AS high_churn, count(*) FILTER (WHERE lo) AS low_churn,
       count(*) FILTER (WHERE ab) AS above_median, count(*) FILTER (WHERE up) AS upto_median,
       count(*) FILTER (WHERE CASE action_type WHEN 'RETENTION_CAMPAIGN' THEN hi AND ab WHEN 'REACTIVATION' THEN hi AND up
                              WHEN 'MONITOR' THEN lo OR up ELSE FALSE END) AS expected
FROM (SELECT action_type, coalesce(churn_probability >= 0.6, FALSE) AS hi, coalesce(churn_probability < 0.6, FALSE) AS lo,
             coalesce(clv_predicted > {MEDIAN_SQL}, FALSE) AS ab, coalesce(clv_predicted <= {MEDIAN_SQL}, FALSE) AS up
      FROM g_queue) GROUP BY 1""")(
    lambda t: actions.rule_validation(stored_marts(t).queue, measures.median_clv(stored_marts(t).clv)))

register("threshold_sweep", "threshold:d actionable:i retention:i reactivation:i flagged_gmv:d delta_actionable:i", f"""
SELECT threshold, count(*) FILTER (WHERE hit) AS actionable, count(*) FILTER (WHERE hit AND valued) AS retention,
       count(*) FILTER (WHERE hit AND NOT valued) AS reactivation,
       coalesce(sum(total_gmv) FILTER (WHERE hit), 0) AS flagged_gmv,
       count(*) FILTER (WHERE hit) - count(*) FILTER (WHERE latest_action_type <> 'MONITOR') AS delta_actionable
FROM (SELECT threshold, total_gmv, latest_action_type, coalesce(churn_probability >= threshold, FALSE) AS hit,
             coalesce(clv_predicted_6m >= {MEDIAN_SQL}, FALSE) AS valued
      FROM g_health CROSS JOIN (SELECT CAST(0.2 + 0.05 * i AS DECIMAL(6,4)) AS threshold FROM range(15) r(i))) GROUP BY 1""")(
    lambda t: actions.threshold_sweep(health(t), measures.median_clv(health(t))))


# -- measures ------------------------------------------------------------------

def both(name: str, columns: str, sql: str, build, by: str = "customer_state") -> None:
    """Register a measure over everything and per group."""
    register(name, columns, sql.format(by="", group=""))(lambda t: build(t, ()))
    register(f"{name}_by_{by}", f"{by}:s {columns}", sql.format(by=f"{by}, ", group=f"GROUP BY {by}"))(
        lambda t: build(t, (by,)))


both("measures_portfolio", "total_gmv:d total_customers:i avg_order_value:d total_freight_paid:d freight_ratio:d "
     "avg_gmv_per_customer:d as_of_date:s", f"""
SELECT {{by}}sum(total_gmv) AS total_gmv, count(*) AS total_customers, {mean('avg_order_value', 2)} AS avg_order_value,
       sum(total_freight_paid) AS total_freight_paid,
       coalesce({ratio(cents('sum(total_freight_paid)'), cents('sum(total_gmv)'), 4)}, 0) AS freight_ratio,
       {ratio(cents('sum(total_gmv)'), 'count(*) * 100', 2)} AS avg_gmv_per_customer, max(as_of_date) AS as_of_date
FROM g_health {{group}}""", lambda t, by: measures.portfolio(health(t), by))

both("measures_churn", "churned_customers:i churn_rate:d avg_churn_probability:d high_churn_customers:i high_churn_rate:d "
     "avg_pct_late:d avg_delivery_delta:d avg_review_score:d avg_health_score:d", f"""
SELECT {{by}}sum(is_churned) AS churned_customers, {ratio('sum(is_churned)', 'count(*)', 4)} AS churn_rate,
       {mean('churn_probability', 4, 4)} AS avg_churn_probability,
       count(*) FILTER (WHERE churn_probability >= 0.6) AS high_churn_customers,
       {ratio('count(*) FILTER (WHERE churn_probability >= 0.6)', 'count(*)', 4)} AS high_churn_rate,
       {mean('pct_late_deliveries', 4, 4)} AS avg_pct_late, {mean('avg_delivery_delta_days', 2)} AS avg_delivery_delta,
       {mean('avg_review_score', 2)} AS avg_review_score, {mean('customer_health_score', 2)} AS avg_health_score
FROM g_health {{group}}""", lambda t, by: measures.churn(health(t), by), "rfm_segment")

both("measures_urgency", "at_risk_customers:i avg_urgency_score:d", f"""
SELECT {{by}}count(*) AS at_risk_customers, {mean('urgency_score', 2)} AS avg_urgency_score FROM g_signals {{group}}""",
     lambda t, by: measures.urgency(signals(t), by))

both("measures_actions", "high_priority:i med_priority:i low_priority:i actionable_customers:i actionable_pct:d "
     "flagged_gmv:d retention_gmv:d reactivation_gmv:d retention_count:i reactivation_count:i monitor_count:i", f"""
SELECT {{by}}count(*) FILTER (WHERE latest_action_priority = 'HIGH') AS high_priority,
       count(*) FILTER (WHERE latest_action_priority = 'MED') AS med_priority,
       count(*) FILTER (WHERE latest_action_priority = 'LOW') AS low_priority,
       count(*) FILTER (WHERE latest_action_type <> 'MONITOR') AS actionable_customers,
       {ratio("count(*) FILTER (WHERE latest_action_type <> 'MONITOR')", 'count(*)', 4)} AS actionable_pct,
       coalesce(sum(total_gmv) FILTER (WHERE latest_action_type <> 'MONITOR'), 0) AS flagged_gmv,
       coalesce(sum(total_gmv) FILTER (WHERE latest_action_type = 'RETENTION_CAMPAIGN'), 0) AS retention_gmv,
       coalesce(sum(total_gmv) FILTER (WHERE latest_action_type = 'REACTIVATION'), 0) AS reactivation_gmv,
       count(*) FILTER (WHERE latest_action_type = 'RETENTION_CAMPAIGN') AS retention_count,
       count(*) FILTER (WHERE latest_action_type = 'REACTIVATION') AS reactivation_count,
       count(*) FILTER (WHERE latest_action_type = 'MONITOR') AS monitor_count
FROM g_health {{group}}""", lambda t, by: measures.actions(health(t), by))

both("measures_clv", "clv_with_prediction:i clv_coverage_pct:d avg_clv:d max_clv:d total_clv:d median_clv:d p90_clv:d", f"""
SELECT {{by}}count(clv_predicted_6m) AS clv_with_prediction, {ratio('count(clv_predicted_6m)', 'count(*)', 4)} AS clv_coverage_pct,
       {mean('clv_predicted_6m', 2)} AS avg_clv, max(clv_predicted_6m) AS max_clv, sum(clv_predicted_6m) AS total_clv,
       round(quantile_cont(CAST(clv_predicted_6m AS DOUBLE), 0.5), 4) AS median_clv,
       round(quantile_cont(CAST(clv_predicted_6m AS DOUBLE), 0.9), 4) AS p90_clv
FROM g_health {{group}}""", lambda t, by: measures.clv(health(t), by), "rfm_segment")

both("measures_sentiment", "reviews_scored:i reviews_with_text:i pct_positive:d pct_neutral:d pct_negative:d "
     "avg_compound_score:d sarcasm_flags:i", f"""
SELECT {{by}}count(compound_score) AS reviews_scored, count(review_comment_message) AS reviews_with_text,
       {", ".join(f'''{ratio(f"count(*) FILTER (WHERE sentiment_label = '{k}')", 'count(compound_score)', 4)} AS pct_{k}'''
                  for k in ('positive', 'neutral', 'negative'))},
       {mean('compound_score', 4, 4)} AS avg_compound_score,
       count(*) FILTER (WHERE review_score = 1 AND compound_score > 0.3) AS sarcasm_flags
FROM g_sent {{group}}""", lambda t, by: measures.sentiment(scored_reviews(t), by), "review_score")

both("measures_customer_sentiment", "customers_scored:i avg_sentiment:d", f"""
SELECT {{by}}count(avg_sentiment_score) AS customers_scored, {mean('avg_sentiment_score', 4, 4)} AS avg_sentiment
FROM g_health {{group}}""", lambda t, by: measures.customer_sentiment(health(t), by), "latest_action_type")

register("customer_sentiment_by_segment", "rfm_segment:s customers_scored:i avg_sentiment:d", f"""
SELECT rfm_segment, count(avg_sentiment_score) AS customers_scored, {mean('avg_sentiment_score', 4, 4)} AS avg_sentiment
FROM g_health GROUP BY 1""")(lambda t: measures.customer_sentiment(health(t), ("rfm_segment",)))

register("measures_geography", "customer_state:s total_gmv:d national_gmv:d state_gmv_share:d", f"""
SELECT customer_state, total_gmv, sum(total_gmv) OVER () AS national_gmv,
       {pct('total_gmv', 'sum(total_gmv) OVER ()', 4)} AS state_gmv_share FROM g_geo""")(lambda t: measures.geography(geo(t)))

register("measures_geography_averages", "avg_state_churn_rate:d avg_state_late_pct:d avg_state_review_score:d", f"""
SELECT {mean('churn_rate_pct', 2)} AS avg_state_churn_rate, {mean('pct_late_deliveries', 2)} AS avg_state_late_pct,
       {mean('avg_review_score', 2)} AS avg_state_review_score FROM g_geo""")(lambda t: measures.geography_averages(geo(t)))

both("measures_next_purchase", "with_prediction:i avg_next_purchase_days:d min_next_purchase_days:d", f"""
SELECT {{by}}count(expected_next_purchase_days) AS with_prediction, {mean('expected_next_purchase_days', 2)} AS avg_next_purchase_days,
       min(expected_next_purchase_days) AS min_next_purchase_days FROM g_health {{group}}""",
     lambda t, by: measures.next_purchase(health(t), by))

register("segment_share", "rfm_segment:s total_customers:i share_pct:d", f"""
SELECT rfm_segment, total_customers, {pct('total_customers', 'sum(total_customers) OVER ()')} AS share_pct
FROM (SELECT rfm_segment, count(*) AS total_customers FROM g_rfm GROUP BY 1)""")(
    lambda t: measures.group_share(health(t), "rfm_segment"))

register("dashboard_readiness", "status:s customers:i queue_rows:i null_clv:i null_sentiment:i", """
SELECT 'PASS' AS status, count(*) AS customers, (SELECT count(*) FROM g_queue) AS queue_rows,
       count(*) FILTER (WHERE clv_predicted_6m IS NULL) AS null_clv,
       count(*) FILTER (WHERE avg_sentiment_score IS NULL) AS null_sentiment FROM g_health""")(
    lambda t: measures.readiness(health(t), stored_marts(t).queue, geo(t)))

GROUPINGS = ((), ("customer_state",), ("rfm_segment",), ("customer_state", "rfm_segment"))

register("measures_all_groupings", "level:s customer_state:s rfm_segment:s total_customers:i total_gmv:d avg_order_value:d total_freight_paid:d "
         "freight_ratio:d avg_gmv_per_customer:d as_of_date:s churned_customers:i churn_rate:d avg_churn_probability:d "
         "high_churn_customers:i high_churn_rate:d avg_pct_late:d avg_delivery_delta:d avg_review_score:d avg_health_score:d "
         "high_priority:i med_priority:i low_priority:i actionable_customers:i actionable_pct:d flagged_gmv:d retention_gmv:d "
         "reactivation_gmv:d retention_count:i reactivation_count:i monitor_count:i clv_with_prediction:i clv_coverage_pct:d avg_clv:d "
         "max_clv:d total_clv:d median_clv:d p90_clv:d customers_scored:i avg_sentiment:d with_prediction:i avg_next_purchase_days:d "
         "min_next_purchase_days:d", f"""
SELECT CASE grouping(customer_state) * 2 + grouping(rfm_segment) WHEN 3 THEN 'all' WHEN 1 THEN 'customer_state' WHEN 2 THEN 'rfm_segment'
            ELSE 'customer_state,rfm_segment' END AS level, customer_state, rfm_segment,
       count(*) AS total_customers, sum(total_gmv) AS total_gmv, {mean('avg_order_value', 2)} AS avg_order_value,
       sum(total_freight_paid) AS total_freight_paid,
       coalesce({ratio(cents('sum(total_freight_paid)'), cents('sum(total_gmv)'), 4)}, 0) AS freight_ratio,
       {ratio(cents('sum(total_gmv)'), 'count(*) * 100', 2)} AS avg_gmv_per_customer, max(as_of_date) AS as_of_date,
       sum(is_churned) AS churned_customers, {ratio('sum(is_churned)', 'count(*)', 4)} AS churn_rate,
       {mean('churn_probability', 4, 4)} AS avg_churn_probability,
       count(*) FILTER (WHERE churn_probability >= 0.6) AS high_churn_customers,
       {ratio('count(*) FILTER (WHERE churn_probability >= 0.6)', 'count(*)', 4)} AS high_churn_rate,
       {mean('pct_late_deliveries', 4, 4)} AS avg_pct_late, {mean('avg_delivery_delta_days', 2)} AS avg_delivery_delta,
       {mean('avg_review_score', 2)} AS avg_review_score, {mean('customer_health_score', 2)} AS avg_health_score,
       count(*) FILTER (WHERE latest_action_priority = 'HIGH') AS high_priority,
       count(*) FILTER (WHERE latest_action_priority = 'MED') AS med_priority,
       count(*) FILTER (WHERE latest_action_priority = 'LOW') AS low_priority,
       count(*) FILTER (WHERE latest_action_type <> 'MONITOR') AS actionable_customers,
       {ratio("count(*) FILTER (WHERE latest_action_type <> 'MONITOR')", 'count(*)', 4)} AS actionable_pct,
       coalesce(sum(total_gmv) FILTER (WHERE latest_action_type <> 'MONITOR'), 0) AS flagged_gmv,
       coalesce(sum(total_gmv) FILTER (WHERE latest_action_type = 'RETENTION_CAMPAIGN'), 0) AS retention_gmv,
       coalesce(sum(total_gmv) FILTER (WHERE latest_action_type = 'REACTIVATION'), 0) AS reactivation_gmv,
       count(*) FILTER (WHERE latest_action_type = 'RETENTION_CAMPAIGN') AS retention_count,
       count(*) FILTER (WHERE latest_action_type = 'REACTIVATION') AS reactivation_count,
       count(*) FILTER (WHERE latest_action_type = 'MONITOR') AS monitor_count,
       count(clv_predicted_6m) AS clv_with_prediction, {ratio('count(clv_predicted_6m)', 'count(*)', 4)} AS clv_coverage_pct,
       {mean('clv_predicted_6m', 2)} AS avg_clv, max(clv_predicted_6m) AS max_clv, sum(clv_predicted_6m) AS total_clv,
       round(quantile_cont(CAST(clv_predicted_6m AS DOUBLE), 0.5), 4) AS median_clv,
       round(quantile_cont(CAST(clv_predicted_6m AS DOUBLE), 0.9), 4) AS p90_clv,
       count(avg_sentiment_score) AS customers_scored, {mean('avg_sentiment_score', 4, 4)} AS avg_sentiment,
       count(expected_next_purchase_days) AS with_prediction, {mean('expected_next_purchase_days', 2)} AS avg_next_purchase_days,
       min(expected_next_purchase_days) AS min_next_purchase_days
FROM g_health GROUP BY GROUPING SETS ((), (customer_state), (rfm_segment), (customer_state, rfm_segment))""")(
    lambda t: rollups.measures_by(health(t), GROUPINGS))
