"""Queries over the model inputs and the models."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import modelling, quantiles, survival
from ..oracle import cents, ratio
from ..plans import gold
from ..sources.sample_tables import ML_CUTOFF, SampleTables
from . import marts as m
from .registry import QUERIES, register
from .store import stored_marts

PRE = ("customer_unique_id:s total_orders_pre_cutoff:i total_gmv_pre_cutoff:d avg_order_value_pre_cutoff:d "
       "tenure_days_pre_cutoff:i days_since_last_order_pre_cutoff:i avg_delivery_delta:d pct_late:d "
       "total_categories_purchased:i tenure_months_pre_cutoff:d order_frequency_per_month_pre_cutoff:d")

PRE_SQL = f"""(SELECT customer_unique_id, n AS total_orders_pre_cutoff, coalesce(gmv, 0) AS total_gmv_pre_cutoff,
       {ratio(cents('coalesce(gmv, 0)'), 'n * 100', 2)} AS avg_order_value_pre_cutoff, tenure AS tenure_days_pre_cutoff,
       date_diff('day', last, DATE '2001-01-01') AS days_since_last_order_pre_cutoff, avg_delivery_delta, pct_late,
       coalesce(kinds, 0) AS total_categories_purchased, {ratio('tenure', '30', 4)} AS tenure_months_pre_cutoff,
       CASE WHEN tenure > 0 THEN {ratio('n * 30', 'tenure', 4)} END AS order_frequency_per_month_pre_cutoff
FROM (SELECT customer_unique_id, count(*) AS n, CAST(max(ts) AS DATE) AS last,
             date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) AS tenure,
             {ratio('sum(delta)', 'count(delta)', 2)} AS avg_delivery_delta, {ratio('sum(late)', 'count(*)', 4)} AS pct_late
      FROM (SELECT customer_unique_id, order_purchase_timestamp AS ts,
                   date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS delta,
                   CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late
            FROM s_orders WHERE order_purchase_timestamp < TIMESTAMP '2001-01-01') GROUP BY 1)
LEFT JOIN (SELECT customer_unique_id, sum(order_gmv) AS gmv FROM s_values
           WHERE order_purchase_timestamp < TIMESTAMP '2001-01-01' GROUP BY 1) USING (customer_unique_id)
LEFT JOIN (SELECT customer_unique_id, count(DISTINCT category) AS kinds FROM c_items JOIN s_orders USING (order_id)
           JOIN s_products USING (product_id) WHERE order_purchase_timestamp < TIMESTAMP '2001-01-01' GROUP BY 1)
  USING (customer_unique_id))"""


def pre_cutoff(t: SampleTables) -> DataFrame:
    return gold.pre_cutoff_features(m.known_orders(t), t.items, m.products_dim(t), ML_CUTOFF)


register("pre_cutoff_features", PRE, f"SELECT * FROM {PRE_SQL}")(pre_cutoff)

register("clv_training_frame", PRE + " customer_state:s preferred_payment_type:s actual_gmv_post_cutoff:d is_single_order:i "
         "repurchased:i", f"""
SELECT p.*, c.customer_state, c.preferred_payment_type, c.actual_gmv_post_cutoff,
       CASE WHEN total_orders_pre_cutoff = 1 THEN 1 ELSE 0 END AS is_single_order,
       CASE WHEN actual_gmv_post_cutoff > 0 THEN 1 ELSE 0 END AS repurchased
FROM {PRE_SQL} p JOIN g_clv c USING (customer_unique_id)""".replace("total_categories_purchased, customer", "customer"))(
    lambda t: gold.clv_training_frame(pre_cutoff(t), stored_marts(t).clv))

register("churn_training_frame", "customer_unique_id:s customer_state:s is_churned:i total_orders:i total_gmv:d "
         "avg_sentiment_score:d total_categories_purchased:i preferred_payment_type:s", "SELECT * FROM g_health")(
    lambda t: gold.churn_training_frame(stored_marts(t).profile, stored_marts(t).clv))

register("purchase_intervals", "customer_unique_id:s duration:i event:i", """
SELECT customer_unique_id, duration, event FROM (
  SELECT customer_unique_id, CAST(floor(epoch(coalesce(nxt, CAST(as_of_date AS TIMESTAMP)) - ts) / 86400) AS BIGINT) AS duration,
         CASE WHEN nxt IS NULL THEN 0 ELSE 1 END AS event
  FROM (SELECT customer_unique_id, order_purchase_timestamp AS ts, count(*) OVER (PARTITION BY customer_unique_id) AS n,
               lead(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp) AS nxt
        FROM s_orders) CROSS JOIN g_const WHERE n >= 2) WHERE duration > 0""")(
    lambda t: survival.purchase_intervals(m.known_orders(t), gold.run_constants(t.orders, ML_CUTOFF)))

register("stratified_holdout", "is_churned:i customers:i holdout:i", """
SELECT is_churned, count(*) AS customers, count(*) * 20 // 100 AS holdout FROM g_base GROUP BY 1""")(
    lambda t: modelling.with_stratified_holdout(stored_marts(t).profile.select(m.PERSON, "is_churned"), "is_churned")
    .groupBy("is_churned").agg(F.count(F.lit(1)).alias("customers"), F.sum("is_holdout").alias("holdout")))

register("score_cells", "recency_score:i frequency_score:i monetary_score:i weight:d z_recency_score:d z_frequency_score:d "
         "z_monetary_score:d", "SELECT recency_score, frequency_score, monetary_score, count(*) AS weight, "
         + ", ".join(f"round((any_value({c}) - any_value(m_{c})) / any_value(d_{c}), 6) AS z_{c}" for c in modelling.SCORES)
         + " FROM (SELECT *, " + ", ".join(
             f"avg({c}) OVER () AS m_{c}, stddev_pop({c}) OVER () AS d_{c}" for c in modelling.SCORES)
         + " FROM g_rfm) GROUP BY 1, 2, 3")(
    lambda t: modelling.score_cells(stored_marts(t).rfm).withColumns(
        {f"z_{c}": F.round(f"z_{c}", 6) for c in modelling.SCORES}))

CURVE_SQL = """(SELECT threshold, pos, n, sum(pos) OVER w AS tp, sum(n) OVER w AS flagged, sum(pos) OVER () AS positives,
       sum(n) OVER () AS total
FROM (SELECT churn_probability AS threshold, sum(is_churned) AS pos, count(*) AS n FROM g_scored
      WHERE churn_probability IS NOT NULL GROUP BY 1) WINDOW w AS (ORDER BY threshold DESC))"""


def stand_in_curve(t: SampleTables) -> DataFrame:
    known = stored_marts(t).profile.where(F.col("churn_probability").isNotNull()).select(
        F.col("churn_probability").cast("double").alias("probability"), F.col("is_churned").alias("label"))
    return modelling.threshold_curve(known)


register("threshold_curve", "threshold:d tp:i flagged:i precision:d recall:d f1:d", f"""
SELECT threshold, tp, flagged, round(CAST(tp AS DOUBLE) / flagged, 9) AS precision, round(CAST(tp AS DOUBLE) / positives, 9) AS recall,
       round(2.0 * CAST(tp AS DOUBLE) / (flagged + positives), 9) AS f1 FROM {CURVE_SQL}""")(
    lambda t: stand_in_curve(t).withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")}))

register("threshold_metrics", "threshold:d f1:d tp:i fp:i fn:i tn:i roc_auc:d", f"""
SELECT threshold, round(2.0 * CAST(tp AS DOUBLE) / (flagged + positives), 9) AS f1, tp, flagged - tp AS fp, positives - tp AS fn,
       total - positives - flagged + tp AS tn,
       (SELECT round(sum((n - pos) * (tp - pos + pos / 2.0)) / (max(positives) * (max(total) - max(positives))), 9) FROM {CURVE_SQL})
         AS roc_auc
FROM {CURVE_SQL} ORDER BY CAST(tp AS DOUBLE) / (flagged + positives) DESC, threshold LIMIT 1""")(
    lambda t: modelling.threshold_metrics(stand_in_curve(t)).withColumns({c: F.round(c, 9) for c in ("f1", "roc_auc")}))


# -- what follows a fit, on given predictions ---------------------------------------

def predicted_values(t: SampleTables) -> DataFrame:
    """Stand-in predictions with the values they stand for."""
    clv = stored_marts(t).clv.where(F.col("clv_predicted_6m").isNotNull())
    number = lambda c: F.col(c).cast("double")
    return clv.select(m.PERSON, number("clv_predicted_6m").alias("prediction"), number("actual_gmv_post_cutoff").alias("label"),
                      number("clv_ci_lower").alias("q_lower"), (number("clv_ci_upper") - 5).alias("q_upper"))


GIVEN = """(SELECT CAST(clv_predicted_6m AS DOUBLE) AS p, CAST(actual_gmv_post_cutoff AS DOUBLE) AS y, CAST(clv_ci_lower AS DOUBLE) AS lo,
       CAST(clv_ci_upper AS DOUBLE) - 5 AS hi FROM g_health WHERE clv_predicted_6m IS NOT NULL)"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


register("regression_metrics", "n:i mae:d rmse:d r2:d mean_actual:d mean_predicted:d", f"""
SELECT count(*) AS n, round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse,
       round(1 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2, round(avg(y), 6) AS mean_actual, round(avg(p), 6) AS mean_predicted FROM {GIVEN}""")(
    lambda t: rounded(modelling.regression_metrics(predicted_values(t))))

register("quantile_band_metrics", "coverage:d loss_lower:d loss_upper:d mean_width:d crossed:i", f"""
SELECT round(avg(CASE WHEN y BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END), 6) AS coverage,
       round(avg(greatest(0.1 * (y - lo), -0.9 * (y - lo))), 6) AS loss_lower, round(avg(greatest(0.9 * (y - hi), -0.1 * (y - hi))), 6) AS loss_upper,
       round(avg(greatest(hi, p) - least(lo, p)), 6) AS mean_width, count(*) FILTER (WHERE lo > p OR hi < p) AS crossed FROM {GIVEN}""")(
    lambda t: rounded(quantiles.band_metrics(quantiles.bounded(predicted_values(t)))))


@register("residual_quantiles", "bin:i low:d high:d", f"""
SELECT bin, round(quantile_cont(y - p, 0.1), 6) AS low, round(quantile_cont(y - p, 0.9), 6) AS high
FROM (SELECT p, y, (SELECT count(DISTINCT q) FROM (SELECT unnest(quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS q FROM {GIVEN})
                    WHERE g.p > q) AS bin
      FROM {GIVEN} g) GROUP BY bin""")
def residual_quantiles(t: SampleTables) -> DataFrame:
    """Per decile of the prediction, what is added to it for the conformal interval."""
    band = modelling.fit_band(predicted_values(t))
    return t.spark.createDataFrame([(b, float(low), float(high)) for b, (low, high) in band.offsets.items()], "bin int, low double, high double").select(
        "bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@register("leaf_quantiles", "recency_score:i low:d high:d", """
SELECT recency_score, min(total_gmv) FILTER (WHERE rn >= ceil(0.1 * n)) AS low, min(total_gmv) FILTER (WHERE rn >= ceil(0.9 * n)) AS high
FROM (SELECT recency_score, total_gmv, row_number() OVER (PARTITION BY recency_score ORDER BY total_gmv) AS rn,
             count(*) OVER (PARTITION BY recency_score) AS n FROM g_rfm JOIN g_360 USING (customer_unique_id)) GROUP BY 1""")
def leaf_quantiles(t: SampleTables) -> DataFrame:
    """The order statistics that a round of quantile boosting puts into its leaves, here of five groups."""
    rows = stored_marts(t).rfm.select("recency_score", F.col("monetary").cast("double").alias("value"))
    low, high = (quantiles.order_statistics(rows, "recency_score", "value", share) for share in (0.1, 0.9))
    return t.spark.createDataFrame([(g, low[g], high[g]) for g in low], "recency_score int, low double, high double")


CLV_MEDIANS = [c for c in modelling.CLV_NUMERIC if c not in modelling.CLV_ZERO_FILL]

register("design_medians", "column_name:s median:d", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median FROM f" for c in CLV_MEDIANS).join(
    ("SELECT * FROM (WITH f AS (SELECT *, CASE WHEN total_orders_pre_cutoff = 1 THEN 1 ELSE 0 END AS is_single_order "
     f"FROM {PRE_SQL}) ", ")")))(
    lambda t: modelling.medians(gold.clv_training_frame(pre_cutoff(t), stored_marts(t).clv), CLV_MEDIANS)
    .select(F.col("column").alias("column_name"), F.round("median", 6).alias("median")))

SHAPE = 1.3
register("remaining_medians", "customer_unique_id:s days:d", f"""
SELECT customer_unique_id, round(greatest(s * pow(pow(w / s, {SHAPE}) + 0.6931471805599453, 1.0 / {SHAPE}) - w, 0), 4) AS days
FROM (SELECT customer_unique_id, CAST(days_since_last_order AS DOUBLE) AS w, 30.0 + 10 * total_orders AS s FROM g_360)""")(
    lambda t: stored_marts(t).profile.select(m.PERSON, F.round(survival.remaining_median(
        F.lit(30.0) + F.col("total_orders") * 10, SHAPE, F.col("days_since_last_order").cast("double")), 4).alias("days")))

INTERVALS = QUERIES["purchase_intervals"].sql


def given_intervals(t: SampleTables) -> DataFrame:
    """Intervals with one covariate, the customer's orders."""
    return survival.purchase_intervals(m.known_orders(t), gold.run_constants(t.orders, ML_CUTOFF)).join(
        stored_marts(t).profile.select(m.PERSON, "total_orders"), m.PERSON)


register("concordance_of_given", "concordance:d comparable_pairs:i", f"""
SELECT round(sum(CASE WHEN b.p > a.p THEN b.n WHEN b.p = a.p THEN b.n / 2.0 ELSE 0 END * a.n) / sum(a.n * b.n), 9) AS concordance,
       CAST(sum(a.n * b.n) AS BIGINT) AS comparable_pairs
FROM (SELECT duration AS d, event AS e, total_orders % 9 AS p, count(*) AS n FROM ({INTERVALS}) i JOIN g_360 USING (customer_unique_id) GROUP BY ALL) a
JOIN (SELECT duration AS d, event AS e, total_orders % 9 AS p, count(*) AS n FROM ({INTERVALS}) i JOIN g_360 USING (customer_unique_id) GROUP BY ALL) b
  ON a.e = 1 AND (b.d > a.d OR (b.d = a.d AND b.e = 0))""")(
    lambda t: rounded(survival.concordance(given_intervals(t).withColumn("prediction", F.col("total_orders") % 9)), 9))

# coefficient, intercept and log shape at which the sums of a Newton step are taken
AT = (0.02, 4.0, 0.1)
_SUMS = {"likelihood": "e * (0.1 - ln(d) + w) - h", "by_coefficient": "x * k * (h - e)", "by_intercept": "k * (h - e)", "by_shape": "e * (1 + w) - w * h",
         "coefficient_coefficient": "-x * x * k * k * h", "coefficient_intercept": "-x * k * k * h", "coefficient_shape": "x * (k * (h - e) + k * w * h)",
         "intercept_intercept": "-k * k * h", "intercept_shape": "k * (h - e) + k * w * h", "shape_shape": "w * (e - h) - w * w * h"}


@register("survival_step_sums", "name:s value:d", " UNION ALL ".join(
    f"SELECT '{n}' AS name, round(sum({f}), 3) AS value FROM s" for n, f in _SUMS.items()).join((f"""
SELECT * FROM (WITH s AS (SELECT *, exp(w) AS h FROM (
  SELECT *, exp(0.1) AS k, exp(0.1) * (ln(d) - 0.02 * x - 4.0) AS w FROM (
    SELECT CAST(duration AS DOUBLE) AS d, CAST(event AS DOUBLE) AS e, CAST(total_orders AS DOUBLE) AS x
    FROM ({INTERVALS}) i JOIN g_360 USING (customer_unique_id)))) """, ")")))
def survival_step_sums(t: SampleTables) -> DataFrame:
    """Log-likelihood, gradient and Hessian of the survival model at given parameters."""
    rows = VectorAssembler(inputCols=["total_orders"], outputCol="features").transform(given_intervals(t)).select(
        vector_to_array("features").alias("x"), F.col("duration").cast("double"), F.col("event").cast("double"))
    total, slope, bend = survival.likelihood_sums(rows, np.ones(1), np.array(AT[:1]), *AT[1:])
    values = [total, *slope, *bend[np.triu_indices(3)]]
    return t.spark.createDataFrame([(n, round(float(v), 3)) for n, v in zip(_SUMS, values, strict=True)], "name string, value double")


# -- clusters: no SQL counterpart -----------------------------------------------------

register("segment_clusters", "customer_unique_id:s rfm_segment:s km_cluster:i")(
    lambda t: modelling.segment_clusters(stored_marts(t).rfm.drop("km_cluster")))

register("cluster_search", "k:i inertia:d silhouette:d")(
    lambda t: modelling.cluster_search(modelling.score_cells(stored_marts(t).rfm)))
