"""The whole run: raw tables to silver from two customer snapshots, marts from current versions, text scores, models, actions.

Each step is stored for the state of the input files; the next one reads what it stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import report
from ..operators.sentiment import customer_sentiment
from ..oracle import mean
from ..plans import gold, scoring, silver
from ..plans.runs import reused
from ..sources.files import row_counts, write_back
from ..sources.sample_tables import FIRST_RUN, ML_CUTOFF, SECOND_RUN, SampleTables
from .checks import CHECK, check_sql
from .marts import PERSON, PROFILE
from .registry import QUERIES, register
from .store import RUN_TIME, inputs_key, scored_dimension

#: boosting rounds of the point models, and rounds and step of the two quantile models
ROUNDS = 200
BAND = {"rounds": 24, "step": 0.25}


def silver_tables(t: SampleTables) -> dict[str, DataFrame]:
    """The stored tables; titles and texts of ``dim_review`` are in ``review_texts``, in as many files as reviews are dealt to tasks."""
    def build(keep) -> silver.Silver:
        raw = silver.Raw(t.moved_customers, t.sellers, t.products, t.orders, t.numbered_items, t.payments, t.dealt_reviews, t.category_translation)
        return silver.build_silver(raw, silver.load_customers(None, t.customers, FIRST_RUN), SECOND_RUN, keep)

    return reused(t.spark, "silver", inputs_key(t), build, in_turn=True)


def chain_facts(t: SampleTables) -> gold.Facts:
    s = silver_tables(t)
    orders = s["fact_orders"]
    return gold.Facts(s["dim_customer"].where(F.col("is_current") == 1), orders, gold.order_values(s["fact_order_items"], orders),
                      silver.marked_reviews(s["dim_review"]), orders)


def gold_tables(t: SampleTables) -> dict[str, DataFrame]:
    """The marts, with the scores of the review texts."""
    def build() -> dict[str, DataFrame]:
        s = silver_tables(t)
        made = gold.build_gold(chain_facts(t), s["fact_order_items"], s["dim_product"], ML_CUTOFF)
        reviews = scored_dimension(t, s["dim_review"], s["review_texts"])
        return {"customer_360": write_back(made.customer_360, customer_sentiment(reviews), PERSON), "rfm_features": made.rfm_features,
                "clv_features": made.clv_features, "sentiment_scores": reviews, "run_constants": made.run_constants}

    return reused(t.spark, "gold", inputs_key(t), build)


def scored_tables(t: SampleTables) -> dict[str, DataFrame]:
    """Everything the models add, with what they say of themselves, and the actions."""
    def build() -> dict[str, DataFrame]:
        s = silver_tables(t)
        return scoring.score_all(gold.Gold(**gold_tables(t)), chain_facts(t), s["fact_order_items"], s["dim_product"], None, ML_CUTOFF,
                                 created_at=RUN_TIME, band_settings=BAND, maxIter=ROUNDS)

    return reused(t.spark, "scored", inputs_key(t), build)


register("silver_row_counts", "table_name:s row_count:i", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in (
        ("dim_customer", "s_versions"), ("dim_product", "c_products"), ("dim_seller", "c_sellers"), ("dim_review", "s_reviews"),
        ("fact_orders", "s_orders"), ("fact_order_items", "c_items JOIN s_orders USING (order_id)"))))(
    lambda t: row_counts({name: table for name, table in silver_tables(t).items() if name != "review_texts"}))

# an order carries only the key of the version in force; the version itself is looked up by it
register("silver_orders", QUERIES["fact_orders"].columns, QUERIES["fact_orders"].sql)(
    lambda t: silver_tables(t)["fact_orders"].join(
        silver_tables(t)["dim_customer"].select("customer_sk", "customer_state", "valid_from"), "customer_sk"))

register("silver_items", QUERIES["fact_order_items"].columns, QUERIES["fact_order_items"].sql)(
    lambda t: silver_tables(t)["fact_order_items"].withColumn("product_known", F.col("product_sk").isNotNull().cast("int"))
    .withColumn("seller_known", F.col("seller_sk").isNotNull().cast("int")))

register("gold_profile", PROFILE + " avg_sentiment_score:d", f"""
SELECT p.* REPLACE (m.customer_state AS customer_state), s.avg_sentiment_score
FROM g_360 p JOIN c_moved_customers m USING (customer_unique_id)
LEFT JOIN (SELECT customer_unique_id, {mean('compound_score', 4, 4)} AS avg_sentiment_score FROM g_sent WHERE compound_score IS NOT NULL
           GROUP BY 1) s USING (customer_unique_id)""")(lambda t: gold_tables(t)["customer_360"])

register("gold_clv_features", QUERIES["clv_features"].columns, """
SELECT c.* REPLACE (m.customer_state AS customer_state) FROM g_clv c JOIN c_moved_customers m USING (customer_unique_id)""")(
    lambda t: gold_tables(t)["clv_features"])

register("gold_rfm_features", QUERIES["rfm_features"].columns.replace(" rfm_segment:s", ""), "SELECT * FROM g_rfm")(
    lambda t: gold_tables(t)["rfm_features"])


@register("chain_checks", CHECK, check_sql("""
SELECT count(*) AS customers, 0 AS without_churn, 0 AS churn_out_of_range, 0 AS values_out_of_order, 0 AS without_segment, 0 AS without_cluster,
       count(*) AS queue_rows, 0 AS unknown_actions, (SELECT count(*) FROM s_reviews) AS review_rows,
       (SELECT count(compound_score) FROM g_sent) AS scored_reviews,
       (SELECT count(DISTINCT customer_unique_id) FROM g_sent WHERE compound_score IS NOT NULL) AS customers_with_sentiment
FROM g_360""", customers="INFO", without_churn="without_churn = 0", churn_out_of_range="churn_out_of_range = 0", values_out_of_order="values_out_of_order = 0",
                                           without_segment="without_segment = 0", without_cluster="without_cluster = 0", queue_rows="INFO",
                                           unknown_actions="unknown_actions = 0", review_rows="INFO", scored_reviews="INFO",
                                           customers_with_sentiment="INFO"))
def chain_checks(t: SampleTables) -> DataFrame:
    """What must hold of the scored tables whatever the models found."""
    s = scored_tables(t)
    profile, clv, rfm, queue, reviews = (s[n] for n in ("customer_360", "clv_features", "rfm_features", "action_queue", "sentiment_scores"))
    ordered = (F.col("clv_ci_lower") <= F.col("clv_predicted_6m")) & (F.col("clv_predicted_6m") <= F.col("clv_ci_upper")) & (F.col("clv_ci_lower") >= 0)
    known = F.col("action_type").isin("RETENTION_CAMPAIGN", "REACTIVATION", "VIP_UPGRADE", "MONITOR")
    one = (profile.agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("churn_probability").isNull()).alias("without_churn"),
                       F.count_if(~F.col("churn_probability").between(0, 1)).alias("churn_out_of_range"),
                       F.count("avg_sentiment_score").alias("customers_with_sentiment"))
           .crossJoin(clv.agg(F.count_if(F.col("clv_predicted_6m").isNotNull() & ~F.coalesce(ordered, F.lit(False))).alias("values_out_of_order")))
           .crossJoin(rfm.agg(F.count_if(F.col("rfm_segment").isNull()).alias("without_segment"), F.count_if(F.col("km_cluster").isNull()).alias("without_cluster")))
           .crossJoin(queue.agg(F.count(F.lit(1)).alias("queue_rows"), F.count_if(~known).alias("unknown_actions")))
           .crossJoin(reviews.agg(F.count(F.lit(1)).alias("review_rows"), F.count("compound_score").alias("scored_reviews"))))
    wanted = ("without_churn", "churn_out_of_range", "values_out_of_order", "without_segment", "without_cluster", "unknown_actions")
    return report(one, {n: F.col(n) == 0 if n in wanted else None for n in (
        "customers", *wanted[:5], "queue_rows", "unknown_actions", "review_rows", "scored_reviews", "customers_with_sentiment")})


# -- what the fitted models give: no SQL counterpart ----------------------------------

register("clv_predictions", "customer_unique_id:s clv_predicted_6m:d clv_ci_lower:d clv_ci_upper:d")(
    lambda t: scored_tables(t)["clv_features"].where(F.col("clv_predicted_6m").isNotNull()))

register("clv_metrics", "n:i mae:d rmse:d r2:d mean_actual:d mean_predicted:d coverage:d")(lambda t: scored_tables(t)["value_metrics"])

register("churn_predictions", "customer_unique_id:s churn_probability:d")(
    lambda t: scored_tables(t)["customer_360"].where(F.col("churn_probability").isNotNull()))

register("churn_metrics", "threshold:d f1:d precision:d recall:d roc_auc:d tp:i fp:i fn:i tn:i")(lambda t: scored_tables(t)["churn_metrics"])

register("churn_importances", "feature:s importance:d")(lambda t: scored_tables(t)["churn_importances"])

register("next_purchase", "customer_unique_id:s expected_next_purchase_days:d")(lambda t: scored_tables(t)["next_purchase"])

register("survival_concordance", "concordance:d comparable_pairs:i")(lambda t: scored_tables(t)["survival_concordance"])
