"""The composed jobs from raw tables to actions, end to end at sf0.001."""

from patronage.operators.actions import ACTION_TYPES
from patronage.plans import gold, scoring, silver
from patronage.sources.sample_tables import FIRST_RUN, ML_CUTOFF, SECOND_RUN

PERSON = "customer_unique_id"


def raw(sample, customers):
    return silver.Raw(customers, sample.sellers, sample.products, sample.orders, sample.numbered_items, sample.payments,
                      sample.reviews, sample.category_translation)


def test_raw_to_actions(spark, sample):
    first = silver.build_silver(raw(sample, sample.customers), None, FIRST_RUN)
    second = silver.build_silver(raw(sample, sample.moved_customers), first.dim_customer, SECOND_RUN)
    people = sample.customers.count()
    moved = sample.customers.where("cast(customer_id as int) % 10 = 0").count()
    assert second.dim_customer.count() == people + moved
    assert second.fact_orders.count() == sample.orders.count()
    assert second.fact_order_items.select("item_sk").distinct().count() == sample.items.count()
    assert silver.unresolved_orders(sample.orders, second.fact_orders).count() == 0

    current = second.dim_customer.where("is_current = 1")
    facts = gold.Facts(current, second.fact_orders, gold.order_values(sample.items, second.fact_orders), second.dim_review,
                       second.fact_orders)
    marts = gold.build_gold(facts, sample.items, second.dim_product, ML_CUTOFF)
    active = second.fact_orders.select(PERSON).distinct().count()
    assert marts.customer_360.count() == marts.rfm_features.count() == marts.clv_features.count() == active

    scored = scoring.score_all(marts, facts, sample.items, second.dim_product, sample.lexicon, ML_CUTOFF, forced_k=3,
                               created_at="2001-08-02 00:00:00", maxIter=2)
    assert scored["customer_360"].where("churn_probability is null or churn_probability not between 0 and 1").count() == 0
    assert scored["clv_features"].where("clv_ci_lower > clv_predicted_6m or clv_ci_upper < clv_predicted_6m").count() == 0
    assert scored["rfm_features"].where("km_cluster is null or rfm_segment is null").count() == 0
    with_text = scored["sentiment_scores"].where("review_comment_message is not null")
    assert with_text.count() > 0 and with_text.where("compound_score is null").count() == 0
    queue = scored["action_queue"]
    assert queue.count() == active and {r[0] for r in queue.select("action_type").distinct().collect()} <= set(ACTION_TYPES)
