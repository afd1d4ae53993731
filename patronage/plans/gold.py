"""Customer marts: profile with health score, RFM scores, lifetime-value features."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators.ranking import Order, bounded_median, global_positions, ntile
from ..session import materialize

PERSON = "customer_unique_id"
DAYS_PER_MONTH = 30


@dataclass(frozen=True)
class Facts:
    """What the marts read. ``order_values`` is one row per order: GMV and freight."""

    customers: DataFrame
    orders: DataFrame
    order_values: DataFrame
    reviews: DataFrame
    payments: DataFrame


def run_constants(orders: DataFrame, ml_cutoff: str, churn_window: int = fx.CHURN_WINDOW_DAYS) -> DataFrame:
    """One row: the date of the last purchase and the constants of the run."""
    return orders.where(F.col("order_purchase_timestamp").isNotNull()).agg(
        F.to_date(F.max("order_purchase_timestamp")).alias("as_of_date")).select(
        F.lit(1).alias("refresh_id"), "as_of_date", F.lit(ml_cutoff).cast("date").alias("ml_cutoff_date"),
        F.lit(churn_window).alias("churn_window_days"))


def order_values(items: DataFrame, orders: DataFrame) -> DataFrame:
    """GMV and freight per order. Lines are summed before the join, so both join sides are unique."""
    sums = items.groupBy("order_id").agg(
        F.sum(fx.item_gmv()).cast("decimal(14,2)").alias("order_gmv"),
        F.sum("freight_value").cast("decimal(14,2)").alias("order_freight"))
    return sums.join(orders.select("order_id", PERSON, "order_purchase_timestamp"), "order_id")


def customer_orders(orders: DataFrame) -> DataFrame:
    """Order counts, dates and delivery behaviour per customer; orders are unique by id."""
    purchased = F.to_date("order_purchase_timestamp")
    delta = fx.delivery_delta_days()
    return orders.groupBy(PERSON).agg(
        F.count("order_id").alias("total_orders"),
        F.min(purchased).alias("first_order_date"),
        F.max(purchased).alias("last_order_date"),
        fx.ratio(F.sum(delta), F.count(delta), 2, 8).alias("avg_delivery_delta_days"),
        fx.ratio(F.sum(fx.is_late()), F.count(F.lit(1)), 4, 6).alias("pct_late_deliveries"),
    )


def customer_values(values: DataFrame) -> DataFrame:
    return values.groupBy(PERSON).agg(
        F.sum("order_gmv").cast("decimal(14,2)").alias("total_gmv"),
        F.sum("order_freight").cast("decimal(14,2)").alias("total_freight_paid"))


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id", PERSON).agg(
        fx.ratio(F.sum("review_score"), F.count("review_score"), 6, 8).alias("order_avg_review_score"))


def customer_reviews(reviews: DataFrame) -> DataFrame:
    """Review averages per order first, so an order with two reviews counts once."""
    score = F.col("order_avg_review_score")
    # the sum is exact in millionths; dividing it as an integer keeps six digits
    mean = (F.sum(score).cast("decimal(20,6)") / F.count(score).cast("decimal(12,0)")).cast("decimal(8,6)")
    return reviews_per_order(reviews).groupBy(PERSON).agg(
        mean.alias("review_mean"),
        fx.ratio(F.count_if(score <= 2), F.count(score), 4, 6).alias("pct_negative_reviews"))


def customer_base(facts: Facts, constants: DataFrame) -> DataFrame:
    """Everything about a customer that needs no comparison with others, stored as one table."""
    people = facts.customers.select(PERSON, "customer_state", "customer_city")
    base = (people.join(customer_orders(facts.orders), PERSON)
            .join(customer_values(facts.order_values), PERSON, "left")
            .join(customer_reviews(facts.reviews), PERSON, "left")
            .crossJoin(F.broadcast(constants.select("as_of_date", "churn_window_days"))))
    gmv = F.coalesce("total_gmv", F.lit(0)).cast("decimal(14,2)")
    freight = F.coalesce("total_freight_paid", F.lit(0)).cast("decimal(14,2)")
    idle = fx.day_diff("last_order_date", "as_of_date")
    return materialize(base.select(
        PERSON, "customer_state", "customer_city", "total_orders",
        gmv.alias("total_gmv"),
        freight.alias("total_freight_paid"),
        fx.ratio(gmv, F.col("total_orders"), 2, 12).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        fx.day_diff("first_order_date", "last_order_date").alias("tenure_days"),
        idle.alias("days_since_last_order"),
        "review_mean",
        F.col("review_mean").cast("decimal(4,2)").alias("avg_review_score"),
        "pct_negative_reviews", "avg_delivery_delta_days", "pct_late_deliveries",
        fx.is_churned(idle, F.col("churn_window_days")).alias("is_churned"),
    ), "customer-base")


def with_positions(base: DataFrame) -> DataFrame:
    """Add every customer's place by recency, frequency, value and satisfaction, in one sort pass."""
    # review means lie in 1..5 with six digits
    median = bounded_median(base, "review_mean")
    rated = base.crossJoin(F.broadcast(median)).withColumn(
        "satisfaction", F.coalesce("review_mean", F.col("median").cast("decimal(4,2)")))
    places = global_positions(rated, [PERSON], {
        "recency": Order(F.col("days_since_last_order"), ascending=False),
        "frequency": Order(F.col("total_orders")),
        "monetary": Order(F.col("total_gmv")),
        "satisfaction": Order(F.col("satisfaction")),
    })
    return base.join(places, PERSON)


def health_score() -> Column:
    """100 * (0.4 recency + 0.4 value + 0.2 satisfaction) of the percent ranks, one decimal, in exact arithmetic."""
    weighted = ((F.col("recency_rank") - 1) * 4 + (F.col("monetary_rank") - 1) * 4 + (F.col("satisfaction_rank") - 1) * 2)
    return F.coalesce(fx.ratio(weighted * 10, F.col("recency_total") - 1, 1, 6), F.lit(0)).cast("decimal(6,2)")


def customer_360(placed: DataFrame) -> DataFrame:
    """One row per customer: profile, behaviour, churn flag and health score. Takes ``with_positions`` rows."""
    score = health_score()
    return placed.select(
        PERSON, "customer_state", "customer_city", "total_orders", "total_gmv", "avg_order_value",
        "total_freight_paid", "first_order_date", "last_order_date", "tenure_days", "days_since_last_order",
        "avg_review_score", "pct_negative_reviews", "avg_delivery_delta_days", "pct_late_deliveries", "is_churned",
        score.alias("customer_health_score"), fx.health_tier(score).alias("health_tier"))


def rfm_features(placed: DataFrame, score_direction: str = "documented") -> DataFrame:
    """Quintile scores, 5 is best. ``as_coded`` gives the highest spenders and most frequent buyers a 1 instead."""
    if score_direction not in ("documented", "as_coded"):
        raise ValueError(f"unknown score direction: {score_direction}")

    def quintile(name: str) -> Column:
        return ntile(name, 5) if score_direction == "documented" else ntile_descending(name, 5)

    scored = placed.select(
        PERSON, F.col("days_since_last_order").alias("recency_days"), F.col("total_orders").alias("frequency"),
        F.col("total_gmv").alias("monetary"), ntile("recency", 5).alias("recency_score"),
        quintile("frequency").alias("frequency_score"), quintile("monetary").alias("monetary_score"))
    return scored.withColumn("rfm_score", fx.rfm_code())


def ntile_descending(name: str, buckets: int) -> Column:
    """NTILE over the reverse order, from the place in the forward order."""
    row, total = F.col(f"{name}_total") - F.col(f"{name}_row") + 1, F.col(f"{name}_total")
    extra, small = total % buckets, F.floor(total / buckets)
    wide = extra * (small + 1)
    return (F.when(row <= wide, F.ceil(row / (small + 1)))
            .otherwise(extra + F.ceil((row - wide) / F.nullif(small, F.lit(0))))).cast("int")


def category_diversity(items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct categories per customer. Lines shrink to (order, category) where they meet the products, before the orders."""
    named = items.select("order_id", "product_id").join(
        products.select("product_id", "product_category_name_english"), "product_id", "left")
    kinds = named.where(F.col("product_category_name_english").isNotNull()).select(
        "order_id", "product_category_name_english").distinct()
    return (kinds.join(orders.select("order_id", PERSON), "order_id")
            .groupBy(PERSON).agg(F.count_distinct("product_category_name_english").alias("total_categories_purchased")))


def preferred_payment(order_payments: DataFrame) -> DataFrame:
    """Most used main payment type per customer; ties by value, then by name."""
    kinds = order_payments.where(F.col("payment_type_primary").isNotNull()).groupBy(PERSON, "payment_type_primary").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("total_payment_value", F.lit(0))).alias("value"))
    return kinds.groupBy(PERSON).agg(F.min_by(
        "payment_type_primary", F.struct(-F.col("n"), -F.col("value"), "payment_type_primary"))
        .alias("preferred_payment_type"))


def value_after(values: DataFrame, cutoff: str) -> DataFrame:
    return (values.where(F.col("order_purchase_timestamp") >= F.lit(cutoff).cast("timestamp_ntz"))
            .groupBy(PERSON).agg(F.sum("order_gmv").cast("decimal(14,2)").alias("actual_gmv_post_cutoff")))


def clv_features(profile: DataFrame, diversity: DataFrame, payment: DataFrame, after_cutoff: DataFrame) -> DataFrame:
    """Lifetime-value inputs and the target; frequency is NULL for single-day customers."""
    months = F.col("tenure_days").cast("decimal(12,0)") / F.lit(DAYS_PER_MONTH).cast("decimal(2,0)")
    per_month = (F.col("total_orders").cast("decimal(12,0)") * DAYS_PER_MONTH
                 / F.nullif(F.col("tenure_days").cast("decimal(12,0)"), F.lit(0).cast("decimal(12,0)")))
    joined = (profile.join(diversity, PERSON, "left").join(payment, PERSON, "left")
              .join(after_cutoff, PERSON, "left"))
    return joined.select(
        PERSON, "avg_order_value",
        F.when(F.col("tenure_days") > 0, per_month).cast("decimal(10,4)").alias("order_frequency_per_month"),
        months.cast("decimal(10,2)").alias("tenure_months"),
        F.coalesce("total_categories_purchased", F.lit(0)).alias("total_categories_purchased"),
        "avg_review_score",
        F.col("avg_delivery_delta_days").alias("avg_delivery_delta"),
        F.col("pct_late_deliveries").alias("pct_late"),
        "customer_state", "days_since_last_order", "preferred_payment_type",
        F.coalesce("actual_gmv_post_cutoff", F.lit(0)).cast("decimal(14,2)").alias("actual_gmv_post_cutoff"))


def pre_cutoff_features(orders: DataFrame, items: DataFrame, products: DataFrame, cutoff: str) -> DataFrame:
    """Customer features from orders strictly before the cutoff, so nothing of the target leaks in."""
    earlier = orders.where(F.col("order_purchase_timestamp") < F.lit(cutoff).cast("timestamp_ntz"))
    people = customer_orders(earlier)
    values = customer_values(order_values(items, earlier)).select(PERSON, "total_gmv")
    joined = (people.join(values, PERSON, "left")
              .join(category_diversity(items, products, earlier), PERSON, "left"))
    gmv = F.coalesce("total_gmv", F.lit(0)).cast("decimal(14,2)")
    n, tenure = F.col("total_orders"), fx.day_diff("first_order_date", "last_order_date")
    whole = tenure.cast("decimal(12,0)")
    per_month = n.cast("decimal(12,0)") * DAYS_PER_MONTH / F.nullif(whole, F.lit(0).cast("decimal(12,0)"))
    return joined.select(
        PERSON, n.alias("total_orders_pre_cutoff"), gmv.alias("total_gmv_pre_cutoff"),
        fx.ratio(gmv, n, 2, 12).alias("avg_order_value_pre_cutoff"),
        tenure.alias("tenure_days_pre_cutoff"),
        F.datediff(F.lit(cutoff).cast("date"), F.col("last_order_date")).alias("days_since_last_order_pre_cutoff"),
        F.col("avg_delivery_delta_days").alias("avg_delivery_delta"), F.col("pct_late_deliveries").alias("pct_late"),
        F.coalesce("total_categories_purchased", F.lit(0)).alias("total_categories_purchased"),
        (whole / F.lit(DAYS_PER_MONTH).cast("decimal(2,0)")).cast("decimal(10,4)").alias("tenure_months_pre_cutoff"),
        F.when(tenure > 0, per_month).cast("decimal(10,4)").alias("order_frequency_per_month_pre_cutoff"))


def clv_training_frame(features: DataFrame, clv: DataFrame) -> DataFrame:
    """Pre-cutoff features with the static attributes, the target and the two labels."""
    static = clv.select(PERSON, "customer_state", "preferred_payment_type", "actual_gmv_post_cutoff")
    return features.join(static, PERSON).withColumns({
        "is_single_order": fx.single_flag("total_orders_pre_cutoff"),
        "repurchased": fx.positive_flag("actual_gmv_post_cutoff")})


def churn_training_frame(profile: DataFrame, clv: DataFrame) -> DataFrame:
    """Profile columns and the rule label; the column the label is made from and the health score stay out."""
    kept = [PERSON, "customer_state", "is_churned", "total_orders", "total_gmv", "total_freight_paid", "avg_order_value",
            "avg_review_score", "pct_negative_reviews", "avg_sentiment_score", "avg_delivery_delta_days",
            "pct_late_deliveries"]
    return profile.select(*kept).join(
        clv.select(PERSON, "total_categories_purchased", "preferred_payment_type"), PERSON, "left")


def sentiment_skeleton(reviews: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """The review columns of the score table, with the scores that ``reviews`` carries, if any, and the columns ``carried``."""
    scores = [(F.col(c) if c in reviews.columns else F.lit(None).cast(kind)).alias(c)
              for c, kind in (("compound_score", "decimal(6,4)"), ("sentiment_label", "string"))]
    return reviews.select("review_id", "order_id", PERSON, "review_score", "review_comment_message",
                          "review_creation_date", *scores, *carried)


@dataclass(frozen=True)
class Gold:
    customer_360: DataFrame
    rfm_features: DataFrame
    clv_features: DataFrame
    sentiment_scores: DataFrame
    run_constants: DataFrame


def build_gold(facts: Facts, items: DataFrame, products: DataFrame, ml_cutoff: str,
               churn_window: int = fx.CHURN_WINDOW_DAYS, score_direction: str = "documented") -> Gold:
    """All marts from one set of facts; facts are scanned once for the stored customer base, and lines summed once per order."""
    facts = replace(facts, order_values=materialize(facts.order_values, "order-values"))
    constants = run_constants(facts.orders, ml_cutoff, churn_window)
    placed = materialize(with_positions(customer_base(facts, constants)), "customer-places")
    profile = customer_360(placed)
    features = clv_features(profile, category_diversity(items, products, facts.orders),
                            preferred_payment(facts.payments), value_after(facts.order_values, ml_cutoff))
    return Gold(profile, rfm_features(placed, score_direction), features, sentiment_skeleton(facts.reviews), constants)
