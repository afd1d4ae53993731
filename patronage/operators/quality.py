"""Data-quality checks. Each returns rows (check_name, value, status)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..plans.gold import order_values
from ..plans.views import mean_of
from .history import overlapping_versions

PERSON = "customer_unique_id"
CENT = "0.01"


def report(one: DataFrame, checks: Mapping[str, Column | None]) -> DataFrame:
    """Turn a one-row frame into check rows: column name -> condition that must hold (None: informational)."""
    rows = []
    for name, passes in checks.items():
        status = F.lit("INFO") if passes is None else (
            F.when(F.col(name).isNull(), "N/A").when(passes, "OK").otherwise("FAIL"))
        rows.append(F.struct(F.lit(name).alias("check_name"), F.col(name).cast("double").alias("value"), status.alias("status")))
    return one.select(F.inline(F.array(*rows)))


def _none(name: str) -> Column:
    return F.col(name) == 0


def _merge(*frames: DataFrame) -> DataFrame:
    one = frames[0]
    for frame in frames[1:]:
        one = one.crossJoin(F.broadcast(frame))
    return one


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def row_count_checks(counts: DataFrame) -> DataFrame:
    """From ``row_counts``: each table against its expected size."""
    status = F.when(F.col("matches").isNull(), "INFO").when(F.col("matches") == 1, "OK").otherwise("FAIL")
    return counts.select(F.concat(F.lit("rows_"), "table_name").alias("check_name"),
                         F.col("row_count").cast("double").alias("value"), status.alias("status"))


def version_checks(dim_customer: DataFrame) -> DataFrame:
    """One open version per customer, and no overlapping versions."""
    repeated = (dim_customer.where(F.col("is_current") == 1).groupBy(PERSON).agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1))
    one = _merge(_count(repeated, "customers_with_two_open_versions"),
                 _count(overlapping_versions(dim_customer), "overlapping_versions"))
    return report(one, {n: _none(n) for n in one.columns})


def orphan_checks(orders: DataFrame, items: DataFrame, reviews: DataFrame, dim_customer: DataFrame,
                  products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Orders without a customer, lines without an order, reviews without a customer, unknown products and sellers."""
    one = _merge(
        _count(orders.join(dim_customer.select(PERSON), PERSON, "left_anti"), "orphan_orders"),
        _count(items.join(orders.select("order_id"), "order_id", "left_anti"), "orphan_items"),
        reviews.agg(F.count_if(F.col(PERSON).isNull()).alias("reviews_missing_customer")),
        _count(items.join(products.select("product_id"), "product_id", "left_anti"), "items_missing_product"),
        _count(items.join(sellers.select("seller_id"), "seller_id", "left_anti"), "items_missing_seller"))
    informational = ("items_missing_product", "items_missing_seller")
    return report(one, {n: None if n in informational else _none(n) for n in one.columns})


def multi_review_orders(reviews: DataFrame) -> DataFrame:
    """Orders with more than one review; joins on order id must aggregate reviews first."""
    return reviews.groupBy("order_id").agg(F.count(F.lit(1)).alias("review_count")).where(F.col("review_count") > 1)


def multi_review_check(reviews: DataFrame) -> DataFrame:
    return report(_count(multi_review_orders(reviews), "orders_with_several_reviews"), {"orders_with_several_reviews": None})


def share_checks(shares: DataFrame, name: str, share: str, status: Column) -> DataFrame:
    """A table of shares as check rows, one per value of ``name``."""
    return shares.select(F.concat(F.lit("pct_"), name).alias("check_name"), F.col(share).cast("double").alias("value"),
                         status.alias("status"))


def most_reviewed_orders(reviews: DataFrame, n: int = 10) -> DataFrame:
    return multi_review_orders(reviews).orderBy(F.desc("review_count"), "order_id").limit(n)


def payment_differences(paid: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders whose stored payment total differs from the payment rows by more than a cent."""
    totals = payments.groupBy("order_id").agg(F.sum("payment_value").alias("raw_total"))
    joined = paid.join(totals, "order_id")
    gap = F.abs(F.coalesce("total_payment_value", F.lit(0)) - F.coalesce("raw_total", F.lit(0)))
    return joined.where(gap > F.lit(CENT).cast("decimal(4,2)")).select("order_id", "total_payment_value", "raw_total")


def payment_checks(paid: DataFrame, payments: DataFrame) -> DataFrame:
    one = _count(payment_differences(paid, payments), "payment_differences")
    return report(one, {"payment_differences": _none("payment_differences")})


def order_date_checks(orders: DataFrame) -> DataFrame:
    """Orders on the unknown date, and the late share of delivered orders."""
    delivered = F.col("order_delivered_customer_date").isNotNull()
    one = orders.agg(
        F.count_if(F.col("order_purchase_date_sk") == fx.UNKNOWN_DATE_KEY).alias("orders_on_unknown_date"),
        F.count_if(delivered & (F.col("is_late") == 1)).alias("late_orders"),
        F.count_if(delivered).alias("delivered_with_dates"),
        fx.ratio(F.count_if(delivered & (F.col("is_late") == 1)) * 100, F.count_if(delivered), 2).alias("pct_late"))
    return report(one, {"orders_on_unknown_date": _none("orders_on_unknown_date"), "late_orders": None,
                        "delivered_with_dates": None, "pct_late": None})


def mart_checks(profile: DataFrame, rfm: DataFrame, clv: DataFrame, customers: DataFrame, constants: DataFrame,
                orders: DataFrame) -> DataFrame:
    """Run constants agree with the facts; the marts have one row per current customer."""
    newest = orders.agg(F.to_date(F.max("order_purchase_timestamp")).alias("newest"))
    dates = constants.crossJoin(F.broadcast(newest)).agg(
        F.count_if(F.col("as_of_date") != F.col("newest")).alias("as_of_mismatch"),
        F.count(F.lit(1)).alias("run_constant_rows"))
    one = _merge(_count(profile, "rows_profile"), _count(rfm, "rows_rfm"), _count(clv, "rows_clv"),
                 _count(customers, "rows_customers"), dates)
    same = F.col("rows_profile") == F.col("rows_customers")
    return report(one, {
        "rows_profile": same, "rows_rfm": F.col("rows_rfm") == F.col("rows_customers"),
        "rows_clv": F.col("rows_clv") == F.col("rows_customers"), "rows_customers": None,
        "as_of_mismatch": _none("as_of_mismatch"), "run_constant_rows": F.col("run_constant_rows") == 1})


def score_checks(profile: DataFrame, rfm: DataFrame) -> DataFrame:
    """Health scores within 0..100, three tiers in use, quintiles from 1 to 5."""
    score = F.col("customer_health_score")
    one = profile.agg(F.min(score).alias("min_health"), F.max(score).alias("max_health"),
                      F.count_if((score < 0) | (score > 100)).alias("health_out_of_range"),
                      F.count_distinct("health_tier").alias("health_tiers"))
    names = ("recency", "frequency", "monetary")
    quintiles = rfm.agg(*[f(F.col(f"{n}_score")).alias(f"{label}_{n}") for n in names
                          for f, label in ((F.min, "min"), (F.max, "max"))])
    checks = {"min_health": F.col("min_health") >= 0, "max_health": F.col("max_health") <= 100,
              "health_out_of_range": _none("health_out_of_range"), "health_tiers": None}
    for n in names:
        checks[f"min_{n}"] = F.col(f"min_{n}") == 1
        checks[f"max_{n}"] = F.col(f"max_{n}") == 5
    return report(_merge(one, quintiles), checks)


def tier_distribution(profile: DataFrame) -> DataFrame:
    return profile.groupBy("health_tier").agg(F.count(F.lit(1)).alias("customer_count"))


def feature_checks(clv: DataFrame, profile: DataFrame) -> DataFrame:
    """Share of value after the cutoff, missing payment types, missing frequencies that should exist."""
    joined = clv.select(PERSON, "actual_gmv_post_cutoff", "preferred_payment_type", "order_frequency_per_month").join(
        profile.select(PERSON, "total_gmv", "first_order_date", "last_order_date"), PERSON)
    one = joined.agg(
        F.sum("actual_gmv_post_cutoff").alias("post_cutoff_gmv"), F.sum("total_gmv").alias("total_gmv"),
        fx.share(F.sum("actual_gmv_post_cutoff") * 100, F.sum("total_gmv"), 2).alias("pct_post_cutoff"),
        F.count_if(F.col("preferred_payment_type").isNull()).alias("missing_payment_type"),
        F.count_if(F.col("order_frequency_per_month").isNull() & (F.col("first_order_date") != F.col("last_order_date")))
        .alias("missing_frequency"))
    return report(one, {"post_cutoff_gmv": None, "total_gmv": None, "pct_post_cutoff": None,
                        "missing_payment_type": _none("missing_payment_type"),
                        "missing_frequency": _none("missing_frequency")})


def reconciliation_checks(profile: DataFrame, items: DataFrame, orders: DataFrame, scores: DataFrame,
                          reviews: DataFrame) -> DataFrame:
    """GMV and freight of the profile against the order lines; one sentiment row per review."""
    sums = order_values(items, orders).groupBy(PERSON).agg(
        F.sum("order_gmv").alias("line_gmv"), F.sum("order_freight").alias("line_freight"))
    joined = profile.select(PERSON, "total_gmv", "total_freight_paid").join(sums, PERSON)
    cent = F.lit(CENT).cast("decimal(4,2)")
    one = joined.agg(F.count_if(F.abs(F.col("total_gmv") - F.col("line_gmv")) > cent).alias("gmv_differences"),
                     F.count_if(F.abs(F.col("total_freight_paid") - F.col("line_freight")) > cent).alias("freight_differences"))
    rows = _merge(_count(scores, "sentiment_rows"), _count(reviews, "review_rows")).select(
        (F.col("sentiment_rows") - F.col("review_rows")).alias("sentiment_row_gap"))
    one = _merge(one, rows)
    return report(one, {n: _none(n) for n in one.columns})


def coverage(table: DataFrame, columns: list[str]) -> DataFrame:
    """Filled rows and percent per predicted column, one scan."""
    one = table.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("populated")) for c in columns])
    return one.select("_n", F.inline(rows)).select(
        "column_name", "populated", F.col("_n").alias("total"),
        fx.ratio(F.col("populated") * 100, F.col("_n"), 2).alias("pct_populated"))


def prediction_coverage(profile: DataFrame, clv: DataFrame, rfm: DataFrame, scores: DataFrame) -> DataFrame:
    return (coverage(profile, ["churn_probability", "avg_sentiment_score", "expected_next_purchase_days"])
            .unionByName(coverage(clv, ["clv_predicted_6m"]))
            .unionByName(coverage(rfm, ["rfm_segment", "km_cluster"]))
            .unionByName(coverage(scores.where(F.col("review_comment_message").isNotNull()), ["compound_score"])))


# fixed bounds of each predicted column
PREDICTION_BOUNDS = {"churn_probability": (0, 1), "clv_predicted_6m": (0, None), "avg_sentiment_score": (-1, 1),
                     "expected_next_purchase_days": (0, None)}


def prediction_ranges(health: DataFrame) -> DataFrame:
    """Smallest and largest prediction per column, both ends tested."""
    one = health.agg(*[f(c).alias(f"{label}_{c}") for c in PREDICTION_BOUNDS for f, label in ((F.min, "min"), (F.max, "max"))])
    checks = {}
    for c, (low, high) in PREDICTION_BOUNDS.items():
        checks[f"min_{c}"] = F.col(f"min_{c}") >= low
        checks[f"max_{c}"] = F.lit(True) if high is None else F.col(f"max_{c}") <= high
    return report(one, checks)


def rule_model_agreement(profile: DataFrame, threshold: float = 0.5) -> DataFrame:
    known = profile.where(F.col("churn_probability").isNotNull())
    flag = F.when(F.col("churn_probability") >= threshold, 1).otherwise(0)
    n = F.count(F.lit(1))
    one = known.agg(fx.ratio(F.sum("is_churned"), n, 4).alias("rule_churn_rate"),
                    mean_of("churn_probability", 4, 4).alias("mean_churn_probability"),
                    fx.ratio(F.count_if(F.col("is_churned") == flag), n, 4).alias("agreement"))
    return report(one, {"rule_churn_rate": None, "mean_churn_probability": None, "agreement": None})


def segment_distribution(rfm: DataFrame) -> DataFrame:
    """Customers per segment; a missing segment is flagged."""
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("n")).select(
        F.coalesce("rfm_segment", F.lit("(missing)")).alias("rfm_segment"), "n",
        fx.ratio(F.col("n") * 100, total, 1).alias("pct"),
        F.when(F.col("rfm_segment").isNull(), "FAIL").otherwise("OK").alias("status"))


def drift_check(profile: DataFrame, reference_rate: float, tolerance: str = "0.05") -> DataFrame:
    """Warn when the churn rate is more than five points away from the reference rate."""
    one = profile.agg(fx.ratio(F.sum("is_churned"), F.count(F.lit(1)), 4).alias("churn_rate"))
    gap = F.abs(F.col("churn_rate") - F.lit(str(reference_rate)).cast("decimal(8,6)"))
    return one.select(F.lit("churn_rate").alias("check_name"), F.col("churn_rate").cast("double").alias("value"),
                      F.when(gap > F.lit(tolerance).cast("decimal(8,6)"), "WARN").otherwise("OK").alias("status"))


def combined(parts: Mapping[str, DataFrame]) -> DataFrame:
    """All check rows under the name of their job."""
    union = None
    for job, part in parts.items():
        rows = part.select(F.lit(job).alias("job"), "check_name", "value", "status")
        union = rows if union is None else union.unionByName(rows)
    return union
