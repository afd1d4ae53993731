"""Exploration of the raw and mart tables: counts, shares, distributions, correlations, cross-tabs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators.history import keep_first
from ..operators.ranking import Order, exact_percentiles, global_positions
from .views import mean_of, share_of_total

PERSON = "customer_unique_id"


def _rows() -> Column:
    return F.count(F.lit(1))


# -- identity ------------------------------------------------------------------

def identity_summary(customers: DataFrame) -> DataFrame:
    return customers.agg(
        _rows().alias("id_records"), F.count_distinct("customer_id").alias("distinct_ids"),
        F.count_distinct(PERSON).alias("distinct_people")).withColumn(
        "dedup_rate_pct", fx.ratio((F.col("id_records") - F.col("distinct_people")) * 100, F.col("id_records"), 2))


def ids_per_person(customers: DataFrame) -> DataFrame:
    return customers.groupBy(PERSON).agg(F.count_distinct("customer_id").alias("id_count"))


def id_multiplicity(customers: DataFrame) -> DataFrame:
    return ids_per_person(customers).groupBy("id_count").agg(_rows().alias("customer_count")).withColumn(
        "pct_of_customers", share_of_total("customer_count", 3))


def listed_ids(customers: DataFrame, n: int = 10) -> DataFrame:
    """One row per (person, id) of the people with the most ids, however many ids one of them has."""
    top = (ids_per_person(customers).where(F.col("id_count") > 1).orderBy(F.desc("id_count"), PERSON).limit(n))
    return customers.join(F.broadcast(top), PERSON).select(PERSON, "id_count", "customer_id").where("customer_id IS NOT NULL").distinct()


def most_ids(customers: DataFrame, n: int = 10) -> DataFrame:
    """People with the most ids, their ids in one text, which one task makes; ``listed_ids`` has them in rows."""
    return listed_ids(customers, n).groupBy(PERSON, "id_count").agg(
        F.array_join(F.sort_array(F.collect_list("customer_id")), " | ").alias("customer_ids"))


def orders_of_repeated_ids(customers: DataFrame, orders: DataFrame) -> DataFrame:
    people = ids_per_person(customers).where(F.col("id_count") > 1).select(PERSON)
    ids = customers.join(people, PERSON, "left_semi").select("customer_id").distinct()
    per_id = orders.groupBy("customer_id").agg(F.count("order_id").alias("orders"))
    return ids.join(per_id, "customer_id", "left").agg(
        _rows().alias("id_records"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders_placed"))


# -- volumes -------------------------------------------------------------------

def monthly_volume(orders: DataFrame, items: DataFrame) -> DataFrame:
    prices = items.groupBy("order_id").agg(F.sum("price").alias("order_price"))
    return (orders.where(F.col("order_purchase_timestamp").isNotNull()).join(prices, "order_id", "left")
            .groupBy(fx.month_start("order_purchase_timestamp").alias("month"))
            .agg(_rows().alias("order_count"), F.sum("order_price").alias("total_price")))


def split_sizes(orders: DataFrame, cutoff: str) -> DataFrame:
    return (orders.where(F.col("order_purchase_timestamp").isNotNull())
            .groupBy(fx.split_label("order_purchase_timestamp", cutoff).alias("split"))
            .agg(_rows().alias("order_count"), F.count_distinct("customer_id").alias("customer_id_count")))


def order_value_stats(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Percentiles and extremes of order totals; canceled and unavailable orders left out."""
    totals = items.groupBy("order_id").agg(F.sum("price").alias("order_total"), _rows().alias("item_count"))
    kept = totals.join(orders.where(~F.col("order_status").isin("canceled", "unavailable")).select("order_id"), "order_id")
    summary = kept.agg(
        mean_of("order_total", 2).alias("avg_order_value"), F.min("order_total").alias("min_order_value"),
        F.max("order_total").alias("max_order_value"), _rows().alias("total_orders"),
        F.floor(F.sum("item_count") / _rows()).alias("avg_items_per_order"),
        F.max("item_count").alias("max_items_per_order"),
        F.count_if(F.col("order_total") <= 0).alias("zero_value_orders"))
    points = exact_percentiles(kept, "order_total", {"p10": "0.1", "median": "0.5", "p90": "0.9"})
    rounded = points.select(*[F.round(c, 4).alias(f"{c}_order_value") for c in points.columns])
    return summary.crossJoin(F.broadcast(rounded))


# -- reviews and delivery ------------------------------------------------------

def review_scores(reviews: DataFrame) -> DataFrame:
    scored = reviews.where(F.col("review_score").isNotNull()).groupBy(F.col("review_score").cast("int").alias("review_score"))
    return scored.agg(_rows().alias("review_count"), F.sum(fx.has_text("review_comment_message")).alias("with_text")).select(
        "*", fx.ratio(F.col("with_text") * 100, F.col("review_count"), 1).alias("pct_with_text"),
        share_of_total("review_count", 1).alias("pct_of_all_reviews"))


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.where((F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
                        & F.col("order_estimated_delivery_date").isNotNull())


def _whole_mean(value: Column) -> Column:
    """Mean of an integer column cut to an integer, toward zero."""
    total, n = F.sum(value), F.count(value)
    return (F.signum(total) * F.floor(F.abs(total) / F.nullif(n, F.lit(0)))).cast("int")


def score_by_delay(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    deltas = _delivered(orders).select("order_id", fx.delivery_delta_days().alias("delta"))
    return (reviews.where(F.col("review_score").isNotNull()).select("order_id", "review_score").join(deltas, "order_id")
            .groupBy(F.col("review_score").cast("int").alias("review_score"))
            .agg(_whole_mean(F.col("delta")).alias("avg_delivery_delta_days"), _rows().alias("order_count")))


def _delivery_measures() -> list[Column]:
    return [_whole_mean(fx.delivery_delta_days()).alias("avg_delta_days"),
            fx.ratio(F.sum(fx.is_late()) * 100, _rows(), 4).alias("pct_late"), _rows().alias("orders")]


def delivery_overall(orders: DataFrame) -> DataFrame:
    return _delivered(orders).agg(*_delivery_measures())


def delivery_by_state(orders: DataFrame, customers: DataFrame, minimum: int = 100) -> DataFrame:
    per_id = _delivered(orders).select("customer_id", fx.delivery_delta_days().alias("delta"), fx.is_late().alias("late"))
    sums = per_id.groupBy("customer_id").agg(F.sum("delta").alias("delta"), F.sum("late").alias("late"), _rows().alias("n"))
    states = sums.join(customers.select("customer_id", "customer_state"), "customer_id").groupBy("customer_state").agg(
        F.sum("delta").alias("delta"), F.sum("late").alias("late"), F.sum("n").alias("orders"))
    whole = F.signum(F.col("delta")) * F.floor(F.abs("delta") / F.col("orders"))
    return states.where(F.col("orders") >= minimum).select(
        "customer_state", "orders", whole.cast("int").alias("avg_delta_days"),
        fx.ratio(F.col("late") * 100, F.col("orders"), 4).alias("pct_late"))


def extreme_delivery_states(states: DataFrame, n: int = 5) -> DataFrame:
    """The n states with the earliest and the n with the latest deliveries."""
    best = states.orderBy("avg_delta_days", "customer_state").limit(n).withColumn("side", F.lit("best"))
    worst = states.orderBy(F.desc("avg_delta_days"), "customer_state").limit(n).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


# -- customers -----------------------------------------------------------------

def orders_per_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    per_id = orders.groupBy("customer_id").agg(F.count("order_id").alias("n"))
    return customers.select(PERSON, "customer_id").join(per_id, "customer_id", "left").groupBy(PERSON).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("order_count"))


def order_count_distribution(customers: DataFrame, orders: DataFrame, top: int = 5) -> DataFrame:
    counts = orders_per_customer(customers, orders).groupBy(fx.capped("order_count", top).alias("order_count"))
    return counts.agg(_rows().alias("customer_count")).select(
        "*", fx.capped_label("order_count", top).alias("order_count_label"),
        share_of_total("customer_count").alias("pct_of_customers"))


def value_by_frequency(known_orders: DataFrame, items: DataFrame, top: int = 5) -> DataFrame:
    """Basket size by how often a customer buys; orders without lines count for frequency only."""
    lines = items.groupBy("order_id").agg(F.sum("price").alias("price"), _rows().alias("lines"))
    people = known_orders.select("order_id", PERSON).join(lines, "order_id", "left").groupBy(PERSON).agg(
        F.count("order_id").alias("order_count"), F.sum("price").alias("price"), F.sum("lines").alias("lines"),
        F.count("lines").alias("orders_with_lines"))
    return people.where(F.col("orders_with_lines") > 0).groupBy(fx.capped("order_count", top).alias("order_count_bucket")).agg(
        _rows().alias("customers"), fx.ratio(F.sum("price"), F.sum("lines"), 2).alias("avg_item_price"),
        fx.ratio(F.sum("price"), F.sum("orders_with_lines"), 2).alias("avg_order_value"))


def churn_baseline(known_orders: DataFrame, as_of: DataFrame, window_days: int = fx.CHURN_WINDOW_DAYS) -> DataFrame:
    """The exploratory churn rule: idle for at least the window."""
    idle = (known_orders.where(F.col("order_purchase_timestamp").isNotNull()).groupBy(PERSON)
            .agg(F.max("order_purchase_timestamp").alias("last")).crossJoin(F.broadcast(as_of.select("as_of_date")))
            .select(fx.day_diff("last", "as_of_date").alias("idle")))
    churned = F.sum(fx.is_churned("idle", window_days, inclusive=True))
    return idle.agg(_rows().alias("total_customers"), churned.alias("churned_by_definition"),
                    fx.ratio(F.sum("idle"), _rows(), 4).alias("avg_days_since_last_order"),
                    fx.ratio(churned * 100, _rows(), 2).alias("churn_rate_pct"))


def customer_prices(known_orders: DataFrame, items: DataFrame) -> DataFrame:
    prices = items.groupBy("order_id").agg(F.sum("price").alias("price"))
    return known_orders.select("order_id", PERSON).join(prices, "order_id").groupBy(PERSON).agg(
        F.sum("price").cast("decimal(20,2)").alias("total_gmv"))


def pareto(people: DataFrame, value: str = "total_gmv") -> DataFrame:
    """Cumulative share of value over customers, largest first."""
    places = global_positions(people, [PERSON], {"gmv": Order(F.col(value), ascending=False, amount=F.col(value))})
    totals = people.agg(F.sum(value).alias("_all"))
    return places.crossJoin(F.broadcast(totals)).select(
        PERSON, F.col("gmv_row").alias("place"),
        fx.share(F.col("gmv_running") * 100, F.col("_all")).alias("cum_gmv_pct"),
        fx.ratio(F.col("gmv_row") * 100, F.col("gmv_total"), 4).alias("cum_customer_pct"))


def top_share(curve: DataFrame, percent: int = 20) -> DataFrame:
    return curve.where(F.col("cum_customer_pct") <= percent).agg(F.max("cum_gmv_pct").alias("top_share_pct"))


# -- payments ------------------------------------------------------------------

def payment_methods(payments: DataFrame) -> DataFrame:
    per_order = payments.where(F.col("payment_type").isNotNull()).groupBy("payment_type", "order_id").agg(
        _rows().alias("n"), F.sum("payment_value").alias("value"))
    kinds = per_order.groupBy("payment_type").agg(
        F.sum("n").alias("transactions"), _rows().alias("orders"), F.sum("value").alias("total_value"))
    return kinds.select("*", fx.ratio("total_value", "transactions", 2).alias("avg_value"),
                        share_of_total("transactions", 1).alias("pct_of_transactions"))


def installments(payments: DataFrame, top: int = 10) -> DataFrame:
    bucket = fx.capped("payment_installments", top).alias("installments_bucket")
    return payments.where(F.col("payment_installments").isNotNull()).groupBy(bucket).agg(
        _rows().alias("transaction_count")).withColumn("bucket_label", fx.capped_label("installments_bucket", top))


# -- geography -----------------------------------------------------------------

def state_summary(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    prices = items.groupBy("order_id").agg(F.sum("price").alias("price"))
    per_id = orders.select("order_id", "customer_id").join(prices, "order_id", "left").groupBy("customer_id").agg(
        _rows().alias("orders"), F.sum("price").alias("price"))
    people = customers.join(per_id, "customer_id", "left").groupBy("customer_state", PERSON).agg(
        F.sum("orders").alias("orders"), F.sum("price").alias("price"))
    states = people.groupBy("customer_state").agg(
        _rows().alias("customers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.sum("price").cast("decimal(20,2)").alias("total_gmv"))
    return states.select("*", share_of_total("customers").alias("pct_of_customers"),
                         share_of_total("total_gmv").alias("pct_of_gmv"))


# -- features and correlation --------------------------------------------------

def correlation_frame(known_orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Customer features over delivered orders; lines and reviews are summed apart, so neither multiplies the other."""
    kept = known_orders.where(F.col("order_status") == "delivered")
    lines = items.groupBy("order_id").agg(F.sum("price").alias("price"), _rows().alias("lines"))
    rated = reviews.groupBy("order_id").agg(F.sum("review_score").alias("score"), F.count("review_score").alias("reviews"))
    delta = fx.delivery_delta_days()
    joined = kept.select("order_id", PERSON, delta.alias("delta"), fx.is_late().alias("late")).join(
        lines, "order_id", "left").join(rated, "order_id", "left")
    return joined.groupBy(PERSON).agg(
        _rows().alias("order_count"), F.coalesce(F.sum("price"), F.lit(0)).cast("decimal(20,2)").alias("total_gmv"),
        fx.ratio(F.sum("price"), F.sum("lines"), 2).alias("avg_item_price"),
        fx.ratio(F.sum("score"), F.sum("reviews"), 4).alias("avg_review_score"),
        fx.ratio(F.sum("delta"), F.count("delta"), 4).alias("avg_delivery_delta"),
        fx.ratio(F.sum("late"), _rows(), 4).alias("pct_late"))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every column pair in one pass; a pair uses the rows where both have a value."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"), F.col(f"`{a}|{b}`").alias("correlation"))
                     for a, b in pairs])
    return one.select(F.inline(rows))


def strong_pairs(pairs: DataFrame, threshold: float = 0.6) -> DataFrame:
    return pairs.where(F.abs("correlation") >= threshold)


def correlation_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in columns])
    return one.select(F.inline(rows))


# -- cross-tabs, profiles, descriptions ----------------------------------------

def cross_tab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts with one column per given value, 0 where there is none."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == value).alias(value) for value in values])


def group_profile(df: DataFrame, by: str, columns: Mapping[str, int]) -> DataFrame:
    """Mean of each column per group; the mapping gives the scale of the column."""
    return df.groupBy(by).agg(*[mean_of(c, 2, scale).alias(c) for c, scale in columns.items()])


def repurchase_comparison(frame: DataFrame, columns: Mapping[str, int], target: str = "actual_gmv_post_cutoff") -> DataFrame:
    """Feature means of customers with and without later purchases, and their ratio."""
    flag = fx.positive_flag(target)
    cells = []
    for name, scale in columns.items():
        cells += [mean_of(F.when(flag == 1, F.col(name)), 4, scale).alias(f"{name}_yes"),
                  mean_of(F.when(flag == 0, F.col(name)), 4, scale).alias(f"{name}_no")]
    one = frame.agg(*cells)
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"{n}_no").alias("non_repurchaser"),
                              F.col(f"{n}_yes").alias("repurchaser")) for n in columns])
    ratio = (F.col("repurchaser").cast("decimal(18,4)")
             / F.nullif(F.col("non_repurchaser").cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)")))
    return one.select(F.inline(rows)).withColumn("ratio", ratio.cast("decimal(18,2)"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(_rows().alias("n"))
    # the total is one row; a window over all values would be one task
    return counts.crossJoin(F.broadcast(df.agg(_rows().alias("_all")))).select(
        column, "n", fx.share(F.col("n") * 100, F.col("_all"), 2).cast("decimal(18,2)").alias("pct"))


def top_values(df: DataFrame, by: str, column: str, n: int = 5) -> DataFrame:
    """The n most frequent values per group and their share of the group."""
    counts = df.groupBy(by, column).agg(_rows().alias("n"))
    sizes = df.groupBy(by).agg(_rows().alias("group_size"))
    place = Window.partitionBy(by).orderBy(F.desc("n"), column)
    top = counts.withColumn("place", F.row_number().over(place)).where(F.col("place") <= n)
    return top.join(sizes, by).withColumn(
        "pct", fx.ratio(F.col("n") * 100, F.col("group_size"), 1))


def top_rows(df: DataFrame, by: str, order: Sequence[Column], n: int = 5) -> DataFrame:
    if n == 1:
        return keep_first(df, [by], order)
    place = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("place", F.row_number().over(place)).where(F.col("place") <= n)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation and extremes, one row per column."""
    cells = []
    for c in columns:
        v = F.col(c).cast("double")
        cells += [F.count(v).alias(f"{c}_count"), F.avg(v).alias(f"{c}_mean"), F.stddev_samp(v).alias(f"{c}_std"),
                  F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
    one = df.agg(*cells)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}_{m}").alias(m) for m in
                                                          ("count", "mean", "std", "min", "max")]) for c in columns])
    return one.select(F.inline(rows))


def quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact quartiles, one row per column; all columns share one sort of their distinct values."""
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("decimal(28,10)").alias("value")) for c in columns])
    return exact_percentiles(df.select(F.inline(values)), "value", {"q25": "0.25", "median": "0.5", "q75": "0.75"}, ["feature"])


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Words of a text column; equal texts are counted once before they are split."""
    texts = df.where(F.col(text).isNotNull()).groupBy(text).agg(_rows().alias("n"))
    words = texts.select(F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}]+")).alias("word"), "n")
    return words.where(F.col("word") != "").groupBy("word").agg(F.sum("n").alias("n"))


# columns that may be missing, and texts for which empty is the same as missing
OPTIONAL = ("order_delivered_customer_date", "review_comment_message", "product_category_name")
EMPTY_IS_MISSING = ("review_comment_message",)


def null_profile(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Count and share of missing values of the named columns, one scan per table; for optional columns they only inform."""
    parts = []
    for name, (df, columns) in tables.items():
        missing = {c: F.col(c).isNull() | (F.length(c) == 0) if c in EMPTY_IS_MISSING else F.col(c).isNull() for c in columns}
        one = df.agg(_rows().alias("_n"), *[F.count_if(m).alias(c) for c, m in missing.items()])
        rows = F.array(*[F.struct(F.lit(f"{name}.{c}").alias("column_checked"), F.col(c).alias("null_count")) for c in columns])
        parts.append(one.select("_n", F.inline(rows)))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    optional = F.element_at(F.split("column_checked", r"\."), -1).isin(*OPTIONAL)
    return union.select("column_checked", "null_count", fx.ratio(F.col("null_count") * 100, F.col("_n"), 2).alias("pct_of_table"),
                        F.when(F.col("null_count") == 0, "OK").when(optional, "INFO").otherwise("INVESTIGATE").alias("status"))
