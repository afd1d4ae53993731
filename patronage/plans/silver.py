"""Raw tables to dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..operators.history import first_versions, keep_first, scd2_merge, with_version_at
from ..operators.joins import hot_keys, lookup_join


@dataclass(frozen=True)
class Raw:
    """The raw tables, as read by ``patronage.sources`` or mapped from elsewhere."""

    customers: DataFrame
    sellers: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    category_translation: DataFrame


@dataclass(frozen=True)
class Silver:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_seller: DataFrame
    dim_review: DataFrame
    fact_orders: DataFrame
    fact_order_items: DataFrame
    #: texts by ``text_row``, where they are stored apart from the review dimension
    review_texts: DataFrame | None = None


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Typed products with an English category, 'UNKNOWN' when there is none."""
    named = products.join(translation, "product_category_name", "left")
    return named.select(
        F.xxhash64("product_id").alias("product_sk"),
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", F.lit("UNKNOWN")).alias("product_category_name_english"),
        F.col("product_name_lenght").try_cast("int").alias("product_name_length"),
        F.col("product_description_lenght").try_cast("int").alias("product_description_length"),
        F.col("product_photos_qty").try_cast("int").alias("product_photos_qty"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        fx.product_volume().alias("product_volume_cm3"),
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(F.xxhash64("seller_id").alias("seller_sk"), "seller_id", "seller_zip_code_prefix",
                          "seller_city", "seller_state")


def dim_review(reviews: DataFrame, orders: DataFrame, customers: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per review id: the latest, on a tie the lowest order id. Scores outside 1..5 are dropped.

    The rows are chosen by their keys and days alone; texts are shuffled once, to the rows that were chosen. Columns named in
    ``carried`` go along.
    """
    people = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id").select("order_id", "customer_unique_id")
    # the ids again, with a place for NULL among them
    valid = reviews.where(F.col("review_score").between(1, 5)).withColumn(
        "_id", F.coalesce(F.concat(F.lit("="), F.col("review_id").cast("string")), F.lit("")))
    known = valid.select("_id", "order_id", "review_creation_date").join(people, "order_id")
    chosen = keep_first(known, ["_id"], [F.col("review_creation_date").desc(), F.col("order_id").asc()]).select(
        "_id", F.col("order_id").alias("_order"), F.col("review_creation_date").alias("_day"), "customer_unique_id")
    # inside coalesce, so that both sides meet by id alone and the next step finds its rows together
    picked = F.coalesce((F.col("order_id") == F.col("_order")) & (F.col("review_creation_date") == F.col("_day")),
                        (F.col("order_id") == F.col("_order")) & F.col("review_creation_date").isNull() & F.col("_day").isNull())
    columns = ["review_id", "order_id", "customer_unique_id", "review_score", "review_comment_title", "review_comment_message",
               "review_creation_date", "review_answer_timestamp", *carried]
    # rows alike in id, order and day count once
    one = (valid.join(chosen, "_id").where(picked).groupBy("_id").agg(F.first(F.struct(*columns)).alias("_row"))
           .select("_row.*"))
    message = fx.blank_to_null("review_comment_message")
    return one.select(
        F.xxhash64("review_id").alias("review_sk"), "review_id", "order_id", "customer_unique_id",
        F.col("review_score").cast("int").alias("review_score"),
        fx.blank_to_null("review_comment_title").alias("review_comment_title"),
        message.alias("review_comment_message"),
        fx.has_text(message).alias("has_comment"),
        "review_creation_date", "review_answer_timestamp",
        fx.day_diff("review_creation_date", "review_answer_timestamp").alias("response_delay_days"), *carried,
    )


def review_texts(reviews: DataFrame) -> DataFrame:
    """Reviews with a score of 1..5 as they are read, each with a number in ``text_row``, which holds once they are stored."""
    message = fx.blank_to_null("review_comment_message")
    return reviews.where(F.col("review_score").between(1, 5)).select(
        F.monotonically_increasing_id().alias("text_row"), "review_id", "order_id", "review_score",
        fx.blank_to_null("review_comment_title").alias("review_comment_title"), message.alias("review_comment_message"),
        fx.has_text(message).alias("has_comment"), "review_creation_date", "review_answer_timestamp")


def review_heads(texts: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """``dim_review`` of stored ``review_texts`` with the number of its row in the place of its title and text, which do not move."""
    people = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id").select("order_id", "customer_unique_id")
    known = texts.drop("review_comment_title", "review_comment_message").join(people, "order_id")
    one = keep_first(known, ["review_id"], [F.col("review_creation_date").desc(), F.col("order_id").asc(), F.col("text_row").asc()])
    return one.select(
        F.xxhash64("review_id").alias("review_sk"), "review_id", "order_id", "customer_unique_id",
        F.col("review_score").cast("int").alias("review_score"), "has_comment", "review_creation_date", "review_answer_timestamp",
        fx.day_diff("review_creation_date", "review_answer_timestamp").alias("response_delay_days"), "text_row")


def whole_reviews(heads: DataFrame, texts: DataFrame) -> DataFrame:
    """``dim_review`` with its titles and texts, which only readers of whole reviews move."""
    return heads.join(texts.select("text_row", "review_comment_title", "review_comment_message"), "text_row").select(
        "review_sk", "review_id", "order_id", "customer_unique_id", "review_score", "review_comment_title", "review_comment_message", "has_comment",
        "review_creation_date", "review_answer_timestamp", "response_delay_days")


def marked_reviews(heads: DataFrame) -> DataFrame:
    """Heads for readers that ask only whether there is a text: 'text' where there is one."""
    return heads.withColumn("review_comment_message", F.when(F.col("has_comment") == 1, "text"))


def payments_per_order(payments: DataFrame) -> DataFrame:
    kinds = payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("value"), F.max("payment_installments").alias("installments"),
        F.min("payment_sequential").alias("first"))
    return kinds.groupBy("order_id").agg(
        F.sum("value").cast("decimal(12,2)").alias("total_payment_value"),
        F.min_by("payment_type", F.struct("first", "payment_type")).alias("payment_type_primary"),
        F.max("installments").alias("payment_installments_max"),
        F.count("payment_type").alias("payment_methods_count"),
    )


def order_columns(orders: DataFrame) -> DataFrame:
    """Derived order columns: flags, delivery delta, approval delay, date key."""
    return (orders
            .withColumn("order_purchase_date_sk", fx.date_key("order_purchase_timestamp"))
            .withColumn("is_delivered", fx.is_delivered())
            .withColumn("is_canceled", fx.is_canceled())
            .withColumn("delivery_delta_days", fx.delivery_delta_days())
            .withColumn("is_late", fx.is_late())
            .withColumn("approval_delay_hours", fx.hour_boundaries("order_purchase_timestamp", "order_approved_at")))


def fact_orders(orders: DataFrame, customers: DataFrame, dim_customer: DataFrame, payments: DataFrame,
                carried: tuple[str, ...] = ("customer_sk",)) -> DataFrame:
    placed = with_version_at(orders, customers, dim_customer, "order_purchase_timestamp", carried)
    paid = placed.join(payments_per_order(payments), "order_id", "left")
    return order_columns(paid).withColumn("order_sk", F.xxhash64("order_id"))


def unresolved_orders(orders: DataFrame, facts: DataFrame) -> DataFrame:
    """Orders that found no customer version and are missing from the facts."""
    return orders.join(facts.select("order_id"), "order_id", "left_anti")


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Order lines with the customer and the product and seller keys; lines of unknown orders drop out."""
    hot = hot_keys(items, ["product_id", "seller_id"])
    # an order has a handful of lines, so its key needs no counting
    rows = items.join(orders.select("order_id", "customer_unique_id"), "order_id")
    rows = lookup_join(rows, products.select("product_id", "product_sk"), "product_id", hot=hot)
    rows = lookup_join(rows, sellers.select("seller_id", "seller_sk"), "seller_id", hot=hot)
    rows = rows.withColumn("gmv", fx.item_gmv()).withColumn("freight_ratio", fx.freight_ratio())
    if "order_item_id" in items.columns:
        rows = rows.withColumn("item_sk", F.xxhash64("order_id", "order_item_id"))
    return rows


def load_customers(prior: DataFrame | None, snapshot: DataFrame, run_date: str) -> DataFrame:
    return first_versions(snapshot, run_date) if prior is None else scd2_merge(prior, snapshot, run_date)


def build_silver(raw: Raw, prior_dim_customer: DataFrame | None, run_date: str,
                 keep: Callable[[str, DataFrame], DataFrame] | None = None) -> Silver:
    """All dimensions and facts. Each goes through ``keep``, which stores it; those made from it read what ``keep`` returns.

    The reviews are then stored as ``review_texts``, where they are read, and ``dim_review`` without its texts. Nothing is stored without ``keep``.
    """
    kept = keep or (lambda name, table: table)
    customers = kept("dim_customer", load_customers(prior_dim_customer, raw.customers, run_date))
    products = kept("dim_product", dim_product(raw.products, raw.category_translation))
    sellers = kept("dim_seller", dim_seller(raw.sellers))
    texts = keep("review_texts", review_texts(raw.reviews)) if keep else None
    reviews = (whole_reviews(keep("dim_review", review_heads(texts, raw.orders, raw.customers)), texts) if keep
               else dim_review(raw.reviews, raw.orders, raw.customers))
    orders = kept("fact_orders", fact_orders(raw.orders, raw.customers, customers, raw.payments))
    items = kept("fact_order_items", fact_order_items(raw.items, orders, products, sellers))
    return Silver(customers, products, sellers, reviews, orders, items, texts)
