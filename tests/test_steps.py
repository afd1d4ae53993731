"""Steps that took more shuffles or tasks than their rows ask for."""

import re

from pyspark.sql import functions as F

from patronage.operators import modelling
from patronage.plans import gold, scoring


def test_lines_meet_the_products_without_a_shuffle_of_their_own(spark, capsys):
    items = spark.createDataFrame([("o1", "a"), ("o1", "a"), ("o1", "b"), ("o2", "c"), ("o3", "d")], "order_id string, product_id string")
    products = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "Y")], "product_id string, product_category_name_english string")
    orders = spark.createDataFrame([("o1", "p"), ("o2", "p"), ("o3", "q")], "order_id string, customer_unique_id string")
    kinds = gold.category_diversity(items, products, orders)
    assert [tuple(r) for r in kinds.collect()] == [("p", 2)]
    kinds.explain()
    assert "hashpartitioning(order_id, product_id" not in re.sub(r"#\d+", "", capsys.readouterr().out)


def test_few_training_rows_take_one_task(spark):
    frame = spark.range(200).repartition(8).select(
        F.col("id").cast("string").alias("customer_unique_id"), (F.col("id") % 7).cast("double").alias("label"),
        *[(F.col("id") % (n + 2)).alias(c) for n, c in enumerate(modelling.CHURN_NUMERIC)],
        F.lit("S").alias("customer_state"), F.lit("card").alias("preferred_payment_type"))
    rows, _ = scoring._designed(frame, modelling.CHURN_NUMERIC)
    assert rows.rdd.getNumPartitions() == 1 and rows.count() == 200


def test_steps_side_by_side_keep_their_places():
    assert scoring._side_by_side(lambda: 1, lambda: "b", lambda: None) == [1, "b", None]
