"""Silver stores review texts where they are read: none is shuffled, and each meets its own row again."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from patronage.plans import gold, scoring, silver
from patronage.session import materialize

COLUMNS = ("review_id string, order_id string, review_score double, review_comment_title string, review_comment_message string, "
           "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz")
ROWS = [("a", "o1", 5.0, "old", 1), ("a", "o2", 4.0, " bom! ", 2), ("a", "o9", 4.0, "unknown order", 3), ("a", "o3", 9.0, "bad score", 4),
        ("b", "o2", 3.0, "bom", 1), ("b", "o1", 3.0, "ruim", 1), ("c", "o1", 1.0, "bom", None), ("c", "o1", 1.0, "bom", None), (None, "o0", 2.0, "bom", 1),
        (None, "o0", 2.0, "bom", 1), ("d", "o0", 2.0, "  ", 1), ("e", "o0", 2.0, None, 1), ("f", None, 2.0, "x", 1), ("g", "o1", None, "x", 1)]


@pytest.fixture
def tables(spark):
    day = lambda n: n and dt.datetime(2020, 1, n)
    raw = spark.createDataFrame([(r, o, score, " t ", text, day(n), day(9)) for r, o, score, text, n in ROWS], COLUMNS).repartition(3)
    orders = spark.createDataFrame([(f"o{i}", f"c{i}") for i in range(4)], "order_id string, customer_id string")
    customers = spark.createDataFrame([(f"c{i}", f"p{i}") for i in range(4)], "customer_id string, customer_unique_id string")
    return raw, orders, customers


def alike(a, b):
    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_whole_reviews_are_the_review_dimension(spark, tables):
    raw, orders, customers = tables
    texts = materialize(silver.review_texts(raw), "review-texts")
    heads = silver.review_heads(texts, orders, customers)
    alike(silver.whole_reviews(heads, texts), silver.dim_review(raw, orders, customers))
    assert texts.count() == 12 and "review_comment_message" not in heads.columns


def test_scores_of_stored_texts_are_those_of_whole_reviews(spark, tables):
    raw, orders, customers = tables
    lexicon = spark.createDataFrame([("bom", "2"), ("ruim", "-2")], "word string, valence string")
    texts = materialize(silver.review_texts(raw), "review-texts")
    heads = gold.sentiment_skeleton(silver.marked_reviews(silver.review_heads(texts, orders, customers)), ("text_row",))
    todo = texts.where("review_id IS NOT NULL").withColumn("compound_score", F.lit(None).cast("decimal(6,4)"))
    found = scoring.scored_sentiment(heads, lexicon, todo, key="text_row").drop("text_row")
    whole = gold.sentiment_skeleton(silver.dim_review(raw, orders, customers))
    wanted = scoring.scored_sentiment(whole, lexicon).withColumn("review_comment_message", F.expr("if(review_comment_message IS NULL, NULL, 'text')"))
    alike(found, wanted.select(*found.columns))


def test_no_text_is_shuffled_on_the_way_to_silver(spark, tables, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        given = {}

        def keep(name, table):
            given[name] = table
            return materialize(table, f"kept-{name}")

        raw, orders, customers = tables
        texts = keep("review_texts", silver.review_texts(raw.coalesce(1)))
        keep("dim_review", silver.review_heads(texts, orders, customers))
        for table, shuffles in (given["review_texts"], 1), (given["dim_review"], 5):
            table.explain("formatted")
            moved = [part for part in capsys.readouterr().out.split("\n\n") if re.search(r"\) Exchange", part)]
            # the one that deals the rows of the fixture is no part of the plan
            assert len(moved) <= shuffles and not any("review_comment_message" in part for part in moved if "RoundRobin" not in part)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_silver_that_is_stored_holds_its_texts_once(spark, sample):
    given = {}

    def keep(name, table):
        given[name] = table
        return materialize(table, f"kept-{name}")

    raw = silver.Raw(sample.moved_customers, sample.sellers, sample.products, sample.orders, sample.numbered_items, sample.payments, sample.reviews,
                     sample.category_translation)
    made = silver.build_silver(raw, silver.load_customers(None, sample.customers, "1998-01-01"), "2000-01-01", keep)
    assert [n for n, table in given.items() if "review_comment_message" in table.columns] == ["review_texts"]
    alike(made.dim_review, silver.dim_review(sample.reviews, sample.orders, sample.customers))
