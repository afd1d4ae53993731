"""The review dimension: which rows stay, and how often texts are shuffled."""

import datetime as dt

import pytest

from patronage.functions.text import BLANK, BLANKS, cleaned
from patronage.plans import gold, scoring, silver

COLUMNS = ("review_id string, order_id string, review_score double, review_comment_title string, review_comment_message string, "
           "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz")


@pytest.fixture
def tables(spark):
    orders = spark.createDataFrame([(f"o{i}", f"c{i}") for i in range(4)], "order_id string, customer_id string")
    customers = spark.createDataFrame([(f"c{i}", f"p{i}") for i in range(4)], "customer_id string, customer_unique_id string")
    return orders, customers


def reviews(spark, *rows):
    day = lambda n: n and dt.datetime(2020, 1, n)
    return spark.createDataFrame([(r, o, score, "t", text, day(n), None) for r, o, score, text, n in rows], COLUMNS)


def test_latest_known_review_stays_with_its_own_text(spark, tables):
    rows = reviews(spark, ("a", "o1", 5.0, "old", 1), ("a", "o2", 4.0, "new", 2), ("a", "o9", 4.0, "unknown order", 3), ("a", "o3", 9.0, "bad score", 4),
                   ("b", "o2", 3.0, "high", 1), ("b", "o1", 3.0, "low", 1), ("c", "o1", 1.0, "dayless", None), ("c", "o1", 1.0, "dayless", None),
                   (None, "o0", 2.0, " ", 1), (None, "o0", 2.0, " ", 1), ("d", "o0", 2.0, "twice", 1), ("d", "o0", 2.0, "twice", 1), ("e", None, 2.0, "x", 1))
    found = {(r["review_id"], r["order_id"], r["customer_unique_id"], r["review_score"], r["review_comment_message"])
             for r in silver.dim_review(rows, *tables).collect()}
    assert found == {("a", "o2", "p2", 4, "new"), ("b", "o1", "p1", 3, "low"), ("c", "o1", "p1", 1, "dayless"), (None, "o0", "p0", 2, None), ("d", "o0", "p0", 2, "twice")}
    assert silver.dim_review(rows, *tables).count() == 5


def shuffles_of_texts(df, capsys) -> int:
    df.explain("formatted")
    parts = capsys.readouterr().out.split("\n\n")
    return sum(") Exchange" in part and "review_comment_message" in part for part in parts)


def test_texts_are_shuffled_once(spark, tables, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = reviews(spark, ("a", "o1", 5.0, "bom", 1))
        dim = silver.dim_review(raw, *tables)
        assert shuffles_of_texts(dim, capsys) == 1
        heads = gold.sentiment_skeleton(dim).drop("review_comment_message").selectExpr("*", "'text' AS review_comment_message")
        lexicon = spark.createDataFrame([("bom", "2")], "word string, valence string")
        scored = scoring.scored_sentiment(heads, lexicon, gold.sentiment_skeleton(dim))
        # the other one is of the word that stands for a text
        assert shuffles_of_texts(scored, capsys) == 2
        row = scored.first()
        assert row["review_comment_message"] == "text" and float(row["compound_score"]) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_blank_is_cut_off(spark):
    df = spark.createDataFrame([(b,) for b in BLANKS], "b string")
    assert df.where(df.b.rlike(f"^[{BLANK}]$")).count() == len(BLANKS)
    assert {r[0] for r in df.selectExpr("concat(b, 'x', b, b, 'y', b) AS t").select(cleaned("t")).collect()} == {"x y"}
