"""Texts are scored where they are read: no shuffle holds one, and scores are those of the chosen rows' own texts."""

import datetime as dt
import re
import unicodedata

from pyspark.sql import functions as F

from patronage.functions.text import BLANK, BLANK_RUN, BLANKS, WORD, cleaned
from patronage.operators.sentiment import score_raw_reviews, score_reviews
from patronage.plans import gold, scoring, silver

COLUMNS = ("review_id string, order_id string, review_score double, review_comment_title string, review_comment_message string, "
           "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz")
LEXICON = [("bom", "2"), ("ruim", "-2")]


def tables(spark):
    orders = spark.createDataFrame([(f"o{i}", f"c{i}") for i in range(4)], "order_id string, customer_id string")
    customers = spark.createDataFrame([(f"c{i}", f"p{i}") for i in range(4)], "customer_id string, customer_unique_id string")
    return orders, customers


def reviews(spark, *rows):
    day = lambda n: n and dt.datetime(2020, 1, n)
    return spark.createDataFrame([(r, o, score, "t", text, day(n), None) for r, o, score, text, n in rows], COLUMNS)


ROWS = [("a", "o1", 5.0, "ruim", 1), ("a", "o2", 4.0, " muito bom!\tnão ruim ", 2), ("a", "o3", 9.0, "bad score: ruim", 4),
        ("b", "o2", 3.0, "bom", 1), ("b", "o1", 3.0, "«ruim»,\nruim.", 1), ("c", "o1", 1.0, "bom", None), ("c", "o1", 1.0, "bom", None),
        (None, "o0", 2.0, "bom", 1), ("d", "o0", 2.0, "  ", 1), ("e", "o0", 2.0, None, 1), ("f", "o1", 2.0, "<br>", 1), ("g", "o3", 2.0, "???", 1)]


def test_scores_before_and_after_the_choice_are_alike(spark):
    lexicon = spark.createDataFrame(LEXICON, "word string, valence string")
    raw, (orders, customers) = reviews(spark, *ROWS), tables(spark)
    skeleton = gold.sentiment_skeleton(silver.dim_review(raw, orders, customers))
    heads = skeleton.selectExpr("* EXCEPT (review_comment_message)", "if(review_comment_message IS NULL, NULL, 'text') AS review_comment_message")
    after = scoring.scored_sentiment(heads, lexicon, skeleton)
    before = gold.sentiment_skeleton(silver.dim_review(score_raw_reviews(raw, lexicon), orders, customers, ("compound_score", "sentiment_label")))
    key = lambda r: str(r["review_id"])
    assert sorted(before.select(*after.columns).collect(), key=key) == sorted(after.collect(), key=key)
    found = {r["review_id"]: r["compound_score"] for r in before.collect()}
    assert found["a"] > 0 > found["b"] and found["g"] == 0 and [found[i] for i in (None, "d", "e", "f")] == [None] * 4
    assert score_reviews(skeleton, lexicon).count() == 5  # with the one that has no id


def test_no_text_is_shuffled(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = reviews(spark, *ROWS).withColumnRenamed("review_comment_message", "whole").selectExpr("*", "concat('<', whole) AS review_comment_message").drop("whole")
        scored = score_raw_reviews(raw, spark.createDataFrame(LEXICON, "word string, valence string"))
        dim = silver.dim_review(scored, *tables(spark), ("compound_score", "sentiment_label"))
        dim.explain("formatted")
        out = capsys.readouterr().out
        moved = [part for part in out.split("\n\n") if re.search(r"\) Exchange", part)]
        assert moved and not any("_body" in part or "_words" in part or "_text" in part for part in moved)
        assert dim.count() == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_patterns_give_what_they_gave_without_a_look_ahead(spark):
    plain = [(rf"https?://[^{BLANK}]+|www\.[^{BLANK}]+", " "), (r"<[^>]+>", " "), (r"&[a-zA-Z]+;|&#\p{Nd}+;", " "), (r"[\r\n\t]+", " "),
             (rf"[rR]\$[{BLANK}]?\p{{Nd}}{{1,3}}(?:\.\p{{Nd}}{{3}})*(?:,\p{{Nd}}{{2}})?", " "),
             (rf"(?<![{WORD}])\p{{Nd}}{{6,}}(?![{WORD}])", " "), (r"([!?.])\1{2,}", "$1$1"), (r"([a-zA-ZÀ-ÿ])\1{3,}", "$1$1$1"), (BLANK_RUN, " ")]
    parts = ["http://x.y", "https:", "www.a", "www", "<b>", "<", ">", "&amp;", "&#9;", "&", ";", "\r\n", "\t", "R$ 1.234,56", "r$9", "$", "1234567", "x123456",
             "123456é", "٣٤٥٦٧٨٩", "12345", "!!!!", "??", "...", "aaaaa", "éééé", "××××", "ÿÿÿ", "é", *BLANKS, "\x0b\x0b", " \xa0", "　 ", "日本"]
    texts = [a + b + c for i, a in enumerate(parts) for j, b in enumerate(parts) for c in (parts[(i * 7 + j * 3) % len(parts)], "")]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(8)

    composed = spark.createDataFrame([(k, unicodedata.normalize("NFC", t)) for k, t in enumerate(texts)], "k int, was string")
    for pattern, by in plain:
        composed = composed.withColumn("was", F.regexp_replace("was", pattern, by))
    composed = composed.select("k", F.nullif(F.btrim("was", F.lit(BLANKS)), F.lit("")).alias("was"))
    wrong = df.select("k", "t", cleaned("t").alias("now")).join(composed, "k").where("NOT (now <=> was)").collect()
    assert wrong == []
