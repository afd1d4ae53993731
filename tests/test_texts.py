import pytest
from pyspark.sql import functions as F

from patronage.functions.text import cleaned
from patronage.operators.sentiment import compound_scores


@pytest.mark.parametrize("raw, expected", [
    ("see https://x.com/a?b=1 now", "see now"),
    ("www.shop.com.br", None),
    ("<br/>great<p>", "great"),
    ("a &amp; b &#39;", "a b"),
    ("one\r\ntwo\tthree", "one two three"),
    ("paid R$ 1.234,56 today", "paid today"),
    ("order 1234567 ok 12345", "order ok 12345"),
    ("é123456 x", "é123456 x"),  # a letter before the digits: no word boundary
    ("wow!!!!! really????", "wow!! really??"),
    ("ótimoooooo", "ótimooo"),
    ("    ", None),
    ("", None),
    (None, None),
    ("ótimo", "ótimo"),
    ("KEEP Case, and punctuation!", "KEEP Case, and punctuation!"),
])
def test_cleaning(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(cleaned("t")).first()[0] == expected


def test_whole_texts_are_cleaned(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("word "), 50_000), F.lit("1234567")).alias("t"))
    assert df.select(F.length(cleaned("t"))).first()[0] == 5 * 50_000 - 1


def scores(spark, *texts):
    lexicon = spark.createDataFrame([("bom", "2"), ("ruim", "-2")], "word string, valence string")
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return {texts[r["k"]]: (float(r["compound_score"]), r["sentiment_label"])
            for r in compound_scores(df, "k", "t", lexicon).collect()}


def test_compound_scores(spark):
    texts = ["bom", "ruim", "não bom", "muito bom", "bom!!", "nada a dizer", "pouco ruim"]
    found = scores(spark, *texts)
    assert found["bom"] == (pytest.approx(2 / 19 ** 0.5, abs=1e-4), "positive")
    assert found["ruim"][0] == -found["bom"][0] and found["ruim"][1] == "negative"
    assert found["não bom"][0] < 0 < found["bom"][0] < found["muito bom"][0]
    assert found["bom!!"][0] > found["bom"][0] and found["pouco ruim"][0] > found["ruim"][0]
    assert found["nada a dizer"] == (0.0, "neutral")


def test_missing_texts_are_not_scored(spark):
    lexicon = spark.createDataFrame([("bom", "2")], "word string, valence string")
    df = spark.createDataFrame([(1, None), (2, "bom")], "k int, t string")
    assert [r["k"] for r in compound_scores(df, "k", "t", lexicon).collect()] == [2]
