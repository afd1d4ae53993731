"""Lexicon sentiment: a compound score in -1..1 per text, and its roll-up to customers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import as_column, blank_to_null, sentiment_label
from ..functions.text import cleaned, contains_any
from ..plans.views import mean_of
from .joins import word_join

# published constants of valence-based scoring
REACH = 3
NEGATION = "-0.74"
DAMPING = ("1", "0.95", "0.9")
BOOST = "0.293"
EXCLAMATION, MOST_EXCLAMATIONS = "0.292", 4
QUESTION, MANY_QUESTIONS = "0.18", "0.96"
NORMALISER = 15

# Portuguese words that turn or change the strength of the next ones
NEGATORS = ("não", "nao", "nem", "nunca", "jamais", "sem", "nenhum", "nenhuma")
BOOSTERS = {"muito": BOOST, "muita": BOOST, "bastante": BOOST, "demais": BOOST, "super": BOOST, "bem": BOOST,
            "pouco": "-0.293", "pouca": "-0.293", "quase": "-0.293"}


def _decimal(value: str) -> Column:
    return F.lit(value).cast("decimal(8,6)")


def _boost(word: Column, boosters: Mapping[str, str]) -> Column:
    by_value: dict[str, list[str]] = {}
    for term, value in boosters.items():
        by_value.setdefault(value, []).append(term)
    found = [F.when(word.isin(*terms), _decimal(value)) for value, terms in by_value.items()]
    return F.coalesce(*found, _decimal("0"))


def emphasis(text) -> Column:
    """Extra weight of exclamation and question marks."""
    text = as_column(text)
    count = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    marks, questions = F.least(count("!"), F.lit(MOST_EXCLAMATIONS)), count("?")
    asked = (F.when(questions <= 1, _decimal("0")).when(questions <= 3, questions * _decimal(QUESTION))
             .otherwise(_decimal(MANY_QUESTIONS)))
    return (marks * _decimal(EXCLAMATION) + asked).cast("decimal(8,6)")


#: marks that are cut off words, and blanks between words beside the space
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
OTHER_BLANKS = "\t\n\x0b\f\r"


def token_scores(texts: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame, negators: Sequence[str],
                 boosters: Mapping[str, str]) -> DataFrame:
    """One row per token that the lexicon knows, with its valence after the words before it, and one row per text without a score.

    A NULL text has only the latter, and no emphasis.
    """
    lowered = texts.select(*keys, F.when(F.col(text).isNotNull(), emphasis(text)).alias("emphasis"), F.lower(F.col(text)).alias("_text"))
    split = lowered.select(*keys, "emphasis", F.when(contains_any(F.col("_text"), OTHER_BLANKS), F.split("_text", r"\s"))
                           .otherwise(F.split("_text", " ")).alias("_words"))
    no_word = F.array(F.lit(None).cast("string"))
    placed = split.select("*", F.posexplode(F.coalesce(F.concat("_words", no_word), no_word)).alias("_at", "_raw"))
    word = lambda raw: F.btrim(raw, F.lit(MARKS))
    tokens = placed.select(*keys, "emphasis", word(F.col("_raw")).alias("word"), *[
        word(F.get("_words", F.col("_at") - d)).alias(f"w{d}") for d in range(1, REACH + 1)])
    known = word_join(tokens, lexicon.select("word", F.col("valence").cast("decimal(8,6)").alias("valence")), "word")
    known = known.where(F.col("valence").isNotNull() | F.col("word").isNull())
    strength = _decimal("0").cast("decimal(12,8)")
    turns = F.lit(0)
    for distance in range(1, REACH + 1):
        before = F.col(f"w{distance}")
        strength = strength + (_boost(before, boosters) * F.lit(DAMPING[distance - 1]).cast("decimal(3,2)")).cast("decimal(12,8)")
        turns = turns + F.when(before.isin(*negators), 1).otherwise(0)
    sign = F.when(F.col("valence") < 0, -1).otherwise(1)
    factor = F.coalesce(*[F.when(turns == n, F.lit(str(round((-0.74) ** n, 6))).cast("decimal(8,6)")) for n in range(REACH + 1)])
    value = (F.col("valence") + sign * strength).cast("decimal(12,8)")
    score = F.when(F.col("valence").isNotNull(), (value * factor).cast("decimal(18,12)"))
    return known.select(*keys, "emphasis", score.alias("score"))


def _compound(texts: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame, negators: Sequence[str],
              boosters: Mapping[str, str]) -> DataFrame:
    """``keys``, ``compound_score``, ``sentiment_label`` of every text, both NULL for a NULL text.

    Tokens are joined to the lexicon where the text is read and summed per text
    before the shuffle, so what moves is one row per text.
    """
    scores = token_scores(texts, keys, text, lexicon, negators, boosters)
    summed = scores.groupBy(*keys).agg(F.coalesce(F.sum("score"), F.lit(0)).cast("decimal(30,12)").alias("s"),
                                       F.max("emphasis").alias("emphasis"))
    total = (F.col("s") + F.signum(F.col("s")).cast("decimal(2,0)") * F.col("emphasis")).cast("double")
    compound = F.round(total / F.sqrt(total * total + NORMALISER), 4).cast("decimal(6,4)")
    return summed.select(*keys, compound.alias("compound_score")).withColumn(
        "sentiment_label", sentiment_label("compound_score"))


def compound_scores(texts: DataFrame, key: str, text: str, lexicon: DataFrame, negators: Sequence[str] = NEGATORS,
                    boosters: Mapping[str, str] = BOOSTERS) -> DataFrame:
    """``key``, ``compound_score``, ``sentiment_label`` of every text that is not NULL."""
    # no filter on the text: it would be cleaned once more for the test
    return _compound(texts, [key], text, lexicon, negators, boosters).where(F.col("compound_score").isNotNull())


def score_reviews(scores: DataFrame, lexicon: DataFrame, force: bool = False, negators: Sequence[str] = NEGATORS,
                  boosters: Mapping[str, str] = BOOSTERS, key: str = "review_id") -> DataFrame:
    """New scores for the reviews with text, by ``key``; those already scored are left alone unless forced."""
    todo = scores.where(F.col("review_comment_message").isNotNull())
    if not force:
        todo = todo.where(F.col("compound_score").isNull())
    texts = todo.select(key, cleaned("review_comment_message").alias("text"))
    return compound_scores(texts, key, "text", lexicon, negators, boosters)


def score_raw_reviews(reviews: DataFrame, lexicon: DataFrame, negators: Sequence[str] = NEGATORS,
                      boosters: Mapping[str, str] = BOOSTERS) -> DataFrame:
    """Raw reviews with scores, and a word in the place of each text: 'text', or '' for a blank one.

    Texts are scored where they are read and none is shuffled; ids may repeat, as rows are numbered. A review without an id gets no score.
    """
    message = F.col("review_comment_message")
    body = blank_to_null("review_comment_message")
    marker = F.when(F.trim(message) != "", "text").when(message.isNotNull(), "")
    heads = [c for c in reviews.columns if c != "review_comment_message"]
    rows = reviews.select(*heads, marker.alias("review_comment_message"), F.monotonically_increasing_id().alias("_row"),
                          cleaned(F.when(F.col("review_id").isNotNull(), body)).alias("_body"))
    return _compound(rows, [*heads, "review_comment_message", "_row"], "_body", lexicon, negators, boosters).drop("_row")


def customer_sentiment(scores: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Mean score per customer; texts without a score do not count."""
    return scores.where(F.col("compound_score").isNotNull()).groupBy(key).agg(
        mean_of("compound_score", 4, 4).cast("decimal(6,4)").alias("avg_sentiment_score"))
