"""Queries over texts: cleaning and lexicon sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cleaned
from ..operators import sentiment
from ..oracle import cleaned as cleaned_sql
from ..oracle import mean
from ..session import spread
from ..sources.sample_tables import SAMPLE_BOOSTERS, SAMPLE_NEGATORS, SampleTables
from .registry import register
from .store import raw_review_scores

register("cleaned_documents", "doc_id:i cleaned:s", f"SELECT doc_id, {cleaned_sql('text')} AS cleaned FROM documents")(
    lambda t: spread(t.read("documents")).select("doc_id", cleaned("text").alias("cleaned")))

register("cleaned_pages", "page_id:i cleaned:s", f"SELECT page_id, {cleaned_sql('html')} AS cleaned FROM pages")(
    lambda t: spread(t.read("pages")).select("page_id", cleaned("html").alias("cleaned")))

register("cleaned_conversations", "conv_id:i turn:i cleaned:s",
         f"SELECT conv_id, turn, {cleaned_sql('text')} AS cleaned FROM conversations")(
    lambda t: spread(t.read("conversations")).select("conv_id", "turn", cleaned("text").alias("cleaned")))

LABEL_SQL = """CASE WHEN compound_score >= 0.05 THEN 'positive' WHEN compound_score <= -0.05 THEN 'negative' ELSE 'neutral' END"""
DOC_SCORES_SQL = "d_scores"

register("document_sentiment", "doc_id:i compound_score:d sentiment_label:s",
         f"SELECT *, {LABEL_SQL} AS sentiment_label FROM {DOC_SCORES_SQL}")(
    lambda t: sentiment.compound_scores(spread(t.read("documents")).select("doc_id", cleaned("text").alias("body")), "doc_id", "body",
                                        t.lexicon, SAMPLE_NEGATORS, SAMPLE_BOOSTERS))


def review_scores(t: SampleTables) -> DataFrame:
    return raw_review_scores(t).where(F.col("compound_score").isNotNull()).select(
        "review_id", "customer_unique_id", "compound_score", "sentiment_label")


REVIEW_SCORES_SQL = f"""(SELECT review_id, customer_unique_id, compound_score, {LABEL_SQL} AS sentiment_label
FROM s_reviews JOIN {DOC_SCORES_SQL} USING (doc_id))"""

register("review_sentiment", "review_id:s customer_unique_id:s compound_score:d sentiment_label:s",
         f"SELECT * FROM {REVIEW_SCORES_SQL}")(review_scores)

register("customer_sentiment", "customer_unique_id:s avg_sentiment_score:d",
         f"SELECT customer_unique_id, {mean('compound_score', 4, 4)} AS avg_sentiment_score FROM {REVIEW_SCORES_SQL} GROUP BY 1")(
    lambda t: sentiment.customer_sentiment(review_scores(t)))

register("sentiment_labels", "sentiment_label:s n:i",
         f"SELECT sentiment_label, count(*) AS n FROM {REVIEW_SCORES_SQL} GROUP BY 1")(
    lambda t: review_scores(t).groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n")))
