"""Marts stored once per state of the input files; views and dashboards read the stored tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.actions import assign_actions
from ..operators.sentiment import score_raw_reviews
from ..plans import gold, scoring, silver, views
from ..plans.runs import fingerprint, reused
from ..session import materialize
from ..sources.files import add_nullable, write_back
from ..sources.sample_tables import ML_CUTOFF, SAMPLE_BOOSTERS, SAMPLE_NEGATORS, SampleTables
from . import marts as m

PERSON = "customer_unique_id"
RUN_TIME = "2001-08-02 00:00:00"


@dataclass(frozen=True)
class Marts:
    profile: DataFrame
    rfm: DataFrame
    clv: DataFrame
    queue: DataFrame
    constants: DataFrame

    @property
    def health(self) -> DataFrame:
        return views.customer_health(self.profile, self.rfm, self.clv, self.queue, self.constants)


def build_marts(t: SampleTables) -> Marts:
    """All marts from the raw tables, with the stand-in scores written back and the actions assigned."""
    f = m.facts(t)
    made = gold.build_gold(f, t.items, m.products_dim(t), ML_CUTOFF)
    scores = t.customer_scores()
    profile = made.customer_360
    for name, kind in (("churn_probability", "decimal(6,4)"), ("avg_sentiment_score", "decimal(6,4)"),
                       ("expected_next_purchase_days", "decimal(10,1)")):
        profile = add_nullable(profile, name, kind)
    profile = materialize(write_back(profile, scores.select(
        PERSON, "churn_probability", "avg_sentiment_score", "expected_next_purchase_days"), PERSON), "customer-360")
    rfm = materialize(write_back(m.with_segment(made.rfm_features), scores.select(PERSON, "km_cluster"), PERSON), "rfm")
    clv = materialize(write_back(made.clv_features, scores.select(
        PERSON, "clv_predicted_6m", "clv_ci_lower", "clv_ci_upper"), PERSON), "clv")
    inputs = profile.select(PERSON, "churn_probability", "is_churned", "health_tier").join(
        rfm.select(PERSON, "rfm_segment"), PERSON).join(clv.select(PERSON, "clv_predicted_6m"), PERSON)
    queue = materialize(assign_actions(inputs, created_at=RUN_TIME), "action-queue")
    return Marts(profile, rfm, clv, queue, materialize(made.run_constants, "run-constants"))


def inputs_key(t: SampleTables) -> str:
    return fingerprint(t.spark, t.path)


def stored_marts(t: SampleTables) -> Marts:
    """The marts of the input files as they are now."""
    names = [f.name for f in fields(Marts)]

    def build() -> dict[str, DataFrame]:
        made = build_marts(t)
        return {n: getattr(made, n) for n in names}

    tables = reused(t.spark, "marts", inputs_key(t), build)
    return Marts(**{n: tables[n] for n in names})


def raw_review_scores(t: SampleTables) -> DataFrame:
    """The review table with the lexicon scores of its texts, which are scored before the rows are chosen and go no further."""
    raw = materialize(score_raw_reviews(t.dealt_reviews, t.lexicon, SAMPLE_NEGATORS, SAMPLE_BOOSTERS), "raw-review-scores")
    return gold.sentiment_skeleton(silver.dim_review(raw, t.orders, t.customers, ("compound_score", "sentiment_label")))


def scored_reviews(t: SampleTables) -> DataFrame:
    """Reviews with the lexicon scores of their texts; of a text itself only that there is one."""
    return reused(t.spark, "scored-reviews", inputs_key(t), lambda: {"reviews": raw_review_scores(t)})["reviews"]


def scored_dimension(t: SampleTables, heads: DataFrame, texts: DataFrame) -> DataFrame:
    """The same from a stored review dimension, whose texts are scored where they are stored and meet its rows by their number."""
    rows = gold.sentiment_skeleton(silver.marked_reviews(heads), ("text_row",))
    # a review without an id gets no score
    todo = texts.where(F.col("review_id").isNotNull()).withColumn("compound_score", F.lit(None).cast("decimal(6,4)"))
    return materialize(scoring.scored_sentiment(rows, t.lexicon, todo, key="text_row", negators=SAMPLE_NEGATORS, boosters=SAMPLE_BOOSTERS)
                       .drop("text_row"), "scored-reviews")
