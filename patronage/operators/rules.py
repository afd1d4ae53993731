"""First-match rules: customer segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rfm_segment(recency="recency_score", frequency="frequency_score", monetary="monetary_score") -> Column:
    r, f, m = F.col(recency), F.col(frequency), F.col(monetary)
    return (F.when((r == 5) & (f >= 4) & (m >= 4), "Champions")
            .when((r >= 4) & (f >= 3) & (m >= 3), "Loyal")
            .when((r >= 4) & (f < 3), "Potential Loyalist")
            .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
            .when((r <= 2) & (m >= 4), "Can't Lose")
            .when((r == 1) & (f == 1) & (m == 1), "Lost")
            .when((r <= 2) & (f <= 2), "Hibernating")
            .when((f >= 3) & (m <= 2), "Frequent Low-Spender")
            .when(r == 3, "Needs Attention")
            .otherwise(F.raise_error(F.concat(F.lit("no segment for scores "),
                                              F.concat_ws("", *[c.cast("string") for c in (r, f, m)])))))


def with_segment(rfm: DataFrame) -> DataFrame:
    return rfm.withColumn("rfm_segment", rfm_segment())
