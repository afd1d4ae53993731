"""Dashboard measures for many groupings at once: states that add up, folded by grouping sets, then the formulas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..session import materialize
from .ranking import counted_percentiles

VALUE = "clv_predicted_6m"
#: digits of the columns that are averaged
AVERAGED = {"avg_order_value": 2, "churn_probability": 4, "pct_late_deliveries": 4, "avg_delivery_delta_days": 2, "avg_review_score": 2,
            "customer_health_score": 2, VALUE: 2, "avg_sentiment_score": 4, "expected_next_purchase_days": 2}


def _states() -> dict[str, Column]:
    """What a group of customers leaves behind; each state of a union of groups is the sum of theirs, or their greatest or least."""
    kind, level = F.col("latest_action_type"), F.col("latest_action_priority")
    active = F.coalesce(kind != "MONITOR", F.lit(True))
    count = lambda condition: F.count_if(F.coalesce(condition, F.lit(False)))
    money = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("total_gmv"))), F.lit(0)).cast("decimal(24,2)")
    states = {"customers": F.count(F.lit(1)), "gmv": F.sum("total_gmv").cast("decimal(24,2)"), "freight": F.sum("total_freight_paid").cast("decimal(24,2)"),
              "churned": count(F.col("is_churned") == 1), "risky": count(F.col("churn_probability") >= fx.HIGH_CHURN_PROBABILITY),
              "high": count(level == "HIGH"), "med": count(level == "MED"), "low": count(level == "LOW"), "active": count(active),
              "retention": count(kind == "RETENTION_CAMPAIGN"), "reactivation": count(kind == "REACTIVATION"), "monitor": count(kind == "MONITOR"),
              "gmv_active": money(active), "gmv_retention": money(kind == "RETENTION_CAMPAIGN"), "gmv_reactivation": money(kind == "REACTIVATION")}
    for name, digits in AVERAGED.items():
        value = F.col(name).cast(f"decimal(20,{digits})")
        states |= {f"n_{name}": F.count(value), f"s_{name}": F.sum(value).cast(f"decimal(28,{digits})")}
    return states | {"max_value": F.max(VALUE), "min_days": F.min("expected_next_purchase_days"), "max_as_of": F.max("as_of_date")}


def _folded() -> list[Column]:
    return [(F.max(n) if n.startswith("max_") else F.min(n) if n.startswith("min_") else F.sum(n)).alias(n) for n in _states()]


def _mean(name: str) -> Column:
    digits = AVERAGED[name]
    whole = F.nullif(F.col(f"n_{name}"), F.lit(0)).cast("decimal(12,0)")
    return (F.col(f"s_{name}").cast(f"decimal(24,{digits})") / whole).cast(f"decimal(18,{digits})")


def _rate(part: str, whole: str = "customers") -> Column:
    return F.coalesce(fx.ratio(part, whole, 4), F.lit(0))


def _measures() -> dict[str, Column]:
    return {
        "total_customers": F.col("customers"), "total_gmv": F.col("gmv"), "avg_order_value": _mean("avg_order_value"),
        "total_freight_paid": F.col("freight"), "freight_ratio": fx.share("freight", "gmv"),
        "avg_gmv_per_customer": F.coalesce(fx.ratio("gmv", "customers", 2), F.lit(0)), "as_of_date": F.col("max_as_of"),
        "churned_customers": F.col("churned"), "churn_rate": _rate("churned"), "avg_churn_probability": _mean("churn_probability"),
        "high_churn_customers": F.col("risky"), "high_churn_rate": _rate("risky"), "avg_pct_late": _mean("pct_late_deliveries"),
        "avg_delivery_delta": _mean("avg_delivery_delta_days"), "avg_review_score": _mean("avg_review_score"),
        "avg_health_score": _mean("customer_health_score"),
        "high_priority": F.col("high"), "med_priority": F.col("med"), "low_priority": F.col("low"), "actionable_customers": F.col("active"),
        "actionable_pct": _rate("active"), "flagged_gmv": F.col("gmv_active"), "retention_gmv": F.col("gmv_retention"),
        "reactivation_gmv": F.col("gmv_reactivation"), "retention_count": F.col("retention"), "reactivation_count": F.col("reactivation"),
        "monitor_count": F.col("monitor"),
        "clv_with_prediction": F.col(f"n_{VALUE}"), "clv_coverage_pct": _rate(f"n_{VALUE}"), "avg_clv": _mean(VALUE),
        "max_clv": F.col("max_value"), "total_clv": F.col(f"s_{VALUE}"),
        "customers_scored": F.col("n_avg_sentiment_score"), "avg_sentiment": _mean("avg_sentiment_score"),
        "with_prediction": F.col("n_expected_next_purchase_days"), "avg_next_purchase_days": _mean("expected_next_purchase_days"),
        "min_next_purchase_days": F.col("min_days")}


def measures_by(health: DataFrame, groupings: Sequence[Sequence[str]], percentiles: dict[str, str] | None = None) -> DataFrame:
    """All measures of the customer table for every grouping, each a list of columns, from one scan.

    ``level`` names the grouping (``all`` for none); columns that it leaves out are NULL, and ``level`` tells them from groups of
    NULL. The scan leaves states per finest group and predicted value, which are stored. Grouping sets add them up per grouping; medians
    and other exact percentiles come from how often each value occurs in each group.
    """
    percentiles = {"median_clv": "0.5", "p90_clv": "0.9"} if percentiles is None else percentiles
    columns = list(dict.fromkeys(c for g in groupings for c in g))
    if not columns:
        return _national(health, percentiles)
    cells = materialize(health.groupBy(*columns, VALUE).agg(*[s.alias(n) for n, s in _states().items()]), "measure-cells")
    out = F.grouping_id()
    # bit by bit from the first column: one where the grouping leaves it out
    names = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in g): ",".join(g) or "all" for g in groupings}
    level = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("out").cast("int"))
    folded = cells.groupingSets([[F.col(c) for c in g] for g in groupings], *columns).agg(out.alias("out"), *_folded())
    counted = (cells.where(F.col(VALUE).isNotNull()).groupingSets([[*map(F.col, g), F.col(VALUE)] for g in groupings], *columns, VALUE)
               .agg(out.alias("out"), F.sum("customers").alias("n")).withColumn("out", F.shiftright("out", 1)))
    # a group is a struct, as NULL groups and left-out columns must not meet
    group = F.struct(level.alias("level"), *columns).alias("grp")
    known = counted.select(group, F.col(VALUE).alias("value"), "n")
    points = counted_percentiles(known, "value", "n", percentiles, ["grp"])
    rounded = [F.round(p, 4).alias(p) for p in percentiles]
    rows = folded.select(group, *[m.alias(n) for n, m in _measures().items()])
    return rows.join(points.select("grp", *rounded), "grp", "left").select("grp.*", *_measures(), *percentiles)


def _national(health: DataFrame, percentiles: dict[str, str]) -> DataFrame:
    return measures_by(health.withColumn("everyone", F.lit(1)), [["everyone"]], percentiles).withColumn("level", F.lit("all")).drop("everyone")
