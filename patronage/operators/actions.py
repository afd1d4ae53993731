"""One action per customer from ordered rules, its reason, and the run log."""

from __future__ import annotations

import copy
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import Order, average_rank_percentile, global_positions

PERSON = "customer_unique_id"

# fixed values
ACTION_TYPES = ("RETENTION_CAMPAIGN", "REACTIVATION", "VIP_UPGRADE", "MONITOR")
PRIORITIES = ("HIGH", "MED", "LOW")
DEFAULT_CONFIG = {
    "rules": {
        "RETENTION_CAMPAIGN": {
            "action_type": "RETENTION_CAMPAIGN",
            "conditions": {"churn_probability_gte": 0.6, "clv_percentile_gte": 50},
            "priority": "HIGH",
            "enabled": True,
        },
        "REACTIVATION": {
            "action_type": "REACTIVATION",
            "conditions": {"churn_probability_gte": 0.6, "clv_percentile_lt": 50},
            "priority": "MED",
            "enabled": True,
        },
        "VIP_UPGRADE": {
            "action_type": "VIP_UPGRADE",
            "conditions": {"rfm_segment_in": ["Champions"], "clv_percentile_gte": 90},
            "priority": "MED",
            "enabled": True,
        },
        "MONITOR": {"action_type": "MONITOR", "conditions": {}, "priority": "LOW", "enabled": True},
    },
    "evaluation_order": ["RETENTION_CAMPAIGN", "REACTIVATION", "VIP_UPGRADE", "MONITOR"],
    "write_mode": "TRUNCATE_INSERT",
    "audit": {"write_run_log": True},
}
CATCH_ALL = "MONITOR"


def validate_config(config: dict) -> dict:
    """Raise on a rule set that could leave a customer without an action."""
    missing = {"rules", "evaluation_order", "write_mode", "audit"} - set(config)
    if missing:
        raise ValueError(f"missing keys: {sorted(missing)}")
    order = config["evaluation_order"]
    unknown = [name for name in order if name not in config["rules"]]
    if unknown:
        raise ValueError(f"evaluation_order names unknown rules: {unknown}")
    if not order or order[-1] != CATCH_ALL or CATCH_ALL in order[:-1]:
        raise ValueError(f"{CATCH_ALL} must be the last rule")
    wrong = {name: rule.get("action_type", name) for name, rule in config["rules"].items()
             if rule.get("action_type", name) not in ACTION_TYPES}
    if wrong:
        raise ValueError(f"unknown action types: {wrong}")
    return config


def with_overrides(config: dict, churn_threshold: float | None = None, clv_percentile: float | None = None,
                   vip_percentile: float | None = None) -> dict:
    """A copy with other thresholds; None leaves a threshold as it is, 0 does not."""
    config = copy.deepcopy(config)
    changes = [(name, prefix, value) for name in ("RETENTION_CAMPAIGN", "REACTIVATION")
               for prefix, value in (("churn_probability_", churn_threshold), ("clv_percentile_", clv_percentile))]
    changes.append(("VIP_UPGRADE", "clv_percentile_gte", vip_percentile))
    for name, prefix, value in changes:
        conditions = config["rules"].get(name, {}).get("conditions", {})
        for key in conditions:
            if value is not None and key.startswith(prefix):
                conditions[key] = value
    return config


def thresholds(config: dict) -> dict[str, float]:
    def condition(rule: str, key: str, default: float) -> float:
        return config["rules"].get(rule, {}).get("conditions", {}).get(key, default)

    return {"churn_threshold": condition("RETENTION_CAMPAIGN", "churn_probability_gte", 0.6),
            "clv_percentile": condition("RETENTION_CAMPAIGN", "clv_percentile_gte", 50),
            "vip_percentile": condition("VIP_UPGRADE", "clv_percentile_gte", 90)}


def clv_percentiles(customers: DataFrame) -> DataFrame:
    """Percentile 0..100 of predicted value among customers that have one; 0 for the others."""
    places = global_positions(customers, [PERSON], {"clv": Order(F.col("clv_predicted_6m"), nulls="skip")})
    return (customers.join(places, PERSON, "left").withColumn("clv_percentile", average_rank_percentile("clv"))
            .drop("clv_row", "clv_rank", "clv_ties", "clv_total"))


def rule_condition(rule: dict) -> Column:
    """All conditions of a rule; a missing churn probability meets none on churn."""
    tests = {
        "churn_probability_gte": lambda v: F.col("churn_probability") >= v,
        "churn_probability_lt": lambda v: F.col("churn_probability") < v,
        "clv_percentile_gte": lambda v: F.col("clv_percentile") >= v,
        "clv_percentile_lt": lambda v: F.col("clv_percentile") < v,
        "rfm_segment_in": lambda v: F.col("rfm_segment").isin(*v),
        "is_churned": lambda v: F.col("is_churned") == int(v),
    }
    met = F.lit(True)
    for key, value in rule.get("conditions", {}).items():
        met = met & F.coalesce(tests[key](value), F.lit(False))
    return met


def _number(value: Column, digits: int) -> Column:
    return F.translate(F.format_number(value.cast("double"), digits), ",", "")


def trigger_reason(name: str, rule: dict, churn_threshold: float) -> Column:
    """Why the rule fired, with the customer's values."""
    conditions = rule.get("conditions", {})
    churn = F.coalesce(_number(F.col("churn_probability"), 3), F.lit("N/A"))
    clv = F.coalesce(F.concat(F.lit("R$"), _number(F.col("clv_predicted_6m"), 2)), F.lit("NULL"))
    place = F.concat(_number(F.col("clv_percentile"), 0), F.lit("th pct"))
    segment = F.coalesce("rfm_segment", F.lit("unknown"))
    health = F.coalesce("health_tier", F.lit("unknown"))
    risk = [F.lit("Churn risk "), churn, F.lit(f" ≥ {churn_threshold:.2f}; CLV "), clv, F.lit(" at "), place]
    # fixed wording of the reasons
    if name == "RETENTION_CAMPAIGN":
        parts = [*risk, F.lit(f" (≥ {conditions.get('clv_percentile_gte', 50)}th) — "
                              "high-value customer, premium retention warranted")]
    elif name == "REACTIVATION":
        parts = [*risk, F.lit(f" (< {conditions.get('clv_percentile_lt', 50)}th) — "
                              "lower-value at-risk, cost-efficient reactivation")]
    elif name == "VIP_UPGRADE":
        parts = [F.lit("Segment: "), segment, F.lit(f" (in {conditions.get('rfm_segment_in', [])}); CLV "), clv,
                 F.lit(" at "), place, F.lit(f" (≥ {conditions.get('clv_percentile_gte', 90)}th) — "
                                             "VIP candidate for loyalty programme or account manager")]
    elif name == "MONITOR":
        parts = [F.lit("No high-priority conditions met — churn="), churn, F.lit(", segment="), segment,
                 F.lit(", CLV "), clv, F.lit(" at "), place, F.lit(", health="), health]
    else:
        parts = [F.lit(f"Rule '{name}' matched — churn="), churn, F.lit(", segment="), segment, F.lit(", CLV "), clv,
                 F.lit(" at "), place]
    return F.concat(*parts)


def assign_actions(customers: DataFrame, config: dict | None = None, created_at: str | None = None) -> DataFrame:
    """First matching rule per customer, as one expression. A customer without a rule fails the job."""
    config = validate_config(config or DEFAULT_CONFIG)
    limit = thresholds(config)["churn_threshold"]
    ranked = customers if "clv_percentile" in customers.columns else clv_percentiles(customers)
    chosen = None
    for name in config["evaluation_order"]:
        rule = config["rules"][name]
        if not rule.get("enabled", True):
            continue
        outcome = F.struct(F.lit(rule.get("action_type", name)).alias("action_type"),
                           F.lit(rule["priority"]).alias("priority"),
                           trigger_reason(name, rule, limit).alias("trigger_reason"))
        matched = rule_condition(rule)
        chosen = F.when(matched, outcome) if chosen is None else chosen.when(matched, outcome)
    unmatched = F.raise_error(F.concat(F.lit("no rule matches customer "), F.col(PERSON)))
    moment = F.lit(created_at).cast("timestamp_ntz") if created_at else F.localtimestamp()
    chosen = unmatched if chosen is None else chosen.otherwise(unmatched)
    return ranked.withColumn("_action", chosen).select(
        PERSON, "_action.action_type", "_action.priority", "churn_probability",
        F.col("clv_predicted_6m").alias("clv_predicted"), "_action.trigger_reason", moment.alias("created_at"))


def run_log(queue: DataFrame, customers_in: DataFrame, config: dict | None = None, dry_run: bool = False,
            run_by: str | None = None, version: str = "1") -> DataFrame:
    """One summary row of a run, to be appended to the history, dry runs included."""
    config = config or DEFAULT_CONFIG
    used = thresholds(config)
    counts = [F.count_if(F.col("action_type") == kind).alias(f"n_{kind.lower()}") for kind in ACTION_TYPES]
    counts += [F.count_if(F.col("priority") == level).alias(f"n_priority_{level.lower()}") for level in PRIORITIES]
    rows_in = customers_in.agg(F.count(F.lit(1)).alias("n_customers_in"))
    log = queue.agg(*counts, F.count(F.lit(1)).alias("n_total")).crossJoin(F.broadcast(rows_in))
    return log.select(
        F.localtimestamp().alias("run_timestamp"), F.lit(run_by).cast("string").alias("run_by"),
        F.lit(version).alias("script_version"),
        *[F.lit(float(value)).alias(f"{name}_used") for name, value in used.items()],
        F.lit("DRY_RUN" if dry_run else config["write_mode"]).alias("write_mode"), "*",
        (F.col("n_customers_in") - F.col("n_total")).alias("n_customers_unmatched"),
        F.lit(json.dumps(config["rules"], ensure_ascii=False)).alias("config_snapshot"),
        F.lit("dry run, queue not modified" if dry_run else None).cast("string").alias("run_notes"))


def latest_actions(queue: DataFrame) -> DataFrame:
    """The newest action per customer, from a queue that may hold history."""
    newest = F.max_by(F.struct("action_type", "priority", "trigger_reason", "created_at"),
                      F.struct("created_at", "action_type"))
    return queue.groupBy(PERSON).agg(newest.alias("_a")).select(
        PERSON, F.col("_a.action_type").alias("latest_action_type"), F.col("_a.priority").alias("latest_action_priority"),
        F.col("_a.trigger_reason").alias("latest_action_reason"), F.col("_a.created_at").alias("latest_action_date"))


def rule_validation(queue: DataFrame, median_clv: DataFrame, churn_threshold: float = 0.6) -> DataFrame:
    """Per action, how many of its customers meet the conditions its name promises."""
    rows = queue.crossJoin(F.broadcast(median_clv.select("median_clv")))
    high_churn = F.coalesce(F.col("churn_probability") >= churn_threshold, F.lit(False))
    low_churn = F.coalesce(F.col("churn_probability") < churn_threshold, F.lit(False))
    above = F.coalesce(F.col("clv_predicted") > F.col("median_clv"), F.lit(False))
    upto = F.coalesce(F.col("clv_predicted") <= F.col("median_clv"), F.lit(False))
    both = (F.when(F.col("action_type") == "RETENTION_CAMPAIGN", high_churn & above)
            .when(F.col("action_type") == "REACTIVATION", high_churn & upto)
            .when(F.col("action_type") == "MONITOR", low_churn | upto))
    return rows.groupBy("action_type").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(high_churn).alias("high_churn"),
        F.count_if(low_churn).alias("low_churn"), F.count_if(above).alias("above_median"),
        F.count_if(upto).alias("upto_median"), F.count_if(both).alias("expected"))


def threshold_grid(start: float = 0.2, stop: float = 0.9, step: float = 0.05) -> list[float]:
    count = round((stop - start) / step) + 1
    return [round(start + step * i, 4) for i in range(count)]


def threshold_sweep(health: DataFrame, median_clv: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """Customers, split and GMV that each churn threshold would flag, and the change against the stored actions.

    Customers are first counted per probability (four digits, so at most 10,001 values).
    """
    spark = health.sparkSession
    valued = F.coalesce(F.col("clv_predicted_6m") >= F.col("median_clv"), F.lit(False))
    cells = (health.crossJoin(F.broadcast(median_clv.select("median_clv")))
             .where(F.col("churn_probability").isNotNull())
             .groupBy(F.col("churn_probability").cast("decimal(6,4)").alias("p"), valued.alias("valued"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("total_gmv").alias("gmv")))
    current = health.agg(F.count_if(F.coalesce(F.col("latest_action_type") != CATCH_ALL, F.lit(True))).alias("now"))
    steps = spark.createDataFrame([(str(g),) for g in grid or threshold_grid()], "t string").select(
        F.col("t").cast("decimal(6,4)").alias("threshold"))
    flagged = F.col("p") >= F.col("threshold")
    swept = (steps.crossJoin(cells).groupBy("threshold").agg(
        F.coalesce(F.sum(F.when(flagged, F.col("n"))), F.lit(0)).alias("actionable"),
        F.coalesce(F.sum(F.when(flagged & F.col("valued"), F.col("n"))), F.lit(0)).alias("retention"),
        F.coalesce(F.sum(F.when(flagged & ~F.col("valued"), F.col("n"))), F.lit(0)).alias("reactivation"),
        F.coalesce(F.sum(F.when(flagged, F.col("gmv"))), F.lit(0)).alias("flagged_gmv")))
    return (swept.crossJoin(F.broadcast(current))
            .withColumn("delta_actionable", F.col("actionable") - F.col("now")).drop("now"))
