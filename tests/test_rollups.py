"""Measures for many groupings at once against one grouping at a time."""

import datetime

from pyspark.sql import functions as F

from patronage.operators import measures, rollups


def customers(spark):
    """States and segments with NULLs, so that a NULL group and a left-out column have to be told apart."""
    k = F.col("id")
    return spark.range(200).select(
        k, F.when(k % 5 != 0, F.concat(F.lit("s"), k % 3)).alias("customer_state"), F.when(k % 7 != 0, F.concat(F.lit("g"), k % 2)).alias("rfm_segment"),
        (k * 3).cast("decimal(14,2)").alias("total_gmv"), (k / 4).cast("decimal(14,2)").alias("total_freight_paid"),
        (k % 13).cast("decimal(14,2)").alias("avg_order_value"), F.lit(datetime.date(2020, 1, 1)).alias("as_of_date"), (k % 2).cast("int").alias("is_churned"),
        F.when(k % 6 != 0, (k % 10) / 10).cast("decimal(6,4)").alias("churn_probability"), F.lit(0.25).cast("decimal(6,4)").alias("pct_late_deliveries"),
        (k % 9 - 4).cast("decimal(8,2)").alias("avg_delivery_delta_days"), (k % 5 + 1).cast("decimal(4,2)").alias("avg_review_score"),
        (k % 101).cast("decimal(6,2)").alias("customer_health_score"), F.when(k % 4 != 0, k % 17).cast("decimal(14,2)").alias("clv_predicted_6m"),
        F.when(k % 3 != 0, 0.5).cast("decimal(6,4)").alias("avg_sentiment_score"), F.when(k % 2 != 0, k).cast("decimal(10,1)").alias("expected_next_purchase_days"),
        F.when(k % 8 == 0, None).when(k % 3 == 0, "RETENTION_CAMPAIGN").when(k % 3 == 1, "MONITOR").otherwise("REACTIVATION").alias("latest_action_type"),
        F.when(k % 3 == 0, "HIGH").when(k % 3 == 1, "LOW").otherwise("MED").alias("latest_action_priority"))


def test_every_grouping_equals_its_own_aggregation(spark):
    health = customers(spark)
    groupings = [[], ["customer_state"], ["rfm_segment"], ["customer_state", "rfm_segment"]]
    found = rollups.measures_by(health, groupings).cache()
    for by in groupings:
        rows = {tuple(r[c] for c in by): r for r in found.where(F.col("level") == (",".join(by) or "all")).collect()}
        for build in (measures.portfolio, measures.churn, measures.actions, measures.clv, measures.customer_sentiment, measures.next_purchase):
            one = build(health, by)
            if by:  # the single measures join their percentiles on the group, which a NULL group does not survive
                one = one.where(" and ".join(f"{c} is not null" for c in by))
            for r in one.collect():
                own = rows[tuple(r[c] for c in by)]
                assert {c: own[c] for c in one.columns} == r.asDict(), (by, build.__name__)
        assert len(rows) == health.select(*by, F.lit(1)).distinct().count()
    assert rollups.measures_by(health, [[]]).count() == 1
    assert rollups.measures_by(health.limit(0), groupings).where("level <> 'all'").count() == 0


def test_the_table_is_scanned_once(spark, tmp_path):
    customers(spark).write.parquet(str(tmp_path / "health"))
    plan = rollups.measures_by(spark.read.parquet(str(tmp_path / "health")), [[], ["customer_state"]])._jdf.queryExecution().optimizedPlan().toString()
    # the plan starts at the stored states, so the table itself was read before, in the one job that wrote them
    assert "latest_action_priority" not in plan
