import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import actions, history, modelling, survival
from patronage.operators.joins import hot_keys, lookup_join
from patronage.operators.rules import rfm_segment
from patronage.plans import gold, silver

DAY = dt.date


def test_lookup_join_with_hot_and_missing_keys(spark):
    facts = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None)
                                     .otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("k"))
    dim = spark.range(150).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("x"))
    dim = dim.unionByName(spark.createDataFrame([("hot", 999)], "k string, x bigint"))
    for how in ("left", "inner"):
        found, expected = lookup_join(facts, dim, "k", how), facts.join(dim, "k", how).select("id", "k", "x")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_hot_keys_of_several_columns(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("a"),
                                    F.when(F.col("id") % 5 > 0, F.lit("x")).alias("b"))
    for frame, expected in ((rows, (["7"], ["x"])), (rows.limit(0), ([], []))):
        found = spark.range(1).select(hot_keys(frame, ["a", "b"]).alias("hot")).first()["hot"]
        assert (found["a"], found["b"]) == expected


def test_fact_order_items_reads_each_table_once(spark, sample):
    from patronage.queries import queries

    plan = queries()["fact_order_items"](spark, sample.path)._jdf.queryExecution().optimizedPlan()
    names = [line.split("parquet")[0] for line in plan.toString().splitlines() if "Relation [" in line]
    # the lines once more for their hot keys, in the subquery that both lookups name
    for key in ("o_orderkey", "p_partkey", "s_suppkey", "c_custkey"):
        assert sum(f"[{key}#" in n or f",{key}#" in n for n in names) == 1, key


# -- versions ------------------------------------------------------------------

SNAPSHOT = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"


def snapshot(spark, *rows):
    return spark.createDataFrame([(f"c{p}", p, z, c, s) for p, z, c, s in rows], SNAPSHOT)


def as_rows(dim):
    return sorted((r["customer_unique_id"], r["customer_city"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"])
                  for r in dim.collect())


def test_versions_close_open_and_stay(spark):
    first = history.first_versions(snapshot(spark, ("a", "1", "x", "S"), ("b", "1", "x", "S"), ("gone", "1", "x", "S")), "2020-01-01")
    changed = snapshot(spark, ("a", "1", "y", "S"), ("b", "1", "x", "S"), ("new", "1", "z", "S"))
    second = history.scd2_merge(first, changed, "2020-02-01")
    expected = [("a", "x", "2020-01-01", "2020-02-01", 0), ("a", "y", "2020-02-01", "None", 1),
                ("b", "x", "2020-01-01", "None", 1), ("gone", "x", "2020-01-01", "None", 1),
                ("new", "z", "2020-02-01", "None", 1)]
    assert as_rows(second) == expected
    assert as_rows(history.scd2_merge(second, changed, "2020-03-01")) == expected
    assert second.select("customer_sk").distinct().count() == len(expected)


def test_missing_and_empty_attributes_are_no_change(spark):
    first = history.first_versions(snapshot(spark, ("a", None, "x", "S")), "2020-01-01")
    assert history.scd2_merge(first, snapshot(spark, ("a", "", "x", "S")), "2020-02-01").count() == 1


def test_snapshot_keeps_the_highest_id(spark):
    rows = spark.createDataFrame([("c1", "a", "1", "low", "S"), ("c9", "a", "1", "high", "S")], SNAPSHOT)
    assert as_rows(history.first_versions(rows, "2020-01-01")) == [("a", "high", "2020-01-01", "None", 1)]


def test_a_same_day_change_leaves_an_empty_version(spark):
    first = history.first_versions(snapshot(spark, ("a", "1", "x", "S")), "2020-01-01")
    same_day = history.scd2_merge(first, snapshot(spark, ("a", "1", "y", "S")), "2020-01-01")
    assert as_rows(same_day) == [("a", "x", "2020-01-01", "2020-01-01", 0), ("a", "y", "2020-01-01", "None", 1)]
    assert history.overlapping_versions(same_day).count() == 0


def test_overlaps_are_found(spark):
    rows = spark.createDataFrame([("a", DAY(2020, 1, 1), DAY(2020, 3, 1)), ("a", DAY(2020, 2, 1), None),
                                  ("b", DAY(2020, 1, 1), DAY(2020, 2, 1)), ("b", DAY(2020, 2, 1), None)],
                                 "customer_unique_id string, valid_from date, valid_to date")
    assert [r[0] for r in history.overlapping_versions(rows).select("customer_unique_id").collect()] == ["a"]


def test_version_at_the_time_of_the_order(spark):
    first = history.first_versions(snapshot(spark, ("a", "1", "x", "S")), "2020-01-10")
    dim = history.scd2_merge(first, snapshot(spark, ("a", "1", "y", "S")), "2020-02-10")
    moments = {"before": "2019-12-31", "on_first": "2020-01-10", "on_second": "2020-02-10", "after": "2020-05-01", "none": None}
    orders = spark.createDataFrame([(k, "ca", v) for k, v in moments.items()] + [("stranger", "cz", "2020-01-01")],
                                   "order_id string, customer_id string, t string").select(
        "order_id", "customer_id", F.col("t").cast("timestamp_ntz").alias("t"))
    found = history.with_version_at(orders, snapshot(spark, ("a", "1", "y", "S")), dim, "t", ("customer_sk", "customer_city"))
    assert {r["order_id"]: r["customer_city"] for r in found.collect()} == {
        "before": "x", "on_first": "x", "on_second": "y", "after": "y", "none": "x"}


def test_a_stored_dimension_is_changed_in_place(spark, tmp_path):
    path = str(tmp_path / "dim")
    people = lambda city, n=40: snapshot(spark, *[(f"k{i}", "1", city if i % 4 == 0 else "x", "S") for i in range(n)])
    files = lambda: {f: (f.stat().st_mtime_ns, f.stat().st_size) for f in (tmp_path / "dim").rglob("*.parquet")}
    history.load_versions(people("x"), path, "2020-01-01")
    history.load_versions(people("y"), path, "2020-02-01")
    closed = {f: v for f, v in files().items() if "is_current=0" in str(f)}
    assert closed
    third = history.load_versions(people("z", 44), path, "2020-03-01")
    # versions closed before stay in the files they were in; only the open part is new
    assert {f: v for f, v in files().items() if f in closed} == closed
    plain = history.first_versions(people("x"), "2020-01-01")
    for city, n, day in (("y", 40, "2020-02-01"), ("z", 44, "2020-03-01")):
        plain = history.scd2_merge(plain, people(city, n), day)
    columns = plain.columns
    assert third.select(columns).exceptAll(plain).count() == 0 and third.count() == plain.count() == 40 + 10 + 10 + 4
    # the same load once more, and another change on the same day
    assert history.load_versions(people("z", 44), path, "2020-03-01").select(columns).exceptAll(plain).count() == 0
    more = history.load_versions(people("w", 44), path, "2020-03-01")
    assert more.count() == plain.count() + 11 and more.where("is_current = 1").count() == 44


def plain_version(versions, day):
    """The first version in order of (valid_from, valid_to) that covers the day, else the first."""
    ordered = sorted(versions, key=lambda v: (v[0], v[1] or "9999-12-31", v[2]))
    return next((v for v in ordered if day and v[0] <= day < (v[1] or "9999-12-31")), ordered[0])[2]


def test_version_at_equals_trying_all_versions(spark):
    """Gaps, overlaps, empty versions, days without a version, NULL days; one person with a third of the facts and 10,000 versions."""
    import datetime
    import random

    draw, start = random.Random(9), datetime.date(1990, 1, 1)
    day = lambda n: str(start + datetime.timedelta(n))
    versions = {f"p{p}": [(day(a), None if draw.random() < 0.2 else day(a + draw.randint(0, 40)), f"v{p}-{i}") for i in range(draw.randint(1, 6))
                          for a in [draw.randint(0, 100)]] for p in range(60)}
    versions["hot"] = [(day(i), day(i + 1), f"h{i}") for i in range(10_000)]
    customers = [(f"{p}#{i}", p) for p in versions for i in range(2)] + [("nobody#0", "nobody")]
    facts = [(i, draw.choice(customers)[0], draw.choice([None, day(draw.randint(-5, 140))])) for i in range(4000)]
    facts += [(10_000 + i, f"hot#{i % 2}", day(draw.randint(-100, 10_100))) for i in range(2500)] + [(20_000, "unknown", day(3)), (20_001, None, day(3))]
    dim = spark.createDataFrame([(p, *v) for p, vs in versions.items() for v in vs], "customer_unique_id string, f string, t string, customer_sk string").select(
        "customer_unique_id", F.to_date("f").alias("valid_from"), F.to_date("t").alias("valid_to"), "customer_sk")
    orders = spark.createDataFrame(facts, "id int, customer_id string, d string").withColumn("t", F.to_timestamp("d"))
    people = spark.createDataFrame(customers, "customer_id string, customer_unique_id string")
    found = history.with_version_at(orders, people, dim, "t")
    person = dict(customers)
    wanted = {i: plain_version(versions[person[c]], d) for i, c, d in facts if person.get(c) in versions}
    assert {r["id"]: r["customer_sk"] for r in found.collect()} == wanted and found.count() == len(wanted)
    # no list of versions is gathered; the only list is that of the at most 64 hot people
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "valid_from" in plan and "collect_list(struct" not in plan



# -- payments, reviews, dates --------------------------------------------------

def test_payments_of_an_order(spark):
    rows = spark.createDataFrame([("o", 2, "voucher", 1, 5.0), ("o", 1, "card", 3, 7.5), ("o", 3, "card", 2, 1.0)],
                                 "order_id string, payment_sequential int, payment_type string, payment_installments int, v double")
    one = silver.payments_per_order(rows.withColumn("payment_value", F.col("v").cast("decimal(12,2)"))).first()
    assert (float(one["total_payment_value"]), one["payment_type_primary"], one["payment_installments_max"],
            one["payment_methods_count"]) == (13.5, "card", 3, 2)


def test_an_order_with_two_reviews_counts_once(spark):
    reviews = spark.createDataFrame([("o1", "a", 1), ("o1", "a", 3), ("o2", "a", 5)],
                                    "order_id string, customer_unique_id string, review_score int")
    one = gold.customer_reviews(reviews).first()
    assert float(one["review_mean"]) == 3.5 and float(one["pct_negative_reviews"]) == 0.5


def test_hours_and_days_count_boundaries(spark):
    from patronage.functions import scalars as fx
    row = spark.createDataFrame([("2020-01-01 10:59:00", "2020-01-01 11:01:00", "2020-01-02 00:01:00")], "a string, b string, c string")
    row = row.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in "abc"])
    found = row.select(fx.hour_boundaries("a", "b"), fx.day_diff("b", "c"), fx.elapsed_days("b", "c"), fx.date_key(F.lit(None).cast("date"))).first()
    assert tuple(found) == (1, 1, 0, 19000101)


# -- rules and actions ---------------------------------------------------------

def test_every_score_combination_has_a_segment(spark):
    scores = spark.range(125).select((F.col("id") % 5 + 1).alias("recency_score"), (F.floor(F.col("id") / 5) % 5 + 1).alias("frequency_score"),
                                     (F.floor(F.col("id") / 25) + 1).alias("monetary_score"))
    labels = scores.select(rfm_segment().alias("s")).groupBy("s").count().collect()
    assert sum(r["count"] for r in labels) == 125 and len(labels) == 9 and all(r["s"] for r in labels)


def test_scores_outside_the_domain_fail(spark):
    bad = spark.createDataFrame([(3, None, 1)], "recency_score int, frequency_score int, monetary_score int")
    assert bad.select(rfm_segment()).first()[0] == "Needs Attention"
    with pytest.raises(Exception, match="no segment"):
        spark.createDataFrame([(None, 1, 5)], bad.schema).select(rfm_segment()).collect()


def customers(spark):
    rows = [("risky_rich", 0.9, 90, "Loyal"), ("risky_poor", 0.6, 10, "Lost"), ("champion", 0.1, 95, "Champions"),
            ("unknown_churn", None, 95, "Loyal"), ("no_clv", 0.7, None, "Lost")]
    return spark.createDataFrame([(n, c, None if v is None else float(v), s, 0, "High") for n, c, v, s in rows],
                                 "customer_unique_id string, churn_probability double, v double, rfm_segment string, "
                                 "is_churned int, health_tier string").select(
        "*", F.col("v").cast("decimal(14,2)").alias("clv_predicted_6m"), F.coalesce("v", F.lit(0)).alias("clv_percentile"))


def assigned(spark, config=None):
    return {r["customer_unique_id"]: r["action_type"] for r in actions.assign_actions(customers(spark), config).collect()}


def test_first_matching_rule_wins(spark):
    assert assigned(spark) == {"risky_rich": "RETENTION_CAMPAIGN", "risky_poor": "REACTIVATION", "champion": "VIP_UPGRADE",
                               "unknown_churn": "MONITOR", "no_clv": "REACTIVATION"}


def test_zero_is_a_threshold_and_disabled_rules_are_skipped(spark):
    config = actions.with_overrides(actions.DEFAULT_CONFIG, churn_threshold=0)
    assert assigned(spark, config)["champion"] == "RETENTION_CAMPAIGN"
    assert assigned(spark, config)["unknown_churn"] == "MONITOR"
    config["rules"]["RETENTION_CAMPAIGN"]["enabled"] = False
    assert assigned(spark, config)["champion"] == "VIP_UPGRADE"
    assert actions.DEFAULT_CONFIG["rules"]["RETENTION_CAMPAIGN"]["enabled"]


def test_reasons_name_the_values(spark):
    reasons = {r["customer_unique_id"]: r["trigger_reason"] for r in actions.assign_actions(customers(spark)).collect()}
    assert reasons["risky_rich"] == ("Churn risk 0.900 ≥ 0.60; CLV R$90.00 at 90th pct (≥ 50th) — "
                                     "high-value customer, premium retention warranted")
    assert reasons["unknown_churn"] == ("No high-priority conditions met — churn=N/A, segment=Loyal, CLV R$95.00 at 95th pct, "
                                        "health=High")


def test_a_customer_without_a_rule_fails(spark):
    config = actions.with_overrides(actions.DEFAULT_CONFIG)
    config["rules"]["MONITOR"]["enabled"] = False
    with pytest.raises(Exception, match="no rule matches"):
        actions.assign_actions(customers(spark), config).collect()


@pytest.mark.parametrize("change", [
    lambda c: c.pop("audit"),
    lambda c: c["evaluation_order"].reverse(),
    lambda c: c["evaluation_order"].remove("MONITOR"),
    lambda c: c["evaluation_order"].insert(0, "NO_SUCH_RULE"),
    lambda c: c["rules"]["VIP_UPGRADE"].update(action_type="GIFT"),
])
def test_broken_configs_are_refused(change):
    config = actions.with_overrides(actions.DEFAULT_CONFIG)
    change(config)
    with pytest.raises(ValueError):
        actions.validate_config(config)


# -- survival ------------------------------------------------------------------

def test_purchase_intervals(spark):
    rows = [("one", "2020-01-01 10:00:00"), ("two", "2020-01-01 10:00:00"), ("two", "2020-01-11 09:00:00"),
            ("same_day", "2020-01-01 08:00:00"), ("same_day", "2020-01-01 20:00:00"),
            ("last_day", "2020-01-01 00:00:00"), ("last_day", "2020-02-01 00:00:00")]
    orders = spark.createDataFrame(rows, "customer_unique_id string, t string").select(
        "customer_unique_id", F.col("t").cast("timestamp_ntz").alias("order_purchase_timestamp"))
    constants = spark.createDataFrame([(DAY(2020, 2, 1),)], "as_of_date date")
    found = sorted(map(tuple, survival.purchase_intervals(orders, constants).collect()))
    assert found == [("last_day", 31, 1), ("same_day", 30, 0), ("two", 9, 1), ("two", 20, 0)]


def test_remaining_median_follows_the_weibull_curve(spark):
    scale, shape, waited = 100.0, 1.5, 40.0
    row = spark.range(1).select(survival.remaining_median(F.lit(scale), shape, F.lit(waited)).alias("later"),
                                survival.remaining_median(F.lit(scale), shape, F.lit(0.0)).alias("fresh"),
                                survival.remaining_median(F.lit(float("inf")), shape, F.lit(1.0)).alias("never")).first()
    alive = lambda t: math.exp(-((t / scale) ** shape))
    assert alive(waited + row["later"]) / alive(waited) == pytest.approx(0.5)
    assert alive(row["fresh"]) == pytest.approx(0.5) and row["never"] is None


@pytest.mark.parametrize("distinct", [10, 2500])
def test_concordance_equals_pair_counting(spark, distinct):
    rows = [(i * 37 % 19 + 1, i % 3 > 0, float(i * 1301 % distinct) / 7) for i in range(60 if distinct == 10 else 2600)]
    df = spark.createDataFrame([(d, int(e), p) for d, e, p in rows], "duration int, event int, prediction double")
    day, event, predicted = (np.array(x) for x in zip(*rows))
    comparable = event[:, None] & ((day[None, :] > day[:, None]) | ((day[None, :] == day[:, None]) & ~event[None, :]))
    good, ties = (comparable & (predicted[None, :] > predicted[:, None])).sum(), (comparable & (predicted[None, :] == predicted[:, None])).sum()
    found = survival.concordance(df).first()
    assert found["comparable_pairs"] == comparable.sum()
    assert found["concordance"] == pytest.approx((good + ties / 2) / comparable.sum())


def test_silhouette_of_cells_is_that_of_the_rows(spark):
    rng = np.random.default_rng(1)
    rows = rng.integers(1, 6, (700, 3))
    table = spark.createDataFrame([tuple(map(int, r)) for r in rows], "recency_score int, frequency_score int, monetary_score int")
    scored = (rows - rows.mean(axis=0)) / rows.std(axis=0)
    apart = np.sqrt(((scored[:, None] - scored[None]) ** 2).sum(axis=2))
    cells = modelling.score_cells(table)
    for k in (1, 2, 4):
        label = rows.sum(axis=1) % k
        total = 0.0
        for i in range(len(rows)):
            own = label == label[i]
            others = [apart[i, label == c].mean() for c in set(label) if c != label[i]]
            if others and own.sum() > 1:
                a, b = apart[i, own].sum() / (own.sum() - 1), min(others)
                total += (b - a) / max(a, b)
        place = F.pmod(F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"), F.lit(k))
        assert modelling.silhouette(cells.withColumn("km_cluster", place)).first()[0] == pytest.approx(total / len(rows))
