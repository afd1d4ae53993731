import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from patronage.operators.ranking import (
    Order, average_rank_percentile, bounded_median, exact_percentiles, global_positions, group_positions, ntile, percent_rank)


def numbers(spark, values):
    return spark.createDataFrame([(f"k{i:04d}", v) for i, v in enumerate(values)], "k string, v int")


@pytest.mark.parametrize("values", [
    [i * 7919 % 1000 for i in range(997)],
    [1] * 700 + [i % 13 for i in range(300)],  # one value holds most rows
    [5] * 50,
    [3],
], ids=["mixed", "hot", "equal", "single"])
@pytest.mark.parametrize("partitions", [None, 7])
def test_same_numbers_as_one_partition_windows(spark, values, partitions):
    df = numbers(spark, values)
    placed = global_positions(df, ["k"], {"up": Order(F.col("v")), "down": Order(F.col("v"), ascending=False, amount=F.col("v"))},
                              partitions)
    up, down = Window.orderBy("v", "k"), Window.orderBy(F.desc("v"), "k")
    expected = df.select(
        "k", F.row_number().over(up).alias("r"), F.rank().over(Window.orderBy("v")).alias("q"),
        F.percent_rank().over(Window.orderBy("v")).alias("p"), F.ntile(5).over(up).alias("n5"),
        F.ntile(100).over(up).alias("n100"), F.sum("v").over(down.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.count("*").over(Window.partitionBy("v")).alias("t"))
    found = placed.select("k", "up_row", "up_rank", percent_rank("up"), ntile("up", 5), ntile("up", 100),
                          F.col("down_running").cast("long"), "up_ties")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_missing_values_go_where_they_are_told(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("c", 1)], "k string, v int")
    rows = {n: {r["k"]: r["x_row"] for r in global_positions(df, ["k"], {"x": Order(F.col("v"), nulls=n)}).collect()}
            for n in ("first", "last", "skip")}
    assert rows == {"first": {"a": 1, "c": 2, "b": 3}, "last": {"c": 1, "b": 2, "a": 3}, "skip": {"c": 1, "b": 2}}


def test_group_positions_with_a_group_larger_than_a_partition(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 40).alias("g"), (F.col("id") * 31 % 17).alias("v"), "id")
    placed = group_positions(df, ["g"], ["v"], ["id"], partitions=11)
    inside = Window.partitionBy("g")
    wrong = placed.select("row", "rank", "ties", F.row_number().over(inside.orderBy("v", "id")).alias("r"),
                          F.rank().over(inside.orderBy("v")).alias("q"),
                          F.count("*").over(Window.partitionBy("g", "v")).alias("t")).where("row <> r or rank <> q or ties <> t")
    assert placed.count() == 3000 and wrong.count() == 0


def test_average_rank_percentile_leaves_unranked_rows_at_zero(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 3), ("e", None)], "k string, v int")
    placed = df.join(global_positions(df, ["k"], {"x": Order(F.col("v"), nulls="skip")}), "k", "left")
    assert {r[0]: float(r[1]) for r in placed.select("k", average_rank_percentile("x")).collect()} == {
        "a": 25.0, "b": 62.5, "c": 62.5, "d": 100.0, "e": 0.0}


def test_percentiles_equal_the_builtin_ones(spark):
    df = spark.range(1001).select((F.col("id") * 37 % 501).cast("decimal(10,2)").alias("v"), (F.col("id") % 3).alias("g"))
    probabilities = {"a": "0.1", "b": "0.5", "c": "0.95"}
    exact = df.groupBy("g").agg(F.percentile("v", [0.1, 0.5, 0.95]).alias("p"))
    found = {r["g"]: [r["a"], r["b"], r["c"]] for r in exact_percentiles(df, "v", probabilities, ["g"]).collect()}
    for row in exact.collect():
        assert found[row["g"]] == pytest.approx(row["p"])
    one = exact_percentiles(df, "v", probabilities).first()
    assert [one["a"], one["b"], one["c"]] == pytest.approx(df.agg(F.percentile("v", [0.1, 0.5, 0.95])).first()[0])
    assert bounded_median(df, "v").first()[0] == one["b"]


def test_ranking_plan_has_no_one_partition_window(spark):
    df = numbers(spark, range(100))
    plan = global_positions(df, ["k"], {"x": Order(F.col("v"))})._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_percentiles_work_out_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted_value(value):
        seen.add(1)
        return float(value)

    rows = spark.range(0, 1000, 1, 8).select(F.pmod("id", F.lit(2)).alias("g"), counted_value("id").alias("v"))
    found = exact_percentiles(rows.withColumn("v", F.col("v")), "v", {"median": "0.5"}, ["g"]).collect()
    assert {(r["g"], r["median"]) for r in found} == {(0, 499.0), (1, 500.0)}
    assert seen.value <= 2000  # the test for NULL may call it once more per row
