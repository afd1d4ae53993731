"""Stored steps follow their input files."""

import shutil
import time

from pyspark.sql import functions as F

from conftest import DATA
from patronage.plans import runs
from patronage.queries import queries
from patronage.queries.chain import silver_tables
from patronage.session import shared_dir
from patronage.sources.sample_tables import SampleTables


def test_steps_are_made_once_per_state_of_their_inputs(spark, tmp_path):
    made = []

    def step(path):
        key = runs.fingerprint(spark, str(tmp_path / "in"))
        tables = runs.reused(spark, "test-step", key, lambda: made.append(1) or {"twice": spark.read.parquet(path).select(F.col("id") * 2)})
        return key, sorted(r[0] for r in tables["twice"].collect())

    path = str(tmp_path / "in" / "t.parquet")
    spark.range(3).write.parquet(path)
    first, rows = step(path)
    assert rows == [0, 2, 4] and step(path) == (first, rows) and len(made) == 1
    # as another process would: nothing opened, the stored tables count
    runs._OPENED.clear()
    assert step(path) == (first, rows) and len(made) == 1
    time.sleep(0.01)
    spark.range(2).write.mode("overwrite").parquet(path)
    second, rows = step(path)
    assert rows == [0, 2] and second != first and len(made) == 2
    assert runs.drop_others(spark, "test-step", second) == 1 and runs.drop_others(spark, "test-step", second) == 0
    assert runs.fingerprint(spark, path, settings="a") != runs.fingerprint(spark, path, settings="b")


def test_a_step_that_fails_leaves_nothing_to_reuse(spark):
    def broken():
        return {"good": spark.range(1), "bad": spark.range(1).select(F.raise_error(F.lit("no")).alias("x"))}

    for _ in range(2):
        try:
            runs.reused(spark, "broken", "k", broken)
            raise AssertionError("the step should fail")
        except Exception as failure:  # noqa: BLE001
            assert "the step should fail" not in str(failure)
    assert runs.reused(spark, "broken", "k", lambda: {"good": spark.range(1)})["good"].count() == 1
    assert runs.drop_others(spark, "broken", "k") == 2
    assert shared_dir(spark)


def test_changed_input_changes_the_marts_of_the_same_session(spark, tmp_path):
    folder = str(tmp_path / "sample")
    shutil.copytree(DATA, folder, copy_function=shutil.copyfile)  # the contents, not that they are read-only
    before = {r["table_name"]: r["row_count"] for r in queries()["silver_row_counts"](spark, folder).collect()}
    customers = queries()["customer_health"](spark, folder).count()
    one = spark.read.parquet(f"{folder}/orders.parquet").where("o_orderkey % 2 = 0").toPandas()
    one.to_parquet(f"{folder}/orders.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    after = {r["table_name"]: r["row_count"] for r in queries()["silver_row_counts"](spark, folder).collect()}
    assert after["fact_orders"] == len(one) < before["fact_orders"] and after["dim_customer"] == before["dim_customer"]
    assert queries()["customer_health"](spark, folder).count() <= customers
    assert silver_tables(SampleTables(spark, folder))["fact_orders"].count() == len(one)
