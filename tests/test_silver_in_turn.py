"""Silver tables read those stored before them, and order lines move once to meet their orders."""

from patronage.plans import runs, silver
from patronage.session import materialize
from patronage.sources.sample_tables import FIRST_RUN, SECOND_RUN


def test_lines_are_shuffled_once_for_their_numbers_and_their_orders(spark, sample):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = sample.numbered_items.join(sample.orders.select("order_id", "customer_id"), "order_id")
        assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert met.count() == sample.items.join(sample.orders, "order_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_meet_the_stored_orders(spark, sample):
    t, given = sample, {}

    def keep(name, table):
        given[name] = table
        return materialize(table, f"in-turn-{name}")

    raw = silver.Raw(t.moved_customers, t.sellers, t.products, t.orders, t.numbered_items, t.payments, t.reviews, t.category_translation)
    first = silver.load_customers(None, t.customers, FIRST_RUN)
    made = silver.build_silver(raw, first, SECOND_RUN, keep)
    read = " ".join(given["fact_order_items"].inputFiles())
    assert "in-turn-fact_orders" in read and "in-turn-dim_product" in read and "customer.parquet" not in read and "orders.parquet" not in read
    assert set(given) == set(made.__dataclass_fields__)
    whole = silver.build_silver(raw, first, SECOND_RUN)
    assert sorted(map(str, made.fact_order_items.collect())) == sorted(map(str, whole.fact_order_items.collect()))


def test_a_step_may_store_its_tables_in_turn(spark):
    def build(keep):
        one = keep("one", spark.range(3).selectExpr("id", "rand() AS x"))
        keep("two", one.selectExpr("id", "x AS again"))

    tables = runs.reused(spark, "in-turn", "k", build, in_turn=True)
    assert tables["one"].join(tables["two"], "id").where("x = again").count() == 3
    assert runs.drop_others(spark, "in-turn", "none") == 1
