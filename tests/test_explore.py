from patronage.plans import explore


def test_listed_ids_has_one_row_per_id_of_the_people_kept(spark):
    rows = [("hot", f"c{i:05}") for i in range(5000)] + [("hot", "c00000"), ("two", "a"), ("two", "b"), ("one", "z"), ("two", None)]
    listed = explore.listed_ids(spark.createDataFrame(rows, "customer_unique_id string, customer_id string"), 1)
    assert sorted(tuple(r) for r in listed.collect()) == [("hot", 5000, f"c{i:05}") for i in range(5000)]
    assert "collect_list" not in listed._jdf.queryExecution().toString()
