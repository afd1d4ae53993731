"""Raw CSV file sets with line breaks in their values are read by several tasks."""

from types import SimpleNamespace

from patronage.queries.ingestion import through_csv


def test_a_file_set_has_files_of_bounded_rows(spark):
    rows = spark.range(50).coalesce(1).selectExpr(
        "concat('r', id) AS review_id", "concat('o', id) AS order_id", "CAST(id % 5 + 1 AS double) AS review_score", "'t' AS review_comment_title",
        "concat('line ', id, '\\n\"quoted\", more') AS review_comment_message", "TIMESTAMP_NTZ'2020-01-01' AS review_creation_date",
        "TIMESTAMP_NTZ'2020-01-02' AS review_answer_timestamp")
    back = through_csv(SimpleNamespace(spark=spark), rows, "order_reviews", rows_per_file=10)
    per_file = [r["count"] for r in back.groupBy("source_file").count().collect()]
    assert per_file == [10] * 5
    assert sorted(back.select(*rows.columns).collect()) == sorted(rows.collect())
