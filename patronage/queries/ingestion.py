"""Queries that send sample rows through the file sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import files
from ..sources.sample_tables import SampleTables
from .registry import register
from .store import stored_marts


#: a file with line breaks inside its values is read by one task, so a file set has many
ROWS_PER_FILE = 20_000


def through_csv(t: SampleTables, rows: DataFrame, table: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write rows as a raw CSV file set and read it back with types."""
    spec = files.RAW_FILES[table]
    folder = f"{shared_dir(t.spark)}/raw-{uuid.uuid4().hex}"
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in spec.columns])
    texts.write.option("maxRecordsPerFile", rows_per_file).csv(f"{folder}/{spec.filename}", header=True, quote='"', escape='"', quoteAll=True,
                    ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.read_raw(t.spark, folder, spec, "2001-08-02 00:00:00")


@register("orders_from_csv", "order_id:s customer_id:s order_status:s order_purchase_timestamp:s "
          "order_delivered_customer_date:s load_timestamp:s", """
SELECT order_id, nullif(customer_id, '7') AS customer_id, order_status,
       CASE WHEN CAST(order_id AS BIGINT) % 13 <> 0 THEN order_purchase_timestamp END AS order_purchase_timestamp,
       order_delivered_customer_date, TIMESTAMP '2001-08-02' AS load_timestamp FROM c_orders""")
def orders_from_csv(t: SampleTables) -> DataFrame:
    """Some ids are a text that means no value, some dates are no dates: both come back as NULL."""
    key = F.col("order_id").cast("bigint")
    rows = t.orders.withColumns({
        "customer_id": F.when(F.col("customer_id") == "7", "NULL").otherwise(F.col("customer_id")),
        "order_purchase_timestamp": F.when(key % 13 == 0, "not a date").otherwise(
            F.col("order_purchase_timestamp").cast("string"))})
    return through_csv(t, rows, "orders")


@register("reviews_from_csv", "review_id:s order_id:s review_score:d review_comment_title:s review_creation_date:s "
          "message_length:i", """
SELECT review_id, order_id, review_score, review_comment_title, review_creation_date, length(d.text) AS message_length
FROM c_review_heads LEFT JOIN documents d USING (doc_id)""")
def reviews_from_csv(t: SampleTables) -> DataFrame:
    """Messages hold line breaks, commas and quotes."""
    return through_csv(t, t.reviews, "order_reviews").withColumn("message_length", F.length("review_comment_message"))


@register("stored_queue", "customer_unique_id:s action_type:s", "SELECT customer_unique_id, action_type FROM g_queue")
def stored_queue(t: SampleTables) -> DataFrame:
    """The queue as readers see it after two published snapshots."""
    folder = f"{shared_dir(t.spark)}/queue-{uuid.uuid4().hex}"
    queue = stored_marts(t).queue
    files.swap_in(queue.withColumn("action_type", F.lit("MONITOR")), folder, "v9")
    files.swap_in(queue, folder, "v10")
    return files.current_snapshot(t.spark, folder)


@register("load_manifest", "table_name:s status:s rows_loaded:i expected_rows:i", """
SELECT 'payments' AS table_name, 'loaded' AS status, count(*) AS rows_loaded, count(*) AS expected_rows FROM c_payments
UNION ALL SELECT 'payments', 'skipped', count(*), count(*) FROM c_payments
UNION ALL SELECT 'payments', 'loaded', count(*), count(*) FROM c_payments""")
def load_manifest(t: SampleTables) -> DataFrame:
    """Load a table, load it again (nothing to do), force a third load."""
    path = f"{shared_dir(t.spark)}/load-{uuid.uuid4().hex}"
    expected = t.payments.count()
    entries = [files.reload_table(t.payments, path, "payments", expected, force) for force in (False, False, True)]
    rows = [(e["table_name"], e["status"], e["rows_loaded"], e["expected_rows"]) for e in entries]
    return t.spark.createDataFrame(rows, "table_name string, status string, rows_loaded bigint, expected_rows bigint")


@register("score_write_back", "customer_unique_id:s churn_probability:d touched:i", """
SELECT customer_unique_id, CASE WHEN churn_probability >= 0.9 THEN NULL WHEN churn_probability >= 0.5 THEN 1 ELSE churn_probability END AS churn_probability,
       CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END AS touched FROM c_scores""")
def score_write_back(t: SampleTables) -> DataFrame:
    """New scores reach the matching rows, also where they are NULL; the others keep their score and their time stamp."""
    table = t.customer_scores().select("customer_unique_id", "churn_probability")
    new = table.where(F.col("churn_probability") >= 0.5).withColumn(
        "churn_probability", F.when(F.col("churn_probability") < 0.9, F.lit(1).cast("decimal(6,4)")))
    written = files.write_back(table, new, "customer_unique_id", touched="refreshed_at")
    return written.withColumn("touched", F.when(F.col("refreshed_at").isNotNull(), 1).otherwise(0))


@register("appended_scores", "run:s customer_unique_id:s churn_probability:d", """
SELECT run, customer_unique_id, churn_probability FROM c_scores, (VALUES ('first'), ('second')) runs(run)""")
def appended_scores(t: SampleTables) -> DataFrame:
    """The scores of two runs, the second appended to the first."""
    path = f"{shared_dir(t.spark)}/scores-{uuid.uuid4().hex}"
    scores = t.customer_scores().select("customer_unique_id", "churn_probability")
    for run in ("first", "second"):
        files.append_rows(scores.withColumn("run", F.lit(run)), path)
    return t.spark.read.parquet(path)
