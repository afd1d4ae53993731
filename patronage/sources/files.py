"""Typed CSV ingestion, audit columns, table writes and load manifests."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: texts that mean "no value"
NA_TOKENS = ("", "NULL", "null", "None", "NaN", "nan")


@dataclass(frozen=True)
class FileSpec:
    """One raw file and its columns in order.

    Texts with line breaks need ``multi_line``; such a file cannot be split, so deliver a large one in parts.
    """

    table: str
    filename: str
    columns: Mapping[str, str]
    expected_rows: int | None = None
    depends_on: tuple[str, ...] = ()
    multi_line: bool = False


# fixed values: raw tables, their files and columns, in load order
RAW_FILES = {spec.table: spec for spec in (
    FileSpec("customers", "customers.csv", {
        "customer_id": "string", "customer_unique_id": "string", "customer_zip_code_prefix": "string",
        "customer_city": "string", "customer_state": "string"}, 99_441),
    FileSpec("sellers", "sellers.csv", {
        "seller_id": "string", "seller_zip_code_prefix": "string", "seller_city": "string",
        "seller_state": "string"}, 3_095),
    FileSpec("products", "products.csv", {
        "product_id": "string", "product_category_name": "string", "product_name_lenght": "double",
        "product_description_lenght": "double", "product_photos_qty": "double", "product_weight_g": "double",
        "product_length_cm": "double", "product_height_cm": "double", "product_width_cm": "double"}, 32_951),
    FileSpec("category_translation", "category_translation.csv", {
        "product_category_name": "string", "product_category_name_english": "string"}, 71),
    FileSpec("geolocation", "geolocation.csv", {
        "geolocation_zip_code_prefix": "string", "geolocation_lat": "double", "geolocation_lng": "double",
        "geolocation_city": "string", "geolocation_state": "string"}, 1_000_163),
    FileSpec("orders", "orders.csv", {
        "order_id": "string", "customer_id": "string", "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz", "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz", "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz"}, 99_441, ("customers",)),
    FileSpec("order_items", "order_items.csv", {
        "order_id": "string", "order_item_id": "int", "product_id": "string", "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz", "price": "decimal(12,2)", "freight_value": "decimal(12,2)"},
        112_650, ("orders", "products", "sellers")),
    FileSpec("order_payments", "order_payments.csv", {
        "order_id": "string", "payment_sequential": "int", "payment_type": "string", "payment_installments": "int",
        "payment_value": "decimal(12,2)"}, 103_886, ("orders",)),
    FileSpec("order_reviews", "order_reviews.csv", {
        "review_id": "string", "order_id": "string", "review_score": "double", "review_comment_title": "string",
        "review_comment_message": "string", "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz"}, 99_224, ("orders",), multi_line=True),
)}


def no_value_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def lenient_timestamp(text) -> Column:
    """A text that is no moment becomes NULL instead of failing the load."""
    text = text if isinstance(text, Column) else F.col(text)
    return text.try_cast("timestamp_ntz")


def typed_column(name: str, kind: str) -> Column:
    """Text to its declared type. Only moments are lenient: a number that is no number fails the load."""
    value = no_value_to_null(F.col(name))
    if kind == "string":
        return value.alias(name)
    if kind == "timestamp_ntz":
        return lenient_timestamp(value).alias(name)
    return value.cast(kind).alias(name)


def typed(raw: DataFrame, spec: FileSpec) -> DataFrame:
    return raw.select(*[typed_column(name, kind) for name, kind in spec.columns.items()],
                      *[c for c in raw.columns if c not in spec.columns])


def read_raw(spark: SparkSession, folder: str, spec: FileSpec, run_timestamp: str | None = None) -> DataFrame:
    """One raw CSV with types and audit columns."""
    text_schema = T.StructType([T.StructField(name, T.StringType()) for name in spec.columns])
    raw = (spark.read.schema(text_schema)
           .csv(f"{folder.rstrip('/')}/{spec.filename}", header=True, mode="PERMISSIVE", multiLine=spec.multi_line,
                quote='"', escape='"', encoding="UTF-8", nullValue="")
           .select("*", F.col("_metadata.file_name").alias("source_file")))
    return stamped(typed(raw, spec), run_timestamp)


def stamped(df: DataFrame, run_timestamp: str | None = None, source_file: str | None = None) -> DataFrame:
    """Add the audit columns: one load time per run, and the file a row came from."""
    moment = F.lit(run_timestamp).cast("timestamp_ntz") if run_timestamp else F.localtimestamp()
    result = df.withColumn("load_timestamp", moment)
    return result.withColumn("source_file", F.lit(source_file)) if source_file is not None else result


# -- writes --------------------------------------------------------------------

MANIFEST_SCHEMA = ("run_id string, table_name string, status string, rows_loaded bigint, expected_rows bigint, "
                   "elapsed_seconds double, error string")


def stored_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of a stored table, None when there is none yet."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def reload_table(df: DataFrame, path: str, table: str, expected_rows: int | None = None, force: bool = False) -> dict:
    """Replace a table, unless it already holds the expected rows. Returns its manifest entry."""
    started = time.monotonic()
    entry = {"table_name": table, "status": "loaded", "rows_loaded": 0, "expected_rows": expected_rows, "error": None}
    try:
        present = None if force or expected_rows is None else stored_rows(df.sparkSession, path)
        if present is not None and present == expected_rows:
            entry.update(status="skipped", rows_loaded=present)
        else:
            seen = Observation(f"load-{table}")
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            entry["rows_loaded"] = seen.get["rows"]
            if expected_rows is not None and entry["rows_loaded"] != expected_rows:
                entry["error"] = f"expected {expected_rows} rows"
    except Exception as failure:  # noqa: BLE001
        entry.update(status="failed", error=str(failure))
    entry["elapsed_seconds"] = round(time.monotonic() - started, 2)
    return entry


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def load_all(spark: SparkSession, folder: str, target: str, run_id: str, force: bool = False,
             specs: Mapping[str, FileSpec] = RAW_FILES) -> DataFrame:
    """Load every raw file and append one manifest row per table. A failed table does not stop the others."""
    entries = []
    for name, spec in specs.items():
        try:
            rows = read_raw(spark, folder, spec)
        except AnalysisException as missing:
            entries.append({"table_name": name, "status": "failed", "rows_loaded": 0, "expected_rows": spec.expected_rows,
                            "elapsed_seconds": 0.0, "error": str(missing)})
        else:
            entries.append(reload_table(rows, f"{target}/{name}", name, spec.expected_rows, force))
    names = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")][1:]
    manifest = spark.createDataFrame([(run_id, *[e[n] for n in names]) for e in entries], MANIFEST_SCHEMA)
    append_rows(manifest, f"{target}/load_manifest")
    return manifest


def swap_in(df: DataFrame, folder: str, version: str) -> str:
    """Publish a snapshot: write a complete new version, then point readers to it.

    A crash while writing leaves the previous version in place.
    """
    folder, spark = folder.rstrip("/"), df.sparkSession
    df.write.mode("errorifexists").parquet(f"{folder}/{version}")
    try:
        last = _published(spark, folder).agg(F.max("number")).first()[0]
    except AnalysisException:  # nothing is published yet
        last = None
    pointer = spark.createDataFrame([(version, (last or 0) + 1)], PUBLISHED)
    pointer.coalesce(1).write.mode("append").parquet(f"{folder}/_current")
    return f"{folder}/{version}"


PUBLISHED = "version string, number long"


def _published(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PUBLISHED).parquet(f"{folder}/_current")


def current_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The version published last, by the number it got then; names need no order."""
    folder = folder.rstrip("/")
    newest = _published(spark, folder).agg(F.max_by("version", "number")).first()[0]
    return spark.read.parquet(f"{folder}/{newest}")


# -- columns of stored tables --------------------------------------------------

def add_nullable(df: DataFrame, name: str, kind: str) -> DataFrame:
    """The table with one more column, empty so far; nothing to do when it is there."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def write_back(table: DataFrame, scores: DataFrame, key: str, touched: str | None = None) -> DataFrame:
    """Put new scores into a table by key. Rows of no new key keep what they had; a new NULL replaces an old score."""
    names = [c for c in scores.columns if c != key]
    incoming = scores.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_hit"))
    joined = table.join(incoming, key, "left")
    columns = [F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in table.columns]
    columns += [F.col(f"_new_{c}").alias(c) for c in names if c not in table.columns]
    if touched:
        now = F.when(F.col("_hit"), F.localtimestamp())
        old = F.col(touched) if touched in table.columns else F.lit(None).cast("timestamp_ntz")
        return joined.select(*columns, F.coalesce(now, old).alias("_touched")).drop(touched).withColumnRenamed(
            "_touched", touched)
    return joined.select(*columns)


def row_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None) -> DataFrame:
    """One row per table: its count, and how it compares with the expected count."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                    F.lit((expected or {}).get(name)).cast("bigint").alias("expected")) for name, df in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return (union.withColumn("diff", F.col("row_count") - F.col("expected"))
            .withColumn("matches", F.when(F.col("expected").isNull(), None)
                        .when(F.col("diff") == 0, 1).otherwise(0)))
