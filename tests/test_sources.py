import pytest
from pyspark.sql import functions as F

from patronage.sources import files
from patronage.sources.calendar import dim_date


def test_typed_csv(spark, tmp_path):
    spec = files.RAW_FILES["order_reviews"]
    header = ",".join(spec.columns)
    (tmp_path / spec.filename).write_text(
        f'{header}\nr1,o1,5.0,NaN,"two\nlines, ""quoted""",2018-01-02 03:04:05,rubbish\nr2,o2,null,,"None",,2018-02-30 00:00:00\n',
        encoding="utf-8")
    rows = {r["review_id"]: r for r in files.read_raw(spark, str(tmp_path), spec, "2020-01-01 00:00:00").collect()}
    assert rows["r1"]["review_comment_message"] == 'two\nlines, "quoted"' and rows["r1"]["review_comment_title"] is None
    assert str(rows["r1"]["review_creation_date"]) == "2018-01-02 03:04:05" and rows["r1"]["review_answer_timestamp"] is None
    assert rows["r2"]["review_score"] is None and rows["r2"]["review_comment_message"] is None
    assert rows["r2"]["review_answer_timestamp"] is None
    assert rows["r1"]["source_file"] == spec.filename and str(rows["r1"]["load_timestamp"]) == "2020-01-01 00:00:00"


def test_zip_codes_keep_leading_zeros(spark, tmp_path):
    spec = files.RAW_FILES["sellers"]
    (tmp_path / spec.filename).write_text(",".join(spec.columns) + "\ns1,01310,x,SP\n")
    assert files.read_raw(spark, str(tmp_path), spec).first()["seller_zip_code_prefix"] == "01310"


def test_load_all_keeps_a_manifest(spark, tmp_path):
    specs = {n: files.RAW_FILES[n] for n in ("sellers", "category_translation")}
    (tmp_path / specs["sellers"].filename).write_text(",".join(specs["sellers"].columns) + "\ns1,01310,x,SP\n")
    manifest = files.load_all(spark, str(tmp_path), str(tmp_path / "out"), "run1", specs=specs)
    status = {r["table_name"]: (r["status"], r["rows_loaded"]) for r in manifest.collect()}
    assert status == {"sellers": ("loaded", 1), "category_translation": ("failed", 0)}
    files.load_all(spark, str(tmp_path), str(tmp_path / "out"), "run2", specs=specs)
    assert spark.read.parquet(str(tmp_path / "out" / "load_manifest")).count() == 4


def test_a_loaded_table_is_skipped_unless_forced(spark, tmp_path):
    path = str(tmp_path / "t")
    status = [files.reload_table(spark.range(10).toDF("x"), path, "t", 10, force)["status"] for force in (False, False, True)]
    assert status == ["loaded", "skipped", "loaded"]


def test_snapshots_are_swapped_in(spark, tmp_path):
    folder = str(tmp_path / "queue")
    files.swap_in(spark.range(3), folder, "v1")
    files.swap_in(spark.range(5), folder, "v2")
    assert files.current_snapshot(spark, folder).count() == 5
    for number in (3, 9, 10, 4):
        files.swap_in(spark.range(number), folder, f"v{number}")
    assert files.current_snapshot(spark, folder).count() == 4


def test_write_back_keeps_old_scores(spark):
    table = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, s int")
    new = spark.createDataFrame([("a", None, 1.5), ("b", 8, 2.5)], "k string, s int, extra double")
    rows = {r["k"]: (r["s"], r["extra"], r["at"] is not None) for r in files.write_back(table, new, "k", touched="at").collect()}
    assert rows == {"a": (None, 1.5, True), "b": (8, 2.5, True), "c": (3, None, False)}


def test_added_columns(spark):
    df = spark.range(1).toDF("x")
    added = files.add_nullable(df, "days", "decimal(10,1)")
    assert added.first()["days"] is None and files.add_nullable(added, "days", "int").schema == added.schema


def test_row_counts(spark):
    rows = files.row_counts({"a": spark.range(3), "b": spark.range(2)}, {"a": 4}).orderBy("table_name").collect()
    assert [(r["row_count"], r["diff"], r["matches"]) for r in rows] == [(3, -1, 0), (2, None, None)]


@pytest.mark.parametrize("day, week, weekend, holiday", [
    ("2016-01-01", 53, 0, "New Year's Day"), ("2018-09-07", 36, 0, "Independence Day"), ("2018-09-09", 36, 1, None)])
def test_calendar(spark, day, week, weekend, holiday):
    row = dim_date(spark, "2015-01-01", "2020-12-31").where(F.col("full_date") == day).first()
    assert (row["week_of_year"], row["is_weekend"], row["holiday_name"]) == (week, weekend, holiday)


def test_calendar_has_the_unknown_date(spark):
    dates = dim_date(spark, "2015-01-01", "2020-12-31")
    assert dates.count() == 2192 + 1 and dates.where("date_sk = 19000101").count() == 1
