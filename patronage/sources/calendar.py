"""Calendar dimension with an unknown-date member."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: (month, day) -> holiday
HOLIDAYS = {
    (1, 1): "New Year's Day",
    (4, 21): "Tiradentes",
    (5, 1): "Labour Day",
    (9, 7): "Independence Day",
    (10, 12): "Nossa Sra. Aparecida",
    (11, 2): "All Souls' Day",
    (11, 15): "Republic Day",
    (12, 25): "Christmas Day",
}


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    return calendar_of(spark.range(1).select(F.lit(start).cast("date").alias("start"),
                                             F.lit(end).cast("date").alias("end")))


def calendar_of(bounds: DataFrame) -> DataFrame:
    """Calendar rows for a one-row table (start, end), plus the unknown date 1900-01-01."""
    day = F.col("full_date")
    holiday = F.coalesce(*[F.when((F.month(day) == m) & (F.dayofmonth(day) == d), name)
                           for (m, d), name in HOLIDAYS.items()])
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("full_date")).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0).alias("is_weekend"),
        F.when(holiday.isNotNull(), 1).otherwise(0).alias("is_holiday"),
        holiday.alias("holiday_name"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
    )
    unknown = bounds.select(
        F.lit(19000101).alias("date_sk"), F.lit("1900-01-01").cast("date").alias("full_date"),
        F.lit(1900).alias("year"), F.lit(1).alias("quarter"), F.lit(1).alias("month"), F.lit("Unknown").alias("month_name"),
        F.lit(1).alias("week_of_year"), F.lit(1).alias("day_of_month"), F.lit("Unknown").alias("day_name"),
        F.lit(0).alias("is_weekend"), F.lit(0).alias("is_holiday"), F.lit("UNKNOWN_DATE").alias("holiday_name"),
        F.lit(1900).alias("fiscal_year"), F.lit(1).alias("fiscal_quarter"))
    return days.unionByName(unknown)
