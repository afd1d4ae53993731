"""Versioned (type 2) customer dimension and point-in-time lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import HOT_SHARE, SPREAD, lookup_join

TRACKED = ("customer_zip_code_prefix", "customer_city", "customer_state")
FAR_FUTURE = "9999-12-31"


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``by``. Spark limits each group before the shuffle, so a hot group stays small."""
    place = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(place)).where(F.col("_place") == 1).drop("_place")


def version_key(key: str, tracked: Sequence[str]) -> Column:
    return F.xxhash64(F.col(key), F.col("valid_from"), *[F.col(c) for c in tracked])


def first_versions(snapshot: DataFrame, run_date: str, key: str = "customer_unique_id",
                   tie_break: str = "customer_id", tracked: Sequence[str] = TRACKED) -> DataFrame:
    """The dimension after a first load: one open version per key."""
    rows = keep_first(snapshot, [key], [F.col(tie_break).desc()])
    return _with_surrogate(rows.select(
        key, tie_break, *tracked,
        F.lit(run_date).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        F.lit(1).alias("is_current")), key, tracked)


def _with_surrogate(rows: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    return rows.select(version_key(key, tracked).alias("customer_sk"), "*")


def scd2_merge(dimension: DataFrame, snapshot: DataFrame, run_date: str, key: str = "customer_unique_id",
               tie_break: str = "customer_id", tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Close changed versions on ``run_date`` and open new ones, in one join on the key.

    NULL and the empty string compare equal, so neither opens a version. Keys
    missing from the snapshot keep their open version.
    """
    columns = ["customer_sk", key, tie_break, *tracked, "valid_from", "valid_to", "is_current"]
    today = F.lit(run_date).cast("date")
    incoming = keep_first(snapshot, [key], [F.col(tie_break).desc()]).select(
        F.col(key).alias("_key"), F.struct(tie_break, *tracked).alias("new"))
    current = dimension.where(F.col("is_current") == 1).select(F.struct(*columns).alias("old"))

    same = F.lit(True)
    for column in tracked:
        same = same & (F.coalesce(F.col(f"old.{column}"), F.lit("")) == F.coalesce(F.col(f"new.{column}"), F.lit("")))
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & ~same
    opened = F.col("new").isNotNull() & (F.col("old").isNull() | changed)

    def version(side: str, business_key: Column, sk: Column, start: Column, end: Column, flag: Column) -> Column:
        return F.struct(sk.alias("customer_sk"), business_key.alias(key),
                        *[F.col(f"{side}.{c}").alias(c) for c in (tie_break, *tracked)],
                        start.alias("valid_from"), end.alias("valid_to"), flag.alias("is_current"))

    kept = version("old", F.col(f"old.{key}"), F.col("old.customer_sk"), F.col("old.valid_from"),
                   F.when(changed, today), F.when(changed, 0).otherwise(1))
    new_sk = F.xxhash64(F.col("_key"), today, *[F.col(f"new.{c}") for c in tracked])
    fresh = version("new", F.col("_key"), new_sk, today, F.lit(None).cast("date"), F.lit(1))
    rows = F.array_compact(F.array(F.when(F.col("old").isNotNull(), kept), F.when(opened, fresh)))
    merged = (current.join(incoming, F.col(f"old.{key}") == F.col("_key"), "full_outer")
              .select(F.inline(rows)))
    return dimension.where(F.col("is_current") == 0).select(*columns).unionByName(merged.select(*columns))


# -- the stored dimension --------------------------------------------------------

def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a stored dimension."""
    return spark.read.parquet(path).drop("closed_on")


def _put(rows: DataFrame, path: str) -> None:
    """Replace the partitions that ``rows`` falls into: the open versions, and those closed on one day each."""
    (rows.withColumn("closed_on", F.when(F.col("is_current") == 0, F.col("valid_to")))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("is_current", "closed_on").parquet(path))


def _is_stored(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def load_versions(snapshot: DataFrame, path: str, run_date: str, key: str = "customer_unique_id", tie_break: str = "customer_id",
                  tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Bring the dimension stored at ``path`` up to a snapshot and return all its versions.

    Only open versions are read, joined and rewritten. Versions that close are put beside those closed before, in a partition per
    closing day, so history is neither read nor touched. They are put there before the open ones are replaced: a load that dies in
    between finds the same versions to close again, and one repeated on the same day changes nothing.
    """
    spark = snapshot.sparkSession
    if not _is_stored(spark, path):
        _put(first_versions(snapshot, run_date, key, tie_break, tracked), path)
        return read_versions(spark, path)
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c not in ("is_current", "closed_on")]
    opened = stored.where(F.col("is_current") == 1).select(*columns, F.col("is_current").cast("int").alias("is_current"))
    merged = materialize(scd2_merge(opened, snapshot, run_date, key, tie_break, tracked), "merged-versions")
    closing = merged.where(F.col("is_current") == 0)
    if not closing.isEmpty():
        today = stored.where((F.col("is_current") == 0) & (F.col("closed_on") == F.lit(run_date).cast("date"))).select(
            *columns, F.lit(0).alias("is_current"))
        closed = closing.select(*columns, "is_current").unionByName(today).dropDuplicates(["customer_sk", "valid_from"])
        _put(materialize(closed, "closed-versions"), path)
    _put(merged.where(F.col("is_current") == 1).select(*columns, "is_current"), path)
    return read_versions(spark, path)


# -- the version in force --------------------------------------------------------

def effective_versions(dimension: DataFrame, key: str, carried: Sequence[str]) -> DataFrame:
    """Versions without overlaps, as (key, at, until, version, oldest): the days on which each is the first that covers.

    Among versions that cover a day the oldest counts, so a version holds from the end of all older ones. Each key also has an entry
    without a day, which comes before all others and stands for its oldest version; that one also serves days nobody covers.
    """
    until = F.coalesce("valid_to", F.lit(FAR_FUTURE).cast("date"))
    order = Window.partitionBy(key).orderBy("valid_from", until, *carried)
    older_until = F.max(until).over(order.rowsBetween(Window.unboundedPreceding, -1))
    version = F.struct(*carried)
    rows = dimension.select(key, F.greatest("valid_from", older_until).alias("at"), until.alias("until"), version.alias("version"),
                            F.first(version).over(order).alias("oldest"), F.row_number().over(order).alias("place"))
    none = F.lit(None).cast("date")
    entries = F.array_compact(F.array(F.when(F.col("place") == 1, F.struct(none.alias("at"), none.alias("until"))),
                                      F.when(F.col("at") < F.col("until"), F.struct("at", "until"))))
    return rows.select(key, "version", "oldest", F.inline(entries))


def hot_people(facts: DataFrame, customers: DataFrame, key: str = "customer_unique_id") -> Column:
    """People with at least 1/64 of the facts, at most 64, as a scalar subquery; facts are counted per id before they meet the people."""
    ids = facts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    people = ids.join(customers.select("customer_id", key), "customer_id").groupBy(key).agg(F.sum("n").alias("n"))
    return (people.crossJoin(F.broadcast(people.agg(F.sum("n").alias("size")))).where(F.col("n") * HOT_SHARE >= F.col("size"))
            .agg(F.collect_list(key).alias("hot")).scalar())


def with_version_at(facts: DataFrame, customers: DataFrame, dimension: DataFrame, moment: str,
                    carried: Sequence[str] = ("customer_sk",)) -> DataFrame:
    """Add the person behind ``customer_id`` and the version in force at ``moment``; unresolved rows drop out.

    Versions and facts of a person are one stream in order of their days, and each fact takes the version that came last. The
    facts of a person with a large share of them are dealt over 64 streams, each with a copy of the person's versions.
    """
    key = "customer_unique_id"
    known = lookup_join(facts, customers.select("customer_id", key), "customer_id", "inner")
    is_hot = F.array_contains(hot_people(facts, customers), F.col(key))
    dealt = F.when(is_hot, F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)).cast("int")).otherwise(0)
    rows = known.select(key, dealt.alias("stream"), F.to_date(F.col(moment)).alias("at"), F.lit(1).alias("kind"),
                        F.struct(*[c for c in known.columns if c != key]).alias("fact"))
    copies = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0))))
    versions = effective_versions(dimension, key, carried).select(
        key, copies.alias("stream"), "at", F.lit(0).alias("kind"), F.struct("until", "version", "oldest").alias("entry"))
    in_time = Window.partitionBy(key, "stream").orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.unionByName(versions, allowMissingColumns=True)
              .withColumn("last", F.last("entry", ignorenulls=True).over(in_time)).where((F.col("kind") == 1) & F.col("last").isNotNull()))
    chosen = F.when(F.col("at") < F.col("last.until"), F.col("last.version")).otherwise(F.col("last.oldest"))
    found = placed.select(key, "fact", chosen.alias("version"))
    return found.select(*[F.col(key) if c == key else F.col("fact").getField(c).alias(c) for c in known.columns],
                        *[F.col("version").getField(c).alias(c) for c in carried])


def overlapping_versions(dimension: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Versions that start before their predecessor ended; expected to be empty."""
    order = Window.partitionBy(key).orderBy("valid_from", F.coalesce("valid_to", F.lit(FAR_FUTURE).cast("date")))
    ends = F.coalesce("valid_to", F.lit(FAR_FUTURE).cast("date"))
    previous = dimension.withColumn("previous_valid_to", F.max(ends).over(
        order.rowsBetween(Window.unboundedPreceding, -1)))
    return previous.where((F.col("previous_valid_to") > F.col("valid_from")) & (ends > F.col("valid_from")))
