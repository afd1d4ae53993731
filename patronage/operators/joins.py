"""Joins that stay balanced when a few keys hold a large part of the fact side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 64
SPREAD = 64


SMALL_ROWS = 200_000


def word_join(rows: DataFrame, words: DataFrame, on: str) -> DataFrame:
    """Left join to a word list: broadcast after counting that it is small, otherwise with hot words taken out."""
    if words.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return rows.join(F.broadcast(words), on, "left")
    return lookup_join(rows, words, on)


def hot_keys(rows: DataFrame, on: Sequence[str]) -> Column:
    """One array of hot keys, as text, for each column of ``on``; all columns are counted in one scan of ``rows``.

    A key is hot when it has at least 1/64 of the rows that have a key, so an array holds at most 64. The result is a
    scalar subquery, which Spark runs once however often a plan names it.
    """
    keys = rows.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_of"), F.col(c).cast("string").alias("_key")) for c in on])).alias("_x")).select("_x.*")
    counts = keys.where(F.col("_key").isNotNull()).groupBy("_of", "_key").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.groupBy("_of").agg(F.sum("_n").alias("_size"))
    hot = counts.join(F.broadcast(sizes), "_of").where(F.col("_n") * HOT_SHARE >= F.col("_size"))
    lists = hot.agg(*[F.collect_list(F.when(F.col("_of") == c, F.col("_key"))).alias(c) for c in on])
    return lists.select(F.struct(*on)).scalar()


def lookup_join(facts: DataFrame, dim: DataFrame, on: str, how: str = "left", hot: Column | None = None) -> DataFrame:
    """Join facts to a table that is unique on ``on``, with the rows of hot keys dealt over 64 copies of their dim row.

    ``hot`` is a result of ``hot_keys`` with the column ``on``, by default that of the facts; when the facts are themselves
    the result of joins, count the table that the key column came from. At most 64 dim rows are copied. Both sides are
    read once, and Spark picks broadcast or sort-merge from the size of ``dim``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    added = [c for c in dim.columns if c != on]
    keys = (hot_keys(facts, [on]) if hot is None else hot).getField(on)
    is_hot = F.array_contains(keys, F.col(on).cast("string"))
    dealt = F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)).cast("int")
    marked = facts.withColumn("_salt", F.when(F.col(on).isNull() | is_hot, dealt).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    copied = dim.select(F.col(on).alias("_dim_key"), F.struct(*added).alias("_found"), F.explode(copies).alias("_dim_salt"))
    joined = marked.join(copied, (F.col(on) == F.col("_dim_key")) & (F.col("_salt") == F.col("_dim_salt")), how)
    return joined.select(*facts.columns, *[F.col("_found").getField(c).alias(c) for c in added])
