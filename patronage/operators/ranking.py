"""Positions in a sorted table without a one-partition window.

A window that has no ``partitionBy`` (or whose group holds a large part of the
table) runs in one task. Here the rows are range-partitioned on (group, order
columns, key), so ties and hot groups are cut across partitions; positions are
taken inside each partition and shifted by the rows that come before it. The
shifts are computed on the driver from at most two rows per partition and group
edge, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

VALUE_TYPE = "decimal(28,10)"


def _local_positions(df: DataFrame, group: list[str], order: list[str], key: list[str], amount: str | None,
                     partitions: int | None) -> DataFrame:
    """Range-partition, number the rows of each partition and store the result.

    Without an explicit count, small neighbouring partitions are merged at run time, which keeps their order.
    """
    columns = [*group, *order, *key]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    ranged = ranged.withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part", *group)
    by_row = inside.orderBy(*order, *key)
    columns = [
        F.row_number().over(by_row).cast("long").alias("_row"),
        F.rank().over(inside.orderBy(*order)).cast("long").alias("_rank"),
        F.count(F.lit(1)).over(Window.partitionBy("_part", *group, *order)).alias("_ties"),
    ]
    if amount:
        columns.append(F.sum(amount).over(by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                       .alias("_running"))
    return materialize(ranged.select("*", *columns), "positions")


def _fragments(local: DataFrame, group: list[str], order: list[str], amount: str | None, few_groups: bool) -> list[Row]:
    """Sizes of the group parts that may continue in another partition.

    Only the first and the last group of a partition can, so this is at most two
    rows per partition (or one per partition and group when the groups are few).
    """
    tie = F.struct(*order)
    measures = [
        F.count(F.lit(1)).alias("_size"),
        F.min(tie).alias("_first"), F.min_by("_ties", tie).alias("_n_first"),
        F.max(tie).alias("_last"), F.max_by("_ties", tie).alias("_n_last"),
    ]
    if amount:
        measures.append(F.sum(amount).alias("_sum"))
    if few_groups:
        on_edge = local
    else:
        whole = F.struct(*group)
        edges = local.groupBy("_part").agg(F.min(whole).alias("_lo"), F.max(whole).alias("_hi"))
        on_edge = local.join(F.broadcast(edges), "_part").where((whole == F.col("_lo")) | (whole == F.col("_hi")))
    return on_edge.groupBy("_part", *group).agg(*measures).collect()


def _shifted(local: DataFrame, group: list[str], order: list[str], amount: str | None,
             few_groups: bool = False) -> DataFrame:
    """Add what lies before each partition to the positions inside it."""
    before: dict[tuple, int] = {}
    sum_before: dict[tuple, Decimal] = {}
    runs: dict[tuple, list[int]] = {}
    shifts = []
    for part in sorted(_fragments(local, group, order, amount, few_groups), key=lambda r: r["_part"]):
        name = tuple(part[c] for c in group)
        start = before.get(name, 0)
        shifts.append((part["_part"], *name, start) + ((sum_before.get(name, Decimal(0)),) if amount else ()))
        # a run of equal values may span partitions: keep its start and its full length
        tail = start + part["_size"] - part["_n_last"]
        for tie, at, count in {(part["_first"], start, part["_n_first"]), (part["_last"], tail, part["_n_last"])}:
            run = runs.setdefault((*name, *tie), [at + 1, 0])
            run[0], run[1] = min(run[0], at + 1), run[1] + count
        before[name] = start + part["_size"]
        if amount:
            sum_before[name] = sum_before.get(name, Decimal(0)) + (part["_sum"] or 0)

    spark, fields = local.sparkSession, local.schema
    long = T.LongType()
    shift_schema = T.StructType([fields["_part"], *[fields[c] for c in group], T.StructField("_before", long)]
                                + ([T.StructField("_sum_before", T.DecimalType(38, 6))] if amount else []))
    run_schema = T.StructType([*[fields[c] for c in (*group, *order)],
                               T.StructField("_run_start", long), T.StructField("_run_ties", long)])
    shift_rows = spark.createDataFrame(shifts, shift_schema)
    run_rows = spark.createDataFrame([(*k, *v) for k, v in runs.items()], run_schema)

    joined = (local.join(F.broadcast(shift_rows), ["_part", *group], "left")
              .join(F.broadcast(run_rows), [*group, *order], "left"))
    ahead = F.coalesce("_before", F.lit(0))
    result = (joined.withColumn("row", ahead + F.col("_row"))
              .withColumn("rank", F.coalesce(F.col("_run_start"), ahead + F.col("_rank")))
              .withColumn("ties", F.coalesce("_run_ties", "_ties")))
    if amount:
        result = result.withColumn("running", F.col("_running") + F.coalesce(F.col("_sum_before"), F.lit(0)))
    kept = [c for c in local.columns if c not in ("_part", "_row", "_rank", "_ties", "_running")]
    return result.select(*kept, "row", "rank", "ties", *(["running"] if amount else []))


def group_positions(df: DataFrame, by: Sequence[str], order: Sequence[str], key: Sequence[str],
                    partitions: int | None = None) -> DataFrame:
    """``df`` with ``row`` (ties broken by ``key``), ``rank`` and ``ties`` inside each ``by`` group.

    Same numbers as ``row_number`` and ``rank`` over (by, order); a group may be
    larger than a task can hold. ``by`` and ``order`` columns must not be NULL.
    """
    by, order, key = list(by), list(order), list(key)
    return _shifted(_local_positions(df, by, order, key, None, partitions), by, order, None)


@dataclass(frozen=True)
class Order:
    """One sort order: a numeric value, its direction and where NULLs go ('first', 'last' or 'skip')."""

    value: Column
    ascending: bool = True
    nulls: str = "last"
    amount: Column | None = None


def global_positions(df: DataFrame, key: Sequence[str], orders: dict[str, Order],
                     partitions: int | None = None) -> DataFrame:
    """One row per key with ``<name>_row``, ``_rank``, ``_ties``, ``_total`` for every order.

    All orders share one range shuffle of narrow rows. ``_running`` sums the
    order's ``amount`` up to and including the row.
    """
    key = list(key)
    names = list(orders)
    with_amount = any(o.amount is not None for o in orders.values())
    entries = []
    for number, order in enumerate(orders.values()):
        value = order.value.cast(VALUE_TYPE)
        signed = value if order.ascending else -value
        null_place = F.lit(0 if order.nulls == "first" else 2)
        amount = order.amount if order.amount is not None else F.lit(None)
        entry = F.struct(
            F.lit(number).alias("_o"),
            F.when(value.isNull(), null_place).otherwise(F.lit(1)).alias("_n"),
            F.coalesce(signed, F.lit(0)).cast(VALUE_TYPE).alias("_v"),
            *([amount.cast("decimal(38,6)").alias("_a")] if with_amount else []),
        )
        entries.append(F.when(value.isNotNull(), entry) if order.nulls == "skip" else entry)
    long = df.select(*key, F.explode(F.array_compact(F.array(*entries))).alias("_e")).select(*key, "_e.*")

    amount_name = "_a" if with_amount else None
    local = _local_positions(long, ["_o"], ["_n", "_v"], key, amount_name, partitions)
    placed = _shifted(local, ["_o"], ["_n", "_v"], amount_name, few_groups=True)
    totals = local.groupBy("_o").agg(F.count(F.lit(1)).alias("total"))
    placed = placed.join(F.broadcast(totals), "_o")

    fields = ["row", "rank", "ties", "total"] + (["running"] if with_amount else [])
    if len(names) == 1:
        return placed.select(*key, *[F.col(f).alias(f"{names[0]}_{f}") for f in fields])
    picks = [F.max(F.when(F.col("_o") == number, F.col(field))).alias(f"{name}_{field}")
             for number, name in enumerate(names) for field in fields
             if field != "running" or orders[name].amount is not None]
    return placed.groupBy(*key).agg(*picks)


def running_sums(df: DataFrame, order: Sequence[Column], amounts: dict[str, str], partitions: int | None = None) -> DataFrame:
    """``df`` with, per output name, the sum of a whole-number column up to and including the row in ``order``.

    ``order`` must tell all rows apart. Each range partition is summed by itself; the driver adds one row per partition.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = ranged.withColumn("_part", F.spark_partition_id())
    upto = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = materialize(ranged.withColumns({f"_sum_{n}": F.coalesce(F.sum(c).over(upto), F.lit(0)) for n, c in amounts.items()}), "sums")
    before, shifts = dict.fromkeys(amounts, 0), []
    for part in sorted(local.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in amounts.items()]).collect(), key=lambda r: r["_part"]):
        shifts.append((part["_part"], *before.values()))
        before = {n: before[n] + (part[n] or 0) for n in amounts}
    schema = "_part int, " + ", ".join(f"_before_{n} long" for n in amounts)
    joined = local.join(F.broadcast(df.sparkSession.createDataFrame(shifts, schema)), "_part")
    return joined.select(*df.columns, *[(F.col(f"_sum_{n}") + F.col(f"_before_{n}")).alias(n) for n in amounts])


# -- from positions to the usual rank functions --------------------------------

def percent_rank(name: str) -> Column:
    spread = F.nullif(F.col(f"{name}_total") - 1, F.lit(0))
    return F.coalesce((F.col(f"{name}_rank") - 1).cast("double") / spread, F.lit(0.0))


def ntile(name: str, buckets: int) -> Column:
    """Bucket sizes differ by at most one; the first ``total mod buckets`` get the extra row."""
    row, total = F.col(f"{name}_row"), F.col(f"{name}_total")
    extra = total % buckets
    small = F.floor(total / buckets)
    wide_rows = extra * (small + 1)
    in_wide = F.ceil(row / (small + 1))
    in_small = extra + F.ceil((row - wide_rows) / F.nullif(small, F.lit(0)))
    return F.when(row <= wide_rows, in_wide).otherwise(in_small).cast("int")


def average_rank_percentile(name: str) -> Column:
    """Mean rank of the tie run over the number of ranked rows, times 100; 0 for unranked rows."""
    middle = F.col(f"{name}_rank") * 2 + F.col(f"{name}_ties") - 1
    return F.coalesce(middle.cast("decimal(20,0)") * 50 / F.col(f"{name}_total").cast("decimal(20,0)"),
                      F.lit(0)).cast("decimal(14,8)")


def exact_percentiles(df: DataFrame, value: str, probabilities: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated percentiles, per ``by`` group or over all rows, exact at any number of distinct values.

    Equal values are counted first, so only distinct values are sorted.
    ``probabilities`` maps a column name to a decimal such as ``"0.9"``.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    return counted_percentiles(counted, "_value", "_n", probabilities, by)


def counted_percentiles(counts: DataFrame, value: str, n: str, probabilities: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """The same from how often each value occurs: one row per ``by`` group and ``value``, neither NULL."""
    by = list(by)
    # stored, as the range shuffle reads its rows twice, for bounds and to deal them, and the sizes once more
    counted = materialize(counts.groupBy(*by, F.col(value).cast(VALUE_TYPE).alias("v")).agg(F.sum(n).cast("decimal(38,6)").alias("n")), "counted")
    placed = _shifted(_local_positions(counted, by, ["v"], [], "n", None), by, ["v"], "n", few_groups=not by)
    sizes = counted.groupBy(*by).agg(F.sum("n").alias("size"))
    placed = placed.join(sizes, by) if by else placed.crossJoin(F.broadcast(sizes))
    upto, start = F.col("running"), F.col("running") - F.col("n")
    picks, outputs = [], []
    for name, probability in probabilities.items():
        place = (F.col("size") - 1).cast("decimal(20,0)") * F.lit(probability).cast("decimal(9,6)")
        low, high = F.floor(place), F.ceil(place)
        picks += [F.max(F.when((start <= low) & (low < upto), F.col("v"))).alias(f"{name}_low"),
                  F.max(F.when((start <= high) & (high < upto), F.col("v"))).alias(f"{name}_high"),
                  F.max(place - low).alias(f"{name}_step")]
        step = F.col(f"{name}_step").cast("double")
        outputs.append((F.col(f"{name}_low").cast("double")
                        + (F.col(f"{name}_high") - F.col(f"{name}_low")).cast("double") * step).alias(name))
    return placed.groupBy(*by).agg(*picks).select(*by, *outputs)


def bounded_median(df: DataFrame, value: str) -> DataFrame:
    """One-row median of a column with a small fixed domain, such as a score average kept to six digits.

    The rows are counted per value first; one task then sees at most one entry per possible value.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.percentile(F.col(value).cast("double"), 0.5, F.col("n")).alias("median"))
