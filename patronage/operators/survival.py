"""Time to the next purchase: interval data, penalised Weibull AFT fit, conditional median, concordance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as fx
from ..session import materialize

PERSON = "customer_unique_id"
NUMERIC = ("avg_order_value", "avg_review_score", "avg_sentiment_score", "total_categories_purchased")
CATEGORICAL = ("customer_state",)


def purchase_intervals(orders: DataFrame, constants: DataFrame) -> DataFrame:
    """Observed gaps between purchases (event 1) and the open gap since the last one (event 0).

    Only customers with two or more orders; gaps under a full day are dropped.
    Orders are first reduced to the first and last moment per customer and day:
    gaps inside a day are always dropped, so a customer's window holds at most
    one row per calendar day however many orders there are.
    """
    days = orders.where(F.col("order_purchase_timestamp").isNotNull()).groupBy(
        PERSON, F.to_date("order_purchase_timestamp").alias("day")).agg(
        F.min("order_purchase_timestamp").alias("first"), F.max("order_purchase_timestamp").alias("last"),
        F.count(F.lit(1)).alias("n"))
    in_time = Window.partitionBy(PERSON).orderBy("day")
    per_day = days.select(
        PERSON, "last", F.lead("first").over(in_time).alias("next"),
        F.sum("n").over(Window.partitionBy(PERSON)).alias("orders"))
    repeat = per_day.where(F.col("orders") >= 2).crossJoin(F.broadcast(constants.select("as_of_date")))
    observed = repeat.where(F.col("next").isNotNull()).select(
        PERSON, fx.elapsed_days("last", "next").alias("duration"), F.lit(1).alias("event"))
    censored = repeat.where(F.col("next").isNull()).select(
        PERSON, fx.elapsed_days("last", F.col("as_of_date").cast("timestamp_ntz")).alias("duration"), F.lit(0).alias("event"))
    return observed.unionByName(censored).where(F.col("duration") > 0)


def with_covariates(intervals: DataFrame, profile: DataFrame, clv: DataFrame) -> DataFrame:
    columns = profile.select(PERSON, "customer_state", "avg_order_value", "avg_review_score", "avg_sentiment_score",
                             "days_since_last_order").join(clv.select(PERSON, "total_categories_purchased"), PERSON, "left")
    return intervals.join(columns, PERSON)


@dataclass(frozen=True)
class WeibullModel:
    """Survival exp(-(t / scale)^shape) with scale exp(intercept + coefficients . features)."""

    coefficients: tuple[float, ...]
    intercept: float
    shape: float
    steps: int

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the scale in ``prediction``."""
        weights = F.array(*[F.lit(c) for c in self.coefficients])
        line = F.aggregate(F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w), F.lit(self.intercept), lambda total, x: total + x)
        return rows.withColumn("prediction", F.exp(line))


def likelihood_sums(rows: DataFrame, spreads: np.ndarray, coefficients: np.ndarray, intercept: float, log_shape: float) -> tuple:
    """(log-likelihood, gradient, Hessian) over all rows in (coefficients of x / spreads, intercept, log shape), from one scan.

    Each task adds up its Arrow batches and gives one row; the positions of those rows are summed by Spark.
    """
    size = coefficients.size + 2

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + size * size)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) / spreads
            time, event = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            shape, wide = np.exp(log_shape), np.hstack([x, np.ones((n, 1))])
            with np.errstate(over="ignore", invalid="ignore"):
                w = shape * (np.log(time) - x @ coefficients - intercept)
                hazard = np.exp(w)
                by_line, by_shape = shape * (hazard - event), event * (1 + w) - w * hazard
                line_line, line_shape = -shape * shape * hazard, shape * (hazard - event) + shape * w * hazard
                shape_shape = w * (event - hazard) - w * w * hazard
                hessian = np.empty((size, size))
                hessian[:-1, :-1] = wide.T @ (wide * line_line[:, None])
                hessian[:-1, -1] = hessian[-1, :-1] = wide.T @ line_shape
                hessian[-1, -1] = shape_shape.sum()
                likelihood = (event * (log_shape - np.log(time) + w) - hazard).sum()
                total += np.concatenate([[likelihood], wide.T @ by_line, [by_shape.sum()], hessian.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.mapInArrow(add, "sums array<double>").select(F.posexplode("sums").alias("place", "value"))
    sums = np.zeros(1 + size + size * size)
    for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
        sums[place] = value
    return sums[0], sums[1:1 + size], sums[1 + size:].reshape(size, size)


def train_survival(intervals: DataFrame, penalty: float = 0.01, max_steps: int = 50, tolerance: float = 1e-10) -> WeibullModel:
    """Weibull AFT over ``features``, ``duration`` (above 0) and ``event``, by Newton's method.

    Minimised is minus the mean log-likelihood plus penalty / 2 times the squared coefficients of the features in units of their
    standard deviation; intercept and shape go free. A step that does not lower it is halved, and a Hessian that is not
    positive definite is lifted until it is. Without an event there is nothing to fit: all is zero, the shape one.
    """
    rows = intervals.select(vector_to_array("features").alias("x"), F.col("duration").cast("double").alias("duration"),
                            F.col("event").cast("double").alias("event"))
    n, time, events = rows.agg(F.count(F.lit(1)), F.sum("duration"), F.sum("event")).first()
    if not n:
        return WeibullModel((), 0.0, 1.0, 0)
    spreads = np.array(intervals.select(Summarizer.std(F.col("features"))).first()[0].toArray())
    spreads[spreads < 1e-8] = 1.0
    if not events:
        return WeibullModel((0.0,) * spreads.size, 0.0, 1.0, 0)
    ridge = np.diag(np.concatenate([np.full(spreads.size, penalty), [0.0, 0.0]]))

    def measured(at: np.ndarray) -> tuple:
        likelihood, gradient, hessian = likelihood_sums(rows, spreads, at[:-2], at[-2], at[-1])
        loss = -likelihood / n + at @ ridge @ at / 2
        return (loss if np.isfinite(loss) else np.inf), ridge @ at - gradient / n, ridge - hessian / n

    at = np.concatenate([np.zeros(spreads.size), [np.log(time / events), 0.0]])
    loss, gradient, hessian = measured(at)
    steps = 0
    while steps < max_steps and np.abs(gradient).max() > tolerance:
        lift = max(0.0, 1e-6 - np.linalg.eigvalsh(hessian)[0])
        step = np.linalg.solve(hessian + lift * np.eye(at.size), gradient)
        steps, found = steps + 1, measured(at - step)
        while not found[0] <= loss and np.abs(step).max() > 1e-14:
            step = step / 2
            found = measured(at - step)
        if not found[0] <= loss:
            break
        at, (loss, gradient, hessian) = at - step, found
    return WeibullModel(tuple((at[:-2] / spreads).tolist()), float(at[-2]), float(np.exp(at[-1])), steps)


def remaining_median(scale_time: Column, shape: float, waited: Column) -> Column:
    """Median further wait given ``waited``, for survival exp(-(t / scale)^shape); NULL when it is not finite."""
    ratio = F.pow(waited / scale_time, F.lit(shape))
    remaining = scale_time * F.pow(ratio + F.lit(0.6931471805599453), F.lit(1.0 / shape)) - waited
    finite = remaining.isNotNull() & ~F.isnan(remaining) & (F.abs(remaining) < F.lit(float("inf")))
    return F.when(finite, F.greatest(remaining, F.lit(0.0)))


def expected_next_purchase(model: WeibullModel, repeat_customers: DataFrame) -> DataFrame:
    """Expected days to the next purchase, one decimal, NULL only where it is not finite. The model's prediction is the Weibull scale."""
    waited = F.col("days_since_last_order").cast("double")
    days = remaining_median(F.col("prediction"), model.shape, waited)
    return model.transform(repeat_customers).select(
        PERSON, F.round(days, 1).alias("expected_next_purchase_days"))


def concordance(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Share of comparable pairs the prediction orders rightly, ties counting half; exact, and no pair is made.

    Distinct predictions get rising numbers. Two different numbers part at exactly one bit, where all higher bits agree and the
    smaller has 0: per bit, the rows that agree above it are counted by day on either side, which finds each pair once. That
    makes as many rows per prediction as numbers have varying bits; a window holds at most one row per day.
    """
    cells = materialize(scored.groupBy(F.col("duration").cast("long").alias("d"), F.col(prediction).alias("p")).agg(
        F.sum(F.col("event").cast("long")).alias("events"), F.count(F.lit(1)).alias("n")), "survival-cells")
    numbers = materialize(cells.select("p").distinct().repartitionByRange("p").sortWithinPartitions("p")
                          .withColumn("r", F.monotonically_increasing_id()), "prediction-numbers")
    placed = cells.join(numbers, "p").withColumn("open", F.col("n") - F.col("events"))
    varying = placed.agg(F.bit_or("r").bitwiseAND(F.bitwise_not(F.bit_and("r"))).alias("bits")).first()["bits"] or 0

    def part(level: int, block: Column, earlier: Column, later: Column) -> Column:
        none = F.lit(0).cast("long")
        return F.struct(F.lit(level).alias("level"), block.cast("long").alias("block"), F.when(earlier, F.col("events")).otherwise(none).alias("e"),
                        F.when(later, F.col("n")).otherwise(none).alias("n"), F.when(later, F.col("open")).otherwise(none).alias("o"))

    both = F.lit(True)
    parts = [part(-2, F.lit(0), both, both), part(-1, F.col("r"), both, both)]
    for level in (i for i in range(63) if varying >> i & 1):
        high = F.shiftright("r", level).bitwiseAND(F.lit(1)) == 1
        parts.append(part(level, F.shiftright("r", level + 1), ~high, high))
    counted = placed.select("d", F.explode(F.array(*parts)).alias("x")).select("d", "x.*").groupBy("level", "block", "d").agg(
        F.sum("e").alias("e"), F.sum("n").alias("n"), F.sum("o").alias("o"))
    after = Window.partitionBy("level", "block").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, -1)
    # later rows outlive an event; so does a row still open on the same day
    pairs = counted.withColumn("pairs", F.col("e") * (F.coalesce(F.sum("n").over(after), F.lit(0)) + F.col("o")))
    kinds = pairs.agg(*[F.coalesce(F.sum(F.when(kind, F.col("pairs"))), F.lit(0)).alias(name) for name, kind in (
        ("total", F.col("level") == -2), ("ties", F.col("level") == -1), ("right", F.col("level") >= 0))])
    return kinds.select(((F.col("right") + F.col("ties") / 2) / F.nullif("total", F.lit(0))).alias("concordance"),
                        F.col("total").alias("comparable_pairs"))
