"""The penalised Weibull fit against a plain one."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from patronage.operators import survival


def sample(n=2000, seed=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(3, 2, n), rng.random(n) < 0.3, rng.random(n) < 0.002, np.ones(n)]).astype(float)
    time = np.exp(3 + 0.2 * x[:, 0] - 0.5 * x[:, 1] + 2 * x[:, 2]) * rng.weibull(1.4, n) + 0.01
    limit = rng.exponential(60, n) + 0.01
    return x, np.minimum(time, limit), (time <= limit).astype(float)


def frame(spark, x, time, event):
    rows = [(*map(float, r), float(t), int(e)) for r, t, e in zip(x, time, event, strict=True)]
    names = [f"x{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", duration double, event int")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).repartition(5)


def plain_loss(at, x, time, event, penalty):
    """Minus the mean log-likelihood plus the penalty; ``at`` holds coefficients of x in units of its spread, intercept, log shape."""
    shape = np.exp(at[-1])
    w = shape * (np.log(time) - x @ at[:-2] - at[-2])
    return -(event * (at[-1] - np.log(time) + w) - np.exp(w)).mean() + penalty / 2 * (at[:-2] ** 2).sum()


def plain_fit(x, time, event, penalty):
    """Newton's method with derivatives by differences."""
    spread = x.std(axis=0, ddof=1)
    spread[spread < 1e-8] = 1
    z, k, h = x / spread, x.shape[1] + 2, 1e-4
    at = np.zeros(k)
    at[-2] = np.log(time.sum() / event.sum())
    for _ in range(60):
        f = lambda p: plain_loss(p, z, time, event, penalty)
        unit = np.eye(k) * h
        gradient = np.array([(f(at + u / 10) - f(at - u / 10)) * 10 / (2 * h) for u in unit])
        hessian = np.array([[(f(at + u + v) - f(at + u - v) - f(at - u + v) + f(at - u - v)) / (4 * h * h) for v in unit] for u in unit])
        step = np.linalg.solve(hessian + max(0, 1e-6 - np.linalg.eigvalsh(hessian)[0]) * np.eye(k), gradient)
        while f(at - step) > f(at) and np.abs(step).max() > 1e-12:
            step /= 2
        at = at - step
    return at[:-2] / spread, at[-2], np.exp(at[-1])


def test_equals_a_plain_fit(spark):
    x, time, event = sample()
    model = survival.train_survival(frame(spark, x, time, event))
    coefficients, intercept, shape = plain_fit(x, time, event, 0.01)
    assert list(model.coefficients) == pytest.approx(coefficients.tolist(), abs=1e-6)
    assert (model.intercept, model.shape) == pytest.approx((intercept, shape), abs=1e-6) and model.steps < 30


def test_rare_groups_are_shrunken(spark):
    x, time, event = sample()
    # a group of a few rows without an event would get a coefficient without bound
    event[x[:, 2] > 0] = 0
    assert 0 < (x[:, 2] > 0).sum() < 10
    rows = frame(spark, x, time, event)
    free, held = (survival.train_survival(rows, penalty=p) for p in (1e-6, 0.01))
    assert 0 < held.coefficients[2] < 0.6 * free.coefficients[2]
    # a column without spread gets no weight
    assert abs(held.coefficients[3]) < 1e-8


def test_scale_medians_and_no_events(spark):
    x, time, event = sample(200)
    rows = frame(spark, x, time, event)
    model = survival.train_survival(rows)
    scale = {r["duration"]: r["prediction"] for r in model.transform(rows).collect()}
    for r, t in zip(x, time, strict=True):
        assert scale[t] == pytest.approx(np.exp(model.intercept + r @ np.array(model.coefficients)), rel=1e-12)
    none = survival.train_survival(rows.withColumn("event", F.lit(0)))
    assert (none.intercept, none.shape, none.steps) == (0.0, 1.0, 0)
    assert survival.train_survival(rows.limit(0)).shape == 1.0
