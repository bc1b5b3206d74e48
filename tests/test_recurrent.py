"""The recurrent climate model: gradients, training in tasks, forecasts."""

import numpy as np
from pyspark.sql import functions as F

from agrospark.operators import recurrent as RN


def test_gradient_against_finite_differences():
    net = RN.Net(units=3, dense=2)
    rng = np.random.default_rng(4)
    w = net.start(2) + rng.normal(0, 0.1, net.size)
    x, y = rng.normal(size=(7, 5)), rng.normal(size=7)
    loss, g = net.gradient(w, x, y)
    assert np.isclose(loss, ((net.forward(w, x)[0] - y) ** 2).sum())
    for i in range(net.size):
        step = np.zeros(net.size)
        step[i] = 1e-6
        d = (net.gradient(w + step, x, y)[0] - net.gradient(w - step, x, y)[0]) / 2e-6
        assert np.isclose(d, g[i], rtol=1e-4, atol=1e-6), i


def samples(spark, n=120):
    wave = lambda t: 10 + 5 * np.sin(t / 2)
    rows = [("a", [float(wave(i + j)) for j in range(6)], float(wave(i + 6))) for i in range(n)]
    rows += [("b", [2.0] * 6, 2.0)] * 5 + [("a", [None] * 6, 1.0), ("a", [1.0] * 6, None)]
    return spark.createDataFrame(rows, "series string, x array<double>, y double")


def test_training_in_many_tasks_is_training_in_one(spark, monkeypatch):
    one = RN.train(samples(spark), steps=25, units=6, dense=3, per_task=10_000)
    many = RN.train(samples(spark), steps=25, units=6, dense=3, per_task=20)
    monkeypatch.setattr(RN, "FAN_IN", 3)
    tree = RN.train(samples(spark), steps=25, units=6, dense=3, per_task=20)
    assert set(one) == {"a", "b"} and len(one["a"].losses) == 25
    assert np.allclose(one["a"].losses, many["a"].losses) and np.allclose(many["a"].w, tree["a"].w)
    assert one["a"].losses[-1] < 0.3 * one["a"].losses[0]
    assert RN.train(samples(spark).limit(0), steps=2) == {}


def test_forecast_moves_the_window(spark):
    net = RN.Net(2, 2)
    fitted = RN.Fitted(net, net.start(1), 10.0, 2.0, [])
    last = spark.createDataFrame([("s", [8.0, 9.0, 11.0]), ("t", [None, 9.0, 11.0])], "site string, w array<double>").withColumn(
        "day", F.lit("2020-12-01").cast("date"))
    got = RN.forecast(last, fitted, "site", "day", "w", 3, "v").orderBy("site", "step").collect()
    x, want = np.array([[8.0, 9.0, 11.0]]), []
    for _ in range(3):
        want.append(fitted(x)[0])
        x = np.column_stack([x[:, 1:], want[-1:]])
    assert np.allclose([r["v"] for r in got[:3]], want)
    assert [str(r["day"]) for r in got[:3]] == ["2021-01-01", "2021-02-01", "2021-03-01"]
    assert [r["v"] for r in got[3:]] == [None] * 3
