"""The registered model queries and searches run at the reference's sizes."""

import inspect

import pytest

from agrospark.operators import boosting as B
from agrospark.operators import generations as GN
from agrospark.operators import recurrent as RN
from agrospark.plans import evolution_queries as EQ
from agrospark.plans import model_queries as Q


class Seen(Exception):
    pass


def caught(monkeypatch, owner, name, call):
    """The arguments of the first call of ``owner.name``, with its defaults."""
    sign = inspect.signature(getattr(owner, name))

    def stop(*a, **k):
        bound = sign.bind(*a, **k)
        bound.apply_defaults()
        raise Seen(bound.arguments)
    with monkeypatch.context() as m:
        m.setattr(owner, name, stop)
        with pytest.raises(Seen) as e:
            call()
    return e.value.args[0]


def training(spark, n):
    rows = [(2000 + i, "d", "c", float(i), i + 1, i + 1 <= int(0.8 * n)) for i in range(n)]
    return spark.createDataFrame(rows, "anio int, departamento_nombre string, cultivo_nombre string, produccion_tn double, position long, is_train boolean")


def test_models_run_at_reference_sizes(spark, monkeypatch):
    monkeypatch.setattr(Q, "_training", lambda s, d: training(s, 12))
    fit = caught(monkeypatch, B, "fit_trees", lambda: Q.yield_model_holdout(spark, ""))
    assert (fit["maxIter"], fit["stepSize"], fit["maxDepth"], fit["subsamplingRate"]) == (1000, 0.05, 3, 1.0)
    assert fit["df"].count() == 9          # the first 80 %
    search = caught(monkeypatch, B, "search", lambda: Q.yield_model_selection(spark, ""))
    assert (search["max_depth"], search["folds"], search["df"].count()) == (9, 5, 9)
    assert search["grid"] == dict(maxIter=[500, 1000], stepSize=[0.001, 0.05], maxDepth=[1, 3], subsamplingRate=[0.5, 1.0])
    series = spark.createDataFrame([("a", f"2020-0{i}-01", 1.0 * i, 1, 1, 1.0, 0) for i in range(1, 9)],
                                   "departamento_nombre string, fecha string, v double, anio int, mes int, lag1 double, site_code int")
    monkeypatch.setattr(Q, "_series", lambda s, d, col: series.withColumnRenamed("v", col))
    for q, trees, share in ((Q.rain_forecast_14, 700, 0.8), (Q.wind_forecast_14, 1000, 1.0)):
        fit = caught(monkeypatch, B, "fit_trees", lambda: q(spark, ""))
        assert (fit["maxIter"], fit["stepSize"], fit["maxDepth"], fit["subsamplingRate"]) == (trees, 0.05, 3, share)
    monkeypatch.setattr(Q, "_windows", lambda s, d, col: s.createDataFrame([("a", "2020-01-01", [1.0] * 14, 1.0)], "departamento_nombre string, fecha string, input array<double>, target double"))
    net = caught(monkeypatch, RN, "train", lambda: Q.temperature_lstm_forecast(spark, ""))
    assert (net["units"], net["dense"], net["steps"]) == (64, 8, 200)


def test_searches_run_at_reference_sizes(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    for q, individuals, k in ((EQ.bitstring_evolution_history, 10, 4), (EQ.tour_evolution_history, 50, 20), (EQ.allocation_evolution_totals, 10, None)):
        got = caught(monkeypatch, GN, "evolve", lambda: q(spark, sf))
        assert got["generations"] == 200 and got["search"].n_select == individuals - 2 and k in (None, got["search"].k)
        assert len(got["df"].first()["pop"]) == individuals
