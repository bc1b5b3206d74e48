"""Boosted trees as tables: splits against brute force, nested scores against separate
fits, the MLlib path beyond the bound, missing features."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark.operators import boosting as B
from agrospark.plans import model_queries as Q


def data(n=60, m=4, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, m)), 1)
    return x, np.round(3 * x[:, 0] + (x[:, 1] > 0.4) * 2 + rng.random(n), 3)


def frame(spark, x, y):
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"f{j} double" for j in range(x.shape[1])) + ", y double")


def names(x):
    return [f"f{j}" for j in range(x.shape[1])]


def test_splits_are_the_best_ones():
    x, y = data()
    b = B.Binned(x)
    feature, cut, value = B.grow(b, b.codes, y, 2)

    def best(on):
        found = []
        for j in range(x.shape[1]):
            for c in b.cuts[j]:
                left = on & (x[:, j] <= c)
                right = on & ~left & on
                if left.any() and right.any():
                    found.append((((y[left] - y[left].mean()) ** 2).sum() + ((y[right] - y[right].mean()) ** 2).sum(), j, c))
        return min(found)
    every = np.ones(len(y), bool)
    error, j, c = best(every)
    assert (feature[0], b.cuts[feature[0]][cut[0]]) == (j, c) and value[0] == pytest.approx(y.mean())
    for side, node in ((x[:, j] <= c, 1), (x[:, j] > c, 2)):
        _, k, d = best(side)
        assert (feature[node], b.cuts[feature[node]][cut[node]]) == (k, d)
        assert value[node] == pytest.approx(y[side].mean())


def test_a_cut_tree_and_a_prefix_are_the_smaller_fits():
    x, y = data(80)
    b = B.Binned(x)
    deep = B.grow(b, b.codes, y, 5)
    for d in range(1, 5):
        own = B.grow(b, b.codes, y, d)
        assert np.allclose(deep[2][B.leaves(b.codes, deep[0], deep[1], d)], own[2][B.leaves(b.codes, own[0], own[1], d)])
    long, short = (B.boost(b, y, np.arange(70), n, 0.1, 2, 0.5, 3) for n in (9, 4))
    for one, other in zip(long, short):
        assert all(np.array_equal(p, q) for p, q in zip(one, other))


def separate(x, y, grid, folds, seed, max_depth):
    """Every setting of its own fit, one after the other."""
    fold = B.fold_of(len(y), folds, seed)
    out = {}
    b = B.Binned(x)
    reached = B._cut_scores(b, y, np.arange(len(y)), np.array([], int), max_depth)[0]
    for d in range(1, reached + 1):
        e = []
        for k in range(folds):
            on, off = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            f, c, v = B.grow(b, b.codes[on], y[on], d)
            e.append(-((y[off] - v[B.leaves(b.codes[off], f, c, d)]) ** 2).mean())
        out["depth", float(d)] = np.mean(e)
    for i, p in enumerate(product(*grid.values())):
        p = dict(zip(grid, p))
        e = []
        for k in range(folds):
            on, off = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            rows = B.model_rows(b, B.boost(b, y, on, p["maxIter"], p["stepSize"], p["maxDepth"], p["subsamplingRate"], seed)).to_pylist()
            e.append(-((y[off] - B.Scorer(rows)(x[off])) ** 2).mean())
        out["grid", float(i)] = np.mean(e)
    return out


GRID = dict(maxIter=[3, 6], stepSize=[0.05, 0.2], maxDepth=[1, 2], subsamplingRate=[0.5, 1.0])


def test_search_equals_separate_fits(spark):
    x, y = data()
    got = B.search(frame(spark, x, y).repartition(5), names(x), "y", ["id"], GRID, max_depth=9, folds=3).collect()
    # the rows reach the fit in the order of the text of their keys
    order = np.array(sorted(range(len(y)), key=lambda i: '{"id":%d,' % i))
    want = separate(x[order], y[order], GRID, 3, 1, 9)
    assert {(r["kind"], r["setting"]) for r in got} == set(want)
    for r in got:
        assert r["neg_mse"] == pytest.approx(want[r["kind"], r["setting"]]), r


def test_search_beyond_the_bound_uses_mllib_and_nested_scores(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
    x, y = data(50, 2)
    df = frame(spark, x, y)
    grid = dict(maxIter=[1, 2], stepSize=[0.1], maxDepth=[2], subsamplingRate=[1.0])
    got = {(r["kind"], r["setting"]): r["neg_mse"] for r in
           B.search(df, names(x), "y", ["id"], grid, max_depth=2, folds=2, most=0).collect()}
    fold = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2))
    wide = VectorAssembler(inputCols=names(x), outputCol="_x").transform(df).withColumn("_fold", fold)

    def mean(model):
        e = [model.fit(wide.where(F.col("_fold") != k)).transform(wide.where(F.col("_fold") == k)).agg(
            F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).first()[0] for k in range(2)]
        return -sum(e) / 2
    assert got["depth", 1.0] == pytest.approx(mean(DecisionTreeRegressor(featuresCol="_x", labelCol="y", maxDepth=1, seed=1)))
    assert got["grid", 0.0] == pytest.approx(mean(GBTRegressor(featuresCol="_x", labelCol="y", maxIter=1, stepSize=0.1, maxDepth=2, seed=1)))


def test_both_fits_give_the_same_kind_of_model(spark):
    x, y = data(60, 3)
    df = frame(spark, x, y)
    for most in (None, 0):
        model = B.fit_trees(df, names(x), "y", ["id"], maxIter=5, stepSize=0.3, maxDepth=2, most=most)
        got = B.score(df.withColumn("f1", F.when(F.col("id") != 7, F.col("f1"))), model, names(x)).collect()
        assert len(got) == 60 and [r["id"] for r in got if r["prediction"] is None] == [7]
        error = np.mean([(r["prediction"] - r["y"]) ** 2 for r in got if r["id"] != 7])
        assert error < 0.6 * np.var(y), most


def test_nothing_to_fit_gives_no_prediction(spark):
    x, y = data(3, 2)
    df = frame(spark, x, y)
    model = B.fit_trees(df.limit(0), names(x), "y", ["id"], maxIter=5)
    assert [r["prediction"] for r in B.score(df, model, names(x)).collect()] == [None] * 3
    got = B.search(df, names(x), "y", ["id"], GRID, folds=5).collect()
    assert all(r["neg_mse"] is None for r in got) and len([r for r in got if r["kind"] == "grid"]) == 16


def test_forecast_feeds_predictions_back(spark):
    trees = [dict(tree=0, feature=[-1], threshold=[0.0], value=[1.0]),
             dict(tree=1, feature=[2, -1, -1], threshold=[10.0, 0, 0], value=[0.0, 5.0, 20.0])]
    last = spark.createDataFrame([("a", "2020-11-01", 3.0, 0), ("b", "2020-11-01", 30.0, 1), ("c", "2020-11-01", None, 2)],
                                 "site string, day string, v double, code int").withColumn("day", F.to_date("day"))
    got = [tuple(r) for r in B.forecast(last, B.Scorer(trees), "site", "day", "v", "code", 3).orderBy("site", "step").collect()]
    assert [(s, k, str(d), v) for s, k, d, v in got] == [
        ("a", 1, "2020-12-01", 6.0), ("a", 2, "2021-01-01", 6.0), ("a", 3, "2021-02-01", 6.0),
        ("b", 1, "2020-12-01", 21.0), ("b", 2, "2021-01-01", 21.0), ("b", 3, "2021-02-01", 21.0),
        ("c", 1, "2020-12-01", None), ("c", 2, "2021-01-01", None), ("c", 3, "2021-02-01", None)]


def test_yield_model_on_a_table_with_rows(spark):
    t = Q._training(spark, "/root/testdata/sf0.01")
    train = t.where("is_train")
    model = B.fit_trees(train, Q.FEATURES, "produccion_tn", ["position"], maxIter=60, stepSize=0.1, maxDepth=3)
    tail = B.score(t.where("NOT is_train"), model, Q.FEATURES).collect()
    assert len(tail) == 92 and all(r["prediction"] is not None for r in tail)
    actual = np.array([r["produccion_tn"] for r in tail])
    assert np.mean((actual - [r["prediction"] for r in tail]) ** 2) < 0.5 * actual.var()
    got = B.search(train, Q.FEATURES, "produccion_tn", ["position"], dict(maxIter=[5, 10], stepSize=[0.1], maxDepth=[1, 3], subsamplingRate=[1.0]), folds=2)
    kinds = [r["kind"] for r in got.collect()]
    assert kinds.count("grid") == 4 and kinds.count("depth") == 9
