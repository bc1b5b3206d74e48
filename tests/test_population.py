"""Roulette over a table against a plain walk along the line."""

import bisect
import itertools
import random

from agrospark.operators.population import prefix_weights, roulette_rows


def test_roulette_of_a_table_with_a_hot_individual(spark):
    rnd = random.Random(2)
    w = {i: rnd.choice([0, 0, 1, 5, 9]) for i in range(500)}
    w[77] = 4000                                                    # most draws meet here
    pop = spark.createDataFrame([*w.items(), (500, None), (501, -3)], "id long, weight long").repartition(7)
    ids = [i for i in sorted(w) if w[i] > 0]
    starts = [0, *itertools.accumulate(w[i] for i in ids)]
    got = {r["id"]: r["start"] for r in prefix_weights(pop).collect()}
    assert [got[i] for i in ids] == starts[:-1] and got[501] == starts[-1]
    draws = [(j, rnd.random()) for j in range(4000)] + [(4000, 0.0), (4001, 1 - 2 ** -53), (4002, None)]
    out = {r["draw"]: r["id"] for r in roulette_rows(pop, spark.createDataFrame(draws, "draw long, share double")).collect()}
    want = {j: None if u is None else ids[bisect.bisect_right(starts, min(int(u * starts[-1]), starts[-1] - 1)) - 1] for j, u in draws}
    assert out == want and len(set(want.values())) > 50


def test_no_weight_and_no_draws(spark):
    pop = spark.createDataFrame([(1, 0), (2, None)], "id long, weight long")
    draws = spark.createDataFrame([(1, 0.5)], "draw long, share double")
    assert [r["id"] for r in roulette_rows(pop, draws).collect()] == [None]
    assert [r["id"] for r in roulette_rows(pop.limit(0), draws).collect()] == [None]
    assert roulette_rows(pop, draws.limit(0)).count() == 0
