"""What keeps the searches and price boards within their limits on larger tables."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark.functions.digests import md5_words
from agrospark.operators import evolution as EV
from agrospark.operators import generations as GN
from agrospark.plans import evolution_queries as EQ
from agrospark.plans import text_price_queries as TP
from agrospark.sources.sinks import history_table


def rows(hist):
    return {(r["instance_id"], r["gen"]): (r["max_obj"], r["min_obj"], r["avg_obj"], r["best_idx"], [float(x) for x in r["best_genes"]])
            for r in hist.collect()}


def orders(spark, tmp_path, n=40):
    spark.range(n).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def parts(spark, tmp_path):
    some = [(i, f"part {i}", "promo" if i % 2 else "economy", 16 if i < 4 else 3, 900.0 + i) for i in range(20)]
    spark.createDataFrame(some, "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_bit_strings_as_numbers_equal_arrays(spark):
    pop = EV.init_bits(spark.range(40).withColumnRenamed("id", "instance_id"), 7, 12)
    s = GN.Search(GN.bits_objective, 5, GN.one_point, GN.inversion, k=3, p_mut=0.4, genes="bits")
    end, numbers = GN.evolve(pop, s, 9, stretch=4)
    want, arrays = GN.evolve(pop, replace(s, genes="uint8"), 9)
    assert rows(numbers) == rows(arrays)
    assert {r["instance_id"]: r["pop"] for r in end.collect()} == {r["instance_id"]: r["pop"] for r in want.collect()}


def test_only_the_last_generation_is_recorded_where_no_other_is_read(spark):
    pop = EV.init_bits(spark.range(5).withColumnRenamed("id", "instance_id"), 7, 12)
    s = GN.Search(GN.bits_objective, 5, GN.one_point, GN.inversion, k=3, genes="bits")
    every = rows(GN.evolve(pop, s, 6)[1])
    assert rows(GN.evolve(pop, s, 6, stretch=4, whole=False)[1]) == {k: v for k, v in every.items() if k[1] == 6}


def test_first_decrease_of_one_row_an_instance(spark):
    some = [(1, [1.0, 2.0, 1.5, 1.0]), (2, [1.0, 1.0]), (3, [3.0]), (4, [2.0, 1.0, 3.0, 2.0])]
    hist = spark.createDataFrame(some, "instance_id long, m array<double>").select("instance_id", F.transform("m", lambda x, i: F.struct(i.alias("gen"), x.alias("max_obj"))).alias("hist"))
    one = EV.first_decrease(hist).select("instance_id", "first_decrease_gen").collect()
    many = EV.first_decrease(hist.select("instance_id", F.explode("hist").alias("h")).select("instance_id", "h.*")).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) == [(1, 2), (2, None), (3, None), (4, 1)]


def test_history_of_bits_is_not_shuffled(spark, tmp_path):
    got = EQ.bitstring_evolution_history(spark, orders(spark, tmp_path), 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1 and "Window" not in plan and got.count() == 40 * 4


def test_offspring_are_not_computed_by_a_filter_before_the_exchange(spark, tmp_path):
    plan = EQ.bitstring_offspring(spark, orders(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter (size(" not in plan and "RepartitionByExpression" in plan


def test_pages_are_dealt_and_parsed_once(spark, tmp_path):
    d = parts(spark, tmp_path)
    assert TP.board_entry_prices(spark, d).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    prices = TP.board_prices(spark, d)
    assert "MapInPandas" not in prices._jdf.queryExecution().optimizedPlan().toString()
    assert prices.count() == 2


def test_tours_as_numbers_equal_arrays(spark, monkeypatch):
    """tours of few points are held as numbers, with the same draws; near-equal lengths, points that coincide, no points known."""
    rng = np.random.default_rng(2)
    some = [(i, [[float(x), float(y)] for x, y in rng.integers(0, 4 if i % 3 else 97, (i % 8 + 1, 2))]) for i in range(80)]
    some += [(100 + i, [[0.1 * j, 0.3 * j * j] for j in range(i)]) for i in range(1, 8)] + [(200, [[1.0, 1.0]] * 5), (201, [[None, 1.0], [2.0, 3.0], [4.0, 4.0]])]
    df = spark.createDataFrame(some, "instance_id long, pts array<array<double>>").withColumn("n", F.size("pts"))
    pop = EV.init_permutations(df, 50, "n").withColumn("pts", F.flatten("pts")).coalesce(1)
    b = pop.select("instance_id", F.col("pop").cast("array<array<double>>").alias("pop"),
                   F.transform("pts", lambda x: F.coalesce(x, F.lit(float("nan")))).alias("pts")).toArrow().combine_chunks().to_batches()[0]
    s = replace(EQ.TOUR_SEARCH, labels=None)
    numbered = []
    monkeypatch.setattr(GN, "numbered_swap", lambda *a, real=GN.numbered_swap: numbered.append(len(a[1])) or real(*a))
    monkeypatch.setitem(GN.NUMBERS, GN.swap, GN.numbered_swap)
    got = [x for o in GN._task(s, 0, 30, True, True, ())(iter([b])) for x in o.to_pylist()]
    assert numbered
    monkeypatch.setattr(GN, "NUMBERED", 0)
    want = [x for o in GN._task(s, 0, 30, True, True, ())(iter([b])) for x in o.to_pylist()]
    by = lambda r: r["instance_id"]
    assert sorted(got, key=by) == sorted(want, key=by) and len(got) == len(some)


def test_ranks_of_equal_fitness_are_drawn():
    """individuals by fitness, then draw, whatever the numbers that are sorted can hold."""
    rng = np.random.default_rng(4)
    fit = rng.integers(0, 5, (300, 50)) / 7.0
    fit[:50] = 0.25
    fit[50:60] = 0
    fit[60:90] = np.nextafter(0.3, 1) * (rng.random((30, 50)) < 0.5) + 0.3 * (rng.random((30, 50)) < 0.5)
    for drawn in (rng.random((300, 50)), 0.5 + rng.permuted(np.tile(np.arange(50), (300, 1)), axis=1) * 2.0 ** -40):      # the leading bits of draws differ, or don't
        want = [sorted(range(50), key=lambda i: (-f[i], d[i])) for f, d in zip(fit, drawn)]
        assert GN.shuffled_ranks(fit, lambda tag, shape: drawn).tolist() == want
    far = np.where(rng.random((9, 50)) < 0.5, 1e-200, 1.0) * rng.random((9, 50))
    many = rng.random((4, 90))
    for f in (far, many):
        assert GN.shuffled_ranks(f, lambda tag, shape: np.broadcast_to(0.5, f.shape)).tolist() == np.argsort(-f, axis=1).tolist()
    u = np.append(rng.random(5000), [0.0, 1 - 2.0 ** -53, *GN.best_rank_chances(50, 20)])
    u = u[u < 1]
    for n, k in ((50, 20), (1, 1), (7, 7), (9, 1)):
        want = np.minimum(np.searchsorted(GN.best_rank_chances(n, k), u, "right"), n - 1)
        assert GN.drawn_ranks(n, k, (u * 2.0 ** 53).astype(np.uint64)).tolist() == want.tolist()


def test_digests_of_many_texts():
    heads, tails = [b"0|init|%d|0|" % (7 ** i) for i in range(12)] + [b"x" * 52, b""], [b"%d|%d" % (i, g) for i in range(11) for g in range(3)]
    hexes = [[hashlib.md5(h + t).hexdigest() for t in tails] for h in heads]
    assert md5_words(heads, tails).tolist() == [[[int(x[8 * w:8 * w + 8], 16) for w in range(4)] for x in row] for row in hexes]
    assert md5_words([], tails).shape == (0, len(tails), 4)


def test_batched_populations_equal_the_expressions(spark):
    """initial populations are made for a batch of instances, not gene by gene."""
    ids = [(None, 3), (1, 1), (22, 5), (333, None), (-5, 9), (10 ** 17, 2), (7, 0), (9, 26)]
    df = spark.createDataFrame(ids, "instance_id long, n int")
    texts = df.withColumn("instance_id", F.concat(F.lit("z" * 60), "n"))
    for one in (df, texts, df.limit(0)):
        for batched, plain in ((EV.init_permutations(one, 12, "n", seed=2, batched=True), EV.init_permutations(one, 12, "n", seed=2)),
                               (EV.init_bits(one, 7, 30, batched=True), EV.init_bits(one, 7, 30)), (EV.init_bits(one, 3, 200, batched=True), EV.init_bits(one, 3, 200))):
            assert batched.collect() == plain.collect()


@pytest.mark.parametrize("labels", [None, " -> "])
def test_history_of_tours_is_rendered_by_instance(spark, labels):
    """a history of one row an instance gives the rows of its generations, each distance rendered once."""
    df = spark.createDataFrame([(i, [[float(j * j % 7), 1e6 * (j % 3)] for j in range(i % 6 + 1)]) for i in range(1, 14)], "instance_id long, pts array<array<double>>")
    pop = EV.init_permutations(df.withColumn("n", F.size("pts")), 10, "n").withColumn("pts", F.flatten("pts"))
    s = replace(EQ.TOUR_SEARCH, n_select=8, k=4)
    got = history_table(GN.evolve(pop, replace(s, labels=labels), 9, by_instance=True)[1], "tour")
    want = history_table(GN.evolve(pop, replace(s, labels=None), 9)[1], "tour")
    assert sorted(got.collect()) == sorted(want.collect()) and got.columns == want.columns
    assert {r.Distancia_km for r in got.where("instance_id = 6").collect()} == {"inf"}


def test_equal_parents_draw_nothing(monkeypatch):
    """whether and where parents are cut is drawn only for those that differ."""
    tags = []
    monkeypatch.setattr(GN, "hashed_bits", lambda base, tag, *a, real=GN.hashed_bits: tags.append(tag) or real(base, tag, *a))
    s, ids = GN.held(replace(EQ.BIT_SEARCH, p_mut=0.0), GN.PACKED), np.arange(40)
    GN.run(s, ids, np.full((40, 10), 5), {"bits": 30}, 0, 6, True)
    assert set(tags) == {"tour", "mp"}
    tags.clear()
    GN.run(s, ids, np.arange(400).reshape(40, 10), {"bits": 30}, 0, 1, True)
    assert {"xp", "xc"} <= set(tags)


@pytest.mark.parametrize("bits", [1, 2, 30, 53])
def test_inversion_of_numbers(bits):
    """genes between two places are turned as a word, as those of an array are."""
    rng = np.random.default_rng(bits)
    pop, s = rng.integers(0, 2, (500, 8, bits)), GN.Search(GN.bits_objective, 8, GN.one_point, GN.inversion, p_mut=0.7)
    u = GN.Draws(s, np.arange(500))
    numbers = pop @ (1 << np.arange(bits - 1, -1, -1))
    assert (GN._digits(numbers, bits) == pop).all()
    for step, packed in ((GN.inversion, GN.packed_inversion), (GN.one_point, GN.packed_one_point)):
        assert (GN._digits(packed(s, numbers, {"bits": bits}, u), bits) == step(s, pop, {}, u)).all()


def test_histories_do_not_digest_gene_by_gene(spark, tmp_path):
    """populations are no expression of md5 digests."""
    plan = EQ.bitstring_evolution_history(spark, orders(spark, tmp_path), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" not in plan and "ArrowEvalPython" in plan
