"""Evolutionary-search queries: bit strings per order, tours per order,
crop allocations per customer field.  Every instance of the table is
searched; one generation step per oracle query, full loops rows-only."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evolution as EV
from ..operators import features as FE
from ..operators import generations as GN
from ..operators import geo as G
from ..operators import tours as TR
from ..session import cut_lineage, read_table, spread
from ..sources.sinks import history_table
from . import tables as T
from .registry import register
from .search_queries import SQL_NODES, tour_nodes
from .soil_geo_queries import POINTS_IN_DEPARTMENTS_SQL
from .tables import R, with_ctes
from .text_price_queries import SQL_BOARD, board_prices

N_IND, N_BITS, N_SEL, K_TOUR = 10, 30, 8, 4
P_CROSS, P_MUT = 0.75, 0.05
# the reference's tour search; its other two searches ask for the number of generations
GENERATIONS, TOUR_IND, TOUR_K = 200, 50, 20
CROPS = ["economy", "large", "medium", "promo", "small", "standard"]


def U(tag: str, *keys: str, seed: int = 0) -> str:
    """DuckDB twin of :func:`agrospark.operators.evolution.u_sql`."""
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"(('0x' || substr(md5(concat_ws('|', '{seed}', '{tag}', {parts})), 1, 8))::BIGINT"
            f" / 4294967296.0)")


def _elements(df, array: str, pos: str, value: str, *keys: str):
    """``posexplode`` of a computed array.  The plain one adds a filter on the array's size,
    which the optimizer pushes below the exchanges: the array would be computed there first."""
    return df.select(*keys, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())


def _bit_pop(spark, d):
    inst = spread(read_table(spark, d, "orders").select(F.col("o_orderkey").alias("instance_id")), "instance_id")
    return EV.fitness(EV.bits_objective(EV.init_bits(inst, N_IND, N_BITS)))


SQL_BITS = f"""
b_ind AS (SELECT o_orderkey AS instance_id, i FROM orders, range({N_IND}) t(i)),
b_bits AS (
  SELECT instance_id, i, g,
         (('0x' || substr(md5(concat_ws('|', '0', 'bits', CAST(instance_id AS VARCHAR),
                                        '0', CAST(i AS VARCHAR), CAST(g // 128 AS VARCHAR))),
                          1 + (g % 128) // 4, 1))::INTEGER >> (3 - g % 4)) & 1 AS b
  FROM b_ind, range({N_BITS}) s(g)),
b_vals AS (
  SELECT instance_id, i, sum(CAST(b AS BIGINT) << ({N_BITS - 1} - g)) AS x,
         string_agg(CAST(b AS VARCHAR), '' ORDER BY g) AS bits
  FROM b_bits GROUP BY 1, 2),
b_obj AS (
  SELECT instance_id, i, bits, pow(x / CAST({2 ** 30 - 1} AS DOUBLE), 2) AS obj,
         pow(x / CAST({2 ** 30 - 1} AS DOUBLE), 2)
           / sum(pow(x / CAST({2 ** 30 - 1} AS DOUBLE), 2)) OVER (PARTITION BY instance_id) AS fit
  FROM b_vals),
b_comp AS (
  SELECT instance_id, j, l, CAST(floor({U('tour', 'instance_id', '0', 'j', 'l')} * {N_IND}) AS INTEGER) AS c
  FROM (SELECT DISTINCT instance_id FROM b_ind), range({N_SEL}) t(j), range({K_TOUR}) s(l)),
b_win AS (
  SELECT c.instance_id, c.j, min({{'nf': -o.fit, 'l': c.l, 'c': c.c}}).c AS w
  FROM b_comp c JOIN b_obj o ON o.instance_id = c.instance_id AND o.i = c.c GROUP BY 1, 2)"""


@register("bitstring_population_stats", covers=("G1", "P23", "P25", "A5", "A6"), bench=True, sql=with_ctes(
    SQL_BITS, body=f"""
SELECT instance_id, {R('max(obj)', 8)} AS max_obj, {R('min(obj)', 8)} AS min_obj,
       {R(f'sum(obj) / {N_IND}', 4)} AS avg_obj,
       CAST(min({{'no': -obj, 'i': i}}).i AS INTEGER) AS best_idx,
       min({{'no': -obj, 'i': i, 'b': bits}}).b AS best_bits
FROM b_obj GROUP BY 1"""))
def bitstring_population_stats(spark, d):
    s = EV.stats(_bit_pop(spark, d), 4)
    return s.select("instance_id", F.bround("max_obj", 8).alias("max_obj"),
                    F.bround("min_obj", 8).alias("min_obj"), "avg_obj", "best_idx",
                    F.array_join(F.col("best_genes").cast("array<string>"), "").alias("best_bits"))


@register("bitstring_roulette_selection", covers=("G4", "W4", "J10"), sql=with_ctes(
    SQL_BITS, f"""
b_cum AS (SELECT instance_id, i, sum(fit) OVER (PARTITION BY instance_id ORDER BY i
                                                ROWS UNBOUNDED PRECEDING) AS c FROM b_obj),
b_draw AS (SELECT instance_id, j, {U('roul', 'instance_id', '0', 'j')} AS r
           FROM (SELECT DISTINCT instance_id FROM b_ind), range({N_SEL}) t(j)),
b_pick AS (SELECT d.instance_id, d.j, coalesce(min(c.i) FILTER (WHERE d.r <= c.c), {N_IND - 1}) AS s
           FROM b_draw d JOIN b_cum c USING (instance_id) GROUP BY 1, 2)""", body="""
SELECT instance_id, string_agg(CAST(s AS VARCHAR), ',' ORDER BY j) AS selected
FROM b_pick GROUP BY 1"""))
def bitstring_roulette_selection(spark, d):
    r = EV.roulette(_bit_pop(spark, d), N_SEL)
    return r.select("instance_id", F.array_join(F.col("sel_idx").cast("array<string>"), ",")
                    .alias("selected"))


@register("bitstring_tournament_selection", covers=("G5",), sql=with_ctes(SQL_BITS, body="""
SELECT instance_id, string_agg(CAST(w AS VARCHAR), ',' ORDER BY j) AS selected
FROM b_win GROUP BY 1"""))
def bitstring_tournament_selection(spark, d):
    t = EV.tournament(_bit_pop(spark, d), N_SEL, K_TOUR)
    return t.select("instance_id", F.array_join(F.col("sel_idx").cast("array<string>"), ",")
                    .alias("selected"))


def _cut(j):
    return f"(1 + CAST(floor({U('xc', 'instance_id', '0', f'{j} // 2')} * {N_BITS - 1}) AS INTEGER))"


@register("bitstring_offspring", covers=("G6", "G9"), sql=with_ctes(SQL_BITS, f"""
b_sel AS (SELECT w.instance_id, w.j, o.bits FROM b_win w
          JOIN b_obj o ON o.instance_id = w.instance_id AND o.i = w.w),
b_xo AS (
  SELECT a.instance_id, a.j,
         CASE WHEN b.j IS NULL OR {U('xp', 'a.instance_id', '0', 'a.j // 2')} >= {P_CROSS} THEN a.bits
              ELSE left(a.bits, {_cut('a.j').replace('instance_id', 'a.instance_id')})
                   || substr(b.bits, {_cut('a.j').replace('instance_id', 'a.instance_id')} + 1) END AS bits
  FROM b_sel a LEFT JOIN b_sel b ON b.instance_id = a.instance_id AND b.j = a.j + 1 - 2 * (a.j % 2)),
b_mu AS (
  SELECT instance_id, j, bits,
         {U('mp', 'instance_id', '0', 'j')} < {P_MUT} AS hit,
         least(CAST(floor({U('m1', 'instance_id', '0', 'j')} * {N_BITS}) AS INTEGER),
               CAST(floor({U('m2', 'instance_id', '0', 'j')} * {N_BITS}) AS INTEGER)) AS lo,
         greatest(CAST(floor({U('m1', 'instance_id', '0', 'j')} * {N_BITS}) AS INTEGER),
                  CAST(floor({U('m2', 'instance_id', '0', 'j')} * {N_BITS}) AS INTEGER)) AS hi
  FROM b_xo)""", body="""
SELECT instance_id, CAST(j AS INTEGER) AS idx,
       CASE WHEN hit THEN left(bits, lo) || reverse(substr(bits, lo + 1, hi - lo + 1))
                          || substr(bits, hi + 2) ELSE bits END AS genes
FROM b_mu"""))
def bitstring_offspring(spark, d):
    t = EV.apply_selection(EV.tournament(_bit_pop(spark, d), N_SEL, K_TOUR))
    o = EV.mutate_inversion(EV.crossover_one_point(t, P_CROSS), P_MUT)
    return _elements(o, "sel", "idx", "g", "instance_id").select(
        "instance_id", "idx", F.array_join(F.col("g").cast("array<string>"), "").alias("genes"))


@register("bitstring_elites", covers=("W6", "G11"), sql=with_ctes(SQL_BITS, body="""
SELECT instance_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY fit DESC, i) AS elites
FROM (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY fit DESC, i) AS rn FROM b_obj)
WHERE rn <= 2 GROUP BY 1"""))
def bitstring_elites(spark, d):
    e = EV.elites(_bit_pop(spark, d), 2)
    return e.select("instance_id", F.array_join(F.col("elite_idx").cast("array<string>"), ",")
                    .alias("elites"))


BIT_SEARCH = GN.Search(GN.bits_objective, N_IND - 2, GN.one_point, GN.inversion, k=K_TOUR, p_cross=P_CROSS, p_mut=P_MUT, genes="bits")


@register("bitstring_evolution_history", covers=("G13", "U2", "W7", "S15"), sql=None)
def bitstring_evolution_history(spark, d, generations: int = GENERATIONS):
    inst = spread(read_table(spark, d, "orders").select(F.col("o_orderkey").alias("instance_id")), "instance_id")
    _, hist = GN.evolve(EV.init_bits(inst, N_IND, N_BITS, batched=True), BIT_SEARCH, generations, dealt=True, by_instance=True)
    hist = EV.first_decrease(hist).withColumn("first_decrease_gen", F.expr("IF(instance_id IS NULL, NULL, first_decrease_gen)"))
    rows = hist.select("instance_id", "first_decrease_gen", F.explode("hist").alias("h")).select("instance_id", "h.*", "first_decrease_gen")
    rows = rows.withColumn("best_value", F.conv("best_genes", 2, 10).cast("bigint"))
    return history_table(rows, "bits", ("first_decrease_gen",))


# ---- tours -------------------------------------------------------------------
def _tour_pop(spark, d, n_ind: int = N_IND, dealt: bool = False):
    inst = TR.instance_points(tour_nodes(spark, d))
    inst = spread(inst, "instance_id") if dealt else inst
    return EV.init_permutations(inst, n_ind, "n", batched=dealt)


@register("tour_population_lengths", covers=("G1", "G3", "J9", "A13"), sql=with_ctes(
    SQL_NODES.split(",\nt_dist")[0],
    f"""
p_ind AS (SELECT n.instance_id, n.n, t.i FROM t_n n, range({N_IND}) t(i)),
p_genes AS (
  SELECT p.instance_id, p.i, x.idx AS g, {U('init', 'p.instance_id', '0', 'p.i', 'x.idx')} AS u
  FROM p_ind p JOIN t_nodes x ON x.instance_id = p.instance_id),
p_ord AS (
  SELECT instance_id, i, g, row_number() OVER (PARTITION BY instance_id, i ORDER BY u, g) AS pos,
         count(*) OVER (PARTITION BY instance_id, i) AS n
  FROM p_genes),
p_legs AS (
  SELECT a.instance_id, a.i, a.pos, a.g,
         sqrt(CAST((na.x - nb.x) * (na.x - nb.x) + (na.y - nb.y) * (na.y - nb.y) AS DOUBLE)) AS d
  FROM p_ord a JOIN p_ord b ON b.instance_id = a.instance_id AND b.i = a.i
                           AND b.pos = CASE WHEN a.pos = a.n THEN 1 ELSE a.pos + 1 END
       JOIN t_nodes na ON na.instance_id = a.instance_id AND na.idx = a.g
       JOIN t_nodes nb ON nb.instance_id = b.instance_id AND nb.idx = b.g)""", body=f"""
SELECT instance_id, CAST(i AS INTEGER) AS idx,
       string_agg(CAST(g AS VARCHAR), ',' ORDER BY pos) AS tour, {R('sum(d)', 4)} AS length
FROM p_legs GROUP BY 1, 2"""))
def tour_population_lengths(spark, d):
    nodes = tour_nodes(spark, d)
    pop = _elements(_tour_pop(spark, d), "pop", "idx", "genes", "instance_id")
    t = TR.tour_length(pop, nodes, "genes")
    return t.select("instance_id", "idx",
                    F.array_join(F.col("genes").cast("array<string>"), ",").alias("tour"),
                    F.bround("length", 4).alias("length"))


TOUR_SEARCH = GN.Search(GN.tour_objective, TOUR_IND - 2, GN.cycle, GN.swap, k=TOUR_K, replace=False, avg_scale=None,
                        p_cross=P_CROSS, p_mut=P_MUT, params=("pts",), genes="int16", labels=" -> ")


@register("tour_evolution_history", covers=("G8", "G10", "G13", "G5", "S15"), sql=None)
def tour_evolution_history(spark, d, generations: int = GENERATIONS):
    pop = _tour_pop(spark, d, TOUR_IND, dealt=True).withColumn("pts", F.flatten(F.transform("pts", lambda p: F.array(p["x"], p["y"]))))
    _, hist = GN.evolve(pop, TOUR_SEARCH, generations, dealt=True, by_instance=True)
    return history_table(hist, "tour")


# ---- crop allocations per customer field -------------------------------------
def located_fields(spark, d):
    """One field a customer point: point_id, departamento_nombre, area_ha."""
    pts = spread(T.customer_points(spark, d), "point_id")
    return G.locate_points(pts, T.department_polygons(spark, d), few_polygons=True).withColumn(
        "area_ha", (F.lit(10) + F.col("point_id") % 91).cast("double"))


def allocation_fields(spark, d):
    """Customer fields located in departments (J4), with per-crop tons for
    the whole field (department yield per ha x area, P22) and prices (J5)."""
    fields = located_fields(spark, d)
    ch = T.crop_history(spark, d)
    yph = ch.groupBy("departamento_nombre", "cultivo_nombre").agg(
        (F.sum("produccion_tn") / F.sum("superficie_sembrada_ha")).alias("tph"))
    crops = FE.crops_for_fields(
        yph.select("departamento_nombre").distinct(), CROPS, "cultivo_nombre", "crop_pos")
    dept = (crops.join(yph, ["departamento_nombre", "cultivo_nombre"], "left")
                 .join(board_prices(spark, d), F.col("cultivo_nombre") == F.col("crop_key"), "left")
                 .groupBy("departamento_nombre")
                 .agg(F.array_sort(F.collect_list(F.struct("crop_pos", "tph", "price"))).alias("_c")))
    f = fields.join(dept, "departamento_nombre", "left").withColumnRenamed("point_id", "instance_id")
    empty = F.array_repeat(F.lit(None).cast("double"), len(CROPS))
    f = spread(f, "instance_id")                     # the searches that follow work by field
    return (f.withColumn("tons_full", F.coalesce(F.transform("_c", lambda c: c["tph"] * F.col("area_ha")), empty))
             .withColumn("prices", F.coalesce(F.transform("_c", lambda c: c["price"].cast("double")), empty))
             .drop("_c"))


@register("allocation_population_revenue", covers=("G1", "G2", "J5", "P22", "A5", "A7"),
          sql=with_ctes(
    T.SQL_POLYGONS, T.SQL_POINTS,
    POINTS_IN_DEPARTMENTS_SQL,
    T.SQL_CROP_HISTORY, SQL_BOARD,
    f"""
a_tph AS (SELECT departamento_nombre, cultivo_nombre,
                 sum(produccion_tn) / sum(superficie_sembrada_ha) AS tph
          FROM crop_history GROUP BY 1, 2),
a_crops AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(CROPS))})
            v(crop_pos, cultivo_nombre)),
a_fields AS (SELECT point_id AS instance_id, departamento_nombre,
                    CAST(10 + point_id % 91 AS DOUBLE) AS area_ha FROM located),
a_raw AS (
  SELECT f.instance_id, f.area_ha, f.departamento_nombre, t.i, c.crop_pos, c.cultivo_nombre,
         {U('init', 'f.instance_id', '0', 't.i', 'c.crop_pos')} AS u
  FROM a_fields f, range({N_IND}) t(i), a_crops c),
a_genes AS (
  SELECT r.*, u / sum(u) OVER (PARTITION BY instance_id, i) * area_ha AS ha,
         y.tph * r.area_ha AS tons_full, CAST(p.price AS DOUBLE) AS price
  FROM a_raw r LEFT JOIN a_tph y ON y.departamento_nombre = r.departamento_nombre
                                AND y.cultivo_nombre = r.cultivo_nombre
       LEFT JOIN board_prices p ON p.crop_key = r.cultivo_nombre),
a_ind AS (
  SELECT instance_id, i, sum(coalesce(ha / area_ha * (tons_full * price), 0)) AS revenue,
         string_agg(CAST({R('ha', 2)} AS VARCHAR), ',' ORDER BY crop_pos) AS alloc
  FROM a_genes GROUP BY 1, 2)""", body=f"""
SELECT instance_id, {R('max(revenue)', 2)} AS max_revenue, {R('min(revenue)', 2)} AS min_revenue,
       CAST(min({{'nr': -revenue, 'i': i}}).i AS INTEGER) AS best_idx,
       min({{'nr': -revenue, 'i': i, 'a': alloc}}).a AS best_allocation
FROM a_ind GROUP BY 1"""))
def allocation_population_revenue(spark, d):
    f = allocation_fields(spark, d)
    p = EV.stats(EV.fitness(EV.revenue_objective(EV.init_allocations(f, N_IND, len(CROPS)))))
    return p.select(
        "instance_id", F.bround("max_obj", 2).alias("max_revenue"),
        F.bround("min_obj", 2).alias("min_revenue"), "best_idx",
        F.array_join(F.transform("best_genes", lambda x: F.bround(x, 2).cast("string")), ",")
         .alias("best_allocation"))


PLOT_SEARCH = GN.Search(GN.revenue_objective, N_IND - 2, GN.one_point, GN.swap, selection="roulette", p_cross=P_CROSS, p_mut=0.001,
                        correction=GN.small_plots, params=("area_ha", "tons_full", "prices"))


@register("allocation_evolution_totals", covers=("G7", "G12", "G10", "G13", "A7"), sql=None)
def allocation_evolution_totals(spark, d, generations: int = GENERATIONS):
    return allocation_totals(allocation_fields(spark, d), generations, len(CROPS))


def allocation_totals(fields, generations: int, n_crops: int):
    """Search the allocations of every field, then the totals of the last population."""
    pop = EV.init_allocations(spread(fields, "instance_id"), N_IND, n_crops).withColumn("area_ha", F.array("area_ha"))
    final, hist = GN.evolve(pop, PLOT_SEARCH, generations, dealt=True, whole=False)
    best = hist.where(F.col("gen") == generations).select("instance_id", "max_obj", "best_genes")
    last = EV.gene_totals(final.join(best, "instance_id"))
    return last.select("instance_id", "gen", F.bround("max_obj", 2).alias("max_revenue"),
                       F.bround("grand_total", 4).alias("grand_total"),
                       F.bround("best_total", 4).alias("best_total"),
                       F.array_join(F.transform("crop_totals", lambda x: F.bround(x, 2).cast("string")),
                                    ",").alias("crop_totals"))


@register("allocation_positive_shares", covers=("F7",), sql=with_ctes(
    T.SQL_POLYGONS, T.SQL_POINTS,
    POINTS_IN_DEPARTMENTS_SQL,
    T.SQL_CROP_HISTORY, SQL_BOARD,
    f"""
a_tph AS (SELECT departamento_nombre, cultivo_nombre,
                 sum(produccion_tn) / sum(superficie_sembrada_ha) AS tph
          FROM crop_history GROUP BY 1, 2),
a_crops AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(CROPS))})
            v(crop_pos, cultivo_nombre)),
a_fields AS (SELECT point_id AS instance_id, departamento_nombre,
                    CAST(10 + point_id % 91 AS DOUBLE) AS area_ha FROM located),
a_raw AS (
  SELECT f.instance_id, f.area_ha, f.departamento_nombre, t.i, c.crop_pos, c.cultivo_nombre,
         {U('init', 'f.instance_id', '0', 't.i', 'c.crop_pos')} AS u
  FROM a_fields f, range({N_IND}) t(i), a_crops c),
a_genes AS (
  SELECT r.*, u / sum(u) OVER (PARTITION BY instance_id, i) * area_ha AS ha,
         y.tph * r.area_ha AS tons_full, CAST(p.price AS DOUBLE) AS price
  FROM a_raw r LEFT JOIN a_tph y ON y.departamento_nombre = r.departamento_nombre
                                AND y.cultivo_nombre = r.cultivo_nombre
       LEFT JOIN board_prices p ON p.crop_key = r.cultivo_nombre),
a_ind AS (
  SELECT instance_id, i, sum(coalesce(ha / area_ha * (tons_full * price), 0)) AS revenue
  FROM a_genes GROUP BY 1, 2),
a_best AS (SELECT instance_id, min({{'nr': -revenue, 'i': i}}).i AS i FROM a_ind GROUP BY 1)""",
    body=f"""
SELECT g.instance_id, g.cultivo_nombre, {R('g.ha', 2)} AS ha,
       g.cultivo_nombre || chr(10) || CAST({R('g.ha', 2)} AS VARCHAR) AS label
FROM a_genes g JOIN a_best b ON b.instance_id = g.instance_id AND b.i = g.i
WHERE g.ha > 0"""))
def allocation_positive_shares(spark, d):
    """the best allocation's crops with a positive area, labelled
    ``crop\\nha`` (the treemap's data table)."""
    f = allocation_fields(spark, d)
    p = EV.stats(EV.fitness(EV.revenue_objective(EV.init_allocations(f, N_IND, len(CROPS)))))
    crops = F.array(*[F.lit(c) for c in CROPS])
    e = _elements(p.select("instance_id", "best_genes"), "best_genes", "pos", "ha", "instance_id")
    e = e.filter(F.col("ha") > 0).withColumn("_c", crops).withColumn("cultivo_nombre", F.col("_c")[F.col("pos")])
    return e.select("instance_id", "cultivo_nombre", F.bround("ha", 2).alias("ha"),
                    F.concat(F.col("cultivo_nombre"), F.lit("\n"),
                             F.bround("ha", 2).cast("string")).alias("label"))
