"""Boosted regression trees as tables.

A model is a DataFrame with one row a tree (``MODEL``): nodes in heap order
(children of node i are 2i + 1 and 2i + 2), feature -1 at a leaf, rows with
``x[feature] <= threshold`` go left.  Row 0 is the base value.  Its size is set by
the parameters (trees x nodes), not by the data, so it may be collected and sent to
every task that scores.

Many fits at once: the settings of a search (folds, grid points, depths) are rows,
and every setting is fitted in a task of its own by :func:`each_fit`, on a table of
at most ``MOST_CELLS`` cells, which is checked.  Larger tables are fitted by MLlib,
data-parallel, one fit after the other, and give the same model table.

Scores are nested: the first 500 trees of a 1000-tree fit are the 500-tree model, and
a tree of depth 9 cut at depth d is the tree of depth d, so a search fits the largest
setting of each group once.

Splits minimise the squared error over at most 255 cut points a feature (quantiles of
the distinct values); ties go to the first feature and the lowest cut.  A tree of a
subsample below 1 sees a seeded draw without replacement.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

MODEL = "tree int, feature array<int>, threshold array<double>, value array<double>"
MOST_CELLS = 32_000_000          # rows x features that one task fits: 256 MB of doubles
BINS = 255


class Binned:
    """Columns as bin numbers with the cut points between the bins."""

    def __init__(self, x: np.ndarray):
        self.cuts, codes = [], []
        for col in x.T:
            u = np.unique(col)
            mid = (u[:-1] + u[1:]) / 2
            if len(mid) > BINS:
                mid = np.unique(np.quantile(mid, np.linspace(0, 1, BINS), method="nearest"))
            self.cuts.append(mid)
            codes.append(np.searchsorted(mid, col, "left"))
        self.width = max(map(len, self.cuts), default=0) + 2
        self.codes = np.column_stack(codes).astype(np.int64) if codes else np.zeros((len(x), 0), np.int64)


def grow(binned: Binned, codes: np.ndarray, y: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A least-squares tree, level by level: (feature, cut number, mean) in heap order."""
    n, m = codes.shape
    width = binned.width
    size = 2 ** (depth + 1) - 1
    feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
    node = np.zeros(n, np.int64)
    flat = codes + np.arange(m) * width
    for level in range(depth + 1):
        first, count = 2 ** level - 1, 2 ** level
        own = node - first                                    # rows that stopped above are negative
        live = np.flatnonzero(own >= 0)
        if not len(live):
            break
        total = np.bincount(own[live], y[live], count)
        rows = np.bincount(own[live], minlength=count)
        value[first:first + count] = np.where(rows > 0, total / np.maximum(rows, 1), 0)
        if level == depth or not m:
            break
        at = (own[live, None] * (m * width) + flat[live]).ravel()
        s = np.bincount(at, np.repeat(y[live], m), count * m * width).reshape(count, m, width).cumsum(2)[:, :, :-1]
        c = np.bincount(at, minlength=count * m * width).reshape(count, m, width).cumsum(2)[:, :, :-1]
        rest, other = total[:, None, None] - s, rows[:, None, None] - c
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where((c > 0) & (other > 0), s * s / c + rest * rest / other, -np.inf).reshape(count, -1)
        best = gain.argmax(1)
        base = np.where(rows > 0, total * total / np.maximum(rows, 1), 0)
        split = gain[np.arange(count), best] > base + 1e-9 * np.maximum(1, np.abs(base))
        feature[first:first + count] = np.where(split, best // (width - 1), -1)
        cut[first:first + count] = np.where(split, best % (width - 1), 0)
        chosen = feature[node[live]]
        on = chosen >= 0
        right = codes[live[on], chosen[on]] > cut[node[live[on]]]
        node[live[on]] = 2 * node[live[on]] + 1 + right
        node[live[~on]] = -1                                  # a leaf above the last level
    return feature, cut, value


def leaves(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Node in which each row ends, not below ``depth``."""
    node = np.zeros(len(codes), np.int64)
    rows = np.arange(len(codes))
    for _ in range(depth):
        f = feature[node]
        node = np.where(f >= 0, 2 * node + 1 + (codes[rows, np.maximum(f, 0)] > cut[node]), node)
    return node


def boost(binned: Binned, y: np.ndarray, on: np.ndarray, trees: int, rate: float, depth: int, subsample: float,
          seed: int, keep: Callable | None = None):
    """Least-squares boosting on the rows ``on``; ``keep(t, prediction)`` sees the
    prediction of all rows after each tree.  Returns [(feature, cut, value)]."""
    base = y[on].mean()
    now = np.full(len(y), base)
    out = [(np.array([-1]), np.array([0]), np.array([base]))]
    for t in range(1, trees + 1):
        some = on
        if subsample < 1:
            draw = np.random.default_rng([seed, t]).permutation(len(on))
            some = on[np.sort(draw[:max(1, int(subsample * len(on)))])]
        feature, cut, value = grow(binned, binned.codes[some], (y - now)[some], depth)
        value = value * rate
        now = now + value[leaves(binned.codes, feature, cut, depth)]
        out.append((feature, cut, value))
        if keep:
            keep(t, now)
    return out


def fold_of(n: int, folds: int, seed: int) -> np.ndarray:
    """Fold of each row: consecutive runs of a seeded shuffle, sizes at most one apart."""
    out = np.empty(n, np.int64)
    for k, part in enumerate(np.array_split(np.random.default_rng(seed).permutation(n), folds)):
        out[part] = k
    return out


def complete(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows whose features are all numbers."""
    ok = F.lit(True)
    for f in features:
        x = F.col(f"`{f}`").cast("double")
        ok = ok & x.isNotNull() & ~F.isnan(x)
    return df.where(ok)


def each_fit(df: DataFrame, features: list[str], label: str, order: list[str], settings: int, fit: Callable, schema: str) -> DataFrame:
    """Run ``fit(setting, x, y)`` for every setting, each in a task with the whole
    (bounded) table, rows in the order of ``order``; ``fit`` returns a pyarrow table."""
    columns = [F.col(f"`{f}`").cast("double") for f in features]
    slim = complete(df, [*features, label]).select(F.array(*columns).alias("x"), F.col(label).cast("double").alias("y"),
                                                   F.to_json(F.struct(*order, F.array(*columns))).alias("_rank"))
    every = slim.withColumn("setting", F.explode(F.sequence(F.lit(0), F.lit(settings - 1))))

    def task(table: pa.Table) -> pa.Table:
        table = table.take(pa.compute.sort_indices(table.column("_rank")))
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return fit(table.column("setting")[0].as_py(), x, table.column("y").to_numpy())

    # a task a setting: dealt by number, so that no exchange is coalesced by its size
    return every.repartitionByRange(settings, "setting").groupBy("setting").applyInArrow(task, schema)


def model_rows(binned: Binned, trees) -> pa.Table:
    feature, threshold, value = [], [], []
    for f, c, v in trees:
        cuts = [float(binned.cuts[i][k]) if i >= 0 else 0.0 for i, k in zip(f.tolist(), c.tolist())]
        feature.append(f.tolist())
        threshold.append(cuts)
        value.append(v.tolist())
    return pa.table([pa.array(range(len(trees)), pa.int32()), pa.array(feature, pa.list_(pa.int32())),
                     pa.array(threshold, pa.list_(pa.float64())), pa.array(value, pa.list_(pa.float64()))],
                    names=["tree", "feature", "threshold", "value"])


def is_small(df: DataFrame, features: list[str], most: int | None = None) -> bool:
    return df.count() * max(len(features), 1) <= (MOST_CELLS if most is None else most)


def fit_trees(df: DataFrame, features: list[str], label: str, order: list[str], maxIter: int = 1000, stepSize: float = 0.05,
              maxDepth: int = 3, subsamplingRate: float = 1.0, seed: int = 1, most: int | None = None) -> DataFrame:
    """M2: the model table of boosted trees; empty without a complete row."""
    if not is_small(df, features, most):
        return _mllib_trees(df, features, label, maxIter, stepSize, maxDepth, subsamplingRate, seed)

    def fit(_, x, y):
        binned = Binned(x)
        return model_rows(binned, boost(binned, y, np.arange(len(y)), maxIter, stepSize, maxDepth, subsamplingRate, seed))
    return each_fit(df, features, label, order, 1, fit, MODEL)


def _mllib_trees(df, features, label, trees, rate, depth, subsample, seed) -> DataFrame:
    """The same model table from a data-parallel MLlib fit, read from its saved nodes."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    spark = df.sparkSession
    data = VectorAssembler(inputCols=features, outputCol="_x").transform(complete(df, [*features, label])).select(
        "_x", F.col(label).cast("double").alias("_y"))
    path = scratch_path(spark, "mllib-trees")
    model = GBTRegressor(featuresCol="_x", labelCol="_y", maxIter=trees, stepSize=rate, maxDepth=depth,
                         subsamplingRate=subsample, seed=seed).fit(data)
    model.write().overwrite().save(path)
    weights, size = list(model.treeWeights), 2 ** (depth + 1) - 1
    out = [(0, [-1], [0.0], [0.0])]
    nodes: dict = {}
    # trees x nodes: bounded by the parameters
    for row in spark.read.parquet(f"{path}/data").collect():
        n = row["nodeData"]
        nodes.setdefault(row["treeID"], {})[n["id"]] = n
    for t in range(len(weights)):
        feature, threshold, value = [-1] * size, [0.0] * size, [0.0] * size
        todo = [(0, 0)]
        while todo:
            at, i = todo.pop()
            n = nodes[t][i]
            value[at] = n["prediction"] * weights[t]
            if n["leftChild"] >= 0:
                feature[at], threshold[at] = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]
                todo += [(2 * at + 1, n["leftChild"]), (2 * at + 2, n["rightChild"])]
        out.append((t + 1, feature, threshold, value))
    return spark.createDataFrame(out, MODEL)


class Scorer:
    """Predictions of a model table; a row with a missing feature has none."""

    def __init__(self, rows):
        rows = sorted(rows, key=lambda r: r["tree"])
        size = max((len(r["feature"]) for r in rows), default=1)
        pad = lambda key, fill: np.array([list(r[key]) + [fill] * (size - len(r[key])) for r in rows])
        self.trees = len(rows)
        self.feature, self.threshold, self.value = pad("feature", -1), pad("threshold", 0.0), pad("value", 0.0)
        self.depth = size.bit_length() - 1

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        filled = np.nan_to_num(x)
        for feature, threshold, value in zip(self.feature, self.threshold, self.value) if self.trees else ():
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + 1 + (filled[rows, np.maximum(f, 0)] > threshold[node]), node)
            out += value[node]
        return np.where(np.isnan(x).any(1) | (self.trees == 0), np.nan, out)


def scorer(model: DataFrame) -> Scorer:
    """The model in memory: trees x nodes, bounded by its parameters."""
    return Scorer(model.collect())


def score(df: DataFrame, model: DataFrame | Scorer, features: list[str], out: str = "prediction") -> DataFrame:
    """``df`` with the prediction of every row, null where a feature is missing."""
    held = df.sparkSession.sparkContext.broadcast(model if isinstance(model, Scorer) else scorer(model))
    columns = [F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))) for f in features]
    wide = df.withColumn("_x", F.array(*columns))
    kinds = [*df.schema.fields]
    schema = df.schema.add(out, "double") if out not in df.columns else df.schema
    names = [f.name for f in kinds]

    def task(batches):
        predict = held.value
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            got = predict(x)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(got, pa.float64(), from_pandas=True)], [*names, out])
    return wide.select(*names, "_x").mapInArrow(task, schema)


def forecast(last: DataFrame, model: DataFrame | Scorer, site: str, date: str, lag: str, code: str, steps: int = 14,
             value: str = "value") -> DataFrame:
    """M9: (site, step, date, value) ``steps`` months ahead, each prediction being the next
    month's lag; a site without a lag value has null forecasts.  Features: year, month, lag, code."""
    held = last.sparkSession.sparkContext.broadcast(model if isinstance(model, Scorer) else scorer(model))
    months = (F.year(date) * 12 + F.month(date) - 1).cast("long")
    rows = last.select(F.col(site).alias("site"), months.alias("month"), F.col(lag).cast("double").alias("lag"), F.col(code).cast("double").alias("code"))

    def task(batches):
        predict = held.value
        for batch in batches:
            month = batch.column("month").to_numpy(zero_copy_only=False)
            now = batch.column("lag").to_numpy(zero_copy_only=False).astype(float)
            code = batch.column("code").to_numpy(zero_copy_only=False).astype(float)
            out = []
            for k in range(1, steps + 1):
                m = month + k
                now = predict(np.column_stack([m // 12, m % 12 + 1, now, code]))
                out.append(now)
            yield pa.RecordBatch.from_arrays([batch.column("site"), batch.column("month"), pa.array(
                np.column_stack(out).tolist() if len(month) else [], pa.list_(pa.float64()))], ["site", "month", "v"])
    found = rows.mapInArrow(task, "site string, month long, v array<double>")
    found = found.select(F.col("site").alias(site), "month", F.posexplode("v").alias("_k", "_v"))
    at = F.col("month") + F.col("_k") + 1
    day = F.make_date(F.floor(at / 12).cast("int"), (at % 12 + 1).cast("int"), F.lit(1))
    return found.select(site, (F.col("_k") + 1).alias("step"), day.alias(date), F.nanvl("_v", F.lit(None).cast("double")).alias(value))


# ---- searches ----------------------------------------------------------------
SCORES = "kind string, setting int, fold int, neg_mse double, reached int"


def _cut_scores(binned, y, on, off, depth):
    """(reached depth, squared error on ``off`` at each depth) of one tree."""
    feature, cut, value = grow(binned, binned.codes[on], y[on], depth)
    # the last level that holds a leaf of a split
    inner = np.flatnonzero(feature >= 0)
    reached = int(np.floor(np.log2(inner.max() + 1))) + 1 if len(inner) else 0
    error = [float(((y[off] - value[leaves(binned.codes[off], feature, cut, d)]) ** 2).mean()) if len(off) else None
             for d in range(1, depth + 1)]
    return reached, error


def search(df: DataFrame, features: list[str], label: str, order: list[str], grid: dict, max_depth: int = 9, folds: int = 5,
           seed: int = 1, most: int | None = None) -> DataFrame:
    """M3 + M4 + M5 + A14: (kind, setting, neg_mse): depths 1 up to the deepest that a
    tree on all rows reaches, and every point of the grid (in the order of its
    product), each the mean over the folds; null with fewer rows than folds."""
    from itertools import product
    names = list(grid)
    points = [dict(zip(names, p)) for p in product(*grid.values())]
    groups: dict = {}                   # points that differ in their number of trees share a fit
    for i, p in enumerate(points):
        groups.setdefault((p["stepSize"], p["maxDepth"], p["subsamplingRate"]), []).append((p["maxIter"], i))
    work = [("tree", None, k) for k in range(-1, folds)] + [("boost", g, k) for g in groups for k in range(folds)]

    if is_small(df, features, most):
        def fit(setting, x, y):
            kind, group, k = work[setting]
            rows = []
            binned = Binned(x)
            enough = len(y) >= folds
            fold = fold_of(len(y), folds, seed)
            on, off = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if kind == "tree":
                reached, error = _cut_scores(binned, y, on, off, max_depth)
                rows = [("depth", d + 1, k, -e if e is not None and enough else None, reached) for d, e in enumerate(error)]
            else:
                want = dict.fromkeys(n for n, _ in groups[group])

                def keep(t, now):
                    if t in want:
                        want[t] = -float(((y[off] - now[off]) ** 2).mean())
                if enough:
                    boost(binned, y, on, max(want), *group, seed, keep)
                rows = [("grid", i, k, want[n], None) for n, i in groups[group]]
            return pa.table([pa.array(c) if j < 3 else pa.array(c, pa.float64() if j == 3 else pa.int32())
                             for j, c in enumerate(zip(*rows))], names=["kind", "setting", "fold", "neg_mse", "reached"]).cast(
                pa.schema([("kind", pa.string()), ("setting", pa.int32()), ("fold", pa.int32()), ("neg_mse", pa.float64()), ("reached", pa.int32())]))
        found = each_fit(df, features, label, order, len(work), fit, SCORES)
    else:
        found = _mllib_search(df, features, label, order, groups, max_depth, folds, seed)
    reached = found.where(F.col("fold") == -1).agg(F.max("reached")).select(F.col("max(reached)").alias("_most"))
    mean = found.where(F.col("fold") >= 0).groupBy("kind", "setting").agg(
        F.when(F.count("neg_mse") == F.count("*"), F.avg("neg_mse")).alias("neg_mse"))
    return (mean.join(F.broadcast(reached)).where((F.col("kind") == "grid") | (F.col("setting") <= F.col("_most")))
            .select("kind", F.col("setting").cast("double").alias("setting"), "neg_mse"))


def _mllib_search(df, features, label, order, groups, max_depth, folds, seed) -> DataFrame:
    """Beyond the bound: data-parallel fits, one a fold and group, scored at every prefix
    and every depth of the fitted trees."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
    spark = df.sparkSession
    data = VectorAssembler(inputCols=features, outputCol="_x").transform(complete(df, [*features, label])).select(
        "_x", F.col(label).cast("double").alias("_y"), F.pmod(F.xxhash64(*order, F.lit(seed)), F.lit(folds)).alias("_fold"))
    data = data.persist()
    tree = DecisionTreeRegressor(featuresCol="_x", labelCol="_y", maxDepth=max_depth, seed=seed)
    rows = [("depth", 1, -1, None, tree.fit(data).depth)]
    for k in range(folds):
        on, off = data.where(F.col("_fold") != k), data.where(F.col("_fold") == k)
        cut = _cut_expressions(tree.fit(on), max_depth)
        errors = off.withColumn("_v", vector_to_array("_x")).agg(
            *[F.avg(F.pow(F.col("_y") - F.expr(e), 2)).alias(f"d{d}") for d, e in cut.items()]).first()
        rows += [("depth", d, k, -errors[f"d{d}"] if errors[f"d{d}"] is not None else None, None) for d in cut]
        for (rate, depth, subsample), members in groups.items():
            model = GBTRegressor(featuresCol="_x", labelCol="_y", maxIter=max(n for n, _ in members), stepSize=rate, maxDepth=depth,
                                 subsamplingRate=subsample, seed=seed).fit(on)
            by_prefix = model.evaluateEachIteration(off, "squared")
            rows += [("grid", i, k, -float(by_prefix[n - 1]), None) for n, i in members]
    data.unpersist()
    return spark.createDataFrame(rows, SCORES)


def _cut_expressions(model, max_depth: int) -> dict[int, str]:
    """SQL text of the prediction of a fitted tree cut at each depth (over the array ``_v``)."""
    root = model._call_java("rootNode")

    def text(node, left: int) -> str:
        if left == 0 or node.subtreeDepth() == 0:
            return f"{node.prediction()!r}D"
        split = node.split()
        return (f"IF(_v[{split.featureIndex()}] <= {split.threshold()!r}D, {text(node.leftChild(), left - 1)}, "
                f"{text(node.rightChild(), left - 1)})")
    return {d: text(root, d) for d in range(1, max_depth + 1)}
