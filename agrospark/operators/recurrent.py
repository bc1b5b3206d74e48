"""Recurrent climate models trained data-parallel (M8, M9).

A network reads the last ``n`` values of a series, one a step, in an LSTM layer; a
small rectified layer and a linear one give the next value.  Every training step is
one Spark job: each task sums the gradient of its samples for the current weights,
the sums are added (in two levels beyond ``FAN_IN`` tasks) and the driver makes the
Adam step.  What is sent and gathered has the size of the weights.  Several series
(one network each) are trained in the same jobs.  Weights and steps are seeded and
sums run in the order of the partitions, so a fit can be repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 64
GRADIENTS = "part int, series string, n long, loss double, gradient binary"


class Net:
    """Weights of one network as slices of a vector."""

    def __init__(self, units: int = 64, dense: int = 8):
        self.units, self.dense = units, dense
        shapes = [(1, 4 * units), (units, 4 * units), (4 * units,), (units, dense), (dense,), (dense, 1), (1,)]
        self.shapes, self.at = shapes, np.cumsum([0] + [int(np.prod(s)) for s in shapes])

    @property
    def size(self) -> int:
        return int(self.at[-1])

    def parts(self, w: np.ndarray) -> list[np.ndarray]:
        return [w[a:b].reshape(s) for a, b, s in zip(self.at, self.at[1:], self.shapes)]

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        w = np.zeros(self.size)
        for p in self.parts(w):
            if p.ndim == 2:
                p[:] = rng.uniform(-1, 1, p.shape) * np.sqrt(6 / sum(p.shape))
        self.parts(w)[2][self.units:2 * self.units] = 1.0                    # forget gates begin open
        return w

    def forward(self, w: np.ndarray, x: np.ndarray):
        """(predictions, what the backward pass needs) of samples x (n, steps)."""
        wx, wh, b, w1, b1, w2, b2 = self.parts(w)
        u, n = self.units, len(x)
        h = c = np.zeros((n, u))
        trace = []
        for t in range(x.shape[1]):
            z = x[:, t:t + 1] * wx + h @ wh + b
            gates = 1 / (1 + np.exp(-z[:, :3 * u]))                          # in, forget, out
            new = np.tanh(z[:, 3 * u:])
            c_next = gates[:, u:2 * u] * c + gates[:, :u] * new
            s = np.tanh(c_next)
            trace.append((h, c, gates, new, s))
            h, c = gates[:, 2 * u:] * s, c_next
        a = h @ w1 + b1
        r = np.maximum(a, 0)
        return (r @ w2 + b2)[:, 0], (trace, h, a, r)

    def gradient(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """(sum of squared errors, its gradient)."""
        wx, wh, b, w1, b1, w2, b2 = self.parts(w)
        u = self.units
        got, (trace, h, a, r) = self.forward(w, x)
        out = np.zeros(self.size)
        gx, gh, gb, g1, gb1, g2, gb2 = self.parts(out)
        d = 2 * (got - y)[:, None]
        g2 += r.T @ d
        gb2 += d.sum(0)
        da = (d @ w2.T) * (a > 0)
        g1 += h.T @ da
        gb1 += da.sum(0)
        dh, dc = da @ w1.T, 0.0
        for t in range(x.shape[1] - 1, -1, -1):
            before, c, gates, new, s = trace[t]
            i, f, o = gates[:, :u], gates[:, u:2 * u], gates[:, 2 * u:]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate([dc * new * i * (1 - i), dc * c * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - new * new)], axis=1)
            gx += x[:, t:t + 1].T @ dz
            gh += before.T @ dz
            gb += dz.sum(0)
            dh, dc = dz @ wh.T, dc * f
        return float(((got - y) ** 2).sum()), out


class Fitted:
    """A trained network of a series: weights and the scale of its values."""

    def __init__(self, net: Net, w: np.ndarray, mean: float, scale: float, losses: list[float]):
        self.net, self.w, self.mean, self.scale, self.losses = net, w, mean, scale, losses

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.net.forward(self.w, (x - self.mean) / self.scale)[0] * self.scale + self.mean


def train(samples: DataFrame, steps: int = 200, rate: float = 0.01, units: int = 64, dense: int = 8, seed: int = 1,
          per_task: int = 512) -> dict[str, Fitted]:
    """(series, x: array, y) -> fitted network of each series.  Samples with a null are
    left out; a series without samples has no network.  ``series`` is a parameter-sized
    set of names."""
    spark = samples.sparkSession
    whole = samples.where(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull())).select(
        "series", F.col("x").cast("array<double>").alias("x"), F.col("y").cast("double").alias("y"))
    scale = {r["series"]: (r["m"], r["s"] or 1.0, r["n"]) for r in whole.groupBy("series").agg(
        F.avg("y").alias("m"), F.stddev_pop("y").alias("s"), F.count("*").alias("n")).collect()}
    total = sum(n for _, _, n in scale.values())
    tasks = max(1, min(-(-total // per_task), 10_000))
    # dealt by content and sorted: the same sums on every run
    whole = whole.repartition(tasks, F.xxhash64("x", "y", "series")).sortWithinPartitions("series", "x", "y").persist()
    net = Net(units, dense)
    w = {s: net.start(seed) for s in scale}
    m1, m2 = {s: np.zeros(net.size) for s in w}, {s: np.zeros(net.size) for s in w}
    losses: dict[str, list[float]] = {s: [] for s in w}

    def gradients(held):
        def task(batches):
            from pyspark import TaskContext
            now, sums = held.value, {}
            for batch in batches:
                names = np.array(batch.column("series").to_pylist(), object)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y = batch.column("y").to_numpy(zero_copy_only=False)
                for s in np.unique(names):
                    mean, wide, _ = scale[s]
                    on = names == s
                    loss, g = net.gradient(now[s], (x[on] - mean) / wide, (y[on] - mean) / wide)
                    n0, l0, g0 = sums.get(s, (0, 0.0, 0.0))
                    sums[s] = n0 + int(on.sum()), l0 + loss, g0 + g
            yield _rows(TaskContext.get().partitionId(), sums)
        return task

    def added(batches):
        from pyspark import TaskContext
        sums: dict = {}
        for row in sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"]):
            n0, l0, g0 = sums.get(row["series"], (0, 0.0, 0.0))
            sums[row["series"]] = n0 + row["n"], l0 + row["loss"], g0 + np.frombuffer(row["gradient"])
        yield _rows(TaskContext.get().partitionId(), sums)

    try:
        for step in range(1, (steps if w else 0) + 1):
            held = spark.sparkContext.broadcast(w)
            found = whole.mapInArrow(gradients(held), GRADIENTS)
            if tasks > FAN_IN:
                found = found.repartition(-(-tasks // FAN_IN), "part").mapInArrow(added, GRADIENTS)
            total_of: dict = {}
            for r in sorted(found.collect(), key=lambda r: r["part"]):
                n0, l0, g0 = total_of.get(r["series"], (0, 0.0, 0.0))
                total_of[r["series"]] = n0 + r["n"], l0 + r["loss"], g0 + np.frombuffer(bytes(r["gradient"]))
            for s, (n, loss, g) in total_of.items():
                g = g / n
                losses[s].append(loss / n)
                m1[s] = 0.9 * m1[s] + 0.1 * g
                m2[s] = 0.999 * m2[s] + 0.001 * g * g
                w[s] = w[s] - rate * (m1[s] / (1 - 0.9 ** step)) / (np.sqrt(m2[s] / (1 - 0.999 ** step)) + 1e-8)
            held.unpersist()
    finally:
        whole.unpersist()
    return {s: Fitted(net, w[s], scale[s][0], scale[s][1], losses[s]) for s in w}


def _rows(part: int, sums: dict) -> pa.RecordBatch:
    rows = [(part, s, n, loss, g.tobytes()) for s, (n, loss, g) in sums.items()]
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["part", "series", "n", "loss", "gradient"])


def forecast(last: DataFrame, fitted: Fitted, site: str, date: str, window: str, steps: int = 14, value: str = "value") -> DataFrame:
    """M9: (site, step, date, value) from each site's last window (ending at ``date``): every
    prediction becomes the newest input.  A window with a null has null forecasts."""
    held = last.sparkSession.sparkContext.broadcast(fitted)
    rows = last.select(F.col(site).alias("site"), F.col(date).cast("date").alias("day"),
                       F.transform(window, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan")))).alias("x"))

    def task(batches):
        for batch in batches:
            now = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
            out = []
            for _ in range(steps):
                got = held.value(now)
                out.append(got)
                now = np.column_stack([now[:, 1:], got])
            yield pa.RecordBatch.from_arrays([batch.column("site"), batch.column("day"), pa.array(
                np.column_stack(out).tolist() if batch.num_rows else [], pa.list_(pa.float64()))], ["site", "day", "v"])
    found = rows.mapInArrow(task, "site string, day date, v array<double>")
    found = found.select(F.col("site").alias(site), "day", F.posexplode("v").alias("_k", "_v"))
    return found.select(site, (F.col("_k") + 1).alias("step"), F.add_months("day", F.col("_k") + 1).alias(date),
                        F.nanvl("_v", F.lit(None).cast("double")).alias(value))
