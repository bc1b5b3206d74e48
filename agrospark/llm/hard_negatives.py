"""Hard-negative mining (12): anchors share candidate lists sorted by an angular bound.

Vectors are whole numbers, a score is their inner product.  Anchors meet candidates
in blocks.  In a task the block's anchors are clustered by direction; for a cluster
with the centre c, whose members are at most t from it, no member reaches more than
``|x| * cos(max(0, angle(x, c) - t))`` times its own norm with a candidate x.  The
candidates are sorted by that bound once a cluster, and every member walks the shared
list until the bound of the next candidate is below what it still needs: the k-th
best score it has, or the least score that counts.  Then no later candidate can
count, so the walk is exact.

Two rounds: the best ``positives`` rows of the anchor's own label (candidates and
anchors meet by label), then, for each of them, the best ``negatives`` rows of other
labels whose score is from ``low`` to ``high`` per cent of the positive's.  The
second round starts with these limits, so its walks end early.  Blocks leave at most
k rows for an anchor and positive; a window picks among the blocks.

Anchors are a stated share of all rows, so work is anchors x rows at worst, in
tasks of bounded size: ``per_block`` candidates and ``per_group`` anchors, 8 bytes a
component.  A label with a third of all rows is many blocks.  Nothing is collected.

Defined results: rows with a null id, label or vector, or a vector with a null
component, take no part, nor does a vector whose inner product with itself is 4e18
or more (a long holds all scores of the rest); scores are between vectors of one
length; a zero or empty vector scores 0; an anchor's own id is never its candidate;
rows that repeat an id are each candidates, and one anchor (the first by label,
then vector); an anchor without a positive, or a positive without a negative,
returns no row; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_in_table

SLACK = 1e-7                    # of a cosine, above the error of the angles
NONE = -(2 ** 62)
FOUND = "anchor_id long, slot int, vec_id long, score long"


def clusters_of(unit: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Cluster of each direction: a few rounds of spherical k-means from spread-out rows."""
    k = max(1, int(np.sqrt(len(unit)) / 1.5))
    centre = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    own = np.zeros(len(unit), int)
    for _ in range(rounds):
        own = np.argmax(unit @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, unit)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(size > 0, total / np.maximum(size, 1e-300), centre)
    return own


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, unit vectors); a zero vector has the direction 0."""
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    return norm, x / np.maximum(norm, 1e-300)[:, None]


def best(member: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best of every member: score descending, then id."""
    order = np.lexsort((ids, -score, member))
    sorted_member = member[order]
    first = np.flatnonzero(np.diff(sorted_member, prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    return order[place < k]


def walk(ids, x, labels, a_ids, a, a_labels, low, high, k: int, same: bool, chunk: int = 128) -> Iterator[tuple]:
    """(anchor positions, slot, candidate positions, scores): the ``k`` best candidates
    of every anchor and slot with ``low`` <= score <= ``high`` (anchors x slots)."""
    norm, unit = directions(x)
    a_norm, a_unit = directions(a)
    whole = np.float64 if norm.max(initial=0) * a_norm.max(initial=0) < 2.0 ** 52 else np.int64
    x, a = x.astype(whole), a.astype(whole)
    own = clusters_of(a_unit)
    for c in np.unique(own):
        members = np.flatnonzero(own == c)
        middle = a_unit[members].sum(0)
        middle = middle / max(np.sqrt((middle * middle).sum()), 1e-300)
        wide = np.arccos(np.clip(a_unit[members] @ middle, -1, 1)).max()
        apart = np.maximum(np.arccos(np.clip(unit @ middle, -1, 1)) - wide, 0)
        bound = norm * (np.cos(apart) + SLACK)
        order = np.argsort(-bound, kind="stable")
        need = low[members].min(1).astype(np.int64)          # the least score that still counts
        have = [(np.empty(0, int), np.empty(0, int), np.empty(0, np.int64)) for _ in range(low.shape[1])]
        at, step = 0, chunk
        while at < len(order):
            going = np.flatnonzero(a_norm[members] * bound[order[at]] + 0.5 >= need)
            if not len(going):
                break
            idx = order[at:at + step]
            score = a[members[going]] @ x[idx].T
            r, i = np.nonzero(score >= need[going][:, None])
            score = score[r, i].astype(np.int64)
            r, i = going[r], idx[i]
            keep = (ids[i] != a_ids[members[r]]) & ((labels[i] == a_labels[members[r]]) == same)
            r, i, score = r[keep], i[keep], score[keep]
            reach = np.full((len(members), low.shape[1]), np.iinfo(np.int64).max)
            for slot in range(low.shape[1]):
                fits = (score >= low[members[r], slot]) & (score <= high[members[r], slot])
                r0, i0, s0 = (np.concatenate(p) for p in zip(have[slot], (r[fits], i[fits], score[fits])))
                top = best(r0, s0, ids[i0], k)
                have[slot] = r0, i0, s0 = r0[top], i0[top], s0[top]
                full = np.bincount(r0, minlength=len(members)) >= k
                least = np.full(len(members), np.iinfo(np.int64).max)
                np.minimum.at(least, r0, s0)
                reach[:, slot] = np.where(full, least, low[members, slot])
            need = np.maximum(need, reach.min(1))
            at, step = at + step, min(step * 2, 2048)
        for slot, (r, i, s) in enumerate(have):
            yield members[r], slot, i, s


def matrix(col: pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists as a matrix of whole numbers."""
    col = col.combine_chunks()
    values = col.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(col), -1)


def _task(k: int, same: bool):
    def search(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if candidates.num_rows and anchors.num_rows:
            number = lambda t, c: t.column(c).to_numpy()
            ids, a_ids = number(candidates, "vec_id"), number(anchors, "vec_id")
            found = walk(ids, matrix(candidates.column("v")), number(candidates, "label"), a_ids, matrix(anchors.column("v")),
                         number(anchors, "label"), matrix(anchors.column("low")), matrix(anchors.column("high")), k, same)
            for anchor, slot, i, score in found:
                for to, part in zip(out, (a_ids[anchor], np.full(len(i), slot, np.int32), ids[i], score)):
                    to.append(part)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(np.concatenate(p) if p else [], t) for p, t in zip(out, kinds)],
                        names=["anchor_id", "slot", "vec_id", "score"])
    return search


def vectors_of(table: DataFrame) -> DataFrame:
    """(row, vec_id, label, v, dim) of the rows that take part."""
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.col("v").cast("array<long>").alias("v"))
    # numbered before any shuffle: repeated rows fall into different blocks
    return (rows.where(ok).where(norm2 < 4e18).withColumn("dim", F.size("v"))
            .withColumn("row", F.monotonically_increasing_id()))


def _meet(candidates: DataFrame, anchors: DataFrame, by: list[str], task, k: int, per_block: int, per_group: int) -> DataFrame:
    """Every block of candidates meets every group of anchors of the same ``by``; the
    ``k`` best of each anchor and slot over all blocks."""
    sizes = candidates.groupBy(by).agg(F.count("*").alias("_n")).join(anchors.groupBy(by).agg(F.count("*").alias("_m")), by)
    sizes = sizes.select(*by, F.ceil(F.col("_n") / per_block).cast("int").alias("_blocks"),
                         F.ceil(F.col("_m") / per_group).cast("int").alias("_groups"))
    part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = candidates.join(sizes, by).withColumn("_b", part("row", "_blocks")).withColumn("_g", each("_groups"))
    right = anchors.join(sizes, by).withColumn("_g", part("vec_id", "_groups")).withColumn("_b", each("_blocks"))
    keys = [*by, "_b", "_g"]
    named = lambda f, more: f.select(
        *[F.col(c).alias(f"k_{c}") for c in keys], *[F.col(c).alias(c) for c in ("vec_id", "label", "v", *more)])
    names = [f"k_{c}" for c in keys]
    found = (named(left, []).groupBy(names).cogroup(named(right, ["low", "high"]).groupBy(names)).applyInArrow(task, FOUND))
    place = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def hard_negatives(table: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   per_block: int = 8192, per_group: int = 2048) -> DataFrame:
    """(vec_id, label, v: whole numbers) -> (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score)."""
    rows = vectors_of(table)
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v", "dim")).alias("_")).select("vec_id", "_.*")
    limit = lambda x: F.array(F.lit(x).cast("long"))
    first = anchors.withColumns({"low": limit(NONE), "high": limit(-NONE)})
    near = _meet(rows, first, ["dim", "label"], _task(positives, True), positives, per_block, per_group)
    # whole numbers, so low * p <= 100 * score <= high * p is a range of scores
    p = F.col("score").cast("decimal(28,0)")
    near = kept_in_table(near.select(
        "anchor_id", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"), F.ceil(p * low / 100).cast("long").alias("low"),
        F.floor(p * high / 100).cast("long").alias("high")), "positives")
    # an unused slot asks for an impossible score
    at = lambda c, other: F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda j: F.coalesce(F.try_element_at(
        F.map_from_entries("_"), j.cast("int"))[c], F.lit(other).cast("long")))
    limits = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("slot", F.struct("low", "high"))).alias("_"))
    limits = limits.select("vec_id", at("low", -NONE).alias("low"), at("high", NONE).alias("high"))
    far = _meet(rows, anchors.join(limits, "vec_id"), ["dim"], _task(negatives, False), negatives, per_block, per_group)
    return far.join(near.select("anchor_id", "slot", "positive_id", "positive_score"), ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def whole_vectors(table: DataFrame, scale: int = 256, every: int = 7, labels: int = 10) -> DataFrame:
    """embeddings -> (vec_id, label, v): floor(scale * x), labels shifted where vec_id is
    divisible by ``every``; a vector with a non-finite component is null."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.pmod(F.col("vec_id"), F.lit(every)) == 0, (label + 1) % labels).otherwise(label)
    return table.select("vec_id", moved.alias("label"), F.when(~bad, F.transform(x, lambda c: F.floor(c * scale))).alias("v"))


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""
