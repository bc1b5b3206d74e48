"""Approximate nearest neighbours (3) by collision counting, largest inner product.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, so that
the largest inner product is the nearest point.  Each block of vectors keeps one
sorted array per projection (the rows of a random rotation: single projections,
jointly without loss).  A query opens a window around its own projection in every
array and widens all windows step by step (virtual rehashing: the arrays stay as
they are, only the ends of the windows move).  A vector collides once for each
window that holds it; vectors whose collisions reach the threshold are verified,
and widening ends once enough vectors of the block have been verified or the
windows hold everything.  Verified vectors are scored exactly, in double
precision; ties go to the smaller id.

Every vector is indexed; nothing is fitted but the rotation, which is drawn from
a seed.  A query verifies at least ``share`` of a block, and ``least_verified``
vectors of it (all of a smaller block).  Recall on the given tables is measured in
the tests.  The windows of a few hundred queries widen together.  Queries meet the
vectors block by block: a task holds one block of vectors and one block of queries.

Defined results: a vector that is null, all zero or holds a null or a
non-finite component takes no part, neither does a row without an id; vectors of
another length than the query's are no candidates; rows that repeat an id count
once, with their best score, and are told apart before anything is cut; further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_in_table

FOUND = "query_id long, vec_id long, score double"


def rotation(d: int, seed: int = 3) -> np.ndarray:
    """Orthonormal projections of d dimensions."""
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]


class Block:
    """Sorted projection arrays of one block; rows that repeat wholly count once."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, biggest: float):
        vectors = vectors + 0.0                               # -0.0 and 0.0 are one value
        order = np.lexsort((*vectors.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(1)
        self.ids, self.vectors = ids[new], vectors[new]
        self.repeats = len(np.unique(self.ids)) < len(self.ids)
        unit = self.vectors / biggest
        lift = np.sqrt(np.maximum(1 - (unit ** 2).sum(1), 0.0))
        self.turn = rotation(self.vectors.shape[1] + 1)
        p = np.column_stack([unit, lift]) @ self.turn.T
        self.order = np.argsort(p, axis=0).T.copy()
        self.sorted = np.take_along_axis(p, self.order.T, axis=0).T.copy()

    def enough(self, picked: np.ndarray, least: int) -> bool:
        return len(picked) >= least and (not self.repeats or len(np.unique(self.ids[picked])) >= min(least, len(np.unique(self.ids))))

    def search(self, query_ids, queries, k: int, share: float, least_verified: int, threshold: float, width: float, growth: float,
               together: int = 256):
        n, m = len(self.ids), len(self.order)
        verify = min(n, max(k + 1 + int(share * n), least_verified))
        least = int(np.ceil(threshold * m))
        for first in range(0, len(query_ids), together):
            ids, own = query_ids[first:first + together], queries[first:first + together].astype(np.float64)
            big = np.abs(own).max(1, keepdims=True)
            unit = own / big
            unit = unit / np.sqrt((unit * unit).sum(1, keepdims=True))
            at = np.column_stack([unit, np.zeros(len(own))]) @ self.turn.T
            edge = lambda x, side: np.column_stack([s.searchsorted(x[:, j], side) for j, s in enumerate(self.sorted)])
            count = np.zeros((len(own), n), np.int32)
            lo = hi = edge(at, "left")
            active = np.arange(len(own))
            picked: list = [None] * len(own)
            half = width / np.sqrt(m)
            while len(active):
                # all windows of the queries that still widen, one array at a time
                new_lo, new_hi = edge(at[active] - half, "left"), edge(at[active] + half, "right")
                going = []
                for r, q in enumerate(active.tolist()):
                    rings = [o[a:b] for o, a, b in zip(self.order, new_lo[r], lo[r])] + [o[a:b] for o, a, b in zip(self.order, hi[r], new_hi[r])]
                    count[q] += np.bincount(np.concatenate(rings), minlength=n).astype(np.int32)
                    picked[q] = np.flatnonzero(count[q] >= least)
                    if not self.enough(picked[q], verify) and not ((new_lo[r] == 0) & (new_hi[r] == n)).all():
                        going.append(r)
                lo, hi, active = new_lo[going], new_hi[going], active[going]
                half *= growth
            for qid, q, some in zip(ids, own, picked):
                some = some[self.ids[some] != qid]
                # a sum over each row by itself, so that equal vectors score equally
                score = (self.vectors[some] * q).sum(1)
                if len(some) > 4 * k and not self.repeats:
                    near = np.flatnonzero(score >= np.partition(score, -2 * k)[-2 * k])
                    some, score = some[near], score[near]
                best = np.lexsort((self.ids[some], -score))
                found = self.ids[some[best]]
                if self.repeats:         # an id once, with its best score
                    best = best[np.sort(np.unique(found, return_index=True)[1])]
                best = best[:k]
                yield qid, self.ids[some[best]], score[best]


def vectors_of(table: DataFrame) -> DataFrame:
    """(vec_id, v, dim, norm) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    big = F.array_max(F.transform("v", F.abs))            # scaled by it, no square overflows
    norm = big * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / big) * (x / big)))
    return (table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")).withColumn("norm", norm))


def nearest(table: DataFrame, every: int = 20, k: int = 20, per_block: int = 8192, per_queries: int = 4096,
            share: float = 0.15, least_verified: int = 600, threshold: float = 0.7, width: float = 0.9, growth: float = 1.15) -> DataFrame:
    """embeddings(vec_id, embedding) -> (query_id, rank, vec_id, score), k a query."""
    rows = kept_in_table(vectors_of(table), "vectors")
    is_query = F.pmod(F.col("vec_id"), F.lit(every)) == 0
    # one row a dimension: few, whatever the number of vectors
    dims = {r["dim"]: r for r in rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.max("norm").alias("m"), F.count_if(is_query).alias("q")).collect()}
    blocks = {d: -(-r["n"] // per_block) for d, r in dims.items()}
    asked = {d: max(1, -(-r["q"] // per_queries)) for d, r in dims.items()}
    biggest = {d: float(r["m"]) for d, r in dims.items()}

    def of(values):
        if not values:
            return F.lit(1)
        return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("dim"))

    def every_part(frame, own, others):
        """Each row in its own part, once for each part of the other side."""
        own_part = F.pmod(F.xxhash64("vec_id"), of(own)).cast("int")
        return frame.withColumn("mine", own_part).withColumn("other", F.explode(F.sequence(F.lit(0), of(others) - 1)))

    left = every_part(rows, blocks, asked).select("dim", F.col("mine").alias("b"), F.col("other").alias("a"), "vec_id", "v")
    right = every_part(rows.where(is_query), asked, blocks).select("dim", F.col("other").alias("b"), F.col("mine").alias("a"), "vec_id", "v")

    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        queries = queries.drop_duplicates("vec_id")
        block = Block(vectors["vec_id"].to_numpy(), np.stack(vectors["v"].to_numpy()), biggest[int(vectors["dim"].iloc[0])])
        got = list(block.search(queries["vec_id"].to_numpy(), np.stack(queries["v"].to_numpy()), k, share, least_verified, threshold, width, growth))
        return pd.DataFrame({"query_id": np.concatenate([np.full(len(i), q) for q, i, _ in got]),
                             "vec_id": np.concatenate([i for _, i, _ in got]), "score": np.concatenate([s for _, _, s in got])})

    found = left.groupBy("dim", "b", "a").cogroup(right.groupBy("dim", "b", "a")).applyInPandas(search, FOUND)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
