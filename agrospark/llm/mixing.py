"""Mixing sources to target weights (4) by pivotal dependent rounding.

A source's documents are each copied target / source size times on average.  The
whole part is fixed; the fractional parts are rounded together: two documents
meet, word mass moves at random from one to the other until one of them is
integral (their expected copies stay), and the one left open meets the next.
Mass is conserved at every meeting.  Meetings happen within blocks of bounded size
(hash of the document); the one open document of each block goes up a reduction tree
of blocks until a source has one left.  The longer of two documents tends to stay open,
so each source's shortest documents are held back: the last long one is rounded, the
short ones take the words it gained or lost, and meet at the end.  A source so ends
within a short document of its target, where the short ones hold enough words.

All draws are hashes of the documents' ids and the level, so that reruns and
retried tasks agree.  Sources are ranked by code point with null last; weights
repeat (5, 2, 1); what a capped source (``most`` times its size) leaves is shared
among the others by weight until none is above.

Defined results: null or empty text has size 0 and takes 0; null sources form
one source; a null id is a document like others; repeated rows are mixed each on
their own; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_in_table, n_words

WEIGHTS = (5, 2, 1)
OPEN = "source string, doc_id long, size long, source_size long, target double, base long, part double, key long, block long, short boolean, copies long"


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """(source, source_size, n) -> with target; one row a source."""
    # one row a source: a window over sources, never over documents
    ranked = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    table = kept_in_table(ranked.withColumn("weight", weight).drop("k"), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, F.lit(False)
    while True:       # the level rises each time a source is capped, so this ends
        row = table.agg(F.sum(F.when(capped, F.col("source_size") * most)).alias("m"),
                        F.sum(F.when(~capped, F.col("weight"))).alias("w"),
                        F.count_if(capped).alias("c")).first()
        if not row["w"]:
            break
        level = (total - (row["m"] or 0.0)) / row["w"]
        above = F.col("weight") * level > F.col("source_size") * most
        if table.where(above).count() == row["c"]:
            break
        capped = above
    share = F.col("source_size") * most
    if level is not None:
        share = F.least(share, F.col("weight") * level)
    return table.withColumn("target", share.cast("double"))


def _draw(seed: int, level: int, a: int, b: int) -> float:
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9 + level) % 2 ** 64
    for shift, k in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ x >> shift) * k) % 2 ** 64
    return ((x ^ x >> 31) >> 11) / 2 ** 53


def pivot(size: np.ndarray, part: np.ndarray, key: np.ndarray, seed: int, level: int, last: bool) -> np.ndarray:
    """Rounded parts (0 or 1); -1 for the one left open unless ``last``.

    ``part`` holds fractions of a copy.  Between a and b with masses x and y
    (words), one ends at 0 or at its full size; the draw keeps expectations."""
    out = np.full(len(part), -1, np.int64)
    eps = 1e-9
    done = (part <= eps) | (part >= 1 - eps)
    out[done] = part[done] > 0.5
    i, p = -1, part.astype(float).copy()
    for j in np.flatnonzero(~done).tolist():
        if i < 0:
            i = j
            continue
        a, b = float(size[i]), float(size[j])
        up = min((1 - p[i]) * a, p[j] * b)        # mass that may move to i
        down = min(p[i] * a, (1 - p[j]) * b)      # mass that may move to j
        move = up if _draw(seed, level, int(key[i]), int(key[j])) * (up + down) < down else -down
        p[i] += move / a
        p[j] -= move / b
        nxt = -1
        for k in (i, j):
            if p[k] <= eps or p[k] >= 1 - eps:
                out[k] = p[k] > 0.5
            else:
                nxt = k
                part[k] = p[k]
        i = nxt
    if i >= 0 and last:
        out[i] = _draw(seed, level, int(key[i]), 0) < p[i]
    elif i >= 0:
        part[i] = p[i]
    return out


def settle(size: np.ndarray, part: np.ndarray, key: np.ndarray, short: np.ndarray, seed: int, level: int) -> np.ndarray:
    """Rounded parts (0 or 1) of the last level: all but the ``short`` documents meet; the
    one left open is rounded by its draw, in the direction that the short ones can make
    good, and the words it gains or loses are taken from or given to them; they meet last."""
    out = np.zeros(len(part), np.int64)
    long_, rest = np.flatnonzero(~short), np.flatnonzero(short)
    p = part[long_].copy()
    got = pivot(size[long_], p, key[long_], seed, level, not len(rest))
    out[long_] = np.maximum(got, 0)
    left = np.flatnonzero(got < 0)
    q = part[rest].copy()
    if len(left):
        i = int(left[0])
        words = float(size[long_[i]])
        room = {1: float((q * size[rest]).sum()), 0: float(((1 - q) * size[rest]).sum())}
        miss = {1: (1 - p[i]) * words, 0: p[i] * words}      # what rounding up or down moves
        fits = [k for k in (0, 1) if miss[k] <= room[k]] or [min((0, 1), key=lambda k: miss[k] - room[k])]
        take = int(_draw(seed, level, int(key[long_[i]]), 0) < p[i]) if len(fits) == 2 else fits[0]
        out[long_[i]] = take
        share = min(1.0, miss[take] / room[take]) if room[take] > 0 else 0.0
        q = q * (1 - share) if take else q + (1 - q) * share
    out[rest] = pivot(size[rest], q, key[rest], seed, level + 1, True)
    return out


def _rounds(seed: int, level: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # rows that are equal in all of these are interchangeable
        rows = rows.sort_values(["size", "key", "part"], ascending=[False, True, True], kind="stable", ignore_index=True)
        part = rows["part"].to_numpy(float).copy()
        if last:
            got = settle(rows["size"].to_numpy(), part, rows["key"].to_numpy(), rows["short"].to_numpy(bool), seed, level)
        else:
            got = pivot(rows["size"].to_numpy(), part, rows["key"].to_numpy(), seed, level, False)
        rows["part"] = part
        rows["copies"] = np.where(got >= 0, rows["base"].to_numpy() + got, -1)
        return rows
    return run


def row_key(seed: int = 17) -> F.Column:
    """64 bits of a row's id, text and source."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"), F.col("source").cast("string"), F.lit(seed))


def mix_documents(docs: DataFrame, weights=WEIGHTS, most: float = 3.0, per_block: int = 1000,
                  held_back: int = 300, seed: int = 17) -> DataFrame:
    """documents(doc_id, text, source) ->
    (key, doc_id, source, size, source_size, target, copies, taken), one row per input row.

    ``key`` is ``row_key()`` of the row; only rows that repeat wholly share it."""
    sized = kept_in_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string"),
                                      n_words("text").alias("size"), row_key(seed).alias("key")), "sized")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    source = targets(sums, weights, most)
    most_blocks = -(-(source.agg(F.max("n")).first()[0] or 0) // per_block)
    # one row a source; the equality is null-safe
    shares = source.select(F.col("source").alias("s"), "source_size", "target",
                           F.ceil(F.col("n") / per_block).alias("blocks"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    open_ = (sized.join(shares, F.col("source").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("base", F.when(F.col("size") > 0, F.floor(rate)).otherwise(F.lit(0)).cast("long"))
             .withColumn("part", F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(F.lit(0.0)))
             .withColumn("block", F.pmod(F.col("key"), F.col("blocks")).cast("long"))
             .drop("blocks").withColumn("copies", F.lit(-1).cast("long")))
    # the shortest documents with an open part wait for the last level: half of a source's, ``held_back`` at most
    nth = F.row_number().over(Window.partitionBy("source").orderBy("size", "key"))
    open_ = kept_in_table(open_, "open")
    halves = open_.where("part > 0").groupBy(F.col("source").alias("s")).agg(F.ceil(F.count("*") / 2).alias("half"))
    few = open_.where("part > 0").select("source", "size", "key").withColumn("nth", nth).where(F.col("nth") <= held_back)
    few = few.join(halves, F.col("source").eqNullSafe(F.col("s"))).where("nth <= half")
    # a key stands for all rows that repeat it wholly
    few = few.select(F.col("key").alias("held")).distinct()
    open_ = open_.join(few, F.col("key") == F.col("held"), "left").withColumn("short", F.col("held").isNotNull()).drop("held")
    open_ = kept_in_table(open_, "open")
    short, open_ = open_.where("short").withColumn("block", F.lit(0).cast("long")), open_.where("NOT short")
    columns = [x.split()[0] for x in OPEN.split(", ")]
    decided, level = [], 0
    while True:
        last = most_blocks <= 1
        if last:
            open_ = open_.select(columns).unionByName(short.select(columns))
        done = kept_in_table(open_.select(columns).groupBy("source", "block").applyInPandas(
            _rounds(seed, level, last), OPEN), "level")
        decided.append(done.where("copies >= 0"))
        if last:
            break
        level += 1
        most_blocks = -(-most_blocks // per_block)
        open_ = done.where("copies < 0").withColumn("block", F.floor(F.col("block") / per_block).cast("long"))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select("key", "doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))
