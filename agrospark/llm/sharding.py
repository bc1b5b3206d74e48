"""Sharding (9) by a k-d tree over document metadata, in DataFrame operations only.

Each node holds a share of the bytes for a number of shards.  It is split along
its widest metadata dimension (source, language, size; widths relative to the
whole table) at the distributed weighted median - for an odd number of shards at
the weighted quantile of the smaller half - until every leaf is one shard of the
target bytes.  A quantile is found in rounds of histograms: bytes by bin along
the dimension, then inside the bin that holds the quantile by a hash of the text,
then by a hash of the id, then by the row.  Equal texts have equal coordinates (the smallest
source and language among them), so a cut falls between two texts and a group of
copies stays in one shard, on the nearer side of the cut, unless the group that
covers the quantile is larger than half a shard: only then is it cut, by the ids (and
rows that repeat an id wholly, by their number).  A hot value is one
that a later round splits, not one that a task has to hold.

The driver reads one row a node and round: at most the number of shards.

Defined results: null text has size 16 and the checksum of the empty text; null
source or language is a value of its own, before all others; repeated rows are
placed each on their own; further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_in_table

BINS = 4096
DIMENSIONS = ("x_source", "x_lang", "x_size")


def _code(column: str) -> F.Column:
    """Order-preserving number of the first 6 bytes of a string; null is -1."""
    six = F.substring(F.rpad(F.hex(F.encode(F.col(column).cast("string"), "UTF-8")), 12, "0"), 1, 12)
    return F.coalesce(F.conv(six, 16, 10).cast("double"), F.lit(-1.0))


def points(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, dimensions, hashes): the metadata of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 16).cast("long")
    bins = lambda *c: F.pmod(F.xxhash64(*c), F.lit(BINS)).cast("int")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        _code("source").alias("x_source"), _code("lang").alias("x_lang"), F.log2(size.cast("double")).alias("x_size"),
        bins(text, F.lit("text")).alias("b_text"), bins(F.col("doc_id").cast("long"), text, F.lit("id")).alias("b_id"),
        # tells rows that repeat wholly apart; the points are written once, so it stays
        bins(F.monotonically_increasing_id(), F.lit("row")).alias("b_row"))


def _choose(node: F.Column, values: dict[int, object], default) -> F.Column:
    """The value of each row's node, from a literal map (at most one entry a shard).
    The map is data to the generated code, which so is compiled once."""
    if not values:
        return F.lit(default)
    flat = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*flat), node), F.lit(default))


def _cut(rows: DataFrame, bin_: F.Column, want: dict[int, float]) -> dict[int, tuple[int, float, int]]:
    """For each node the bin that holds its quantile, the bytes before the bin and in it."""
    sums = rows.groupBy("node", bin_.alias("bin")).agg(F.sum("size").alias("bytes"))
    # at most BINS rows a node
    run = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin"))
    cut = (sums.withColumn("upto", run).where(F.col("upto") > _choose(F.col("node"), want, 0.0))
           .groupBy("node").agg(F.min(F.struct("bin", F.col("upto") - F.col("bytes"), "bytes")).alias("c")))
    return {r[0]: (r[1][0], float(r[1][1]), r[1][2]) for r in cut.collect()}


def leaves(rows: DataFrame, shards: int, share: float = 0.5) -> DataFrame:
    """``rows`` with ``shard`` 0 .. shards - 1, of near equal bytes.

    Texts are not cut apart for less than ``share`` of a shard's bytes."""
    node = F.col("node")
    table = rows.withColumn("node", F.lit(0))
    span = {0: (0, shards)}                     # node -> (first shard, number of shards)
    root, slack = None, 0.0
    while any(n > 1 for _, n in span.values()):
        open_ = [k for k, (_, n) in span.items() if n > 1]
        is_open = lambda keys: _choose(node, dict.fromkeys(keys, True), False)
        live = table.where(is_open(open_))
        box = {r["node"]: r for r in live.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[f(d).alias(f"{f.__name__}_{d}") for d in DIMENSIONS for f in (F.min, F.max)]).collect()}
        if not box:
            break
        root = root or {d: (box[0][f"max_{d}"] - box[0][f"min_{d}"]) or 1.0 for d in DIMENSIONS}
        widest, lo, step, want = {}, {}, {}, {}
        for k, r in box.items():
            d = max(DIMENSIONS, key=lambda d: (r[f"max_{d}"] - r[f"min_{d}"]) / root[d])
            widest[k], lo[k] = d, r[f"min_{d}"]
            step[k] = ((r[f"max_{d}"] - r[f"min_{d}"]) / BINS) or 1.0
            want[k] = r["bytes"] * (span[k][1] // 2) / span[k][1]
        which = _choose(node, {k: DIMENSIONS.index(d) for k, d in widest.items()}, 0)
        x = F.lit(0.0)
        for i, d in enumerate(DIMENSIONS):
            x = F.when(which == i, F.col(d)).otherwise(x)
        place = F.least(F.floor((x - _choose(node, lo, 0.0)) / _choose(node, step, 1.0)), F.lit(BINS - 1)).cast("int")
        live = live.withColumn("b_main", place)
        slack = slack or share * sum(r["bytes"] for r in box.values()) / shards
        cuts, inside, whole = [], live, {}
        for b in ("b_main", "b_text", "b_id", "b_row"):
            got = _cut(inside, F.col(b), want) if len(whole) < len(box) else {}
            cuts.append({k: whole.get(k, got.get(k, (BINS,))[0]) for k in box})
            want = {k: want[k] - got.get(k, (0, 0.0, 0))[1] for k in box}
            if b == "b_text":       # a bin of few bytes goes whole to the nearer side
                whole = {k: BINS if 2 * want[k] >= c[2] else 0 for k, c in got.items() if c[2] <= slack}
            inside = inside.where((F.col(b) == _choose(node, cuts[-1], -1)) & ~is_open(whole))
        at = [_choose(node, c, -1) for c in cuts]
        left = ((F.col("b_main") < at[0]) | ((F.col("b_main") == at[0]) & (
            (F.col("b_text") < at[1]) | ((F.col("b_text") == at[1]) & (
                (F.col("b_id") < at[2]) | ((F.col("b_id") == at[2]) & (F.col("b_row") < at[3])))))))
        child = F.when(left, 2 * node + 1).otherwise(2 * node + 2)
        new = table.withColumn("b_main", place).withColumn("node", F.when(is_open(box), child).otherwise(node)).drop("b_main")
        table = kept_in_table(new, "tree")
        for k in open_:
            first, n = span.pop(k)
            span[2 * k + 1], span[2 * k + 2] = (first, n // 2), (first + n // 2, n - n // 2)
    return table.withColumn("shard", _choose(node, {k: first for k, (first, _) in span.items()}, 0)).drop("node")


def shard(docs: DataFrame, shards: int = 40, per_bucket: int = 5000) -> DataFrame:
    """documents(doc_id, text, source, lang) -> one row each with shard and slot."""
    rows = kept_in_table(points(docs), "points")
    # copies take the smallest coordinates of their group
    same = ["text_crc32", "size", "b_text"]
    group = kept_in_table(rows.groupBy(same).agg(F.min(F.struct("x_source", "x_lang")).alias("g")), "groups")
    rows = kept_in_table(rows.drop("x_source", "x_lang").join(group, same).select("*", "g.*").drop("g"), "points")
    placed = leaves(rows, shards)
    # slots: counted within buckets of a shard and shifted, so no shard is one task
    buckets = max(1, -(-rows.count() // (shards * per_bucket)))
    placed = kept_in_table(placed.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int")), "placed")
    counts = placed.groupBy("shard", "bucket").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")
    shift = counts.withColumn("shift", before).drop("count")
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    return (placed.withColumn("own", own).join(F.broadcast(shift) if buckets * shards <= 10_000 else shift, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("own") + F.col("shift")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
