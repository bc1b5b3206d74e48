"""N-gram Jaccard join (7): blocked sparse product of the document x n-gram incidence.

Two texts link when the Jaccard similarity of their sets of distinct 5-word
shingles reaches the threshold.  Rows of the incidence matrix are *distinct
sets* (a 64-bit signature of the set; equal sets are one row, so copies never
multiply), columns are shingles, dealt to column blocks by hash.

1. One pass writes (document, set size, signature).
2. A second pass ships the incidence by column block, packed (8 bytes a
   shingle; a task ships an equal set once).  A block keeps the columns that at
   least two rows share.
3. Size-derived bounds: a row can link only if it shares at least
   ceil(t * size) columns; all other rows go.  This removes the texts that only
   share a passage.
4. In each block a column proposes the pairs (its first row, each other row):
   linear in the column, never all pairs.  Overlaps of the proposed pairs are
   accumulated over the blocks and pairs below t * union are discarded.
5. Components of these links.  A link between two components must overlap only
   in columns that hold both, so the bound of step 3 is applied again to those
   columns; what survives proposes its remaining cross-component pairs, in the
   windows of size that the bound leaves, and step 4's product decides.  Hence no
   link is lost, and a group of n near copies costs about n pairs.

Defined results: null or word-less text has no shingles, size 0 and links with
nothing; a text of 1 to 4 words is one shingle; a null id counts as no id (its
row keeps a null component unless linked with a text that has an id); repeated
rows give repeated rows; further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buffers, hash_words, kept_in_table, mix, slices
from .components import components

_K = np.uint64(0xD6E8FEB86659FD93)
FLUSH = 1 << 21           # shingles a task gathers before it ships them


def shingle_sets(col: pa.Array, k: int):
    """Sorted distinct shingle hashes (uint64) of each text of a string array."""
    data, offs = buffers(col)
    h, first = hash_words(data, offs)
    n = len(h)
    g = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k if len(g) else 0):
        g = g * _K + h[j:j + len(g)]
    g = mix(g)
    for i in range(len(offs) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            yield np.unique(g[a:b - k + 1])
        elif b > a:
            s = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in h[a:b]:
                    s = s * _K + w
            yield mix(np.array([s], np.uint64))
        else:
            yield g[:0]


def signature(s: np.ndarray) -> int:
    """64 bits of a set, as a signed long; 0 for the empty set."""
    x = (int(mix(s + _K).sum(dtype=np.uint64)) + len(s) * int(_K)) % 2 ** 64
    return x - 2 ** 64 * (x >= 2 ** 63)


def set_table(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, n_shingles, sig): one row per input row."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [(len(s), signature(s)) for s in shingle_sets(part.column("text"), k)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x[0] for x in sets], pa.int64()),
                     pa.array([x[1] for x in sets], pa.int64())], ["doc_id", "n_shingles", "sig"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, sig long")


def _ship(k: int, blocks: int):
    def run(batches):
        seen, sets, sigs, held = set(), [], [], 0

        def flush():
            cols = np.concatenate(sets)
            rows = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
            block = ((cols >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            cols, rows, block = cols[order], rows[order], block[order]
            names = np.array(sigs, np.int64)
            cut = np.flatnonzero(np.diff(block)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(block)]):
                own, counts = np.unique(rows[lo:hi], return_counts=True)
                yield pa.RecordBatch.from_pylist([{
                    "block": int(block[lo]), "sigs": names[own].tobytes(),
                    "counts": counts.astype(np.int32).tobytes(), "cols": cols[lo:hi].tobytes()}],
                    schema=pa.schema([("block", pa.int32()), ("sigs", pa.binary()),
                                      ("counts", pa.binary()), ("cols", pa.binary())]))

        for batch in batches:
            for part in slices(batch, "text"):
                for s in shingle_sets(part.column("text"), k):
                    if len(s) and (sig := signature(s)) not in seen:
                        if len(seen) > 2_000_000:      # only saves work: the blocks drop repeats
                            seen.clear()
                        seen.add(sig)
                        sets.append(s)
                        sigs.append(sig)
                        held += len(s)
                        if held >= FLUSH:
                            yield from flush()
                            sets, sigs, held = [], [], 0
        if sets:
            yield from flush()
    return run


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32),
                                    pa.array(values, pa.int32()))


INCIDENCE = "node long, block int, cols array<int>"


def _emit(block: int, node: np.ndarray, col: np.ndarray) -> pa.Table:
    """Rows (node, block, cols) of entries sorted by node."""
    own, counts = np.unique(node, return_counts=True)
    return pa.table([pa.array(own, pa.int64()), pa.array(np.full(len(own), block, np.int32)),
                     _lists(counts, col)], names=["node", "block", "cols"])


def _shared(table: pa.Table) -> pa.Table:
    """Columns of a block that at least two rows share, as (node, block, cols)."""
    block = table.column("block")[0].as_py()
    cols = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("cols")])
    node = np.concatenate([np.repeat(np.frombuffer(s.as_buffer(), np.int64), np.frombuffer(c.as_buffer(), np.int32))
                           for s, c in zip(table.column("sigs"), table.column("counts"))])
    order = np.argsort(cols)
    cols, node = cols[order], node[order]
    new = np.concatenate([[True], cols[1:] != cols[:-1]])
    run = np.cumsum(new) - 1
    again = np.bincount(run)[run] > 1
    node, run = node[again], run[again]
    order = np.lexsort((run, node))
    node, run = node[order], run[order]
    if len(node):                              # an equal set shipped by two tasks
        keep = np.concatenate([[True], (node[1:] != node[:-1]) | (run[1:] != run[:-1])])
        node, run = node[keep], run[keep]
        twice = np.bincount(run)[run] > 1
        node, run = node[twice], run[twice]
    return _emit(block, node, run.astype(np.int32))


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(row index, column) of every entry of incidence rows."""
    c = table.column("cols").combine_chunks()
    return c.value_parent_indices().to_numpy(), c.flatten().to_numpy()


def _stars(table: pa.Table, t: int) -> pa.Table:
    """Pairs (leader of a column, other row), distinct within the block.

    The leader is the row with the largest share of shared columns: the text that
    a family of near copies was made from has few columns of its own."""
    node, size = table.column("node").to_numpy(), table.column("n").to_numpy()
    place = np.empty(len(node), np.int64)
    place[np.lexsort((node, -(table.column("shared").to_numpy() / size)))] = np.arange(len(node))
    row, col = _flat(table)
    order = np.lexsort((place[row], col))
    row, col = row[order], col[order]
    new = np.concatenate([[True], col[1:] != col[:-1]]) if len(col) else np.zeros(0, bool)
    lead = row[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(col) else row
    pair = np.unique((lead.astype(np.int64) << 32 | row)[~new])
    return _pairs(node, size, pair >> 32, pair & 0xFFFFFFFF, t)


def _pairs(node, size, a, b, t: int) -> pa.Table:
    a, b = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
    ok = (100 * np.minimum(size[a], size[b]) >= t * np.maximum(size[a], size[b])) & (node[a] != node[b])
    a, b = a[ok], b[ok]
    return pa.table([node[a], node[b], size[a], size[b]], names=["a", "b", "na", "nb"])


PAIRS = "a long, b long, na long, nb long"


CLASSES = 48              # classes of columns by the number of rows that hold them
ACROSS = INCIDENCE + ", degrees array<int>"


def _across(table: pa.Table) -> pa.Table:
    """Entries in columns that hold two components."""
    row, col = _flat(table)
    label = table.column("label").to_numpy()[row]
    node = table.column("node").to_numpy()[row]
    width = int(col.max()) + 1 if len(col) else 0
    low, high = np.full(width, np.iinfo(np.int64).max), np.full(width, np.iinfo(np.int64).min)
    np.minimum.at(low, col, label)
    np.maximum.at(high, col, label)
    ok = low[col] != high[col]
    node, col = node[ok], col[ok]
    order = np.lexsort((col, node))
    node, col = node[order], col[order]
    degree = np.bincount(col, minlength=1)
    kind = np.minimum((2 * np.log2(np.maximum(degree, 1))).astype(np.int64), CLASSES - 1)[col]
    out = _emit(table.column("block")[0].as_py(), node, col)
    at = np.searchsorted(out.column("node").to_numpy(), node)
    counts = np.bincount(at * CLASSES + kind, minlength=CLASSES * out.num_rows)
    return out.append_column("degrees", _lists(np.full(out.num_rows, CLASSES), counts.astype(np.int32)))


def _cross_pairs(table: pa.Table, t: int) -> pa.Table:
    """Pairs of different components that share a column and whose sizes the bound
    allows: an overlap of t / (1 + t) * (na + nb) can't exceed what either row
    shares, nor the sum over the classes of columns of the smaller count.

    Of a pair the smaller row (by size, then name) probes.  A partner lacks at most
    shared - t / (1 + t) * 2n of its columns, so one column more than that is enough
    to meet every partner: the row probes in its first blocks only."""
    node, size = table.column("node").to_numpy(), table.column("n").to_numpy()
    label, share = table.column("label").to_numpy(), table.column("shared").to_numpy()
    degrees = table.column("degrees").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
    row, col = _flat(table)
    order = np.lexsort((node[row], size[row], col))
    row, col = row[order], col[order]
    u = 100 + t
    probes = u * (share - table.column("before").to_numpy()) >= 2 * t * size
    found = set()
    cut = np.flatnonzero(np.diff(col)) + 1 if len(col) else []
    for lo, hi in zip([0, *cut], [*cut, len(col)]):
        r = row[lo:hi]
        n = size[r]
        for i in np.flatnonzero(probes[r]):
            x = r[i]
            top = min(100 * n[i] // t, u * share[x] // t - n[i])
            end = int(np.searchsorted(n, top, "right"))
            y = r[i + 1:end]
            y = y[(label[y] != label[x]) & (t * (size[y] + n[i]) <= u * share[y])]
            if len(y):
                y = y[t * (size[y] + n[i]) <= u * np.minimum(degrees[y], degrees[x]).sum(1)]
            found.update((int(x) << 32 | y).tolist())
    pair = np.array(sorted(found), np.int64)
    return _pairs(node, size, pair >> 32, pair & 0xFFFFFFFF, t)


def _linked(pairs: DataFrame, inc: DataFrame, t: int) -> DataFrame:
    """Overlap of each proposed pair, summed over the column blocks; links only."""
    left = inc.select(F.col("node").alias("a"), "block", F.col("cols").alias("ca"))
    right = inc.select(F.col("node").alias("b"), "block", F.col("cols").alias("cb"))
    both = pairs.join(left, "a").join(right, ["b", "block"])
    return (both.groupBy("a", "b", "na", "nb")
            .agg(F.sum(F.size(F.array_intersect("ca", "cb"))).alias("o"))
            .where(F.expr(f"100 * o >= {t} * (na + nb - o)")).select("a", "b"))


def jaccard_components(docs: DataFrame, k: int = 5, threshold: int = 75,
                       rows_per_block: int = 6000, least_blocks: int = 48) -> DataFrame:
    """documents(doc_id, text, ...) -> (doc_id, n_shingles, component_id).

    ``threshold`` is in per cent.  The number of column blocks follows the
    number of documents, so that a block stays of one size."""
    sets = kept_in_table(set_table(docs, k), "sets")
    nodes = kept_in_table(sets.where("n_shingles > 0").groupBy(F.col("sig").alias("node"))
                          .agg(F.max("n_shingles").alias("n"), F.min("doc_id").alias("least")), "nodes")
    blocks = max(least_blocks, -(-sets.count() // rows_per_block))
    shipped = docs.select("text").mapInArrow(
        _ship(k, blocks), "block int, sigs binary, counts binary, cols binary")
    shared = kept_in_table(shipped.groupBy("block").applyInArrow(_shared, INCIDENCE), "shared")
    size = nodes.select("node", "n")

    def bounded(inc: DataFrame) -> DataFrame:
        """Rows whose shared columns reach t * size, with (n, shared)."""
        sums = inc.groupBy("node").agg(F.sum(F.size("cols")).alias("shared"))
        return sums.join(size, "node").where(F.expr(f"100 * shared >= {threshold} * n"))

    live = kept_in_table(shared.join(kept_in_table(bounded(shared), "bounded"), "node"), "live")
    inc = live.select("node", "block", "cols")
    proposed = kept_in_table(live.groupBy("block").applyInArrow(lambda x: _stars(x, threshold), PAIRS).distinct(), "pairs")
    links = kept_in_table(_linked(proposed, inc, threshold), "links")
    label = components(links)
    grouped = live.drop("shared").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    across = kept_in_table(grouped.groupBy("block").applyInArrow(_across, ACROSS), "across")
    each = [F.sum(F.get("degrees", F.lit(i))) for i in range(CLASSES)]
    degrees = across.groupBy("node").agg(F.array(*each).alias("degrees"))
    rest = kept_in_table(bounded(across).join(degrees, "node"), "bounded")
    if rest.limit(1).count():
        again = (across.drop("degrees").join(rest, "node").join(label, "node", "left")
                 .withColumn("label", F.coalesce("label", "node"))
                 .withColumn("before", F.sum(F.size("cols")).over(Window.partitionBy("node").orderBy("block")) - F.size("cols")))
        more = kept_in_table(again.groupBy("block").applyInArrow(lambda x: _cross_pairs(x, threshold), PAIRS).distinct(), "pairs")
        found = kept_in_table(_linked(more, inc, threshold), "links")
        if found.limit(1).count():
            label = components(links.union(found))
    # class id: smallest document of the component
    named = nodes.join(label, "node", "left").select(
        "node", "least", F.coalesce("label", "node").alias("label"))
    least = kept_in_table(named.groupBy("label").agg(F.min("least").alias("component_id")), "least")
    classes = kept_in_table(named.join(least, "label").select(F.col("node").alias("sig"), "component_id"), "classes")
    return (sets.join(classes, "sig", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))
