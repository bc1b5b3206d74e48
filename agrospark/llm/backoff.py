"""LM scoring (2): stupid backoff from bigrams to unigrams, computed relationally.

score(w | h) = c'(h w) / c(h) if c'(h w) > 0, else 0.4 * c(w) / N, with all counts
over the whole corpus and c' without the scored document's own occurrences, so
that a text is judged by the others.  A document's score is the mean log score
of its words; the first word of a text has no history and is scored by its
unigram.

1. Unigram counts: one table (word, c), partitioned by hash.
2. Every position becomes an exploded bigram, shipped to a block by the hash of
   the bigram, packed by task: 8 bytes of hash and two half-precision log counts
   (history and word).  Counts of the ``common`` most frequent words travel to the
   tasks as a table of that fixed size; a position with a rarer word carries the
   word's hash instead.
3. A block is one partition of the bigram count table: it counts its bigrams,
   joins the counts to its positions and sums per document.
4. What still needs a rarer word's count is joined to the unigram table, and the
   sums of all blocks are added per document.

Words are as in ``hash_words`` (A-Z folded).  Defined results: null or empty text
has 0 words, score null; a null id is scored like any other, all rows that share an
id (or have none) are summed as one document; further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buffers, hash_words, kept_in_table, mix, slices

BACKOFF = 0.4
FLUSH = 1 << 21           # positions a task gathers before it ships them
_K = np.uint64(0xD6E8FEB86659FD93)
NONE = -(2 ** 63)         # id of rows without an id


def unigrams(docs: DataFrame) -> DataFrame:
    """(word, c): the count of each word hash over all documents."""
    def run(batches):
        held, n = [], 0

        def out():
            w, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], ["word", "c"])
        for batch in batches:
            for part in slices(batch, "text"):
                held.append(hash_words(*buffers(part.column("text")))[0])
                n += len(held[-1])
                if n >= 2 * FLUSH:
                    yield out()
                    held, n = [], 0
        if n:
            yield out()
    return docs.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(table: DataFrame, common: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent words, at most ``common``."""
    by_count = table.groupBy("c").count()
    # one row a distinct count, few against the words
    above = by_count.withColumn("n", F.sum("count").over(Window.orderBy(F.desc("c"))))
    least = above.where(F.col("n") <= common).agg(F.min("c")).first()[0]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = table.where(F.col("c") >= least).toArrow()
    words, c = got.column("word").to_numpy(), got.column("c").to_numpy()
    order = np.argsort(words)
    return words[order], c[order]


def _ship(held, blocks: int):
    schema = pa.schema([("block", pa.int32()), *[(x, pa.binary()) for x in ("docs", "counts", "grams", "logs", "rare")]])

    def run(batches):
        words, logs = held.value
        ids, sizes, gram, value, rare = [], [], [], [], []
        n = 0

        def flush():
            g, v, r = np.concatenate(gram), np.concatenate(value), np.concatenate(rare)
            row = np.repeat(np.arange(len(sizes)), sizes)
            block = ((mix(g + _K) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            cut = np.flatnonzero(np.diff(block[order])) + 1
            names = np.array(ids, np.int64)
            for at in np.split(order, cut):
                own, counts = np.unique(row[at], return_counts=True)
                place = np.flatnonzero((r[at] != 0).any(1))
                far = np.column_stack([place.astype(np.int64), r[at][place].view(np.int64)]) if len(place) else np.zeros((0, 3), np.int64)
                yield pa.RecordBatch.from_pylist([{
                    "block": int(block[at[0]]), "docs": names[own].tobytes(), "counts": counts.astype(np.int32).tobytes(),
                    "grams": g[at].tobytes(), "logs": v[at].tobytes(), "rare": far.tobytes()}], schema=schema)

        for batch in batches:
            for part in slices(batch, "text"):
                h, first = hash_words(*buffers(part.column("text")))
                place = np.minimum(np.searchsorted(words, h.view(np.int64)), max(0, len(words) - 1))
                known = words[place] == h.view(np.int64) if len(words) else np.zeros(len(h), bool)
                log = np.where(known, logs[place] if len(logs) else 0.0, 0.0)
                far = np.where(known, np.uint64(0), h)
                back, back_far, before = np.roll(log, 1), np.roll(far, 1), np.roll(h, 1)
                g = mix(before * _K + h)
                start = first[:-1][np.diff(first) > 0]
                g[start], back[start], back_far[start] = 0, 0.0, 0       # no history
                v = np.column_stack([back, log]).astype(np.float16)
                r = np.column_stack([back_far, far])
                doc = part.column("doc_id").to_pylist()
                ids += [NONE if d is None else d for d in doc]
                sizes += np.diff(first).tolist()
                gram.append(g)
                value.append(v)
                rare.append(r)
                n += len(g)
                if n >= FLUSH:
                    yield from flush()
                    ids, sizes, gram, value, rare, n = [], [], [], [], [], 0
        if n:
            yield from flush()
    return run


SUMS = "doc long, word long, times double, total double, n long, backed long"


def _block(total_log: float):
    def run(table: pa.Table) -> pa.Table:
        col = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]
        grams, counts = col("grams", np.uint64), col("counts", np.int32)
        doc = np.concatenate([np.repeat(d, c) for d, c in zip(col("docs", np.int64), counts)])
        g = np.concatenate(grams)
        logs = np.concatenate([x.reshape(-1, 2) for x in col("logs", np.float16)])
        shift = np.cumsum([0, *map(len, grams)])
        far = np.concatenate([x.reshape(-1, 3) + np.array([s, 0, 0]) for x, s in zip(col("rare", np.int64), shift)])
        # occurrences by bigram and document
        order = np.lexsort((doc, g))
        gs, ds = g[order], doc[order]
        new = np.concatenate([[True], gs[1:] != gs[:-1]])
        new_doc = new | np.concatenate([[True], ds[1:] != ds[:-1]])
        size = lambda flags: np.diff(np.append(np.flatnonzero(flags), len(flags)))
        others = np.empty(len(g), np.int64)
        others[order] = np.repeat(size(new), size(new)) - np.repeat(size(new_doc), size(new_doc))
        seen = (others > 0) & (g != 0)
        lone = g == 0
        value = np.where(seen, np.log(np.maximum(others, 1)) - logs[:, 0],
                         logs[:, 1].astype(np.float64) - total_log + np.where(lone, 0.0, np.log(BACKOFF)))
        own, at = np.unique(doc, return_inverse=True)
        out = [(own, None, None, np.bincount(at, value), np.bincount(at), np.bincount(at, ~seen & ~lone))]
        # positions whose history (seen) or word (not seen) is rarer than the travelling table
        if len(far):
            use = seen[far[:, 0]]
            word = np.where(use, far[:, 1], far[:, 2])
            some = word != 0
            out.append((doc[far[some, 0]], word[some], np.where(use[some], -1.0, 1.0), None, None, None))
        parts = [pa.table([pa.array(x, t) if x is not None else pa.nulls(len(row[0]), t) for x, t in zip(
            row, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()))],
            names=["doc", "word", "times", "total", "n", "backed"]) for row in
            [(a, b, c, d, e if e is None else e.astype(np.int64), f if f is None else f.astype(np.int64)) for a, b, c, d, e, f in out]]
        return pa.concat_tables(parts)
    return run


def score_documents(docs: DataFrame, common: int = 1 << 19, rows_per_block: int = 4000, least_blocks: int = 48) -> DataFrame:
    """documents(doc_id, text) -> (doc_id, n_words, n_backed_off, score)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = kept_in_table(unigrams(docs), "unigrams")
    total = table.agg(F.sum("c")).first()[0] or 1
    words, counts = frequent(table, common)
    held = docs.sparkSession.sparkContext.broadcast((words, np.log(counts)))     # at most ``common`` words
    blocks = max(least_blocks, -(-docs.select("doc_id").count() // rows_per_block))
    shipped = docs.mapInArrow(_ship(held, blocks), "block int, docs binary, counts binary, grams binary, logs binary, rare binary")
    sums = kept_in_table(shipped.groupBy("block").applyInArrow(_block(float(np.log(total))), SUMS), "sums")
    rare = (sums.where("word IS NOT NULL").groupBy("doc", "word").agg(F.sum("times").alias("times"))
            .join(table, "word").groupBy("doc").agg(F.sum(F.col("times") * F.log("c")).alias("more")))
    per_doc = (sums.where("word IS NULL").groupBy("doc")
               .agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum("backed").alias("backed")))
    scored = per_doc.join(rare, "doc", "left").select(
        "doc", "n", "backed", ((F.col("total") + F.coalesce("more", F.lit(0.0))) / F.col("n")).alias("score"))
    ids = docs.select("doc_id", F.coalesce("doc_id", F.lit(NONE)).alias("doc"))
    return ids.join(scored, "doc", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n_words"),
                                                  F.coalesce("backed", F.lit(0)).alias("n_backed_off"), "score")
