"""Best-fit packing (5) by exact-complement hashing on the histogram of lengths.

Documents become token ids (a public tokenizer, then an end id); longer ones are
cut into pieces of the capacity.  What goes together depends only on how often
each length occurs, so the plan is made on the histogram: at most ``capacity``
counts, whatever the number of documents.  From the longest length down, the gap
that a length leaves is looked up among single lengths, sums of pairs and sums of
triples; a combination that fills it exactly is consumed as often as the
available counts allow.  What has no exact complement is packed best-fit: the
longest remaining length that fits, again and again.  Each step of the plan is a
pattern of lengths with a multiplicity and uses up one of its lengths, so the
plan has a bounded number of steps.

Pieces meet the plan by their rank within their length.  Ranks are counted in
buckets (hash of the document) and shifted by the bucket counts, so that a length
that very many pieces share is never gathered in one task.

Defined results: null or empty text is the end id alone (length 1); repeated
rows are packed once each; a null id packs like any other; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_in_table, slices

SLICE = 1 << 18           # bytes of text that a worker holds as words at a time (a longer text alone)
CACHE = 700_000           # words, and parts of words, whose ids a worker keeps (only saves work)
TOGETHER = 1000           # parts of words in one call of the tokenizer
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# what the tokenizer's pattern finds in a word of printable ASCII characters
ASCII_PART = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
PLAIN = re.compile(rb"[\x21-\x7e]{1,200}")
STOPS = ".,;:!?"


class WordIds(dict):
    """Ids of white-space separated words as little-endian uint32 bytes.  The
    tokenizer's patterns never match across white space, so the ids of a text are
    those of its words in a row.  New words are cut into the parts that its pattern
    finds (the letters and the punctuation behind them are never one part); the new
    parts of many texts go to the tokenizer together, one to a line, and each ends
    with a token that ends a word.  A word that is cut in no plain way goes whole.

    Words are remembered in two halves: where the newer half is full, it becomes the
    older one; what is found in the older half moves to the newer one, so words that
    come again and again are learnt once."""

    def __init__(self, path: str, keep: int = CACHE):
        self.keep = keep
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.parts: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.older_parts: dict[bytes, bytes] = {}

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def cut(word: bytes) -> list[bytes] | None:
        """Parts of the word, or None where it has to go whole."""
        if b"<|" in word:                                   # may hold a special token
            return None
        if PLAIN.fullmatch(word):
            return ASCII_PART.findall(word.lower())
        text = word.decode("utf-8", "replace")
        head = text.rstrip(STOPS)
        if len(head) > 200 or not head.isalpha() or not head.lower().isalpha():
            return None
        return [head.encode(), text[len(head):].encode()] if len(head) < len(text) else [head.encode()]

    def learn(self, words: set) -> None:
        if len(self.parts) > self.keep // 2:
            self.older_parts, self.parts = self.parts, {}
        # nearly all words are letters, with or without stops behind them
        plain = [w for w in words if w.isalpha()]
        low = [w.lower() for w in plain]
        stopped, heads, tails, cut = [], [], [], {}
        for w in words:
            if not w.isalpha():
                h = w.rstrip(STOPS.encode())
                if h.isalpha():
                    stopped.append(w)
                    heads.append(h.lower())
                    tails.append(w[len(h):])
                else:
                    cut[w] = self.cut(w)
        wanted = {*low, *heads, *tails, *chain.from_iterable(filter(None, cut.values()))}
        new = list(filterfalse(self.parts.__contains__, wanted))
        again = list(filter(self.older_parts.__contains__, new))
        self.parts.update(zip(again, map(self.older_parts.__getitem__, again)))
        new = list(filterfalse(self.parts.__contains__, new)) if again else new
        lines = ["\n".join(map(bytes.decode, new[i:i + TOGETHER])) for i in range(0, len(new), TOGETHER)]
        for i, got in enumerate(self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
            some, ids = new[i * TOGETHER:(i + 1) * TOGETHER], np.array(got.ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(some) and stop[-1] == len(ids):
                at, blob = (4 * stop).tolist(), ids.tobytes()
                self.parts.update(zip(some, [blob[lo:hi] for lo, hi in zip([0, *at], at)]))
            else:                                           # a part without a word end: one by one
                for p in some:
                    self.parts[p] = self.ids(p.decode())
        find = self.parts.__getitem__
        self.update(zip(plain, map(find, low)))
        self.update(zip(stopped, map(add, map(find, heads), map(find, tails))))
        for w, parts in cut.items():
            self[w] = b"".join(map(find, parts)) if parts else self.ids(w.decode("utf-8", "replace"))

    def texts(self, texts: list) -> Iterator[bytes]:
        split = [(t or "").encode("utf-8", "replace").split() for t in texts]
        missing = set(filterfalse(self.__contains__, set().union(*split)))
        if len(self) + len(missing) > self.keep // 2 and len(self):
            self.older = dict(self)
            self.clear()
            missing = set().union(*split)
        again = missing & self.older.keys()
        self.update(zip(again, map(self.older.__getitem__, again)))
        self.learn(missing - again)
        find = self.__getitem__
        for words in split:
            yield b"".join(map(find, words))


_IDS: dict[tuple[str, int], WordIds] = {}


def token_pieces(docs: DataFrame, path: str, capacity: int, end: int = 1, keep: int = CACHE) -> DataFrame:
    """One row a piece: (doc_id, piece, start, length, ids_crc32)."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        ids = _IDS.get((path, keep))
        if ids is None:
            ids = _IDS[path, keep] = WordIds(path, keep)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                rows = []
                for doc, blob in zip(part.column("doc_id").to_pylist(), ids.texts(part.column("text").to_pylist())):
                    blob += tail
                    for k, at in enumerate(range(0, len(blob), 4 * capacity)):
                        piece = blob[at:at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with multiplicities that use up the counts."""
    left = np.zeros(capacity + 1, np.int64)
    for k, v in counts.items():
        left[k] = v
    out = []
    indexed = [None, None]         # the available lengths and, by sum, whether two of them add up to it

    def pair_sums() -> np.ndarray:
        have = left > 0
        have[0] = False
        if indexed[0] is None or (have != indexed[0]).any():
            spread = np.fft.rfft(have, 2 * capacity + 2)
            indexed[:] = have, np.fft.irfft(spread * spread)[:capacity + 1] > 0.5
        return indexed[1]

    def take(pattern: list[int]) -> None:
        own, times = np.unique(pattern, return_counts=True)
        m = int((left[own] // times).min())
        left[own] -= m * times
        out.append((tuple(sorted(pattern, reverse=True)), m))

    def pair(gap: int, first: int) -> tuple[int, int] | None:
        """Available lengths a >= b with a + b = gap, beside one ``first``."""
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        if not len(a):
            return None
        b = gap - a
        need = np.ones((2, len(a)), np.int64)
        need[0] += (a == first) + (a == b)
        need[1] += (b == first) + (a == b)
        ok = np.flatnonzero((left[a] >= need[0]) & (left[b] >= need[1]))
        return (int(a[ok[0]]), int(b[ok[0]])) if len(ok) else None

    def exact(length: int) -> list[int] | None:
        gap = capacity - length
        if gap == 0:
            return [length]
        if left[gap] >= 1 + (gap == length):
            return [length, gap]
        if got := pair(gap, length):
            return [length, *got]
        sums = pair_sums()
        for a in np.flatnonzero((left[1:gap] > 0) & sums[gap - 1:0:-1])[::-1] + 1:
            if left[a] < 1 + (a == length):
                continue
            a = int(a)
            left[a] -= 1
            got = pair(gap - a, length)
            left[a] += 1
            if got:
                combo = [length, a, *got]
                own, times = np.unique(combo, return_counts=True)
                if (left[own] >= times).all():
                    return combo
        return None

    for length in range(capacity, 0, -1):
        while left[length] and (combo := exact(length)):
            take(combo)
    # residuals: best fit, the longest remaining length that the gap holds
    while left.any():
        length = int(np.flatnonzero(left)[-1])
        pattern, gap = [length], capacity - length
        while True:
            left[pattern[-1]] -= 1
            fit = np.flatnonzero(left[:gap + 1])
            if not len(fit):
                break
            pattern.append(int(fit[-1]))
            gap -= pattern[-1]
        for x in pattern:
            left[x] += 1
        take(pattern)
    return out


def pack(docs: DataFrame, path: str, capacity: int = 4096, per_bucket: int = 2000, keep: int = CACHE) -> DataFrame:
    """documents(doc_id, text) -> pieces with sequence_id and offset.

    ``keep``: words whose ids a worker remembers; fewer take less memory and more work."""
    pieces = kept_in_table(token_pieces(docs, path, capacity, keep=keep), "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}      # at most ``capacity`` rows
    buckets = max(1, -(-max(counts.values(), default=0) // per_bucket))
    salted = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    shift = (salted.groupBy("length", "bucket").count()
             .withColumn("shift", F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count"))
             .drop("count"))
    shift = kept_in_table(shift, "shift")
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = (salted.withColumn("own", F.row_number().over(own) - 1).join(shift, ["length", "bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("shift")).alias("rank")))
    # slots: for each length its ranks in order, each run with (first sequence, offset)
    runs: dict[int, list[tuple[int, int, int]]] = {k: [] for k in counts}
    used = dict.fromkeys(counts, 0)
    sequence = 0
    for pattern, m in plan(counts, capacity):
        at = 0
        for length in pattern:
            runs[length].append((used[length], sequence, at))
            used[length] += m
            at += length
        sequence += m
    table = {k: np.array(v, np.int64).T for k, v in runs.items()}
    held = docs.sparkSession.sparkContext.broadcast(table)       # bounded by the capacity, see plan()

    def place(batches):
        table = held.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            seq, off = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for k in np.unique(length):
                at = np.flatnonzero(length == k)
                first, begin, offset = table[int(k)]
                run = np.searchsorted(first, rank[at], "right") - 1
                seq[at] = begin[run] + rank[at] - first[run]
                off[at] = offset[run]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(off)],
                                             [*batch.schema.names[:5], "sequence_id", "offset"])
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
