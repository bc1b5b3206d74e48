"""Phrase collocations (11): HAT-trie counting, level by level.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and into
words at spaces and tabs.  Three passes count per language the words, the pairs and
the phrases of three to five words.  A pass leaves out what can't be frequent: a
phrase is counted only where all its words, and its pairs of neighbours, are
frequent themselves.  What is frequent travels as a bit map of about 32 bits an
entry, of 32 MB at most; a wrong bit only counts a phrase that falls below the
threshold later.

A task counts in a HAT-trie: a shallow trie of word ids whose leaves are hash
containers of the remaining ids.  A container that grows beyond ``burst`` entries
becomes a node with containers below the next word.  Beyond ``most`` entries the
trie spills whole subtrees, largest first, as one run a language sorted by phrase; the
rest follows at the end of the task.  Runs are dealt by the hash of a prefix (the word,
the pair, the first three words) and travel compressed; one partition for 8 MB of
text, so what a merge holds doesn't grow with the input, and a hot word or phrase is
at most one entry a run.  A partition's runs are merged in order.  Containers count
Python keys; what is spilled, dealt and merged is made as arrays, not phrase by phrase.

The score of a cut after k words is floor(1000 * a * n / (l * r)) in decimals of 38
digits (exact below 10^17 occurrences).  A phrase within a longer one that is as
frequent lies, word by word, within one that is one word longer and as frequent, so
phrases are dropped by their one word longer neighbours.

Words are known by 64-bit hashes within a task and by their text between tasks.

Defined results: a null text is empty, a null language is ``und``; texts without
words add nothing; the cut with the lowest floored score counts, ties to the
smallest k; equal scores and counts are ordered by the bytes of the phrase; repeated
rows count each; a word or text of any length is whole; further columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buffers, hash_bounds, kept_in_table, mix, slices

COUNTED = "lang string, phrase string, c long"
RUNS = "part int, lang string, n int, raw long, run binary"
MERGE_BYTES = 8 << 20           # of text for one merged partition
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[32, 9]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PAIR = np.uint64(0x9E3779B97F4A7C15)
TOTAL = ""                       # the phrase that stands for all words of a language


class Words:
    """Words of a batch: bytes, bounds, hash, language, piece of each."""

    def __init__(self, texts: pa.Array, langs: list):
        data, offs = buffers(texts)
        self.data = _FOLD[data]
        full = ~_BETWEEN[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offs] = True
        before = np.zeros_like(full)
        after = np.zeros_like(full)
        before[1:], after[:-1] = full[:-1], full[1:]
        self.starts = np.flatnonzero(full & (~before | cut[:-1]))
        self.ends = np.flatnonzero(full & (~after | cut[1:])) + 1
        self.hash = hash_bounds(self.data, self.starts, self.ends, fold=False)
        doc = np.searchsorted(offs, self.starts, "right") - 1
        breaks = np.cumsum(_BREAK[data])[self.starts] if len(data) else np.zeros(0, np.int64)
        apart = (np.diff(breaks) != 0) | (np.diff(doc) != 0)
        self.joined = ~apart                                     # word i and i + 1 are in one piece
        self.langs, code = np.unique(np.array(["und" if x is None else x for x in langs], object), return_inverse=True)
        self.lang = code[doc] if len(doc) else np.zeros(0, np.int64)
        salt = np.array([seed_of(x) for x in self.langs], np.uint64)
        self.key = mix(self.hash ^ salt[self.lang]) if len(doc) else self.hash

    def texts(self, at: np.ndarray) -> list[bytes]:
        """The words at some places."""
        bounds = np.column_stack([self.starts, self.ends]).astype(np.int64).ravel()      # word, gap, word and so on
        words = pa.Array.from_buffers(pa.large_binary(), max(len(bounds) - 1, 0), [None, pa.py_buffer(bounds), pa.py_buffer(self.data)])
        return listed(words.take(pa.array(2 * at)))

    def pairs(self, at: np.ndarray) -> np.ndarray:
        """Key of the pair that begins at some words but the last."""
        return mix(self.key[at] * _PAIR + self.key[at + 1])


def listed(found: pa.Array) -> list[bytes]:
    return found.to_numpy(zero_copy_only=False).tolist()


def seed_of(lang: str) -> int:
    one = np.frombuffer(lang.encode(), np.uint8)
    return int(hash_bounds(one, np.array([0]), np.array([len(one)]), fold=False)[0]) if len(one) else 1


class HatTrie:
    """Counts of id sequences below (language, first id): hash containers that burst."""

    def __init__(self, texts: list[bytes], burst: int, most: int):
        self.texts, self.burst, self.most = texts, burst, most
        self.root: dict = {}
        self.entries = 0

    def add(self, lang: str, first: int, rests: list[bytes]) -> None:
        """Count the sequences ``first`` + rest, a rest being four bytes an id."""
        at = (lang, first)
        node = self.root.get(at)
        if node is None:
            node = self.root[at] = Counter()
        if type(node) is dict:
            for rest in rests:
                leaf = node.get(rest[:4])
                if leaf is None:
                    leaf = node[rest[:4]] = Counter()
                before = len(leaf)
                leaf[rest[4:]] += 1
                self.entries += len(leaf) - before
            return
        before = len(node)
        node.update(rests)
        self.entries += len(node) - before
        if len(node) > self.burst and len(rests[0]) > 4:
            child: dict = {}
            for rest, c in node.items():
                child.setdefault(rest[:4], Counter())[rest[4:]] = c
            self.root[at] = child

    @staticmethod
    def size(node) -> int:
        return sum(map(len, node.values())) if type(node) is dict else len(node)

    def run(self, some: list) -> tuple[pa.Array, np.ndarray]:
        """Take subtrees of one language out, as a run sorted by phrase."""
        rests, counts, firsts = [], [], []
        for at in some:
            node = self.root.pop(at)
            before = len(rests)
            if type(node) is dict:
                for head, leaf in node.items():
                    rests += [head + rest for rest in leaf]
                    counts += leaf.values()
            else:
                rests += node
                counts += node.values()
            firsts.append((at[1], len(rests) - before))
        self.entries -= len(rests)
        first = np.repeat(*np.array(firsts, np.int64).T)
        ids = np.frombuffer(b"".join(rests), np.uint32)
        long = np.fromiter(map(len, rests), np.int64, len(rests)) // 4
        start = np.cumsum(long) - long
        texts, found, order = pa.array(self.texts, pa.large_binary()), [], []
        for n in np.unique(long).tolist():
            same = np.flatnonzero(long == n)
            columns = [first[same], *(ids[start[same] + k] for k in range(n))]
            found.append(pc.binary_join_element_wise(*(texts.take(pa.array(x)) for x in columns), pa.scalar(b" ", pa.large_binary())))
            order.append(same)
        found, count = pa.concat_arrays(found), np.array(counts, np.int64)[np.concatenate(order)]
        place = pc.array_sort_indices(found)
        return found.take(place), count[place.to_numpy()]

    def spill(self, deal, all_of_it: bool = False) -> Iterator[pa.RecordBatch]:
        """Runs of the largest subtrees until half of the room is free; of all at the end, in order."""
        sizes, left, taken = {at: self.size(node) for at, node in self.root.items()}, self.entries, {}
        for at in sorted(sizes, key=sizes.__getitem__, reverse=True):
            if not all_of_it and left <= self.most // 2:
                break
            left -= sizes[at]
            taken.setdefault(at[0], []).append(at)
        for lang, some in taken.items():
            phrases, counts = self.run(some)
            yield from deal(lang, listed(phrases), counts.tolist())


def dealer(prefix: int, parts: int):
    """Function that deals a sorted run among ``parts`` by the hash of ``prefix`` words."""
    def deal(lang: str, phrases: list[bytes], counts: list[int]) -> Iterator[pa.RecordBatch]:
        if not phrases:
            return
        run = pa.array(phrases, pa.large_binary())
        data, offs = buffers(run)
        blanks = np.flatnonzero(data == 32)
        nth = np.searchsorted(blanks, offs[:-1]) + prefix - 1          # the blank that ends the prefix
        stop = np.append(blanks, len(data))[np.minimum(nth, len(blanks))]
        h = mix(hash_bounds(data, offs[:-1], np.minimum(stop, offs[1:]), fold=False) ^ np.uint64(seed_of(lang)))
        part = (h % np.uint64(parts)).astype(np.int64)
        lengths, c = np.diff(offs).astype(np.uint32), np.array(counts, np.int64)
        rows = []
        for where in groups_of(part):
            own, _ = buffers(run.take(pa.array(where)))
            raw = lengths[where].tobytes() + c[where].tobytes() + own.tobytes()
            rows.append((int(part[where[0]]), lang, len(where), len(raw), pa.compress(raw, "zstd", asbytes=True)))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                                         names=["part", "lang", "n", "raw", "run"])
    return deal


def counted(langs: list, phrases: list, counts) -> pa.Table:
    return pa.table([pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                    names=["lang", "phrase", "c"])


def merge_runs(least: int):
    """Merge of a partition's runs: phrases of ``least`` or more, and ``TOTAL``."""
    def merge(table: pa.Table) -> pa.Table:
        runs: dict = {}
        for row in table.select(["lang", "n", "raw", "run"]).to_pylist():
            raw, n = pa.decompress(row["run"], row["raw"], "zstd", asbytes=True), row["n"]
            offs = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint32, n), dtype=np.int64)])
            one = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offs), pa.py_buffer(raw[12 * n:])])
            phrases, counts = runs.setdefault(row["lang"], ([], []))
            phrases.append(one)
            counts.append(np.frombuffer(raw, np.int64, n, 4 * n) if n % 2 == 0 else np.frombuffer(raw[4 * n:12 * n], np.int64))
        out = [counted([], [], [])]
        for lang, (phrases, counts) in runs.items():
            phrases = pa.chunked_array(phrases)
            order = pc.sort_indices(phrases)                                   # sorts each run, then merges them
            merged = pa.concat_arrays(phrases.take(order).chunks)
            differs = pc.not_equal(merged[1:], merged[:-1]).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate([[True], differs]))
            total = np.add.reduceat(np.concatenate(counts)[order.to_numpy()], first)
            keep = total >= least
            keep[0] |= merged[0].as_py() == TOTAL.encode()
            out.append(counted([lang] * int(keep.sum()), listed(merged.take(pa.array(first[keep]))), total[keep]))
        return pa.concat_tables(out)
    return merge


def groups_of(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of each code, in order."""
    order = np.argsort(codes, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(codes[order])) + 1) if len(order) else ()


def count_words(docs: DataFrame, parts: int, most: int) -> DataFrame:
    """Runs of words, and of all words as ``TOTAL``."""
    deal = dealer(1, parts)

    def flush(counts):
        for lang, own in counts.items():
            found = sorted(own.items())
            yield from deal(lang, [p for p, _ in found], [c for _, c in found])

    def task(batches):
        counts: dict = {}
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column("text"), part.column("lang").to_pylist())
                for where in groups_of(w.lang):
                    lang = w.langs[w.lang[where[0]]]
                    _, first, n = np.unique(w.hash[where], return_index=True, return_counts=True)
                    own = counts.setdefault(lang, Counter())
                    own[TOTAL.encode()] += len(where)
                    for word, c in zip(w.texts(where[first]), n.tolist()):
                        own[word] += c
                if sum(map(len, counts.values())) > most:
                    yield from flush(counts)
                    counts = {}
        yield from flush(counts)
    return docs.mapInArrow(task, RUNS)


def count_phrases(docs: DataFrame, lengths: range, word_bits, pair_bits, parts: int, burst: int, most: int) -> DataFrame:
    """Runs of the phrases whose words (and pairs) may be frequent."""
    deal = dealer(lengths[0], parts)

    def task(batches):
        words, pairs = word_bits.value, pair_bits.value if pair_bits else None
        known: dict = {}
        texts: list = []
        trie = HatTrie(texts, burst, most)
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column("text"), part.column("lang").to_pylist())
                if len(w.hash) < lengths[0]:
                    continue
                often = has(words, w.key)
                link = w.joined & often[:-1] & often[1:]
                if pairs is not None:
                    begin = np.flatnonzero(link)
                    link[begin] = has(pairs, w.pairs(begin))
                # ids of the words that take part, new ones with their text
                used = np.zeros(len(w.hash), bool)
                used[:-1] |= link
                used[1:] |= link
                at = np.flatnonzero(used)
                uniq, first, inverse = np.unique(w.hash[at], return_index=True, return_inverse=True)
                uniq = uniq.tolist()
                new = [j for j, h in enumerate(uniq) if h not in known]
                known.update(zip([uniq[j] for j in new], range(len(texts), len(texts) + len(new))))
                texts += w.texts(at[first[new]])
                ids = np.fromiter(map(known.__getitem__, uniq), np.uint32, len(uniq))
                word = np.zeros(len(w.hash), np.uint32)
                word[at] = ids[inverse]
                chain = link
                for n in range(2, lengths[-1] + 1):
                    chain = link if n == 2 else chain[:-1] & link[n - 2:]
                    begin = np.flatnonzero(chain)
                    if n < lengths[0] or not len(begin):
                        continue
                    rests = np.ascontiguousarray(word[begin[:, None] + np.arange(1, n)]).view(f"V{4 * (n - 1)}").ravel()
                    at = w.lang[begin].astype(np.int64) << 32 | word[begin]
                    order = np.argsort(at, kind="stable")
                    rests, at = rests[order].tolist(), at[order]
                    bounds = np.flatnonzero(np.diff(at, prepend=-1))
                    for lo, hi, one in zip(bounds.tolist(), [*bounds[1:].tolist(), len(at)], at[bounds].tolist()):
                        trie.add(w.langs[one >> 32], one & 0xFFFFFFFF, rests[lo:hi])
                if trie.entries > most:
                    yield from trie.spill(deal)
        yield from trie.spill(deal, True)
    return docs.mapInArrow(task, RUNS)


def has(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    i = key & np.uint64(len(bits) * 8 - 1)
    return bits[(i >> np.uint64(3)).astype(np.int64)] >> (i & np.uint64(7)).astype(np.uint8) & 1 == 1


def bit_map(frequent: DataFrame, words: int, widest: int = 28):
    """Broadcast bit map of the keys of ``frequent`` (lang, phrase) of one or two words:
    about 32 bits an entry, 2^``widest`` at most (32 MB), gathered as bytes by number."""
    spark = frequent.sparkSession
    wide = min(max(int(np.ceil(np.log2(max(frequent.count(), 1) * 32))), 13), widest)

    def task(batches):
        for batch in batches:
            w = Words(batch.column("phrase"), batch.column("lang").to_pylist())
            key = w.key if words == 1 else w.pairs(np.arange(0, len(w.key), 2))
            i = key & np.uint64(2 ** wide - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array((i >> np.uint64(16)).astype(np.int64)), pa.array((i & np.uint64(65535)).astype(np.int32))], names=["page", "at"])

    def pages(table: pa.Table) -> pa.Table:
        page = np.zeros(65536, np.uint8)
        page[table.column("at").to_numpy()] = 1
        return pa.table({"page": [table.column("page")[0].as_py()], "bits": pa.array([np.packbits(page, bitorder="little").tobytes()], pa.binary())})

    found = frequent.select("lang", "phrase").mapInArrow(task, "page long, at int").groupBy("page").applyInArrow(pages, "page long, bits binary")
    out = np.zeros(2 ** wide // 8, np.uint8)
    for row in found.toLocalIterator():
        some = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = row["page"] * 8192
        out[at:at + 8192] = some[:len(out) - at]
    return spark.sparkContext.broadcast(out)


def merged(runs: DataFrame, least: int) -> DataFrame:
    """The runs merged by partition: (lang, phrase, c)."""
    return kept_in_table(runs.groupBy("part").applyInArrow(merge_runs(least), COUNTED), "phrases")


def frequent_phrases(docs: DataFrame, longest: int = 5, least: int = 100, burst: int = 4096, most: int = 400_000) -> DataFrame:
    """documents(text, lang) -> (lang, phrase, c): every phrase of 1 to ``longest`` words
    found ``least`` times or more, and the number of all words of a language as ``''``."""
    docs = docs.select("text", "lang")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // MERGE_BYTES) + 1
    words = merged(count_words(docs, parts, most), least)
    word_bits = bit_map(words.where(F.col("phrase") != TOTAL), 1)
    pairs = merged(count_phrases(docs, range(2, 3), word_bits, None, parts, burst, most), least)
    out = words.unionByName(pairs)
    if longest > 2:
        longer = count_phrases(docs, range(3, longest + 1), word_bits, bit_map(pairs, 2), parts, burst, most)
        out = out.unionByName(merged(longer, least))
    return out


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, burst: int = 4096, most: int = 400_000) -> DataFrame:
    """documents(text, lang) -> (lang, rank, phrase, a, l, r, n, score)."""
    found = frequent_phrases(docs, longest, least, burst, most)
    totals = found.where(F.col("phrase") == TOTAL).select("lang", F.col("c").alias("n"))
    counts = found.where(F.col("phrase") != TOTAL)
    size = F.size(F.split("phrase", " "))
    long_ones = counts.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1)
    # by one word longer neighbours
    tail = F.expr("array_join(slice(words, 2, size(words) - 1), ' ')")
    head = F.expr("array_join(slice(words, 1, size(words) - 1), ' ')")
    above = long_ones.where(F.size("words") > 2).select("lang", F.explode(F.array(head, tail)).alias("phrase"), "c")
    above = above.groupBy("lang", "phrase").agg(F.max("c").alias("_above"))
    kept = long_ones.join(above, ["lang", "phrase"], "left").where(F.col("_above").isNull() | (F.col("_above") < F.col("c")))
    cuts = kept.join(totals, "lang").select(
        "lang", "phrase", F.col("c").alias("a"), "n", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"), "words")
    cuts = cuts.select("lang", "phrase", "a", "n", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("first"),
                       F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("rest"))
    part = lambda name, c: counts.select("lang", F.col("phrase").alias(name), F.col("c").alias(c))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) "
                   "div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("_"))
    # first among a part of a language's phrases, then among the firsts
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64)).cast("int")
    scored = scored.select("lang", "phrase", "a", "_.l", "_.r", "n", "_.score", part.alias("part"))
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    return (scored.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


SQL = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (
  SELECT lang, n AS size, array_to_string(ws[i : i + n - 1], ' ') AS phrase, count(*) AS c
  FROM g, (SELECT unnest([1, 2, 3, 4, 5]) AS n) WHERE i + n - 1 <= len(ws)
  GROUP BY 1, 2, 3 HAVING count(*) >= 100),
t AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY 1),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
above AS (
  SELECT lang, phrase, max(c) AS c FROM (
    SELECT lang, array_to_string(ws[1 : size - 1], ' ') AS phrase, c FROM c WHERE size > 2 UNION ALL
    SELECT lang, array_to_string(ws[2 : size], ' '), c FROM c WHERE size > 2) GROUP BY 1, 2),
k AS (
  SELECT c.lang, c.phrase, c.c AS a, unnest(range(1, c.size)) AS k, c.ws, c.size
  FROM c LEFT JOIN above b ON b.lang = c.lang AND b.phrase = c.phrase WHERE b.c IS NULL OR b.c < c.c),
s AS (
  SELECT k.lang, k.phrase, a, k, x.c AS l, y.c AS r, t.n::BIGINT AS n,
         (1000::HUGEINT * a * t.n // (x.c::HUGEINT * y.c))::BIGINT AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.ws[1 : k.k], ' ')
         JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.ws[k.k + 1 : k.size], ' ') JOIN t ON t.lang = k.lang),
one AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM one QUALIFY rank <= 2000
"""
