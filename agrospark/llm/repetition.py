"""Quality rules (6): repeated substrings by a suffix array of words.

Each text is a string of word hashes.  Prefix doubling sorts the suffixes of many
texts at once (only suffixes that still tie take part in the next round), which
gives the suffix array and, from the ranks of each round, the longest common
prefix of neighbours.  The longest repeat that starts at a place is the larger of
its two neighbouring values; these starts and lengths are the occurrences of the
LCP intervals, and the union of the spans of all maximal repeats of at least
``least`` words is the union of these spans.  The method's verdict limits the
covered fraction of the text and its longest repeat.

Texts are taken in batches of bounded size; a text that is longer than a batch is
a batch of its own and is sorted whole.

Defined results: null or empty text has no words (base_failed, not kept); words
compare byte for byte; a null id is returned as it is; repeated rows give repeated rows; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, hash_bounds, slices, word_bounds

SYMBOLS = "#*$%&|<>"
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, longest_repeat long, base_failed boolean, kept boolean")


def exact_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word with its case, starts, ends, first word of each text)."""
    starts, ends, first = word_bounds(data, offs)
    return hash_bounds(data, starts, ends, fold=False), starts, ends, first


def longest_repeats(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every word the length of the longest substring that starts there and
    occurs at another place of the same text (occurrences may overlap).

    ``first``: first word of each text and the end."""
    n = len(words)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][text]
    # rank of suffixes by their first word, within their text
    order = np.lexsort((words, text))
    new = np.concatenate([[True], (words[order][1:] != words[order][:-1]) | (text[order][1:] != text[order][:-1])])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]     # place of the first suffix of the class
    ranks, k = [rank.copy()], 1
    suffixes = np.empty(n, np.int64)
    suffixes[:] = order
    size = np.diff(np.append(np.flatnonzero(new), n))
    live = order[np.repeat(size > 1, size)]
    while len(live):
        after = live + k
        nxt = np.where(after < end[live], rank[np.minimum(after, n - 1)] + 1, 0)
        o = np.lexsort((nxt, rank[live]))
        live, nxt = live[o], nxt[o]
        head = rank[live]
        fresh = np.concatenate([[True], (head[1:] != head[:-1]) | (nxt[1:] != nxt[:-1])])
        starts = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        # a class keeps its places; its parts follow one another from its first place
        base = np.concatenate([[True], head[1:] != head[:-1]])
        within = np.arange(len(live)) - np.flatnonzero(base)[np.cumsum(base) - 1]
        suffixes[head + within] = live
        rank = rank.copy()
        rank[live] = (head + within)[starts][group]
        ranks.append(rank)
        size = np.diff(np.append(starts, len(live)))
        live = live[np.repeat(size > 1, size)]
        k *= 2
    # longest common prefix of neighbours in the array, from the widest rank down
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    at = np.flatnonzero(ranks[0][a] == ranks[0][b])
    a, b = a[at], b[at]
    ea, eb = end[a], end[b]
    for j in range(len(ranks) - 1, -1, -1):
        inside = (a < ea) & (b < eb)
        same = inside & (ranks[j][np.minimum(a, n - 1)] == ranks[j][np.minimum(b, n - 1)])
        lcp[at[same]] += 1 << j
        a, b = a + (same << j), b + (same << j)
    out[suffixes[:-1]] = lcp
    np.maximum.at(out, suffixes[1:], lcp)
    return out


def covered(length: np.ndarray, first: np.ndarray, least: int, width: int | None = None) -> np.ndarray:
    """Words of each text in the union of the spans of at least ``least`` words
    (each cut to ``width``, if given)."""
    n = len(length)
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(length >= least)
    np.add.at(step, at, 1)
    np.add.at(step, at + (length[at] if width is None else width), -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    return inside[first[1:]] - inside[first[:-1]]


_LINE = re.compile("[^\\x20\\x09-\\x0D]")


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    if "\n" not in text:
        return 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif _LINE.search(line):
            seen.add(line)
    return n


def quality(docs: DataFrame, least: int = 5, most_covered: int = 30, most_longest: int = 60,
            window: int = 8) -> DataFrame:
    """The rules' counts and verdicts per document.

    ``most_covered`` is the highest percentage of words in repeats of at least
    ``least`` words, ``most_longest`` the most words of one repeat."""
    symbol = np.zeros(256, np.int64)
    symbol[[ord(c) for c in SYMBOLS]] = 1
    point = np.ones(256, np.int64)
    point[0x80:0xC0] = 0                       # continuation bytes

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 3 << 20):
                data, offs = buffers(part.column("text"))
                words, starts, ends, first = exact_words(data, offs)
                n = np.diff(first)
                points = np.concatenate([[0], np.cumsum(point[data])])
                marks = np.concatenate([[0], np.cumsum(symbol[data])])
                chars = np.concatenate([[0], np.cumsum(points[ends] - points[starts])])
                length = longest_repeats(words, first)
                repeat = covered(length, first, window, window)
                cover = repeat if least == window else covered(length, first, least)
                longest = np.zeros(len(n), np.int64)
                some = np.flatnonzero(n)
                if len(some):
                    longest[some] = np.maximum.reduceat(length, first[:-1][some])
                lines = [duplicate_lines(t.as_py() or "") for t in part.column("text")]
                failed = (n < 20) | (100 * repeat > 30 * n)
                kept = ~failed & (100 * cover <= most_covered * n) & (longest <= most_longest)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(np.diff(chars[first])), pa.array(np.diff(marks[offs])),
                     pa.array(lines, pa.int64()), pa.array(repeat), pa.array(cover), pa.array(longest),
                     pa.array(failed), pa.array(kept)], [x.split()[0] for x in SCHEMA.split(", ")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
