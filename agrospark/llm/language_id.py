"""Language ID (8): segmentation-marginalised unigram models over a public vocabulary.

Each language has a probability for every piece of one fixed vocabulary (the
public SentencePiece file; its path is a parameter, nothing is trained there).
The likelihood of a word is the sum over *all* segmentations into pieces, by the
forward algorithm; a text is the product over its words, since no piece spans a
space.  Words of one length run through the lattice together.  Piece
probabilities come from expectation maximisation (forward-backward expected
counts) on a bounded sample of labelled rows.

Sample bound: about ``sample_docs`` documents a language, chosen by a hash of
the id (the same in every run), of which the counts of the ``sample_words`` most
frequent words are collected.  Prediction reads every word of every text.

Defined results: text null, empty or without a letter gives ``und`` with score
0; ties go to the first language in code point order; lang null or id null
never trains; without any labelled row everything is ``und``; repeated rows give
repeated rows; columns of the names lang_pred and score are replaced.  The score
is the posterior of the predicted language under equal priors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import _BASE, _INVERSE, kept_in_table, mix, slices

LONGEST = 16              # longest piece, in characters, that the vocabulary keeps
LATTICE = 40              # longer words go through the lattice in parts, scaled between them
FLOOR = 1e-5              # a character outside the vocabulary
MEMORY = 400_000          # words whose likelihoods a worker keeps between texts
SCALE = 100.0             # a factor a character, against underflow


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(path: str) -> list[str]:
    """Pieces of the vocabulary that are plain text, in the order of their ids."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [p for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
            and len(p := sp.id_to_piece(i)) <= LONGEST]


def _code_points(words) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words in a row, length of each)."""
    return (np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32),
            np.fromiter(map(len, words), np.int64, len(words)))


class Lattice:
    """Finds the pieces inside many words of one length by hashes of substrings."""

    def __init__(self, vocabulary: list[str]):
        n = LATTICE + LONGEST + 2
        self.up = np.array([pow(_BASE, i, 2 ** 64) for i in range(n)], np.uint64)
        self.down = np.array([pow(_INVERSE, i, 2 ** 64) for i in range(n)], np.uint64)
        cps, size = _code_points(vocabulary)
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        at = np.arange(len(cps)) - np.repeat(starts, size)
        key = mix(np.add.reduceat(mix(cps.astype(np.uint64) + np.uint64(1)) * self.up[at], starts))
        order = np.argsort(key)
        self.keys, self.ids = key[order], order
        # last place of the sorted keys that have these 22 leading bits, or -1
        self.slot = np.full(1 << 22, -1, np.int32)
        self.slot[self.keys >> np.uint64(42)] = np.arange(len(order))
        self.deep = int(np.unique(key >> np.uint64(42), return_counts=True)[1].max()) if len(key) else 0

    def edges(self, points: np.ndarray):
        """For a words x length matrix of code points: by end, the list of
        (start, rows, pieces), and the rows without a piece for the last character."""
        rows, n = points.shape
        h = np.zeros((n + 1, rows), np.uint64)
        np.cumsum(mix(points.T.astype(np.uint64) + np.uint64(1)) * self.up[:n, None], axis=0, out=h[1:], dtype=np.uint64)
        for e in range(1, n + 1):
            found, bare = [], None
            for s in range(max(0, e - LONGEST), e):
                key = mix((h[e] - h[s]) * self.down[s])
                place = self.slot[key >> np.uint64(42)]
                row = np.flatnonzero(place >= 0)
                place, key = place[row], key[row]
                for _ in range(self.deep - 1):      # others of the same leading bits
                    place = np.where((self.keys[place] != key) & (place > 0), place - 1, place)
                ok = self.keys[place] == key
                row = row[ok]
                if len(row):
                    found.append((s, row, self.ids[place[ok]]))
                if s == e - 1:
                    bare = np.ones(rows, bool)
                    bare[row] = False
                    bare = np.flatnonzero(bare)
            yield e, found, bare

    def batches(self, words, most: int = 20_000):
        """(indexes, code points) of words of one length, at most LATTICE characters."""
        cps, size = _code_points(words)
        starts = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        order = np.argsort(size, kind="stable")
        cut = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, cut):
            for lo in range(0, len(group), most):
                idx = group[lo:lo + most]
                yield idx, cps[starts[idx][:, None] + np.arange(size[idx[0]])]


class Model:
    """Log likelihoods of words for all languages; ``probs`` is pieces x languages."""

    def __init__(self, vocabulary: list[str], probs: np.ndarray):
        self.vocabulary, self.lattice, self.probs = vocabulary, Lattice(vocabulary), probs
        size = np.fromiter(map(len, vocabulary), float, len(vocabulary))
        self.scaled = probs * SCALE ** size[:, None]
        self.memory, self.rows = {}, np.zeros((0, probs.shape[1]))

    def _parts(self, points: np.ndarray, alpha: np.ndarray) -> np.ndarray:
        """Forward sums (scaled) over one stretch; alpha[0] is the start."""
        a = [alpha]
        for e, found, bare in self.lattice.edges(points):
            x = np.zeros_like(alpha)
            for s, row, ids in found:
                x[row] += a[s][row] * self.scaled[ids]
            if len(bare):
                x[bare] += a[e - 1][bare] * (FLOOR * SCALE)
            a.append(x)
        return a

    def log_likelihood(self, words) -> np.ndarray:
        """words x languages."""
        out = np.zeros((len(words), self.probs.shape[1]))
        short = [i for i, w in enumerate(words) if len(w) <= LATTICE]
        if short:
            some = words if len(short) == len(words) else [words[i] for i in short]
            back = np.array(short)
            for idx, points in self.lattice.batches(some):
                a = self._parts(points, np.ones((len(idx), out.shape[1])))[-1]
                out[back[idx]] = np.log(a) - points.shape[1] * np.log(SCALE)
        if len(short) < len(words):
            for i, w in enumerate(words):
                if len(w) > LATTICE:
                    out[i] = self._long(w)
        return out

    def remembered(self, words) -> np.ndarray:
        """log_likelihood that keeps up to MEMORY words (only saves work)."""
        if len(self.memory) > MEMORY:
            self.memory, self.rows = {}, np.zeros((0, self.probs.shape[1]))
        at = np.fromiter((self.memory.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [words[i] for i in new]
            at[new] = len(self.rows) + np.arange(len(new))
            self.rows = np.concatenate([self.rows, self.log_likelihood(fresh)])
            self.memory.update(zip(fresh, at[new].tolist()))
        return self.rows[at]

    def _long(self, word: str) -> np.ndarray:
        """One long word: the last LONGEST sums move along, scaled at every step."""
        index, p, n = self._index(), self.probs, self.probs.shape[1]
        last, logs = [np.ones(n)], np.zeros(n)
        for e in range(1, len(word) + 1):
            x, single = np.zeros(n), False
            for back in range(min(LONGEST, e), 0, -1):
                i = index.get(word[e - back:e])
                if i is not None:
                    x = x + last[-back] * p[i]
                    single |= back == 1
            if not single:
                x = x + last[-1] * FLOOR
            logs += np.log(x)
            last = [y / x for y in last[-LONGEST + 1:]] + [np.ones(n)]
        return logs

    def _index(self) -> dict[str, int]:
        if "_by_text" not in self.__dict__:
            self._by_text = {p: i for i, p in enumerate(self.vocabulary)}
        return self._by_text


def fit(counts: dict[str, dict[str, int]], vocabulary: list[str], rounds: int = 2,
        smooth: float = 0.05) -> tuple[list[str], np.ndarray]:
    """Piece probabilities of each language by expected counts over segmentations."""
    langs = sorted(counts)
    out = np.empty((len(vocabulary), len(langs)))
    for j, lang in enumerate(langs):
        words, times = list(counts[lang]), np.array(list(counts[lang].values()), float)
        probs = np.full((len(vocabulary), 1), 1.0 / len(vocabulary))
        for _ in range(rounds):
            model = Model(vocabulary, probs)
            seen = np.full(len(vocabulary), smooth)
            for idx, points in model.lattice.batches(words):
                steps = list(model.lattice.edges(points))
                a = model._parts(points, np.ones((len(idx), 1)))
                b = [np.zeros(len(idx)) for _ in range(len(a))]
                b[-1] += 1.0
                z = a[-1][:, 0]
                for e, found, bare in reversed(steps):
                    for s, row, ids in found:
                        q = model.scaled[ids, 0] * b[e][row]
                        np.add.at(seen, ids, times[idx[row]] * a[s][row, 0] * q / z[row])
                        b[s][row] += q
                    b[e - 1][bare] += FLOOR * SCALE * b[e][bare]
            probs = (seen / seen.sum())[:, None]
        out[:, j] = probs[:, 0]
    return langs, out


def word_pieces(text: str) -> list[str]:
    """Words as the vocabulary spells them: lower case, a leading place mark."""
    return ("▁" + " ▁".join(w)).split(" ") if (w := text.lower().split()) else []


def sample_counts(docs: DataFrame, trainable: F.Column, sample_docs: int,
                  sample_words: int) -> dict[str, dict[str, int]]:
    """Word counts by language of the bounded training sample."""
    rows = docs.where(trainable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    totals = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return {}
    share = F.lit(0.0)
    for lang, n in totals.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language sample")), F.lit(1_000_000)) / 1_000_000

    def count(batches):
        from collections import Counter
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found.setdefault(lang, Counter()).update(word_pieces(text or ""))
            flat = [(k, w, c) for k, v in found.items() for w, c in v.items() if len(w) <= LATTICE]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.string()),
                                              pa.array([x[1] for x in flat], pa.string()),
                                              pa.array([x[2] for x in flat], pa.int64())], ["lang", "word", "c"])

    words = (rows.where(draw < share).select("lang", "text").mapInArrow(count, "lang string, word string, c long")
             .groupBy("lang", "word").agg(F.sum("c").alias("c")))
    top = Window.partitionBy("lang").orderBy(F.desc("c"), "word")      # over the bounded sample
    out: dict[str, dict[str, int]] = {}
    for r in words.withColumn("k", F.row_number().over(top)).where(F.col("k") <= sample_words).orderBy("lang", "k").collect():
        out.setdefault(r["lang"], {})[r["word"]] = r["c"]
    return out


def identify(docs: DataFrame, trainable: F.Column, path: str | None = None,
             sample_docs: int = 250, sample_words: int = 8000, margin: bool = False) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, lang needed) with lang_pred and score.

    ``margin`` adds a column of that name: by how much, per word, the best language's
    log-likelihood is above that of a background in which every piece of the vocabulary
    is equally likely (0 for und).  The posterior compares the learned languages only; a
    text in none of them has a low margin, however long it is."""
    docs = docs.drop("lang_pred", "score", *(["margin"] if margin else []))
    counts = sample_counts(docs, trainable, sample_docs, sample_words)
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    vocabulary, langs, probs = [], [], np.zeros((0, 0))
    if counts:
        vocabulary = pieces(path or public_path("piece_bpe_32k.model"))
        langs, probs = fit(counts, vocabulary)
    # of the size of the vocabulary, whatever the size of the tables
    held = docs.sparkSession.sparkContext.broadcast((vocabulary, langs, probs))

    def run(batches):
        vocabulary, langs, probs = held.value
        flat = np.full((len(vocabulary), int(margin)), 1.0 / max(1, len(vocabulary)))
        model = _model(vocabulary, langs, np.hstack([probs, flat])) if langs else None
        for batch in batches:
            for part in slices(batch, "text", 3 << 20):
                pred, score, above = predict(model, langs, part.column("text").to_pylist())
                extra = [pa.array(above, pa.float64())] if margin else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), *extra],
                    [*part.schema.names, "lang_pred", "score", "margin"][:len(part.columns) + 2 + len(extra)])

    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double" + ", margin double" * margin)


_MODELS: dict = {}


def _model(vocabulary, langs, probs) -> Model:
    """One model a worker process, so that its memory of words serves all tasks."""
    key = (tuple(langs), probs.tobytes())
    if _MODELS.get("key") != key:
        _MODELS.update(key=key, model=Model(vocabulary, probs))
    return _MODELS["model"]


def predict(model: Model | None, langs: list[str], texts: list) -> tuple[list[str], list[float], list[float]]:
    """Language and posterior of each text (see the module), and the margin over the
    background if the model has it as a further column (else 0)."""
    if model is None:
        return ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    words, first = [], [0]
    for t in texts:
        if t is not None and any(map(str.isalpha, t)):
            words += word_pieces(t)
        first.append(len(words))
    total = np.zeros((len(texts), model.probs.shape[1]))
    if words:
        code, own = pd.factorize(np.array(words, dtype=object))
        logs = model.remembered(own)
        for j in range(total.shape[1]):
            run = np.concatenate([[0.0], np.cumsum(logs[:, j][code] - logs[:, 0][code])])
            total[:, j] = run[first[1:]] - run[first[:-1]]
    total, back = total[:, :len(langs)], total[:, len(langs):]
    best = total.argmax(1)
    n = np.diff(first)
    above = (total.max(1) - back[:, 0]) / np.maximum(n, 1) if back.shape[1] else np.zeros(len(texts))
    score = 1.0 / np.exp(np.clip(total - total.max(1, keepdims=True), -700, 0)).sum(1)
    und = n == 0
    return (np.where(und, "und", np.array(langs, dtype=object)[best]).tolist(), np.where(und, 0.0, score).tolist(),
            np.where(und, 0.0, above).tolist())


def fold(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 4; 2 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
