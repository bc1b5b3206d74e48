"""PII (1): base patterns plus a character BiLSTM-CRF over overlapping windows.

The base patterns give the spans of the contract, exactly.  The tagger is trained
from labelled spans of a bounded sample (base spans and rewritten forms of them:
other separators, a missing plus sign, ``at`` for @, an address cut by spaces)
and adds what the patterns miss.  It reads windows of 64 characters at a stride of 32 over the whole text.
Decoded are the windows around a digit, an @, `` at `` or ``(at)`` (in any case):
every form that the tagger learns holds one of these, and a span without one is
not plausible.  The decoded spans of all
windows of a document are reconciled together: pieces of one span that windows
cut are joined, then the non-overlapping set of largest total posterior is kept
(weighted interval scheduling), then spans that meet a base span go.

Sample bound: ``sample_windows`` windows, chosen by a hash.  Each is one window
of text, so the driver sees a fixed number of characters.

Defined results: null or empty text has no span (the digest is that of the empty
string); without any labelled span there is no tagger and the base spans are
all; a null id is returned as it is; repeated rows give repeated rows; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .tagger import KINDS, LENGTH, PAD, Tagger, classes

STRIDE = LENGTH // 2
# an address is the run of user characters before an @ and the host behind it
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the other spellings: a user, a mark that stands for the @, a host with a dot
SPELT = re.compile(r"[A-Za-z0-9._%+-]+(?:\x20@\x20?|@\x20|\x20[Aa][Tt]\x20|\x20?\([Aa][Tt]\)\x20?)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
USER_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits matches from its first digit or not at all, hence the look-behind
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
TRIGGER_FORMS = r"[0-9@]|\x20[Aa][Tt]\x20|\([Aa][Tt]\)"     # one of them is in every form of _variants
TRIGGER = re.compile(TRIGGER_FORMS)
NOT_DIGITS = re.compile("[^0-9]+")
DIGITS = re.compile("[0-9]+")
AT = re.compile(r"(?<=[a-z])\x20(?=[a-z])")
WORDS = re.compile("(?<![^ ])[a-z]{3,}(?![^ ])")
ENDINGS = ("com", "org", "net", "de", "es", "co.uk", "info")
EDGES = re.compile("^[._%+-]+|[._%+-]+$")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the order of kinds, then of starts."""
    out = []
    if not text:
        return out
    at, done = text.find("@"), 0
    while at >= 0:
        # the host first: without one no start before this @ can match
        host = HOST.match(text, at + 1)
        if host:
            lo = at
            while lo > done and text[lo - 1] in USER_CHARS:
                lo -= 1
            if lo < at:
                out.append((0, lo, host.end()))
                done = host.end()
        at = text.find("@", max(at + 1, done))
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        d = NOT_DIGITS.sub("", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def window_starts(text: str) -> list[int]:
    """Starts of the windows on the grid that meet a trigger."""
    out: dict[int, None] = {}
    last = max(0, (len(text) - 1) // STRIDE)
    for m in TRIGGER.finditer(text):
        lo, hi = m.start() // STRIDE, (m.end() - 1) // STRIDE
        for g in range(max(0, lo - 1), min(hi, last) + 1):
            out[g * STRIDE] = None
    return sorted(out)


def _window(c: np.ndarray, start: int) -> np.ndarray:
    out = np.full(LENGTH, PAD, np.int64)
    part = c[start:start + LENGTH]
    out[:len(part)] = part
    return out


def reconcile(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """One non-overlapping set for the document of (kind, start, end, posterior)."""
    merged: list[list] = []
    for k, s, e, q in sorted(found):
        if merged and merged[-1][0] == k and s < merged[-1][2]:      # two windows, one span
            merged[-1][2], merged[-1][3] = max(e, merged[-1][2]), max(q, merged[-1][3])
        else:
            merged.append([k, s, e, q])
    items = sorted(((e, s, k, q) for k, s, e, q in merged))
    ends = [x[0] for x in items]
    best: list[tuple[float, int]] = [(0.0, -1)]
    for i, (e, s, k, q) in enumerate(items):
        j = int(np.searchsorted(ends[:i], s, "right"))
        take = best[j][0] + q * (e - s)
        best.append((take, j) if take > best[i][0] else (best[i][0], -1))
    out, i = [], len(items)
    while i:
        if best[i][1] >= 0:
            e, s, k, q = items[i - 1]
            out.append((k, s, e, q))
            i = best[i][1]
        else:
            i -= 1
    return out[::-1]


def plausible(kind: int, piece: str) -> bool:
    """What a span of the kind must hold, in any spelling."""
    d = len(NOT_DIGITS.sub("", piece))
    if kind == 0:
        return bool("@" in piece or SPELT.fullmatch(piece)) and len(piece) >= 6
    if kind == 1:
        parts = NOT_DIGITS.split(piece.strip())
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 16 <= d <= 19 and luhn(NOT_DIGITS.sub("", piece))
    return 10 <= d <= 15


def bounded(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """The span; one of an address in another spelling up to the ends of the address."""
    if kind == 0:
        for m in SPELT.finditer(text, max(0, start - LENGTH), min(len(text), end + LENGTH)):
            if m.start() < end and start < m.end():
                return m.start(), m.end()
    return start, end


def sure(kind: int, prob: np.ndarray) -> float:
    """Posterior of a span: of its least sure character; of an address, whose ends are
    those of the address (see bounded), the mean."""
    return float(prob.mean() if kind == 0 else prob.min())


def added_spans(tagger: Tagger, texts: list[str], bases, least: float = 0.9, least_spelt: float = 0.7):
    """For each text the tagger's spans that no base span meets, of a posterior of at
    least ``least``, or ``least_spelt`` where the span has the form of an address."""
    rows, where = [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        starts = window_starts(text)
        if starts:
            # only the stretches that windows read
            for s in starts:
                rows.append(_window(classes(text[s:s + LENGTH]), 0))
                where.append((i, s))
    found: dict[int, list] = {}
    for lo in range(0, len(rows), 2048):
        tags, prob = tagger.decode(np.array(rows[lo:lo + 2048]))
        for r in np.flatnonzero(tags.any(1)):
            i, s = where[lo + r]
            t, n = tags[r], min(LENGTH, len(texts[i]) - s)
            a = 0
            while a < n:
                if t[a] == 0:
                    a += 1
                    continue
                k, b = (t[a] - 1) // 2, a + 1
                while b < n and t[b] == 2 * k + 2:
                    b += 1
                found.setdefault(i, []).append((int(k), s + a, s + b, sure(k, prob[r, a:b])))
                a = b
    out = [[] for _ in texts]
    for i, spans in found.items():
        for k, s, e, q in reconcile([(k, *bounded(k, texts[i], s, e), q) for k, s, e, q in spans]):
            spelt = k == 0 and SPELT.fullmatch(texts[i][s:e])
            if q >= (least_spelt if spelt else least) and plausible(k, texts[i][s:e]) and not any(s < e2 and s2 < e for _, s2, e2 in bases[i]):
                out[i].append((k, s, e))
    return out


def _variants(kind: int, piece: str, draw: int, words: list[str] = ()) -> str:
    """Another spelling of a labelled span; the span itself for draw 0."""
    if draw == 0:
        return piece
    if kind == 0:
        user, host = piece.split("@", 1)
        if draw > 3:                     # an address without digits
            user, host = EDGES.sub("", DIGITS.sub("", user)) or user, DIGITS.sub("", host)
        if draw > 6 and words:           # of other words and another ending
            user = words[draw % len(words)] + ("", f".{user}")[draw % 2]
            host = f"{words[-1 - draw % len(words)]}.{ENDINGS[(draw + len(user)) % len(ENDINGS)]}"
        return (f"{user} at {host}", f"{user}(at){host}", f"{user} @ {host}")[draw % 3]
    if kind == 1:
        return piece.replace(".", (" . ", "-", " ")[draw % 3]) if draw % 3 == 0 else piece
    d = NOT_DIGITS.sub("", piece)
    if kind == 2:
        return ((" ", "-", ".")[draw % 3]).join(d[i:i + 4] for i in range(0, len(d), 4))
    return (piece.lstrip("+"), f"+{d[:-10]}-{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}", f"({d[-10:-7]}) {d[-7:-4]} {d[-4:]}")[draw % 3]


def training_windows(docs: DataFrame, most: int) -> list[tuple[str, list[list[int]]]]:
    """(text of a window, its labelled spans): a bounded sample of the table."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for x in part.column("text"):
                    text = x.as_py()
                    if text is None or not TRIGGER.search(text):
                        continue
                    spans = base_spans(text)
                    for s in window_starts(text):
                        inside = [[k, a - s, b - s] for k, a, b in spans if s <= a and b <= s + LENGTH]
                        piece = text[s:s + LENGTH]
                        if sum(a < s + LENGTH and s < b for _, a, b in spans) == len(inside):
                            key = int.from_bytes(hashlib.blake2b(piece.encode("utf-8", "replace"), digest_size=7).digest(), "big")
                            out.append((not inside, key, piece, inside))
                out = sorted(out)[:most]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in out], pa.bool_()), pa.array([x[1] for x in out], pa.int64()),
                    pa.array([x[2] for x in out], pa.string()), pa.array([x[3] for x in out], pa.list_(pa.list_(pa.int32())))],
                    ["bare", "key", "piece", "spans"])
    rows = docs.select("text").mapInArrow(run, "bare boolean, key long, piece string, spans array<array<int>>")
    some = rows.where("not bare").orderBy("key", "piece").limit(most)
    none = rows.where("bare").orderBy("key", "piece").limit(most // 3)
    return [(r["piece"], r["spans"]) for r in some.union(none).collect()]


def train(windows) -> Tagger | None:
    """The tagger from labelled windows; each window also in other spellings, one with
    an address also in spellings without digits, one without a span also with a bare
    ``at`` between two words."""
    xs, ys = [], []
    bare = [(AT.sub(" at ", piece, count=1), []) for piece, spans in windows if not spans]
    for n, (piece, spans) in enumerate([*windows, *bare]):
        address = any(k == 0 for k, _, _ in spans)
        words = WORDS.findall(piece)
        draws = (0, 1 + n % 3, 4 + n % 3, *range(7 + n % 2, 13, 2)) if address else (0, 1, 2, 3) if spans else (0,)
        for draw in draws:
            text, labels, at = "", [], 0
            for k, s, e in sorted(spans, key=lambda x: x[1]):
                if s < at:
                    continue
                text += piece[at:s]
                labels += [0] * (len(text) - len(labels))
                new = _variants(k, piece[s:e], draw, words)
                text += new
                labels += [2 * k + 1] + [2 * k + 2] * (len(new) - 1)
                at = e
            text += piece[at:]
            labels += [0] * (len(text) - len(labels))
            # a window whose end would cut a span is moved to the left by cutting its start
            cut = max(0, len(text) - LENGTH) if len(labels) > LENGTH and any(labels[LENGTH - 1:]) else 0
            while cut and cut < len(labels) and labels[cut] and labels[cut] % 2 == 0:
                cut += 1
            xs.append(_window(classes(text), cut))
            y = np.zeros(LENGTH, np.int64)
            part = labels[cut:cut + LENGTH]
            y[:len(part)] = part
            ys.append(y)
    if not any(y.any() for y in ys):
        return None
    return Tagger().fit(np.array(xs), np.array(ys), steps=450)


def find_spans(docs: DataFrame, sample_windows: int = 360, sample_of: int = 1500) -> DataFrame:
    """All columns of documents with ``base`` and ``spans``: arrays of
    (kind, start, end), kinds as in KINDS, by kind and start.

    The sample comes from about ``sample_of`` documents with a digit or an @: only
    they can hold a labelled span."""
    docs = docs.drop("base", "spans")
    with_trigger = docs.where(F.col("text").rlike("[0-9@]"))
    n = with_trigger.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("personal data")), F.lit(1_000_000)) / 1_000_000
    sample = with_trigger.where(draw < F.lit(min(1.0, sample_of / max(n, 1))))
    tagger = train(training_windows(sample, sample_windows)) if n else None
    held = docs.sparkSession.sparkContext.broadcast(tagger)          # of fixed size
    kind = "array<struct<kind:int,start:int,end:int>>"
    arrow = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        tagger = held.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [x.as_py() for x in part.column("text")]
                base = [base_spans(t) for t in texts]
                more = added_spans(tagger, texts, base) if tagger else [[]] * len(texts)
                dicts = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in sorted(spans)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([dicts(b) for b in base], arrow),
                     pa.array([dicts(b + m) for b, m in zip(base, more)], arrow)], [*part.schema.names, "base", "spans"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, base {kind}, spans {kind}")


def as_text(spans: F.Column) -> F.Column:
    """kind:start:end, comma-joined, of an array column of spans."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: F.Column, spans: F.Column) -> F.Column:
    """The text with each span replaced by its kind in brackets; null stays null.
    Spans that overlap an earlier one (by start) are covered by it."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["end"], x["kind"])))
    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, x):
        fresh = x["start"] >= acc["at"]
        return F.struct(
            F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]),
                                   F.element_at(names, x["kind"] + 1))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], x["end"]).alias("at"))

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(ordered, first, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))
