"""Each operation against brute force on small tables: nulls, empty and long
texts, ties, repeated rows, clashing extra columns and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from agrospark.llm import (backoff, jaccard_join, language_id, mixing, nearest, packing, personal_data, repetition,
                           sharding, warc)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string, base string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def texts(seed=1, n=40):
    r = random.Random(seed)
    out = [None, "", " \n\t", "One.", "a b c", "A B C", "x " * 3000, "1234 5678", "été 你好"]
    for _ in range(n):
        w = [r.choice(WORDS) for _ in range(r.randint(8, 120))]
        out.append(" ".join(w))
        if r.random() < 0.5:
            k = r.randrange(len(w))
            out.append(" ".join(w[:k] + ["changed"] + w[k + 1:]))
        if r.random() < 0.2:
            out.append(out[-1])
    return out


@pytest.fixture(scope="module")
def rows():
    t = texts()
    out = [(i, x, ("en", "de", None)[i % 3], ("s1", "s2", None, "s0")[min(3, i % 5)], None, 7, "x", "y") for i, x in enumerate(t)]
    return out + [out[5], out[20]]          # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows + [(None, "alpha beta gamma", "en", "s1", None, 7, "x", "y")], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return (t or "").encode().split()


def shingles(t, k=5):
    w = [x.lower() for x in words(t)]
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    s = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    up = {i: i for i in s}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in s:
        for b in s:
            if a < b and s[a] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in s}


def test_jaccard_join_matches_brute_force(docs, rows):
    got = jaccard_join.jaccard_components(docs).collect()
    want = brute_components(rows)
    assert Counter((r[0], r[1], r[2]) for r in got if r[0] is not None) == Counter((r[0], *want[r[0]]) for r in rows)
    assert sum(r[0] is None for r in got) == 1


def test_jaccard_join_finds_links_beside_the_leader(spark):
    """A family whose members are far from the leader but close to one another."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    out = []
    for f in range(8):
        w = base[:]
        for j in r.sample(range(120), 9):
            w[j] = f"f{f}x{j}"
        for m in range(5):
            v = w[:]
            v[r.randrange(120)] = f"m{f}{m}"
            out.append((f * 10 + m, " ".join(v)))
    got = jaccard_join.jaccard_components(spark.createDataFrame(out, "doc_id long, text string"), least_blocks=5).collect()
    assert {x[0]: (x[1], x[2]) for x in got} == brute_components(out)


def test_language_id_learns_and_predicts(spark, docs, empty):
    r = random.Random(2)
    make = lambda syl: " ".join("".join(r.choice(syl) for _ in range(r.randint(1, 4))) for _ in range(40))
    kinds = {"aa": ["the", "ing", "ou", "nd"], "bb": ["sch", "ung", "ein", "lich"]}
    data = [(i, make(kinds[k]), k) for i in range(120) for k in ("aa", "bb")]
    data = [(n, t, k if n % 4 else None) for n, (_, t, k) in enumerate(data)] + [(900, None, "aa"), (901, "12 34", "aa"), (902, "", None)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x for x in language_id.identify(frame, language_id.fold() != 2).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (900, 901, 902))
    labelled = [(n, k) for n, _, k in data if k and n < 900 and zlib.crc32(str(n).encode()) % 4 == 2]
    assert sum(got[n]["lang_pred"] == k for n, k in labelled) >= 0.95 * len(labelled) > 10
    assert language_id.identify(empty, language_id.fold() != 2).count() == 0
    assert all(x["lang_pred"] in ("en", "de", "und") for x in language_id.identify(docs, language_id.fold() != 2).collect())


def test_forward_sums_all_segmentations():
    vocabulary = ["a", "b", "ab", "ba", "aba"]
    p = np.array([[0.2, 0.1], [0.3, 0.2], [0.1, 0.4], [0.25, 0.2], [0.15, 0.1]])
    index = {v: i for i, v in enumerate(vocabulary)}

    def brute(w):
        if not w:
            return np.ones(2)
        return sum((p[index[w[:k]]] * brute(w[k:]) for k in range(1, len(w) + 1) if w[:k] in index), np.zeros(2))
    model = language_id.Model(vocabulary, p)
    some = ["a", "ab", "ababa", "bbab", "a" * 10]
    assert np.allclose(model.log_likelihood(some), np.log([brute(w) for w in some]))
    long = "ab" * 40
    halves = language_id.Model(vocabulary, p)._long("ababab")
    assert np.allclose(halves, np.log(brute("ababab"))) and np.isfinite(model.log_likelihood([long])).all()


PII = ["", None, "write to a.b@mail.example.com or x@y", "at 10.0.0.1 and 300.1.1.1 and 1.2.3.4.5", "4111 1111 1111 1111 and 4111111111111112",
       "+1 (456) 555-2186 now, +12 no", "a@b.c" * 3, "@" * 50 + "0" * 500, "no data here", "é 10.1.1.255 ü@x.de"]


def brute_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and personal_data.luhn(d):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_match_the_plain_patterns():
    r = random.Random(3)
    for _ in range(3000):
        t = "".join(r.choice("01459+.-() @ab%_\n") for _ in range(r.randint(0, 60)))
        assert personal_data.base_spans(t) == brute_spans(t), t
    assert [personal_data.base_spans(t) for t in PII] == [brute_spans(t or "") for t in PII]


def test_tagger_finds_other_spellings(spark, empty):
    r = random.Random(6)
    out = []
    for i in range(220):
        ip = ".".join(str(r.randint(1, 255)) for _ in range(4))
        phone = f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
        mail = f"{r.choice(WORDS)}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.example.com"
        pad = lambda: " ".join(r.choice(WORDS) for _ in range(r.randint(3, 9)))
        out.append((i, f"{pad()} {r.choice([ip, phone, mail])} {pad()}"))
    out += [(1000 + i, t) for i, t in enumerate(PII)] + [(2000, "alpha beta (456) 555 2186 gamma delta epsilon zeta")]
    frame = spark.createDataFrame(out, "doc_id long, text string")
    got = {x["doc_id"]: x for x in personal_data.find_spans(frame).collect()}
    for i, t in out:
        base = [tuple(s) for s in got[i]["base"]]
        assert base == sorted(brute_spans(t or "")) and set(base) <= {tuple(s) for s in got[i]["spans"]}
    assert any(x["kind"] == 3 for x in got[2000]["spans"])      # no base pattern sees it
    assert personal_data.find_spans(empty).count() == 0


def test_tagger_finds_addresses_without_digit_or_at_sign(spark):
    r = random.Random(6)
    pad = lambda: " ".join(r.choice(WORDS) for _ in range(r.randint(3, 9)))
    out = [(i, f"{pad()} {r.choice(WORDS)}.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.com {pad()}") for i in range(220)]
    plain = [f"{r.choice(WORDS)} at {pad()} and at {pad()}" for _ in range(20)]
    spelt = ["jane.doe at example.com", "jane(at)example.org", "JOHN.SMITH AT mail.example.com", "maria.lopez(At)test.example.net"]
    far = [(i, "alpha beta gamma " * k + f"write to {a} for the rest") for i, (k, a) in enumerate([(k, a) for k in (0, 1, 2, 40) for a in spelt], 1000)]
    frame = spark.createDataFrame(out + far + list(enumerate(plain, 2000)), "doc_id long, text string")
    got = {x["doc_id"]: [tuple(s) for s in x["spans"]] for x in personal_data.find_spans(frame).collect()}
    for (i, t), a in zip(far, spelt * 4):
        assert got[i] == [(0, t.index(a), t.index(a) + len(a))], t
    assert not any(got[i] for i in range(2000, 2020))
    for draw in range(13):                # every form of the training meets a trigger
        assert personal_data.TRIGGER.search(personal_data._variants(0, "jane.doe@example.com", draw, ["alpha", "beta"]))


def test_windows_are_reconciled_globally():
    spans = [(3, 10, 30, 0.9), (3, 22, 34, 0.95), (2, 31, 40, 0.5), (0, 50, 60, 0.9)]
    assert personal_data.reconcile(spans) == [(3, 10, 34, 0.95), (0, 50, 60, 0.9)]


def test_mixing_keeps_targets_and_reruns_agree(docs, rows, empty):
    got = mixing.mix_documents(docs, per_block=9).collect()
    again = mixing.mix_documents(docs.repartition(5), per_block=9).collect()
    flat = lambda x: Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in x)
    assert flat(got) == flat(again) and len(got) == len(rows) + 1
    total = sum(r["size"] for r in got)
    targets = {r["source"]: r["target"] for r in got}
    sizes = {r["source"]: r["source_size"] for r in got}
    assert math.isclose(sum(targets.values()), total) and list(sorted(targets, key=lambda s: (s is None, s))) == ["s0", "s1", "s2", None]
    assert all(targets[s] <= 3 * sizes[s] + 1e-9 and r["copies"] <= 3 for r in got for s in [r["source"]])
    for s in targets:
        most = max(r["size"] for r in got if r["source"] == s)
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - targets[s]) <= most
    assert mixing.mix_documents(empty).count() == 0


def test_pivot_keeps_mass_and_expectation():
    size, part = np.array([5, 9, 2, 7, 30, 1]), np.array([0.3, 0.5, 0.9, 0.2, 0.6, 0.5])
    mean = np.zeros(6)
    for seed in range(4000):
        got = mixing.pivot(size, part.copy(), np.arange(6), seed, 0, True)
        assert abs((got * size).sum() - (part * size).sum()) <= size.max()
        mean += got
    assert np.abs(mean / 4000 - part).max() < 0.05


def test_packing_is_gapless_and_near_the_bound(docs, rows, empty):
    path = language_id.public_path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    got = packing.pack(docs, path, capacity=64, per_bucket=7).collect()
    want = Counter()
    for r in [*rows, (None, "alpha beta gamma")]:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 64)):
            want[r[0], k, a, len(ids[a:a + 64]), zlib.crc32(np.array(ids[a:a + 64], "<u4").tobytes())] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 64
    assert len(by) <= 1.15 * math.ceil(sum(r["length"] for r in got) / 64)
    assert packing.pack(empty, path).count() == 0


def test_plan_uses_every_piece_once():
    r = random.Random(1)
    for _ in range(30):
        counts = Counter(r.randint(1, 50) for _ in range(r.randint(0, 200)))
        used = Counter()
        for pattern, m in packing.plan(counts, 50):
            assert sum(pattern) <= 50 and m > 0
            for x in pattern:
                used[x] += m
        assert used == counts


def test_quality_matches_brute_force(docs, rows, empty):
    got = {r["doc_id"]: r for r in repetition.quality(docs).collect()}
    for doc, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        rep = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(rep)), t
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_symbols"] == sum((t or "").count(c) for c in "#*$%&|<>")
        assert r["base_failed"] == (len(w) < 20 or 100 * len(rep) > 30 * len(w)) and (not r["base_failed"] or not r["kept"])
    assert repetition.quality(empty).count() == 0


def test_longest_repeats_match_brute_force():
    r = np.random.default_rng(1)
    for _ in range(60):
        parts = [r.integers(0, r.integers(1, 5), r.integers(0, 30)).astype(np.uint64) for _ in range(r.integers(1, 5))]
        first = np.cumsum([0, *map(len, parts)])
        got = repetition.longest_repeats(np.concatenate(parts), first)
        for p, lo in zip(parts, first):
            for a in range(len(p)):
                best = 0
                for b in range(len(p)):
                    k = 0
                    while a != b and max(a, b) + k < len(p) and p[a + k] == p[b + k]:
                        k += 1
                    best = max(best, k)
                assert got[lo + a] == best


def test_sharding_law_slots_and_copies(spark, docs, rows, empty):
    r = random.Random(8)
    data = [(i, "word " * r.randint(1, 400), r.choice(["a", "b"]), r.choice(["s1", "s2", None])) for i in range(600)]
    data += [(1000 + i, "copy " * 60, "a", f"s{i % 3}") for i in range(300)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = sharding.shard(frame, 10, per_bucket=20).collect()
    load, slots = Counter(), defaultdict(list)
    for x in got:
        load[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
    assert sorted(load) == list(range(10)) and max(load.values()) <= 1.1 * min(load.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    text = {d[0]: d[1] for d in data}
    assert all(x["text_crc32"] == zlib.crc32(text[x["doc_id"]].encode()) and x["size"] == len(text[x["doc_id"]]) + 16 for x in got)
    assert sharding.shard(docs, 4).count() == len(rows) + 1 and sharding.shard(empty).count() == 0


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 200
    data = [(3, "u3", big), (1, "u\n1", big), (2, None, None), (4, "u4", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 20), (5, "u5", "small"), (6, "u6", "small"),
            (7, "u7", "é" * 90), (8, "u8", ""), (None, "u9", big), (9, "u9", "y" * 300000), (7, "u7", "é" * 90)]
    pages = spark.createDataFrame([(*d, "z", 1) for d in data], "page_id long, url string, html string, digest string, offset long")
    folder = warc.scratch_path(spark, "test")
    index = warc.write_archives(pages, folder)
    got = warc.read_records(index, folder).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got) == Counter(
        (p, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for p, _, h in data)
    by = {r["page_id"]: r for r in got if r["record_type"] == "response"}
    assert by[1]["payload"] == big.encode() and by[4]["payload"] == data[3][2].encode()
    again = Counter((r["page_id"], r["refers_to"]) for r in got if r["record_type"] == "revisit")
    assert again == Counter([(3, 1), (None, 1), (7, 7)])
    one = warc.read_records(index.where("page_id = 9"), folder).collect()
    assert len(one) == 1 and one[0]["payload"] == b"y" * 300000
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_coalesced_ranges():
    assert list(warc.ranges([0, 10, 30, 1000], [10, 10, 10, 5], gap=10, most=100)) == [(0, 3), (3, 4)]


def test_nearest_neighbours_recall_and_edges(spark):
    r = np.random.default_rng(2)
    v = r.normal(size=(3000, 24)).astype(np.float32)
    v[7] = v[20] = v[8]                      # equal vectors
    data = [(i, x.tolist()) for i, x in enumerate(v)] + [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [1.0] * 3), (None, [1.0] * 24)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = nearest.nearest(frame, per_block=700, per_queries=60).collect()
    by = defaultdict(list)
    for x in sorted(got, key=lambda x: (x["query_id"], x["rank"])):
        by[x["query_id"]].append((x["vec_id"], x["score"]))
    assert set(by) == set(range(0, 3000, 20))
    hit = 0
    for q, found in by.items():
        s = (v.astype(float) * v[q].astype(float)).sum(1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(3000), -s))[:20]
        hit += len(set(best.tolist()) & {i for i, _ in found})
        assert found == sorted(found, key=lambda z: (-z[1], z[0])) and len(found) == 20
        assert all(abs(z - s[i]) < 1e-9 for i, z in found)
    assert hit >= 0.9 * 20 * len(by)
    assert [i for i, _ in by[20]][:2] == [7, 8]
    assert nearest.nearest(frame.limit(0)).count() == 0


def test_backoff_scores_match_brute_force(docs, rows, empty):
    got = defaultdict(list)
    for x in backoff.score_documents(docs, common=8).collect():
        got[x["doc_id"]].append(x)
    flat = [*rows, (None, "alpha beta gamma")]
    toks = [[w.lower() for w in words(r[1])] for r in flat]
    uni, bi = Counter(), Counter()
    for w in toks:
        uni.update(w)
        bi.update(zip(w, w[1:]))
    by = defaultdict(list)
    for r, w in zip(flat, toks):
        by[r[0]].append(w)
    n = sum(uni.values())
    for doc, parts in by.items():
        own = Counter(p for w in parts for p in zip(w, w[1:]))
        total, backed = 0.0, 0
        for w in parts:
            for a, b in zip([None, *w], w):
                c = bi[a, b] - own[a, b] if a is not None else 0
                if c > 0:
                    total += math.log(c / uni[a])
                else:
                    backed += a is not None
                    total += math.log(uni[b] / n * (1 if a is None else backoff.BACKOFF))
        size = sum(map(len, parts))
        for x in got[doc]:
            assert (x["n_words"], x["n_backed_off"]) == (size, backed)
            assert x["score"] is None if not size else abs(x["score"] - total / size) < 0.01
    assert backoff.score_documents(empty).count() == 0
