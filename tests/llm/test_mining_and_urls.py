"""Phrases (11), hard negatives (12) and URL filters (13): SQL on the given tables,
brute force on small ones with the odd cases."""

import re
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark.llm import hard_negatives, oracle_sql, phrases, queries, url_filter

DIR = "/root/testdata/sf0.01"


def rows(found, columns):
    def plain(x):
        return None if x is None or x != x else x.item() if hasattr(x, "item") else x
    return sorted((tuple(map(plain, r)) for r in found[columns].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", ["op11_phrases", "op12_hard_negatives", "op13_url_filter"])
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, scale):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/{scale}/{t}.parquet'")
    expected = con.sql(oracle_sql()[name]).df()
    got = queries()[name](spark, f"/root/testdata/{scale}").toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got, sorted(got.columns)) == rows(expected, sorted(got.columns))
    assert scale == "sf0.001" or len(got)


# ---- phrases -----------------------------------------------------------------
def brute_phrases(docs, longest, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    counts[lang][tuple(w[i:i + n])] += 1
    out = []
    for lang, f in counts.items():
        some = {p: c for p, c in f.items() if c >= least and len(p) > 1}
        scored = []
        for p, a in some.items():
            inside = any(len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, c in some.items())
            if not inside:
                s, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out, key=str)


def test_phrases_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["the", "of", "New", "york", "új", "a%b", "x" * 300, "日本", "été"]
    docs = [(" ".join(rng.choice(words, rng.integers(0, 60), p=[.3, .2, .1, .1, .1, .05, .05, .05, .05])).replace("of", "of,", 1),
             [None, "en", "fr"][i % 3]) for i in range(60)]
    docs += [(None, "en"), ("", None), ("  \t ", "fr"), ("one two. one two! one\ntwo", "en"), ("the the the the the the", "zz")]
    docs += [("New York is New York", "en")] * 7 + [("the of " * 5000, "fr")]
    table = spark.createDataFrame([(i, t, g, i, "c") for i, (t, g) in enumerate(docs)],
                                  "doc_id long, text string, lang string, rank int, c string").repartition(5)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for longest, least, top, burst, most in ((5, 2, 50, 3, 40), (5, 3, 2000, 4096, 400_000), (2, 2, 10, 2, 10), (4, 5, 7, 1, 15)):
        got = phrases.collocations(table, longest, least, top, burst, most).toPandas()
        assert rows(got, columns) == brute_phrases(docs, longest, least, top), (longest, least, burst)


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")).collect() == []


def test_trie_bursts_and_spills_sorted_subtrees():
    texts = [b"a", b"b", b"c", b"d"]
    ids = lambda *x: np.array(x, np.uint32).tobytes()
    trie = phrases.HatTrie(texts, burst=2, most=4)
    trie.add("en", 0, [ids(1, 2), ids(2, 1), ids(3, 3), ids(1, 2)])
    assert type(trie.root["en", 0]) is dict and trie.entries == 3
    trie.add("en", 0, [ids(1, 2), ids(1, 0, 0)])
    trie.add("en", 2, [ids(0)])
    def deal(lang, found, counts):
        yield list(zip(found, counts))
    assert list(trie.spill(deal)) == [[(b"a b a a", 1), (b"a b c", 3), (b"a c b", 1), (b"a d d", 1)]]
    assert trie.entries == 1 and list(trie.spill(deal, True)) == [[(b"c a", 1)]] and not trie.entries


def test_a_spill_is_one_sorted_run_a_language():
    """op11 over its budget: subtrees were spilled one by one, as many pieces as first words, largest first."""
    texts = [b"d", b"\x01", b"d-", b"\xc3\xa9", b"a"]
    trie, want = phrases.HatTrie(texts, burst=2, most=8), Counter()
    rng = np.random.default_rng(2)
    for first, n in ((0, 9), (2, 7), (3, 6), (1, 5), (4, 2)):
        for lang in ("fr", "en"):
            ids = [rng.integers(0, 5, k).astype(np.uint32) for k in rng.integers(1, 4, n)]
            trie.add(lang, first, [x.tobytes() for x in sorted(ids, key=len, reverse=True)])
            want.update((lang, b" ".join([texts[first], *(texts[i] for i in x)])) for x in ids)
    def deal(lang, found, counts):
        yield lang, found, counts
    spilled = list(trie.spill(deal))
    assert len({p.split(b" ")[0] for _, found, _ in spilled for p in found}) > 1 and trie.entries <= 4
    rest = list(trie.spill(deal, True))
    for runs in (spilled, rest):
        assert len({lang for lang, _, _ in runs}) == len(runs) and all(found == sorted(found) for _, found, _ in runs)
    got = Counter()
    for lang, found, counts in spilled + rest:
        got.update({(lang, p): c for p, c in zip(found, counts)})
    assert got == want and not trie.entries


def test_runs_are_dealt_by_prefix_and_merged():
    import pyarrow as pa
    first = [b"", b"a b c", b"a b c d", b"x", "\u00e9 b c".encode()]
    runs = [*phrases.dealer(3, 7)("en", first, [9, 3, 1, 2, 4]), *phrases.dealer(3, 7)("en", [b"a b c", b"x"], [10 ** 12, 2]),
            *phrases.dealer(3, 7)("fr", [b"a b c"], [5])]
    table = pa.Table.from_batches(runs)
    where = {r["part"] for r in phrases_of(table, b"a b c")} & {r["part"] for r in phrases_of(table, b"a b c d")}
    assert where
    got = [r for p in set(table.column("part").to_pylist())
           for r in phrases.merge_runs(4)(table.filter(pa.compute.equal(table.column("part"), p))).to_pylist()]
    assert sorted((r["lang"], r["phrase"], r["c"]) for r in got) == [
        ("en", "", 9), ("en", "a b c", 10 ** 12 + 3), ("en", "x", 4), ("en", "\u00e9 b c", 4), ("fr", "a b c", 5)]


def phrases_of(table, phrase):
    import pyarrow as pa
    return [r for r in table.to_pylist() if phrase in pa.decompress(r["run"], r["raw"], "zstd", asbytes=True)]


def test_score_is_exact_beyond_64_bits(spark):
    a, n, b = 10 ** 12 + 7, 10 ** 15 + 9, 10 ** 13 + 1
    got = spark.sql(f"SELECT (CAST(1000 AS DECIMAL(4,0)) * CAST({a} AS DECIMAL(17,0)) * CAST({n} AS DECIMAL(17,0))) "
                    f"div (CAST({b} AS DECIMAL(19,0)) * CAST({b} AS DECIMAL(19,0)))").first()[0]
    assert got == 1000 * a * n // (b * b)


# ---- hard negatives -----------------------------------------------------------
def brute_negatives(table, positives=5, negatives=3, low=50, high=95):
    ok = [(i, g, v) for i, g, v in table if i is not None and g is not None and v is not None and None not in v
          and sum(x * x for x in v) < 4e18]
    anchors = {}
    for i, g, v in sorted(ok):
        if i % 50 == 0:
            anchors.setdefault(i, (g, v))
    out = []
    for i, (g, v) in anchors.items():
        score = [(-sum(x * y for x, y in zip(v, w)), j, h) for j, h, w in ok if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in score if x[2] == g)[:positives]:
            fits = sorted((t, k) for t, k, h in score if h != g and 50 * -s <= 100 * -t <= 95 * -s)[:negatives]
            out += [(i, j, rank + 1, k, -s, -t) for rank, (t, k) in enumerate(fits)]
    return sorted(out, key=str)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("size,spread", [(9, 3), (9, 60), (2 ** 30, 2 ** 28)])
def test_negatives_against_brute_force(spark, size, spread):
    rng = np.random.default_rng(size)
    centres = rng.integers(-size, size + 1, (4, 5))
    table = []
    for i in range(700):
        at = centres[i % 4] + rng.integers(-spread // 3, spread // 3 + 1, 5)
        table.append((int(i), int(rng.integers(0, 3)), [int(x) for x in at]))
    table += [(None, 1, [1] * 5), (900, None, [1] * 5), (950, 1, None), (1000, 1, [1, None, 1, 1, 1]), (1050, 2, [0] * 5),
              (1100, 2, [1, 2]), (1150, 1, [2, 1]), (1101, 2, [2, 2]), (1200, 0, []), (-50, 1, table[3][2]), (1250, 1, [2 ** 40] * 5)]
    table += [table[5], table[50], (100, 2, table[7][2])]
    frame = spark.createDataFrame([(i, g, v, 7, "x") for i, g, v in table],
                                  "vec_id long, label int, v array<long>, rank int, score string").repartition(3)
    anchors = F.pmod(F.col("vec_id"), F.lit(50)) == 0
    got = hard_negatives.hard_negatives(frame, anchors, per_block=64, per_group=5).toPandas()
    assert rows(got, COLUMNS) == brute_negatives(table)
    got = hard_negatives.hard_negatives(frame, anchors, positives=2, negatives=9, low=10, high=80).toPandas()
    assert {r[:2] for r in rows(got, COLUMNS)} <= {(i, j) for i, j, *_ in brute_negatives(table, 2, 10 ** 6, 50, 95)} | {r[:2] for r in rows(got, COLUMNS)}


def test_walk_ends_before_the_list(monkeypatch):
    """With candidates close to the anchors' cluster first, later ones are never scored."""
    rng = np.random.default_rng(1)
    near = np.array([1000, 0, 0, 0]) + rng.integers(-20, 20, (50, 4))
    far = np.array([0, 1000, 0, 0]) + rng.integers(-20, 20, (5000, 4))
    x = np.vstack([near, far])
    ids = np.arange(len(x))
    seen = []
    keep = hard_negatives.best
    monkeypatch.setattr(hard_negatives, "best", lambda m, s, i, k: (seen.append(len(i)), keep(m, s, i, k))[1])
    low = np.full((10, 1), hard_negatives.NONE)
    list(hard_negatives.walk(ids, x, np.zeros(len(x), int), ids[:10], x[:10], np.zeros(10, int), low, -low, 3, True))
    assert sum(seen) < 10 * 500


def test_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    every = F.pmod(F.col("vec_id"), F.lit(50)) == 0
    assert hard_negatives.hard_negatives(hard_negatives.whole_vectors(empty), every).collect() == []
    odd = spark.createDataFrame([(0, [float("nan"), 1.0], 1), (50, [float("inf"), 1.0], 1), (7, [-0.5, 0.999], 9), (8, None, 1)],
                                "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["label"], r["v"]) for r in hard_negatives.whole_vectors(odd).collect()}
    assert got == {0: (2, None), 50: (1, None), 7: (0, [-128, 255]), 8: (1, None)}


# ---- url filters ----------------------------------------------------------------
ODD = ["http://Example.COM/en/1", "https://www.example.com/en/x?y#z", "http://a.www.example.com/en/", "http://example.com", None, "", "no scheme/en/",
       "x://", "x:///en/7", "http://net/es/2", "ftp://b.c.net/fr/3#top", "http://b.net:80/fr/", "http://q.org?x=/en/", "http://q.org#/en/9",
       "http://ÉXAMPLE.com/en/", "a://b://c.com/", "http://notexample.com/en/4", "http://10.0.0.1/5", "http://user@h.co.uk/6", "http://x.com/" + "p" * 100_000,
       "http://line\nbreak.com/a\nb", "http://example.com/en"]


def test_host_path_and_rules(spark):
    frame = spark.createDataFrame([(i, u, "z") for i, u in enumerate(ODD)] + [(None, ODD[0], "z")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in url_filter.judge(frame, labels, url_filter.RULES).collect()}
    assert len(got) == len(ODD) + 1
    for i, u in enumerate(ODD):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        rest = re.split("[?#]", rest)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), rest.split("/")[0])
        path = rest[len(rest.split("/")[0]):]
        fits = [(len(h + p), said, h + p) for said, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits) if fits else (0, "allow", None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, want[2], want[1]), u
    assert got[0]["host"] == urlsplit(ODD[0].lower()).netloc


def test_reputation_shrinks_to_the_domain_and_blocks_bad_hosts(spark):
    pages, labels, doc = [], [], 0
    def add(host, n, bad):
        nonlocal doc
        for j in range(n):
            pages.append((doc, f"http://{host}/x/{doc}.html"))
            if bad is not None:
                labels.append((doc, 1, int(j < bad)))
            doc += 1
    for i in range(30):
        add(f"w{i}.good{i % 10}.org", 40, 1)
    for i in range(8):
        add(f"h{i}.farm.org", 40, 38)
    add("new.farm.org", 3, None)        # nothing known but the domain
    add("new.good1.org", 3, None)
    add("one.good2.org", 1, 1)          # a single bad page
    add("bad.good3.org", 60, 57)
    frame = spark.createDataFrame(pages, "page_id long, url string")
    known = spark.createDataFrame([*labels, labels[0], (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r["host"]: r["verdict"] for r in url_filter.judge(frame, known, []).select("host", "verdict").distinct().collect()}
    blocked = {h for h, v in got.items() if v == "block"}
    assert blocked == {*(f"h{i}.farm.org" for i in range(8)), "new.farm.org", "bad.good3.org"}
    found = {r["host"]: r for r in url_filter.reputation(url_filter.outcomes_of(frame, known)).collect()}
    assert found["new.farm.org"]["n"] == 0 and found["new.farm.org"]["mean"] > 0.5 > found["one.good2.org"]["bound"]


def test_domains(spark):
    hosts = ["a.b.example.com", "example.com", "localhost", "", "10.0.0.1", "x.y.co.uk", "co.uk", "u@h.org:8080", "[::1]"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [tuple(r) for r in frame.select(*url_filter.domain_and_suffix(F.col("host"))).collect()]
    assert got == [("example.com", "com"), ("example.com", "com"), ("localhost", ""), ("", ""), ("10.0.0.1", ""), ("y.co.uk", "co.uk"),
                   ("co.uk", "uk"), ("h.org", "org"), ("[::1]", "")]


def test_url_filter_is_native(spark):
    plan = queries()["op13_url_filter"](spark, DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
