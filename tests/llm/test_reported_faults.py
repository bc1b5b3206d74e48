"""Faults that a review found, each as a test of its own."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrospark.llm import language_id, mixing, nearest, packing, personal_data, sharding, warc
from agrospark.session import read_table


def test_a_null_page_and_page_minus_one_share_a_payload(spark):
    html = "<p>" + "same " * 50
    pages = spark.createDataFrame([(None, "a", html), (-1, "b", html), (3, "c", html), (None, "d", "x" * 200), (None, "e", None)],
                                  "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got if r["payload_bytes"] > 200)
    assert kinds == [("-1", "response", None), ("3", "revisit", -1), ("None", "revisit", -1)]
    assert [r["record_type"] for r in got if r["payload_bytes"] <= 200] == ["response", "response"] and len(got) == 5


def test_a_vector_repeated_many_times_loses_no_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    rows = [(int(i), [float(c) for c in x[i]]) for i in range(300)] + [(281, [float(c) for c in x[281]])] * 60
    rows += [(282, [float(c) for c in x[j]]) for j in range(20)]                 # one id, other vectors
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("score", F.lit("x"))
    got = nearest.nearest(frame).groupBy("query_id").agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("d")).collect()
    assert len(got) == 15 and all(r["n"] == r["d"] == 20 for r in got)


def test_large_doubles_are_scored_as_they_are(spark):
    rows = [(i, [1e150 * (i + 1), 1.0]) for i in range(30)]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("query_id = 0").collect()
    assert len(got) == 20 and all(np.isfinite(r["score"]) for r in got)
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])][:3] == [29, 28, 27]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, scale):
    table = read_table(spark, f"/root/testdata/{scale}", "embeddings")
    got = nearest.nearest(table).toPandas()
    own = table.toPandas().sort_values("vec_id")
    x, ids = np.stack(own["embedding"]).astype(float), own["vec_id"].to_numpy()
    found = {q: set(g["vec_id"]) for q, g in got.groupby("query_id")}
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        hits.append(len(found[ids[i]] & set(ids[np.lexsort((ids, -score))[:20]])) / 20)
    assert np.mean(hits) >= 0.95, np.mean(hits)


def test_address_parts_of_many_zeros():
    zeros = "0" * 5000
    assert personal_data.base_spans(f"{zeros}1.{zeros}.{zeros}255.2") == [(1, 0, len(f"{zeros}1.{zeros}.{zeros}255.2"))]
    assert personal_data.base_spans(f"{zeros}1.{zeros}.{zeros}256.2") == []


def test_runs_of_address_characters_take_linear_time():
    for text in ("a" * 400_000 + "@", "a@" * 200_000, "a@b" * 100_000, "a@b." * 100_000, "1." * 200_000, "+" * 200_000, "1 " * 200_000):
        began = time.process_time()
        personal_data.base_spans(text)
        assert time.process_time() - began < 5, text[:8]


def test_addresses_are_those_of_the_pattern():
    import re
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(7)
    for _ in range(20_000):
        text = "".join(rng.choice("ab.@@-_ é1") for _ in range(rng.randint(0, 16)))
        assert [(0, m.start(), m.end()) for m in pattern.finditer(text)] == [x for x in personal_data.base_spans(text) if x[0] == 0], text


def test_small_groups_of_equal_texts_stay_together(spark):
    got = sharding.shard(read_table(spark, "/root/testdata/sf0.01", "documents"))
    least, most = got.groupBy("shard").agg(F.sum("size").alias("b")).agg(F.min("b"), F.max("b")).first()
    cut = got.groupBy("text_crc32", "size").agg(F.countDistinct("shard").alias("n")).where("n > 1")
    assert cut.count() == 0 and most < 1.25 * least


def test_a_row_repeated_many_times_is_spread(spark):
    rows = [(7, "w" * 2900, "s", "en")] * 1000 + [(i, "d" * (i * 10), "t", "fr") for i in range(38)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    by = {r["shard"]: r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    assert len(by) == 40 and max(by.values()) < 1.3 * min(by.values())


def test_every_source_ends_near_its_target(spark):
    got = mixing.mix_documents(read_table(spark, "/root/testdata/sf0.01", "documents")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") / F.greatest("size", F.lit(1))).alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.03 * r["target"] and r["most"] <= 3 for r in got)


def test_the_last_open_document_is_made_good_by_short_ones():
    size = np.array([5000, 300, 40, 30, 20, 10, 5, 4, 3, 2, 1] + [60] * 100)
    part = np.full(len(size), 0.37)
    short = size < 100
    for seed in range(40):
        got = mixing.settle(size, part, np.arange(len(size)), short, seed, 0)
        assert set(got) <= {0, 1} and abs((got * size).sum() - (part * size).sum()) <= 60 or got[0] == 1


def test_parts_of_words_have_the_ids_of_whole_texts():
    ids = packing.WordIds(language_id.public_path("word_bpe_49k.json"))
    rng = random.Random(3)
    pool = ("abcXYZ don't I'll we've é É ß Σ ς ﬁ İ ñ 日本 ١٢ ½ ² Ⅳ ' ’ — … . , ; ! ? - _ < | > <|endoftext|> "
            "́ ‍ 😀 \x1c \x00 \x85 \xa0 0 1 9 's 't & " + "long" * 60).split(" ")
    texts = ["".join(rng.choice(pool) + rng.choice(["", "", "", " ", "\n"]) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    assert list(ids.texts(texts)) == [ids.ids(t) for t in texts] and list(ids.texts([None, ""])) == [b"", b""]


def test_different_texts_under_one_id_both_stay(spark):
    import corpus_pipeline
    text = lambda seed: " ".join(f"w{random.Random(seed * 1000 + i).randint(0, 999)}" for i in range(60))
    rows = [(1, text(1)), (1, text(2)), (2, text(1)), (None, text(3)), (None, text(3)), (None, text(4)), (5, text(3)), (6, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, text(1)), (1, text(2)), (None, text(3)), (None, text(3)), (None, text(4)), (5, text(3)), (6, None), (7, "")], key=str)


def test_packing_does_not_depend_on_the_words_remembered(spark):
    """A worker that forgets after 50 words gives the ids of one that keeps all."""
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    path = language_id.public_path("word_bpe_49k.json")
    few, all_ = (packing.token_pieces(docs, path, 4096, keep=k).orderBy("doc_id", "piece").collect() for k in (50, packing.CACHE))
    assert few == all_ and len(all_) > 0


def test_words_that_come_again_are_learnt_once():
    """A full memory forgets the words that did not come again, not the others."""
    from agrospark.llm import language_id, packing
    ids, learnt = packing.WordIds(language_id.public_path("word_bpe_49k.json"), 40), []
    learn = ids.learn
    ids.learn = lambda words: (learnt.extend(words), learn(words))[1]
    texts = [f"always, again {' '.join('x' * (i % 7 + 1) + str(i) for i in range(k, k + 10))} ALWAYS" for k in range(0, 200, 10)]
    got = [b for t in texts for b in ids.texts([t])]
    assert got == [ids.ids(t) for t in texts]
    assert [learnt.count(w) for w in (b"always,", b"again", b"ALWAYS")] == [1, 1, 1] and len(ids) + len(ids.older) <= 60
