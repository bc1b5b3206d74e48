"""The corpus pipeline on a small table, stage by stage and as a whole."""

from __future__ import annotations

import random

import corpus_pipeline as cp
from agrospark.llm import personal_data
from agrospark.llm.common import kept_in_table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    extra = docs.limit(1).selectExpr("-1L AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars").union(
        docs.limit(1).selectExpr("-2L AS doc_id", "'12 34' AS text", "lang", "source", "n_chars"))
    docs = kept_in_table(docs.union(extra), "docs")
    by = {}
    for name, stage in cp.STAGES:
        docs = kept_in_table(stage(spark, docs, SF), "stage")
        by[name] = docs
        if name != cp.STAGES[-1][0]:
            assert docs.columns == list(cp.COLUMNS)
    ids = [r[0] for r in by["language ID"].select("doc_id").collect()]
    assert len(ids) >= 0.98 * n and not {-1, -2} & set(ids)
    assert by["n-gram Jaccard join"].count() < len(ids)
    assert not any(personal_data.base_spans(r[0]) for r in by["personal data"].select("text").collect())
    assert by["best-fit packing"].count() >= by["mix of sources"].count()


def test_language_stage_rejects_what_no_learned_language_explains(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*cp.COLUMNS)
    r = random.Random(4)
    gibberish = [" ".join("".join(r.choice("qxzjkvwpbf") for _ in range(r.randint(3, 9))) for _ in range(200)) for _ in range(3)]
    finnish = "hyvää päivää kaikille ystäville jotka ovat tulleet tänään kylään koska sää oli kaunis ja järvi tyyni " * 12
    russian = "сегодня хорошая погода и мы идем гулять в парк вместе с друзьями потому что завтра будет дождь " * 12
    planted = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate([*gibberish, finnish, russian])]
    mixed = kept_in_table(docs.union(spark.createDataFrame(planted, docs.schema)), "docs")
    ids = {x["doc_id"] for x in cp.language(spark, mixed, SF).select("doc_id").collect()}
    assert not [i for i in ids if i < 0]
    assert len(ids) >= 0.98 * docs.count()


def test_rows_of_one_id_and_null_columns(spark):
    r = random.Random(1)
    t = " ".join(r.choice("the of and in to was for".split()) for _ in range(60))
    rows = [(1, t, None, None, None), (1, t, None, None, None), (2, t + " end", None, "s", 3), (None, t, None, None, None), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.near_duplicates(spark, docs, SF).collect()
    assert sorted((x["doc_id"] is None, x["doc_id"] or 0) for x in kept) == [(False, 1), (False, 3), (True, 0)]
    assert cp.mixed(spark, kept_in_table(docs, "docs"), SF).where("doc_id = 3").count() == 0
    none = docs.limit(0)
    for name, stage in cp.STAGES:
        none = kept_in_table(stage(spark, none, SF), "none")
        assert none.count() == 0
