"""One query per operation, over its whole table (see each operator's module)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (backoff, hard_negatives, jaccard_join, language_id, mixing, nearest, packing, personal_data, phrases,
               repetition, sharding, url_filter, warc)
from .common import documents, read_table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts of the base spans by kind, their digest, all spans."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = personal_data.find_spans(docs)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(personal_data.KINDS)],
                        F.sha2(personal_data.as_text(F.col("base")), 256).alias("base_sha256"),
                        personal_data.as_text(F.col("spans")).alias("spans"))


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), language_id.public_path("word_bpe_49k.json"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    fold = language_id.fold()
    found = language_id.identify(docs, fold != 2)
    return found.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(documents(spark, sf_dir))


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS s FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY s) ELSE page_id END AS first FROM d)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_documents(documents(spark, sf_dir))


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read_table(spark, sf_dir, "embeddings"))


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


ORACLE_SQL["op11_phrases"] = phrases.SQL


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.whole_vectors(read_table(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(vectors, F.pmod(F.col("vec_id"), F.lit(50)) == 0)


ORACLE_SQL["op12_hard_negatives"] = hard_negatives.SQL


@query
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"), url_filter.RULES)


ORACLE_SQL["op13_url_filter"] = url_filter.SQL
