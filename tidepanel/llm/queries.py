"""Registered queries of the subpackage: name -> function, name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm import (collocations, decontaminate, exact_dedup, html_text, near_copies,
                           packing, quality, resample, sharding, sql_oracles, token_counts,
                           token_files, url_filter, warc)
from tidepanel.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_shard_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(read_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "benchmark"))


def op4_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_classes(read_table(spark, sf_dir, "documents"))


def op5_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary())


def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read_table(spark, sf_dir, "documents"), vocabulary())


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary())


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_table(spark))
    return url_filter.judge(read_table(spark, sf_dir, "pages"), model).drop("score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.draw(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
       sha256(d.body) AS text_sha256
FROM d JOIN g ON d.body = g.body
"""


OP7_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (
  SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest,
         max(page_id) OVER (PARTITION BY html) AS first_id
  FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN n >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM q
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_shard_minimax, op2_exact_dedup, op3_decontaminate, op4_near_copies,
        op5_pack_best_fit, op6_quality_trees, op7_warc_round_trip, op8_token_files,
        op9_token_counts, op10_html_text, op11_url_filter, op12_collocations, op13_resample)}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op7_warc_round_trip": OP7_SQL,
            "op11_url_filter": sql_oracles.url_filter_sql(),
            "op12_collocations": sql_oracles.collocations_sql(),
            "op13_resample": sql_oracles.resample_sql()}
