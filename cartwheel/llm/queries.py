"""Queries over the operators of this package, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.llm import (bpe, hard_negatives, id_files, jaccard, language, licenses, line_dedup, mixing,
                           near_vectors, neighbours, packing, sharding, whitening)
from cartwheel.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_sharding(spark, folder):
    return sharding.shard_digest(table(spark, folder, "documents"))


@query
def op2_license_scan(spark, folder):
    return licenses.license_digest(table(spark, folder, "documents"))


@query
def op3_byte_bpe(spark, folder):
    return bpe.bpe_digest(table(spark, folder, "documents"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op8_packing(spark, folder):
    return packing.packing_digest(table(spark, folder, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query
def op7_language_id(spark, folder):
    return language.language_digest(table(spark, folder, "documents"))


@query
def op9_near_vectors(spark, folder):
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


@query
def op4_nearest(spark, folder):
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op1_jaccard(spark, folder):
    return jaccard.jaccard_classes(table(spark, folder, "documents"))


@query
def op6_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


@query
def op5_id_files(spark, folder):
    return id_files.id_file_digest(table(spark, folder, "documents"),
                                   public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_mixing(spark, folder):
    return mixing.mix_digest(table(spark, folder, "documents"))


@query
def op12_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@query
def op13_hard_negatives(spark, folder):
    return hard_negatives.negatives_digest(table(spark, folder, "embeddings"))


# every row as its whole components times 256, and the inner products of anchors with all rows
ORACLES["op13_hard_negatives"] = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(CAST(c AS DOUBLE)))) = 0),
rows AS (SELECT *, row_number() OVER () AS r FROM given),
scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM rows AS a JOIN rows AS b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.x) = len(b.x)),
positive AS (
  SELECT ar, anchor_id, br AS pr, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY s.score DESC, s.vec_id, s.br) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive AS p JOIN scored AS s
  ON s.ar = p.ar AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY s.score DESC, s.vec_id, s.br) <= 10
"""
