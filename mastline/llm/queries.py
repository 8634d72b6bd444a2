"""One query per operator over the given tables, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mastline.llm.circulant import near_duplicate_groups
from mastline.llm.decontaminate import leaks
from mastline.llm.exact import exact_report
from mastline.llm.fim import fim_report
from mastline.llm.langid import language_report
from mastline.llm.licenses import license_report
from mastline.llm.mixing import mixture
from mastline.llm.negatives import negatives_report
from mastline.llm.secrets import scan
from mastline.llm.simhash import linked_documents
from mastline.llm.substrings import passages_report
from mastline.llm.tokens import token_counts
from mastline.llm.toxicity import toxicity_report


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_report(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(_table(spark, sf_dir, "documents"))


def op5_tokens(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(_table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages_report(_table(spark, sf_dir, "documents"))


def op11_circulant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives_report(_table(spark, sf_dir, "embeddings"))


def op13_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_licenses": op4_licenses,
    "op5_tokens": op5_tokens,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_simhash": op8_simhash,
    "op9_secrets": op9_secrets,
    "op10_passages": op10_passages,
    "op11_circulant": op11_circulant,
    "op12_negatives": op12_negatives,
    "op13_middle": op13_middle,
}

_OP2 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""

_OP11 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 2], ' ') for i in range(1, len(words) - 1)] END) AS shingle
  FROM w WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
  FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)
), l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""

_OP13 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents
), h AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y,
         ('0x' || h[17:24])::BIGINT % 100 AS moved, ('0x' || h[25:32])::BIGINT % 100 AS kind
  FROM d
), f AS (
  SELECT *, least(x, y) AS low, greatest(x, y) AS high,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR moved >= 90 THEN 'plain'
      WHEN kind < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), o AS (
  SELECT *, substr(text, 1, low) AS p, substr(text, low + 1, high - low) AS m, substr(text, high + 1) AS s FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM o
"""

ORACLE_SQL: dict[str, str] = {"op2_exact_dedup": _OP2, "op11_circulant": _OP11, "op12_negatives": _OP12, "op13_middle": _OP13}
