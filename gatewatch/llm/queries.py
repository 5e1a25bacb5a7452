"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.llm import (
    alignment,
    bpe,
    decontamination,
    exact_dedup,
    language,
    licenses,
    manifest,
    mixing,
    near_dedup,
    pii,
    quality,
    substring_dedup,
    toxicity,
)
from gatewatch.llm.common import held_out, table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, the same on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted, "neighbours", "cosines")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row for each pair."""
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_exact(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.digest(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digest(manifest.prove(table(spark, sf_dir, "documents")))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_licenses": op1_licenses,
        "op2_toxicity": op2_toxicity,
        "op3_decontamination": op3_decontamination,
        "op4_quality": op4_quality,
        "op5_near_dedup": op5_near_dedup,
        "op6_pii": op6_pii,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_mixing": op9_mixing,
        "op10_language": op10_language,
        "op11_alignment": op11_alignment,
        "op12_manifest": op12_manifest,
        "op13_bpe": op13_bpe,
    }


EXACT_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

#: Levels of all trees by recursion; proofs by following each leaf's number up, halved at every level.
MANIFEST_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, n_chars, source, text,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         list_reduce([4294967295::UBIGINT] || list_transform(
             flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)] || [-1, -1, -1, -1, -1, -1, -1, -1])), lambda x: CASE WHEN x < 0 THEN 1000 ELSE x END::UBIGINT),
           lambda a, x: CASE WHEN x < 1000 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END) AS reversed_crc
  FROM documents
), leaf AS (
  SELECT doc_id, coalesce(lang, '') AS lang, lang IS NOT NULL AS named,
         sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS h,
         sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END || tail) AS other,
         coalesce(xor(reversed_crc, 4294967295::UBIGINT) % 7 = 0, false) AS tampered
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY named, lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY named, lang) AS n FROM leaf
), node AS (
  SELECT named, lang, 0 AS level, i, n, h FROM placed
  UNION ALL
  SELECT named, lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY named, lang, level, n, i // 2
), sub AS (
  SELECT named, lang, h, row_number() OVER (ORDER BY named, encode(lang)) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1
), top AS (
  SELECT 0 AS level, i, n, h FROM sub
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, n, i // 2
), climb AS (
  SELECT p.doc_id, p.h AS leaf, p.named, p.lang, p.i AS id, 0 AS level, p.i, p.n, '' AS proof, CASE WHEN p.tampered THEN p.other ELSE p.h END AS folded FROM placed p
  UNION ALL
  SELECT c.doc_id, c.leaf, c.named, c.lang, c.id, c.level + 1, c.i // 2, (c.n + 1) // 2, c.proof || coalesce(s.h, ''),
         sha256(CASE WHEN c.i % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END)
  FROM climb c LEFT JOIN node s ON s.named = c.named AND s.lang = c.lang AND s.level = c.level AND s.i = xor(c.i, 1)
  WHERE c.n > 1
), over AS (
  SELECT c.doc_id, c.leaf, c.named, c.lang, c.id, sub.h AS subroot, 0 AS level, sub.i, sub.n, c.proof, c.folded
  FROM climb c JOIN sub ON sub.named = c.named AND sub.lang = c.lang WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.named, c.lang, c.id, c.subroot, c.level + 1, c.i // 2, (c.n + 1) // 2, c.proof || coalesce(s.h, ''),
         sha256(CASE WHEN c.i % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END)
  FROM over c LEFT JOIN top s ON s.level = c.level AND s.i = xor(c.i, 1)
  WHERE c.n > 1
)
SELECT o.doc_id, o.leaf, o.subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root, o.folded = r.h AS verified
FROM over o, (SELECT h FROM top WHERE n = 1) r WHERE o.n = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_exact_dedup": EXACT_DEDUP_SQL, "op12_manifest": MANIFEST_SQL}
