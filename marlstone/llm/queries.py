"""The registered query of each operator: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import conversations, decontaminate, fill_in_middle, lm_scoring, packing, pii, quality_ordinal, quality_rules, sentencepieces, sharding, simhash, substrings, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.benchmark_hits(docs, _table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepieces.encoded(docs).drop("text").withColumn("n_pieces", F.size("ids").cast("long"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.scored(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs).select("doc_id", "text", F.array_join("pii_kinds", ",").alias("pii_kinds"), F.size("pii_kinds").cast("long").alias("n_replaced"))


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_ordinal.graded(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "expected_grade", "tail_probability", "kept")


def op11_linear_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(_table(spark, sf_dir, "conversations"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transformed(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_in_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored.cast("binary"), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_toxicity": op5_toxicity,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_pii_pseudonyms": op8_pii_pseudonyms,
    "op9_kd_sharding": op9_kd_sharding,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_linear_grouping_packing": op11_linear_grouping_packing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op1_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS pat
      FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
s AS (SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS pat
      FROM d, (SELECT DISTINCT m FROM p), unnest(range(1, len(w) - m + 2)) AS t(i) WHERE len(w) >= m),
h AS (SELECT r, i, s.m, item FROM s JOIN p ON s.m = p.m AND s.pat = p.pat),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM h, unnest(range(i, i + m)) AS t(k) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)""",
    "op3_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win FROM d, unnest(range(1, len(w) - 18)) AS t(i) WHERE len(w) >= 20),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM s),
x AS (SELECT DISTINCT doc_id, j FROM r, unnest(range(i, i + 20)) AS t(j) WHERE k > 1),
y AS (SELECT doc_id, list(j) AS gone FROM x GROUP BY doc_id),
f AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN y USING (doc_id)),
n AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM (
        SELECT d.doc_id, j, w[j] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(j)) q ANTI JOIN x USING (doc_id, j) GROUP BY doc_id)
SELECT f.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM f LEFT JOIN n USING (doc_id)""",
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS m,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
o AS (SELECT *, substr(t, 1, p) AS a, substr(t, p + 1, m - p) AS b, substr(t, m + 1) AS z FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(p AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(m - p AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM o""",
}
