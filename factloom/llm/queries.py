"""The thin queries of this subpackage and their SQL, by name; each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import leaks, licences, lm, minhash, mixing, neighbours, pii, quality, substring, tokenfile
from .common import table


def op1_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path() -> str:
    """The production tokenizer's file; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), 20).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.read_ids(tokenfile.write_ids(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan_licences(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"), "n_licences")


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("item_ids", F.array_join("item_ids", ","))


QUERIES = {f.__name__: f for f in (op1_quality_compression, op2_learned_partitions, op3_minhash_dedup, op4_substring_dedup, op5_mix_sources, op6_token_files, op7_licence_scan, op8_pitman_yor, op9_pii, op10_decontaminate)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op3_minhash_dedup": rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))
                                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
    both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
    reach AS (SELECT u AS doc_id, u AS r FROM both_ways UNION SELECT reach.doc_id, b.v FROM reach JOIN both_ways b ON b.u = reach.r),
    low AS (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.c, w.doc_id) AS component_id, coalesce(low.c, w.doc_id) = w.doc_id AS kept
    FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)""",
    "op4_substring_dedup": rf"""
    WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    windows AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 18, 1))) AS i, w FROM w WHERE len(w) >= 20),
    hashed AS (SELECT doc_id, i, md5(array_to_string(w[i:i+19], ' ')) AS h FROM windows),
    later AS (SELECT doc_id, i FROM hashed QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
    words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)""",
    "op7_licence_scan": licences.licences_sql(),
    "op10_decontaminate": leaks.leaks_sql(),
}
