"""Registered queries of the corpus operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import bpe, crosstokens, extract, licenses, mixing, multiindex, ngrams, quality, resample, sharding, simhash, substrings, suffixes
from ledgerlens.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return register


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op1_main_text")
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS cap,
    list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1) AS w
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level,
    row_number() OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST) AS place
  FROM s WINDOW before AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, w * coalesce(arg_min(level, place) FILTER (WHERE level * w <= cap) OVER (), 'inf'::DOUBLE)) AS target
  FROM leveled
), drawn AS (
  SELECT doc_id, size, source_size, target, sized.source,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected,
    (CAST('0x' || substr(md5(concat_ws('|', 'mix-1', coalesce(CAST(doc_id AS VARCHAR), 'null'), CAST(size AS VARCHAR))), 1, 12) AS BIGINT)
      + 0.5e0) / 281474976710656e0 AS u
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, CAST(floor(expected) AS BIGINT) AS whole, expected - floor(expected) AS p FROM drawn
), odds AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM ranked
), cut AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS need,
    coalesce(sum(CASE WHEN q IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY q, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM odds
)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN q IS NOT NULL AND before + size / 2 <= need THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM cut
"""


@query("op2_mixing", MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ \t-\r]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), both_of AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM both_of JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, low.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) low USING (doc_id)
"""


@query("op4_ngram_join", JACCARD_SQL)
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query("op6_suffix_array")
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = simhash.fingerprints(table(spark, sf_dir, "documents"))
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", simhash.as_hex(F.col("fp")).alias("fingerprint"),
        simhash.as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        simhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


@query("op8_hilbert_shards")
def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index")


QUALITY_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines,
    row_number() OVER () AS r
  FROM documents
), grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), again AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t-\\r]*$'))) AS n_ellipsis,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[ \\t-\\r]*[-*•]'))) AS n_bullets,
    len(list_intersect(list_distinct(w), {stop})) AS n_stop
  FROM d LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.2e0 AND n_stop >= 2
  AND (n_lines = 0 OR (n_dup_lines / n_lines <= 0.5e0 AND n_ellipsis / n_lines <= 0.5e0 AND n_bullets / n_lines <= 0.9e0)) AS kept
FROM judged
""".replace("{stop}", "[" + ", ".join(f"'{form}'" for s in quality.STOP_WORDS for form in (s, s.capitalize())) + "]")


@query("op9_quality_rules", QUALITY_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_suffix_trees")
def op10_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op11_simhash_near")
def op11_simhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_groups(table(spark, sf_dir, "documents")).withColumn(
        "fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


RESAMPLE_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i, 0 AS k, i AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS c FROM steps WHERE k = 8
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), f AS (
  SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM d) GROUP BY r, w
), h AS (
  SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM f UNION SELECT w FROM b)
), buckets AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
    lambda a, y: xor(crc.c[(xor(a, y) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket FROM h, crc
), s AS (
  SELECT bucket, sum(n) AS s FROM f JOIN buckets USING (w) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS t FROM b JOIN buckets USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)
    / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000))))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)
), weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(gain * n)::DOUBLE / sum(n))::BIGINT AS weight FROM f JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8) AS BIGINT) + 0.5e0) / 4294967296e0)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)
), placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) END AS place,
    count(*) FILTER (WHERE n_words >= 20) OVER () AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank FROM placed
"""


@query("op12_importance_resampling", RESAMPLE_SQL)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query("op13_cross_tokenizer")
def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstokens.cross_alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
