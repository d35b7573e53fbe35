"""The p-queries of the operators in this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import bpe, langid, leaks, mojibake, neardup, quality, runs, sampling


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return sampling.report(table(spark, d, "audio_urls"), table(spark, d, "sample_targets")).where("deficit > 0").select("plan_id", "target_id")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.report(table(spark, d, "audio_urls"), table(spark, d, "sample_targets"))
    return out.select("plan_id", "target_id", "items", "sample_size", "needed", "observed", "drawn", "deficit")


def p2_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.draw(table(spark, d, "audio_urls"), table(spark, d, "sample_targets"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_restored(spark, d).select("id", "field_name")


def p3_restored(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.find_damaged(table(spark, d, "audio_urls"), ["title", "author"], letters=mojibake.letters_of(table(spark, d, "lang_samples")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return runs.collapse(table(spark, d, "cues")).select("track_id", "first_pos", "last_pos")


def p4_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.collapse(table(spark, d, "cues"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.all_pairs(*neardup.near_duplicates(table(spark, d, "audio_urls")))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "audio_urls"))[0]


def _judged(spark: SparkSession, d: str) -> DataFrame:
    model = langid.fitted(table(spark, d, "lang_samples"))
    urls = table(spark, d, "audio_urls").select(F.col("id").cast("string").alias("record_key"), "description", "language")
    items = table(spark, d, "bilibili_sources").select(F.col("bvid").alias("record_key"), F.when(F.try_parse_json("candidate_metadata").isNotNull(), F.get_json_object("candidate_metadata", "$.intro")).alias("description"), F.col("content_language").alias("language"))
    both = urls.withColumn("record_table", F.lit("audio_urls")).unionByName(items.withColumn("record_table", F.lit("bilibili_sources")))
    return langid.segments(both, model, ["record_table", "record_key"], "description", "language")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.mislabelled(_judged(spark, d)).select("record_table", "record_key", "lang_code").distinct()


def p6_languages(spark: SparkSession, d: str) -> DataFrame:
    return _judged(spark, d)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_spans(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _described(spark: SparkSession, d: str) -> DataFrame:
    common, pairs = quality.common_words(table(spark, d, "common_words")), quality.sample_pairs(table(spark, d, "lang_samples"))
    return quality.describe(table(spark, d, "documents"), common, pairs)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _described(spark, d).where("text_kind <> 'prose'").select("doc_id", "text_kind")


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _described(spark, d)


_P2 = """
WITH i AS (SELECT DISTINCT source_id AS item, category, source, language FROM audio_urls WHERE source_id IS NOT NULL AND trim(source_id) <> ''),
n AS (SELECT count(DISTINCT item) AS items FROM i),
o AS (SELECT t.plan_id, t.target_id, count(DISTINCT i.item) AS observed FROM sample_targets t LEFT JOIN i
      ON (t.category = '*' OR t.category = i.category) AND (t.source = '*' OR t.source = i.source) AND (t.language = '*' OR t.language = i.language) GROUP BY 1, 2),
w AS (SELECT t.plan_id, t.target_id, n.items, CAST(t.sample_bp AS BIGINT) * n.items // 10000 AS sample_size,
      greatest(CAST(t.min_rows AS BIGINT), CAST(t.share_bp AS BIGINT) * (CAST(t.sample_bp AS BIGINT) * n.items // 10000) // 10000) AS needed FROM sample_targets t, n)
SELECT {columns} FROM w JOIN o USING (plan_id, target_id) {where}
"""

# The windows of the items and of the documents written out and joined: the brute-force form of the search.
_P9 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(regexp_replace(lower(regexp_replace(text, '<[^>]*>', ' ', 'g')), '([\x{3040}-\x{30FF}\x{3400}-\x{9FFF}])', ' \1 ', 'g'), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, CASE WHEN lang IN ('zh', 'ja') THEN 30 ELSE 12 END AS n, regexp_extract_all(regexp_replace(lower(item_text), '([\x{3040}-\x{30FF}\x{3400}-\x{9FFF}])', ' \1 ', 'g'), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE item_text IS NOT NULL),
q AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM i)),
t AS (SELECT DISTINCT doc_id, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT d.*, unnest([12, 30]) AS n FROM d)))
SELECT DISTINCT doc_id, item_id FROM t JOIN q USING (n, g)
"""

QUERIES = {
    f.__name__: f
    for f in (p2_found, p2_report, p2_sample, p3_found, p3_restored, p4_found, p4_runs, p5_found, p5_classes, p6_found, p6_languages, p8_ids, p9_found, p9_spans, p10_found, p10_statistics)
}
SQL = {
    "p9_found": _P9,
    "p2_found": _P2.format(columns="plan_id, target_id", where="WHERE observed < needed"),
    "p2_report": _P2.format(columns="plan_id, target_id, items, sample_size, needed, observed, least(needed, observed) AS drawn, needed - least(needed, observed) AS deficit", where=""),
}
