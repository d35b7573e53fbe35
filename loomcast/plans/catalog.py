"""Queries of the engine's operators over the test tables, each beside its SQL.

`audio_urls` is the queue, `bilibili_sources` the manifest, `feed_registry` the feeds, `cues` the captions, `documents` the bundles' texts. Every query runs over its whole tables; limits stand
only where they are the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import documents, language, scalars, text, urls
from ..operators import filters, identity, sequences
from ..session import table
from ..sources import feeds, manifests

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _queue(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "audio_urls")


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


# --- filters, first rows of groups, ordering -----------------------------------------------------------------------------------------


@query("""SELECT id, source, status, published_at FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY id) AS rn FROM audio_urls
WHERE status = 'pending' AND artifact_kind = 'audio' AND coalesce(source, '') <> '' AND published_at >= '2022' AND published_at < '2025-07-01') WHERE rn <= 20""")
def pending_per_source(spark, d):
    rows = _queue(spark, d).where(filters.queue_filter("pending", published_since="2022", published_before="2025-06-30", artifact_kind="audio"))
    return filters.first_per_group(rows, "source", 20).select("id", "source", "status", "published_at")


@query("""SELECT id, category, title FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS rn FROM audio_urls WHERE status = 'pending' AND coalesce(category, '') <> '') WHERE rn <= 5""")
def pending_per_category(spark, d):
    return filters.first_per_group(_queue(spark, d).where(filters.queue_filter("pending")), "category", 5).select("id", "category", "title")


@query("SELECT id, url FROM audio_urls WHERE status = 'pending' ORDER BY id LIMIT 50")
def pending_plain(spark, d):
    return _queue(spark, d).where(filters.queue_filter("pending")).orderBy("id").limit(50).select("id", "url")


@query("SELECT id, published_at FROM audio_urls WHERE status = 'done' AND published_at >= '2023-01-01' AND published_at < '2023-07-01'")
def date_range_inclusive(spark, d):
    return _queue(spark, d).where(filters.queue_filter("done", published_since="2023-01-01", published_before="2023-06-30")).select("id", "published_at")


@query("SELECT id, published_at FROM audio_urls WHERE status = 'done' AND published_at >= '2023-01-01' AND published_at <= '2023-06-30'")
def viewer_date_range(spark, d):
    return _queue(spark, d).where(filters.viewer_filter("2023-01-01", "2023-06-30", status="done")).select("id", "published_at")


@query("SELECT id, CASE WHEN json_valid(metadata_json) THEN coalesce(json_extract_string(metadata_json, '$.provenance.source'), json_extract_string(metadata_json, '$.text_source'), '') ELSE '' END AS origin FROM audio_urls WHERE CASE WHEN json_valid(metadata_json) THEN coalesce(json_extract_string(metadata_json, '$.provenance.source'), json_extract_string(metadata_json, '$.text_source'), '') ELSE '' END IN ('youtube', 'page')")
def json_path_filter(spark, d):
    origin = scalars.json_text(F.col("metadata_json"), "$.provenance.source", "$.text_source")
    valid = F.try_parse_json("metadata_json").isNotNull()
    return _queue(spark, d).withColumn("origin", F.when(valid, origin).otherwise("")).where(F.col("origin").isin("youtube", "page")).select("id", "origin")


@query("SELECT id, url, source_id FROM audio_urls WHERE id = 77")
def point_lookup(spark, d):
    return _queue(spark, d).where("id = 77").select("id", "url", "source_id")


@query("SELECT feed_url, podcast_name FROM feed_registry WHERE lower(coalesce(regexp_extract(feed_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)', 1), '')) NOT IN ('feeds.lumuru.example', 'feeds.nemtal.example')")
def host_exclusion(spark, d):
    return filters.without_hosts(table(spark, d, "feed_registry"), "feed_url", ["feeds.LUMURU.example", " feeds.nemtal.example", ""]).select("feed_url", "podcast_name")


@query("SELECT id, title, duration FROM audio_urls WHERE (contains(title, 'history') OR contains(title, 'future')) AND NOT contains(title, 'chess') AND duration BETWEEN 300 AND 1800")
def title_and_duration(spark, d):
    return _queue(spark, d).where(filters.titled(F.col("title"), ["history", "future"], ["chess"]) & F.col("duration").between(300, 1800)).select("id", "title", "duration")


@query("SELECT id, source_id FROM audio_urls WHERE starts_with(source_id, 'po-00')")
def literal_prefix(spark, d):
    return _queue(spark, d).where(F.col("source_id").startswith("po-00")).select("id", "source_id")


@query("SELECT id, published_at FROM audio_urls WHERE starts_with(published_at, '2022-03')")
def month_rows(spark, d):
    return _queue(spark, d).where(F.col("published_at").startswith("2022-03")).select("id", "published_at")


@query("SELECT id, local_path FROM audio_urls WHERE status = 'done' AND coalesce(local_path, '') <> '' AND local_path NOT ILIKE 'dup:%'")
def kept_rows(spark, d):
    return _queue(spark, d).where(filters.kept()).select("id", "local_path")


@query("SELECT id, source FROM audio_urls WHERE coalesce(metadata_json, '') = ''")
def missing_metadata(spark, d):
    return _queue(spark, d).where(_text("metadata_json") == "").select("id", "source")


@query("SELECT id, file_format FROM audio_urls WHERE lower(coalesce(file_format, '')) IN ('mp3', 'm4a', 'aac', 'ogg', 'opus', 'wav') OR contains(coalesce(file_format, ''), 'audio')")
def media_type_filter(spark, d):
    f = _text("file_format")
    return _queue(spark, d).where(F.lower(f).isin(*feeds.AUDIO_EXTENSIONS) | F.contains(f, F.lit("audio"))).select("id", "file_format")


# Least and greatest seconds of each profile, both within.
PROFILES = {"youtube_interviews": (1530.0, 3636.0), "youtube_screen_clips": (0.418, 29.888), "youtube_screen_parents": (0.418, 14400.0), "youtube_conference_forums": (300.0, 14400.0)}


@query("SELECT p.profile, count(*) AS n_rows, sum(CAST(a.duration AS DECIMAL(18, 3))) AS seconds FROM audio_urls a JOIN (VALUES ('youtube_interviews', 1530.0, 3636.0), ('youtube_screen_clips', 0.418, 29.888), ('youtube_screen_parents', 0.418, 14400.0), ('youtube_conference_forums', 300.0, 14400.0)) p(profile, lo, hi) ON a.duration BETWEEN CAST(p.lo AS DOUBLE) AND CAST(p.hi AS DOUBLE) GROUP BY 1")
def duration_profiles(spark, d):
    """A duration is in each profile whose bounds it keeps, so profiles overlap: a fixed array for each row, no join."""
    fits = F.filter(F.array(*[F.struct(F.lit(n).alias("profile"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for n, (lo, hi) in PROFILES.items()]), lambda p: F.col("duration").between(p["lo"], p["hi"]))
    rows = _queue(spark, d).select("duration", F.explode(F.transform(fits, lambda p: p["profile"])).alias("profile"))
    return rows.groupBy("profile").agg(F.count("*").alias("n_rows"), F.sum(F.col("duration").cast("decimal(18,3)")).cast("decimal(38,3)").alias("seconds"))


@query("SELECT id, job_key FROM audio_urls WHERE source = 'youtube' AND artifact_kind = 'video_bundle' AND language = 'en' AND id BETWEEN 100 AND 5000 AND job_key IN (SELECT job_key FROM audio_urls WHERE status = 'failed' AND job_key <> '')")
def exact_scope(spark, d):
    a = _queue(spark, d)
    keys = a.where("status = 'failed' and job_key <> ''").select("job_key").distinct()
    scope = filters.queue_filter(source="youtube", artifact_kind="video_bundle", language="en") & F.col("id").between(100, 5000)
    return a.where(scope).join(keys, "job_key", "left_semi").select("id", "job_key")


@query("SELECT id, job_key FROM audio_urls WHERE source = 'youtube' AND artifact_kind = 'video_bundle' AND language = 'en' AND job_key IN (SELECT job_key FROM audio_urls WHERE status = 'failed' AND job_key <> '')")
def whole_scope(spark, d):
    """As `exact_scope`, over all ids."""
    a = _queue(spark, d)
    keys = a.where("status = 'failed' and job_key <> ''").select("job_key").distinct()
    return a.where(filters.queue_filter(source="youtube", artifact_kind="video_bundle", language="en")).join(keys, "job_key", "left_semi").select("id", "job_key")


@query("SELECT bvid FROM (SELECT DISTINCT bvid FROM bilibili_sources WHERE coalesce(bvid, '') <> '') b WHERE EXISTS (SELECT 1 FROM audio_urls a WHERE a.source_id = b.bvid)")
def known_items(spark, d):
    return filters.present(table(spark, d, "bilibili_sources").select("bvid").distinct(), _queue(spark, d).select(F.col("source_id").alias("bvid")), "bvid")


@query("SELECT id, url FROM audio_urls WHERE status = 'failed' AND source = 'bilibili' ORDER BY id LIMIT 50")
def failed_rows(spark, d):
    return _queue(spark, d).where(filters.queue_filter("failed", source="bilibili")).orderBy("id").limit(50).select("id", "url")


@query("SELECT id, downloaded_at FROM audio_urls WHERE status = 'done' AND local_path NOT ILIKE 'dup:%' ORDER BY downloaded_at DESC, id DESC LIMIT 20")
def recent_kept(spark, d):
    rows = _queue(spark, d).where((F.col("status") == "done") & ~F.col("local_path").ilike("dup:%"))
    return rows.orderBy(F.col("downloaded_at").desc_nulls_last(), F.col("id").desc()).limit(20).select("id", "downloaded_at")


@query("SELECT id, published_at FROM audio_urls WHERE published_at >= '2024' ORDER BY published_at DESC, id DESC LIMIT 30")
def ordered_by_filter(spark, d):
    return _queue(spark, d).where("published_at >= '2024'").orderBy(F.desc("published_at"), F.desc("id")).limit(30).select("id", "published_at")


@query("SELECT DISTINCT category FROM audio_urls WHERE coalesce(category, '') <> ''")
def distinct_categories(spark, d):
    return _queue(spark, d).where(_text("category") != "").select("category").distinct()


@query("SELECT source, feed_no, id FROM (SELECT source, id, row_number() OVER (PARTITION BY source, category ORDER BY id) AS feed_no FROM audio_urls WHERE source IS NOT NULL AND category IS NOT NULL) WHERE feed_no <= 3")
def capped_per_feed(spark, d):
    rows = _queue(spark, d).where("source is not null and category is not null")
    return rows.withColumn("feed_no", F.row_number().over(Window.partitionBy("source", "category").orderBy("id")).cast("long")).where("feed_no <= 3").select("source", "feed_no", "id")


@query("SELECT bvid, batch_id, array_to_string(list_distinct_in_order, ',') AS wanted FROM (SELECT bvid, batch_id, list_filter(languages, lambda x, i: list_position(languages, x) = i) AS list_distinct_in_order FROM bilibili_sources WHERE languages IS NOT NULL)")
def first_occurrences(spark, d):
    return table(spark, d, "bilibili_sources").where("languages is not null").select("bvid", "batch_id", F.array_join(F.array_distinct("languages"), ",").alias("wanted"))


# --- aggregates ----------------------------------------------------------------------------------------------------------------------


@query("SELECT status, count(*) AS n_rows FROM audio_urls GROUP BY ROLLUP (status)")
def status_rollup(spark, d):
    return _queue(spark, d).rollup("status").agg(F.count("*").alias("n_rows"))


@query("SELECT source, artifact_kind, status, count(*) AS n_rows FROM audio_urls GROUP BY GROUPING SETS ((source, status), (artifact_kind, status), (status))")
def status_counts_by_dimension(spark, d):
    rows = _queue(spark, d).select("source", "artifact_kind", "status")
    return rows.groupingSets([["source", "status"], ["artifact_kind", "status"], ["status"]], "source", "artifact_kind", "status").agg(F.count("*").alias("n_rows")).select("source", "artifact_kind", "status", "n_rows")


@query("SELECT dim, key, n_rows FROM (SELECT 'source' AS dim, source AS key, count(*) AS n_rows FROM audio_urls GROUP BY 2 UNION ALL SELECT 'category', category, count(*) FROM audio_urls WHERE coalesce(category, '') <> '' GROUP BY 2 UNION ALL SELECT 'language', language, count(*) FROM audio_urls WHERE coalesce(language, '') <> '' GROUP BY 2 UNION ALL SELECT 'file_format', file_format, count(*) FROM audio_urls GROUP BY 2 UNION ALL SELECT 'artifact_kind', artifact_kind, count(*) FROM audio_urls GROUP BY 2)")
def overview(spark, d):
    dims = ["source", "category", "language", "file_format", "artifact_kind"]
    long = _queue(spark, d).select(F.inline(F.array(*[F.struct(F.lit(c).alias("dim"), F.col(c).alias("key")) for c in dims])))
    return long.where(~F.col("dim").isin("category", "language") | (_text("key") != "")).groupBy("dim", "key").agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (title <> '') AS with_title, count(*) FILTER (description <> '') AS with_description, count(*) FILTER (author <> '') AS with_author, count(*) FILTER (cover_url <> '') AS with_cover, count(*) FILTER (published_at <> '') AS with_date FROM audio_urls")
def coverage_flags(spark, d):
    has = {"with_title": "title", "with_description": "description", "with_author": "author", "with_cover": "cover_url", "with_date": "published_at"}
    return _queue(spark, d).agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c) != "").alias(n) for n, c in has.items()])


@query("SELECT count(*) FILTER (coalesce(published_at, '') <> '') AS filled, count(*) FILTER (coalesce(published_at, '') = '') AS empty, min(nullif(published_at, '')) AS first, max(nullif(published_at, '')) AS last FROM audio_urls")
def published_stats(spark, d):
    p = F.nullif(F.col("published_at"), F.lit(""))
    return _queue(spark, d).agg(F.count_if(p.isNotNull()).alias("filled"), F.count_if(p.isNull()).alias("empty"), F.min(p).alias("first"), F.max(p).alias("last"))


@query("SELECT substr(published_at, 1, 7) AS month, count(*) AS n_rows FROM audio_urls WHERE regexp_matches(published_at, '^\\d{4}-\\d{2}') GROUP BY 1")
def month_histogram(spark, d):
    return _queue(spark, d).where(F.col("published_at").rlike(r"^\d{4}-\d{2}")).groupBy(F.substring("published_at", 1, 7).alias("month")).agg(F.count("*").alias("n_rows"))


@query("SELECT coalesce(sum(CAST(duration AS DECIMAL(18, 3))) FILTER (status = 'pending'), 0) AS pending_s, coalesce(sum(CAST(duration AS DECIMAL(18, 3))) FILTER (status = 'done'), 0) AS done_s, coalesce(sum(CAST(duration AS DECIMAL(18, 3))), 0) AS all_s, count(*) FILTER (duration > 0) AS n_known FROM audio_urls")
def duration_totals(spark, d):
    s = F.col("duration").cast("decimal(18,3)")
    total = lambda c, n: F.coalesce(F.sum(F.when(c, s)), F.lit(0)).cast("decimal(38,3)").alias(n)
    return _queue(spark, d).agg(total(F.col("status") == "pending", "pending_s"), total(F.col("status") == "done", "done_s"), total(F.lit(True), "all_s"), F.count_if(F.col("duration") > 0).alias("n_known"))


@query("SELECT coalesce(nullif(category, ''), '(none)') AS category, count(*) AS n_rows, sum(CAST(duration AS DECIMAL(18, 3))) AS seconds, CAST(sum(file_size) AS BIGINT) AS bytes FROM audio_urls GROUP BY 1")
def category_summary(spark, d):
    c = F.coalesce(F.nullif("category", F.lit("")), F.lit("(none)")).alias("category")
    return _queue(spark, d).groupBy(c).agg(F.count("*").alias("n_rows"), F.sum(F.col("duration").cast("decimal(18,3)")).cast("decimal(38,3)").alias("seconds"), F.sum("file_size").alias("bytes"))


@query("SELECT source, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'failed') AS failed FROM audio_urls WHERE category = 'interview' GROUP BY 1")
def category_detail(spark, d):
    return _queue(spark, d).where("category = 'interview'").groupBy("source").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("pending", "done", "failed")])


@query("SELECT speaker, count(*) AS n_rows FROM audio_urls WHERE coalesce(speaker, '') <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_speakers(spark, d):
    return _queue(spark, d).where(_text("speaker") != "").groupBy("speaker").agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "speaker").limit(10)


_COVERAGE = """WITH r AS (SELECT source, coalesce(description, '') <> '' AS d, coalesce(author, '') <> '' AS a, coalesce(cover_url, '') <> '' AS c, coalesce(webpage_url, '') <> '' AS w,
CASE WHEN json_valid(metadata_json) THEN coalesce(json_type(metadata_json) = 'OBJECT' AND len(json_keys(metadata_json)) > 0, false) ELSE false END AS m,
CASE WHEN json_valid(metadata_json) THEN coalesce(json_type(metadata_json, '$.source_data') = 'OBJECT' AND len(list_filter(json_extract(metadata_json, '$.source_data.*'), lambda x: CAST(x AS VARCHAR) NOT IN ('""', '0', '0.0', 'false', 'null', '[]', '{}'))) > 0, false) ELSE false END AS s,
CASE WHEN json_valid(metadata_json) THEN coalesce(json_extract_string(metadata_json, '$.transcript_status'), 'unknown') ELSE 'unknown' END AS t FROM audio_urls)
"""


def _coverage(spark, d):
    # Parsed once: a column that is used more than once isn't folded into its uses.
    queue, v = _queue(spark, d).withColumn("_v", F.try_parse_json("metadata_json")), F.col("_v")
    object_at = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith("OBJECT"), F.lit(False))
    keys = F.size(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")))
    values = F.map_values(F.try_variant_get(v, "$.source_data", "map<string,variant>"))
    some = object_at("$.source_data") & F.coalesce(F.exists(values, lambda x: scalars.truthy(F.to_json(x))), F.lit(False))
    flags = [(_text(c) != "").alias(n) for n, c in (("d", "description"), ("a", "author"), ("c", "cover_url"), ("w", "webpage_url"))]
    status = F.coalesce(F.try_variant_get(v, "$.transcript_status", "string"), F.lit("unknown"))
    return queue.select("source", *flags, (object_at("$") & (keys > 0)).alias("m"), some.alias("s"), F.when(v.isNotNull(), status).otherwise("unknown").alias("t"))


@query(_COVERAGE + """SELECT source, count(*) AS n_rows, count(*) FILTER (m) AS with_metadata, count(*) FILTER (m AND s AND d::INT + a::INT + c::INT + w::INT >= 3) AS rich, count(*) FILTER (m AND NOT (s AND d::INT + a::INT + c::INT + w::INT >= 3)) AS partial,
count(*) FILTER (NOT m) AS unresolved, count(*) FILTER (d) AS description, count(*) FILTER (a) AS author, count(*) FILTER (c) AS cover_url, count(*) FILTER (w) AS webpage_url FROM r GROUP BY GROUPING SETS ((source), ())""")
def metadata_coverage(spark, d):
    """Rich is a record with any truthy value in source_data and three of four fields; a record without metadata, or with an empty one, is unresolved."""
    rows = _coverage(spark, d).withColumn("rich", F.expr("m and s and int(d) + int(a) + int(c) + int(w) >= 3"))
    n = lambda c, name: F.count_if(c).alias(name)
    c = F.col
    counts = [n(c("m"), "with_metadata"), n(c("rich"), "rich"), n(c("m") & ~c("rich"), "partial"), n(~c("m"), "unresolved"), n(c("d"), "description"), n(c("a"), "author"), n(c("c"), "cover_url"), n(c("w"), "webpage_url")]
    return rows.groupingSets([["source"], []], "source").agg(F.count("*").alias("n_rows"), *counts).select("source", "n_rows", "with_metadata", "rich", "partial", "unresolved", "description", "author", "cover_url", "webpage_url")


@query(_COVERAGE + "SELECT source, t AS transcript_status, count(*) AS n_rows FROM r WHERE m GROUP BY GROUPING SETS ((source, t), (t))")
def transcript_states(spark, d):
    rows = _coverage(spark, d).where("m").select("source", F.col("t").alias("transcript_status"))
    return rows.groupingSets([["source", "transcript_status"], ["transcript_status"]], "source", "transcript_status").agg(F.count("*").alias("n_rows")).select("source", "transcript_status", "n_rows")


_CELLS = """SELECT s.source, c.category, coalesce(n.n_rows, 0) AS n_rows, coalesce(n.done, 0) AS done FROM (SELECT DISTINCT source FROM audio_urls WHERE source IS NOT NULL) s CROSS JOIN (SELECT DISTINCT category FROM sample_targets WHERE category <> '*') c
LEFT JOIN (SELECT source, category, count(*) AS n_rows, count(*) FILTER (status = 'done') AS done FROM audio_urls GROUP BY 1, 2) n USING (source, category)"""


@query(_CELLS)
def quota_cells(spark, d):
    a = _queue(spark, d)
    counts = a.groupBy("source", "category").agg(F.count("*").alias("n_rows"), F.count_if(F.col("status") == "done").alias("done"))
    wanted = sorted(r[0] for r in table(spark, d, "sample_targets").where("category <> '*'").select("category").distinct().limit(1001).collect())
    if len(wanted) > 1000:
        raise ValueError("more than 1000 wanted categories")
    # The grid of two small dimensions: the wanted categories (a stated bound) are a literal array, so nothing is joined without keys.
    grid = a.where("source is not null").select("source").distinct().select("source", F.explode(F.array(*map(F.lit, wanted)).cast("array<string>")).alias("category"))
    return grid.join(counts, ["source", "category"], "left").select("source", "category", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("done", F.lit(0)).alias("done"))


@query("SELECT c.category, c.n_rows, t.wanted, c.n_rows = t.wanted AS equal FROM (SELECT category, count(DISTINCT source_id) AS n_rows FROM audio_urls GROUP BY 1) c JOIN (SELECT category, CAST(sum(share_bp) AS BIGINT) AS wanted FROM sample_targets WHERE category <> '*' GROUP BY 1) t USING (category)")
def quota_equality(spark, d):
    have = _queue(spark, d).select("category", "source_id").distinct().groupBy("category").agg(F.count("source_id").alias("n_rows"))
    want = table(spark, d, "sample_targets").where("category <> '*'").groupBy("category").agg(F.sum("share_bp").alias("wanted"))
    return have.join(want, "category").withColumn("equal", F.col("n_rows") == F.col("wanted"))


@query("SELECT batch_id, sha256(string_agg(bvid, chr(10) ORDER BY bvid)) AS fingerprint FROM (SELECT DISTINCT batch_id, bvid FROM bilibili_sources WHERE bvid IS NOT NULL) GROUP BY 1")
def id_fingerprint(spark, d):
    """Of batches, whose size the manifest bounds; `id_digests` is for sets of any size."""
    return table(spark, d, "bilibili_sources").where("bvid is not null").groupBy("batch_id").agg(scalars.set_fingerprint(F.col("bvid")).alias("fingerprint"))


@query("SELECT source, count(*) AS n_ids, CAST(sum(CAST(h AS HUGEINT)) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor FROM (SELECT DISTINCT source, source_id, CAST('0x' || substr(sha256(source_id), 1, 15) AS BIGINT) AS h FROM audio_urls WHERE source_id IS NOT NULL) GROUP BY 1")
def id_digests(spark, d):
    n, total, xor = scalars.set_digest(F.col("source_id"))
    return _queue(spark, d).where("source_id is not null").select("source", "source_id").distinct().groupBy("source").agg(n.alias("n_ids"), total.alias("hash_sum"), xor.alias("hash_xor"))


@query("SELECT dim, value, count(*) AS n_rows FROM (SELECT unnest(['profile', 'content_kind', 'dataset_category', 'speaker_count_status', 'rights', 'ai']) AS dim, unnest([coalesce(nullif(profile, ''), 'unknown'), coalesce(nullif(content_kind, ''), 'unknown'), coalesce(nullif(dataset_category, ''), 'unknown'), coalesce(nullif(speaker_count_status, ''), 'unknown'), coalesce(nullif(rights.status, ''), 'unknown'), coalesce(nullif(ai_generation.status, ''), 'unknown')]) AS value FROM bilibili_sources) GROUP BY 1, 2")
def long_histograms(spark, d):
    dims = {"profile": "profile", "content_kind": "content_kind", "dataset_category": "dataset_category", "speaker_count_status": "speaker_count_status", "rights": "rights.status", "ai": "ai_generation.status"}
    pairs = F.array(*[F.struct(F.lit(n).alias("dim"), F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias("value")) for n, c in dims.items()])
    return table(spark, d, "bilibili_sources").select(F.inline(pairs)).groupBy("dim", "value").agg(F.count("*").alias("n_rows"))


@query("SELECT counter, count(*) AS n_rows FROM (SELECT unnest(['language:' || coalesce(content_language, ''), 'kind:' || coalesce(content_kind, '')]) AS counter FROM bilibili_sources) GROUP BY 1")
def namespaced_counts(spark, d):
    keys = F.array(F.concat(F.lit("language:"), _text("content_language")), F.concat(F.lit("kind:"), _text("content_kind")))
    return table(spark, d, "bilibili_sources").select(F.explode(keys).alias("counter")).groupBy("counter").agg(F.count("*").alias("n_rows"))


@query("SELECT lan, count(*) AS n_cues, round(CAST(sum(CAST(cue_end - cue_start AS DECIMAL(18, 3))) AS DOUBLE) / count(*), 6) AS mean_s, round(min(cue_end - cue_start), 6) AS shortest, round(max(cue_end - cue_start), 6) AS longest FROM cues GROUP BY 1")
def clip_statistics(spark, d):
    s = F.col("cue_end") - F.col("cue_start")
    return table(spark, d, "cues").groupBy("lan").agg(
        F.count("*").alias("n_cues"), F.round(F.sum(s.cast("decimal(18,3)")).cast("double") / F.count("*"), 6).alias("mean_s"), F.round(F.min(s), 6).alias("shortest"), F.round(F.max(s), 6).alias("longest")
    )


@query("SELECT coalesce(nullif(split_part(discovered_via, ':', 1), ''), 'unknown') AS channel, count(*) AS n_feeds, count(*) FILTER (coalesce(last_crawled, '') <> '') AS crawled, CAST(sum(coalesce(episode_count, 0)) AS BIGINT) AS episodes FROM feed_registry GROUP BY 1")
def feed_channels(spark, d):
    channel = F.coalesce(F.nullif(F.split_part("discovered_via", F.lit(":"), F.lit(1)), F.lit("")), F.lit("unknown")).alias("channel")
    return table(spark, d, "feed_registry").groupBy(channel).agg(F.count("*").alias("n_feeds"), F.count_if(_text("last_crawled") != "").alias("crawled"), F.sum(F.coalesce("episode_count", F.lit(0))).alias("episodes"))


@query("SELECT lan, arg_min(text, struct_pack(a := -n, b := text)) AS representative, max(n) AS n_seen FROM (SELECT lan, text, count(*) AS n FROM cues WHERE coalesce(trim(text), '') <> '' GROUP BY 1, 2) GROUP BY 1")
def representative_texts(spark, d):
    counts = table(spark, d, "cues").where(F.coalesce(F.trim("text"), F.lit("")) != "").groupBy("lan", "text").agg(F.count("*").alias("n"))
    return counts.groupBy("lan").agg(F.min_by("text", F.struct(-F.col("n"), "text")).alias("representative"), F.max("n").alias("n_seen"))


@query("SELECT file_format, count(*) AS n_files, CAST(sum(file_size) AS BIGINT) AS bytes FROM audio_urls WHERE local_path <> '' AND local_path NOT LIKE '%.tmp' GROUP BY 1")
def disk_totals(spark, d):
    return _queue(spark, d).where("local_path <> '' and local_path not like '%.tmp'").groupBy("file_format").agg(F.count("*").alias("n_files"), F.sum("file_size").alias("bytes"))


@query("SELECT id, source_id, parent_no FROM (SELECT id, source_id, dense_rank() OVER (PARTITION BY source ORDER BY first_id) AS parent_no FROM (SELECT id, source, source_id, min(id) OVER (PARTITION BY source, source_id) AS first_id FROM audio_urls WHERE status = 'pending' AND source_id IS NOT NULL AND source IS NOT NULL)) WHERE parent_no <= 25")
def parents_capped(spark, d):
    rows = _queue(spark, d).where("status = 'pending' and source_id is not null and source is not null").select("id", "source", "source_id")
    parents = rows.groupBy("source", "source_id").agg(F.min("id").alias("first_id"))
    taken = parents.withColumn("parent_no", F.row_number().over(Window.partitionBy("source").orderBy("first_id")).cast("long")).where("parent_no <= 25")
    return rows.join(taken, ["source", "source_id"]).select("id", "source_id", "parent_no")


# --- joins and sets ------------------------------------------------------------------------------------------------------------------


@query("SELECT f.id FROM audio_urls f WHERE f.id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM audio_urls s WHERE s.id % 2 = 0 AND ((coalesce(f.job_key, '') <> '' AND s.job_key = f.job_key AND s.source = f.source AND s.artifact_kind = f.artifact_kind) OR (coalesce(f.job_key, '') = '' AND ((coalesce(s.job_key, '') = '' AND s.url = f.url) OR (coalesce(s.source_id, '') <> '' AND s.source = f.source AND s.source_id = f.source_id AND s.artifact_kind = f.artifact_kind)))))")
def insert_absent(spark, d):
    a = _queue(spark, d)
    return identity.insert_absent(a.where("id % 2 = 1"), a.where("id % 2 = 0")).select("id")


@query("SELECT f.id FROM audio_urls f WHERE f.status IS NOT DISTINCT FROM 'pending' AND NOT EXISTS (SELECT 1 FROM audio_urls s WHERE s.status IS DISTINCT FROM 'pending' AND ((coalesce(f.job_key, '') <> '' AND s.job_key = f.job_key AND s.source = f.source AND s.artifact_kind = f.artifact_kind) OR (coalesce(f.job_key, '') = '' AND ((coalesce(s.job_key, '') = '' AND s.url = f.url) OR (coalesce(s.source_id, '') <> '' AND s.source = f.source AND s.source_id = f.source_id AND s.artifact_kind = f.artifact_kind)))))")
def insert_absent_pending(spark, d):
    """The pending rows are incoming, all others are stored; `insert_absent` splits by the id."""
    a, pending = _queue(spark, d), F.col("status").eqNullSafe("pending")
    return identity.insert_absent(a.where(pending), a.where(~pending)).select("id")


@query("""WITH n AS (SELECT source_id, arg_max(title, id) FILTER (coalesce(title, '') <> '') AS t, arg_max(author, id) FILTER (coalesce(author, '') <> '') AS a FROM audio_urls WHERE id % 2 = 1 GROUP BY 1)
SELECT s.id, coalesce(n.t, s.title) AS title, coalesce(n.a, s.author) AS author FROM audio_urls s LEFT JOIN n USING (source_id) WHERE s.id % 2 = 0""")
def enrich_last_nonempty(spark, d):
    a = _queue(spark, d)
    return identity.enrich(a.where("id % 2 = 0").select("id", "source_id", "title", "author"), a.where("id % 2 = 1"), ["source_id"], ["title", "author"], "id").select("id", "title", "author")


@query("""WITH n AS (SELECT source_id, arg_max(title, id) FILTER (coalesce(title, '') <> '') AS t, arg_max(author, id) FILTER (coalesce(author, '') <> '') AS a FROM audio_urls WHERE status IS NOT DISTINCT FROM 'pending' GROUP BY 1)
SELECT s.id, coalesce(n.t, s.title) AS title, coalesce(n.a, s.author) AS author FROM audio_urls s LEFT JOIN n USING (source_id) WHERE s.status IS DISTINCT FROM 'pending'""")
def enrich_from_pending(spark, d):
    """The pending rows are incoming, all others are stored; `enrich_last_nonempty` splits by the id."""
    a, pending = _queue(spark, d), F.col("status").eqNullSafe("pending")
    return identity.enrich(a.where(~pending).select("id", "source_id", "title", "author"), a.where(pending), ["source_id"], ["title", "author"], "id").select("id", "title", "author")


@query("SELECT bvid, batch_id FROM bilibili_sources b WHERE EXISTS (SELECT 1 FROM audio_urls a WHERE a.source_id = b.bvid) OR EXISTS (SELECT 1 FROM audio_urls a WHERE a.job_key <> '' AND a.job_key = b.bvid || ':p1:' || coalesce(b.content_language, ''))")
def semi_or_match(spark, d):
    b, a = table(spark, d, "bilibili_sources").select("bvid", "batch_id", "content_language"), _queue(spark, d)
    b = b.withColumn("job_key", F.concat("bvid", F.lit(":p1:"), _text("content_language")))
    one = b.join(a.select(F.col("source_id").alias("bvid")).distinct(), "bvid", "left_semi")
    two = b.join(one.select("bvid", "batch_id").distinct(), ["bvid", "batch_id"], "left_anti").join(a.where("job_key <> ''").select("job_key").distinct(), "job_key", "left_semi")
    return one.select("bvid", "batch_id").unionByName(two.select("bvid", "batch_id"))


@query("""WITH h AS (SELECT id, source_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, metadata_json FROM audio_urls), t AS (SELECT host, min(id) AS template_id FROM h WHERE coalesce(metadata_json, '') <> '' GROUP BY 1)
SELECT h.id, h.host, t.template_id FROM h JOIN t USING (host) WHERE coalesce(h.metadata_json, '') = ''""")
def host_fallback(spark, d):
    a = _queue(spark, d).select("id", "metadata_json", urls.host(F.col("url")).alias("host"))
    templates = a.where(_text("metadata_json") != "").groupBy("host").agg(F.min("id").alias("template_id"))
    return a.where(_text("metadata_json") == "").join(templates, "host").select("id", "host", "template_id")


_RECONCILE = """WITH e AS (SELECT bvid, count(*) AS expected FROM (SELECT bvid, unnest(parts) AS part FROM (SELECT DISTINCT bvid, parts FROM bilibili_sources WHERE bvid IS NOT NULL)) GROUP BY 1), q AS (SELECT source_id AS bvid, count(*) AS queued, bool_and(status = 'done') AS all_done FROM audio_urls WHERE source = 'bilibili' AND source_id IS NOT NULL GROUP BY 1)
SELECT bvid, coalesce(expected, 0) AS expected, coalesce(queued, 0) AS queued, CASE WHEN queued IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra' ELSE 'present' END AS state, coalesce(all_done, false) AS all_done FROM e FULL JOIN q USING (bvid)"""


@query(_RECONCILE)
def manifest_reconciliation(spark, d):
    parts = table(spark, d, "bilibili_sources").where("bvid is not null").select("bvid", "parts").distinct()
    expected = parts.select("bvid", F.size(F.coalesce("parts", F.array().cast("array<int>"))).alias("n")).groupBy("bvid").agg(F.sum("n").alias("expected")).where("expected > 0")
    queued = _queue(spark, d).where("source = 'bilibili' and source_id is not null").groupBy(F.col("source_id").alias("bvid")).agg(F.count("*").alias("queued"), F.bool_and(F.col("status") == "done").alias("all_done"))
    state = F.when(F.col("queued").isNull(), "missing").when(F.col("expected").isNull(), "extra").otherwise("present").alias("state")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return expected.join(queued, "bvid", "full_outer").select("bvid", zero("expected"), zero("queued"), state, F.coalesce("all_done", F.lit(False)).alias("all_done"))


@query("SELECT track_id FROM (SELECT DISTINCT track_id, split_part(track_id, ':', 1) AS source FROM cues) c WHERE NOT EXISTS (SELECT 1 FROM feed_registry f WHERE f.source = c.source)")
def orphan_tracks(spark, d):
    tracks = table(spark, d, "cues").select("track_id").distinct().withColumn("source", F.split_part("track_id", F.lit(":"), F.lit(1)))
    return tracks.join(table(spark, d, "feed_registry").select("source").distinct(), "source", "left_anti").select("track_id")


@query("SELECT l.l_orderkey, l.l_linenumber FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderkey IS NULL OR l.l_shipdate < o.o_orderdate")
def child_parent_integrity(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(o, "l_orderkey", "left")
    return joined.where("o_orderdate is null or l_shipdate < o_orderdate").select("l_orderkey", "l_linenumber")


@query("SELECT bvid, part FROM (SELECT DISTINCT bvid, unnest(parts) AS part FROM bilibili_sources WHERE bvid IS NOT NULL) e WHERE NOT EXISTS (SELECT 1 FROM audio_urls a WHERE a.source_id = e.bvid AND a.job_key LIKE '%:p' || e.part || ':%')")
def missing_parts(spark, d):
    expected = table(spark, d, "bilibili_sources").where("bvid is not null").select("bvid", F.explode("parts").alias("part")).distinct()
    found = _queue(spark, d).select(F.col("source_id").alias("bvid"), F.regexp_extract("job_key", r":p(\d+):", 1).try_cast("int").alias("part")).where("part is not null").distinct()
    return expected.join(found, ["bvid", "part"], "left_anti")


@query("SELECT bvid FROM bilibili_sources WHERE batch_id = 'b0000' INTERSECT SELECT bvid FROM bilibili_sources WHERE batch_id <> 'b0000'")
def batch_overlap(spark, d):
    b = table(spark, d, "bilibili_sources")
    return b.where("batch_id = 'b0000'").select("bvid").intersect(b.where("batch_id <> 'b0000'").select("bvid"))


@query("SELECT c.doc_id, c.feed_url, f.podcast_name, f.language AS feed_language FROM documents c LEFT JOIN feed_registry f USING (feed_url)")
def attribute_propagation(spark, d):
    f = table(spark, d, "feed_registry").select("feed_url", "podcast_name", F.col("language").alias("feed_language"))
    return table(spark, d, "documents").select("doc_id", "feed_url").join(f, "feed_url", "left").select("doc_id", "feed_url", "podcast_name", "feed_language")


@query("WITH m AS (SELECT bvid, max_by(max_duration_seconds, batch_id) FILTER (max_duration_seconds IS NOT NULL) AS s FROM bilibili_sources GROUP BY 1) SELECT a.id, CASE WHEN coalesce(a.duration, 0) > 0 THEN a.duration ELSE m.s END AS duration FROM audio_urls a LEFT JOIN m ON a.source_id = m.bvid WHERE a.source = 'bilibili'")
def duration_fill(spark, d):
    m = table(spark, d, "bilibili_sources").where("max_duration_seconds is not null").groupBy(F.col("bvid").alias("source_id")).agg(F.max(F.struct("batch_id", "max_duration_seconds")).alias("x")).select("source_id", F.col("x.max_duration_seconds").alias("s"))
    a = _queue(spark, d).where("source = 'bilibili'").select("id", "source_id", "duration")
    return a.join(m, "source_id", "left").select("id", F.when(F.coalesce("duration", F.lit(0.0)) > 0, F.col("duration")).otherwise(F.col("s")).alias("duration"))


@query("WITH f AS (SELECT content_hash, min(id) AS first FROM audio_urls WHERE status = 'done' AND coalesce(content_hash, '') <> '' GROUP BY 1) SELECT a.id, CASE WHEN f.first IS NOT NULL AND a.id > f.first THEN 'dup:' || a.content_hash ELSE a.local_path END AS kept_path FROM audio_urls a LEFT JOIN f USING (content_hash) WHERE a.status = 'done'")
def content_duplicates(spark, d):
    return identity.mark_content_duplicates(_queue(spark, d).where("status = 'done'").select("id", "content_hash", "local_path"), "content_hash", "id").select("id", "kept_path")


@query("SELECT l_orderkey, l_partkey, count(*) AS need FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2 HAVING count(*) > (SELECT count(*) FROM lineitem x WHERE x.l_orderkey = lineitem.l_orderkey AND x.l_partkey = lineitem.l_partkey AND x.l_linenumber > 3)")
def multiset_containment(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    both = rows.groupBy("l_orderkey", "l_partkey").agg(F.count_if(F.col("l_linenumber") <= 3).alias("need"), F.count_if(F.col("l_linenumber") > 3).alias("have"))
    return both.where("need > have and need > 0").select("l_orderkey", "l_partkey", "need")


@query("SELECT bvid, batch_id, i AS place, parts[i] AS part, languages[i] AS language FROM (SELECT bvid, batch_id, parts, languages, unnest(range(1, least(len(parts), len(languages)) + 1)) AS i FROM bilibili_sources WHERE parts IS NOT NULL AND languages IS NOT NULL)")
def positional_zip(spark, d):
    b = table(spark, d, "bilibili_sources").where("parts is not null and languages is not null")
    n = F.least(F.size("parts"), F.size("languages"))
    pairs = F.when(n > 0, F.arrays_zip(F.slice("parts", F.lit(1), n).alias("part"), F.slice("languages", F.lit(1), n).alias("language")))
    return b.select("bvid", "batch_id", F.posexplode(pairs).alias("i", "p")).select("bvid", "batch_id", (F.col("i") + 1).cast("long").alias("place"), F.col("p.part"), F.col("p.language"))


@query("SELECT a.id, b.batch_id, CAST(regexp_extract(a.job_key, ':p([0-9]+):', 1) AS INT) AS part FROM audio_urls a JOIN bilibili_sources b ON a.source_id = b.bvid WHERE regexp_matches(a.job_key, ':p[0-9]+:') AND list_contains(b.parts, CAST(regexp_extract(a.job_key, ':p([0-9]+):', 1) AS INT))")
def part_id_join(spark, d):
    a = _queue(spark, d).where(F.col("job_key").rlike(r":p\d+:")).select("id", F.col("source_id").alias("bvid"), F.regexp_extract("job_key", r":p(\d+):", 1).cast("int").alias("part"))
    return a.join(table(spark, d, "bilibili_sources").select("bvid", "batch_id", "parts"), "bvid").where(F.array_contains("parts", F.col("part"))).select("id", "batch_id", "part")


@query("SELECT source, count(*) AS n_rows FROM (SELECT source, url AS k FROM audio_urls UNION SELECT source, feed_url FROM feed_registry) GROUP BY 1")
def union_of_sources(spark, d):
    both = _queue(spark, d).select("source", F.col("url").alias("k")).unionByName(table(spark, d, "feed_registry").select("source", F.col("feed_url").alias("k"))).distinct()
    return both.groupBy("source").agg(F.count("*").alias("n_rows"))


@query("SELECT 'missing' AS side, bvid FROM (SELECT bvid FROM bilibili_sources EXCEPT SELECT source_id FROM audio_urls) UNION ALL SELECT 'extra', source_id FROM (SELECT source_id FROM audio_urls WHERE source = 'bilibili' EXCEPT SELECT bvid FROM bilibili_sources)")
def difference_both_ways(spark, d):
    b, a = table(spark, d, "bilibili_sources").select("bvid"), _queue(spark, d)
    missing = b.subtract(a.select(F.col("source_id").alias("bvid"))).withColumn("side", F.lit("missing"))
    extra = a.where("source = 'bilibili'").select(F.col("source_id").alias("bvid")).subtract(b).withColumn("side", F.lit("extra"))
    return missing.unionByName(extra).select("side", "bvid")


@query("SELECT bvid, batch_id, len(list_filter(languages, lambda x: NOT list_contains(['zh', 'zh-CN', 'en'], x))) = 0 AS closed, list_has_any(languages, ['ja', 'en']) AS shares FROM bilibili_sources WHERE languages IS NOT NULL")
def closure_and_overlap(spark, d):
    ref = F.array(*map(F.lit, ("zh", "zh-CN", "en")))
    return table(spark, d, "bilibili_sources").where("languages is not null").select("bvid", "batch_id", (F.size(F.array_except("languages", ref)) == 0).alias("closed"), F.coalesce(F.arrays_overlap("languages", F.array(F.lit("ja"), F.lit("en"))), F.lit(False)).alias("shares"))


@query("SELECT count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows FROM (SELECT source_id, count(*) AS n FROM audio_urls WHERE source_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
def uniqueness_check(spark, d):
    return identity.uniqueness_violations(_queue(spark, d).where("source_id is not null"), ["source_id"]).agg(F.count("*").alias("n_keys"), F.sum("n_rows").alias("n_rows"))


@query("SELECT bvid, arg_max(batch_id, batch_id) AS batch_id FROM bilibili_sources WHERE bvid IS NOT NULL GROUP BY 1")
def latest_by_key(spark, d):
    return identity.latest(table(spark, d, "bilibili_sources").where("bvid is not null").select("bvid", "batch_id", F.col("batch_id").alias("o")), ["bvid"], "o").select("bvid", "batch_id")


@query("""WITH RECURSIVE o AS (SELECT row_number() OVER (ORDER BY id) AS n, id, nullif(coalesce(url, ''), '') AS a, nullif(coalesce(source_id, ''), '') AS b FROM audio_urls),
r AS (SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS id, CAST([] AS VARCHAR[]) AS sa, CAST([] AS VARCHAR[]) AS sb, false AS ok UNION ALL
SELECT n, id, CASE WHEN ok AND a IS NOT NULL THEN list_append(sa, a) ELSE sa END, CASE WHEN ok AND b IS NOT NULL THEN list_append(sb, b) ELSE sb END, ok FROM (SELECT o.n, o.id, o.a, o.b, r.sa, r.sb, NOT coalesce(list_contains(r.sa, o.a), false) AND NOT coalesce(list_contains(r.sb, o.b), false) AS ok FROM r JOIN o ON o.n = r.n + 1))
SELECT id FROM r WHERE ok""")
def sequential_accept(spark, d):
    return identity.sequential_accept(_queue(spark, d), "id", "url", "source_id")


# --- sequences -----------------------------------------------------------------------------------------------------------------------


@query("SELECT track_id, pos, cue_start FROM (SELECT *, lag(cue_start) OVER (PARTITION BY track_id ORDER BY pos) AS b FROM (SELECT DISTINCT track_id, pos, cue_start FROM cues)) WHERE cue_start < b")
def cue_monotone(spark, d):
    rows = table(spark, d, "cues").select("track_id", "pos", "cue_start").distinct()
    return sequences.not_monotone(rows, "track_id", "pos", "cue_start").select("track_id", "pos", "cue_start")


@query("SELECT track_id, pos, text AS kept_text FROM (SELECT *, lag(text) OVER (PARTITION BY track_id ORDER BY pos) AS b FROM (SELECT DISTINCT track_id, track_kind, pos, coalesce(text, '') AS text FROM cues)) WHERE text <> '' AND NOT (track_kind = 'automatic' AND b IS NOT NULL AND b = text) AND NOT contains(text, chr(10)) AND NOT coalesce(contains(b, chr(10)), false)")
def overlap_removal(spark, d):
    rows = table(spark, d, "cues").select("track_id", "track_kind", "pos", _text("text").alias("text")).distinct()
    rows = rows.withColumn("b", F.lag("text").over(Window.partitionBy("track_id").orderBy("pos")))
    out = sequences.remove_rolling(rows, automatic=F.col("track_kind") == "automatic")
    return out.where(~F.contains("text", F.lit("\n")) & ~F.coalesce(F.contains("b", F.lit("\n")), F.lit(False))).select("track_id", "pos", "kept_text")


_ROLLING = """WITH c AS (SELECT DISTINCT track_id, track_kind, pos, string_split(coalesce(text, ''), chr(10)) AS n FROM cues), w AS (SELECT *, lag(n) OVER (PARTITION BY track_id ORDER BY pos) AS b FROM c),
k AS (SELECT *, CASE WHEN track_kind = 'automatic' AND b IS NOT NULL THEN coalesce(list_max(list_filter(range(1, least(len(b), len(n)) + 1), lambda k: b[len(b) - k + 1:len(b)] = n[1:k])), 0) ELSE 0 END AS k FROM w)
SELECT track_id, pos, array_to_string(n[k + 1:len(n)], chr(10)) AS kept_text FROM k WHERE array_to_string(n[k + 1:len(n)], chr(10)) <> ''"""


@query(_ROLLING)
def rolling_captions(spark, d):
    """The overlap removal over all cues; `overlap_removal` has only those without line breaks, as its SQL says."""
    rows = table(spark, d, "cues").select("track_id", "track_kind", "pos", _text("text").alias("text")).distinct()
    return sequences.remove_rolling(rows, automatic=F.col("track_kind") == "automatic").select("track_id", "pos", "kept_text")


@query("""WITH RECURSIVE c AS (SELECT track_id AS t, cue_start AS s, cue_end AS e, text AS x, row_number() OVER (PARTITION BY track_id ORDER BY cue_start, cue_end, text, pos) AS n FROM (SELECT DISTINCT track_id, pos, cue_start, cue_end, text FROM cues) WHERE track_id IS NOT NULL AND coalesce(text, '') <> '' AND cue_end > cue_start AND cue_end - cue_start <= 20.0),
r AS (SELECT t, n, x, s AS b, e AS l, true AS open, 1 AS g FROM c WHERE n = 1 UNION ALL
SELECT t, n, x, CASE WHEN fresh THEN s ELSE b END, CASE WHEN fresh THEN e ELSE greatest(l, e) END, fresh OR NOT greatest(l, e) - b >= 11.5, g + fresh::INT FROM (SELECT c.t, c.n, c.x, c.s, c.e, r.b, r.l, r.g, NOT r.open OR c.s - r.l > 5.0 OR greatest(r.l, c.e) - r.b > 20.0 AS fresh FROM r JOIN c ON c.t = r.t AND c.n = r.n + 1))
SELECT t AS track_id, CAST(g AS BIGINT) AS group_no, min(b) AS group_start, max(l) AS group_end, count(*) AS n_cues, string_agg(x, chr(10) ORDER BY n) AS text FROM r GROUP BY 1, 2 HAVING max(l) - min(b) BETWEEN 3.0 AND 20.0""")
def cue_groups(spark, d):
    rows = table(spark, d, "cues").select("track_id", "pos", "cue_start", "cue_end", "text").distinct()
    return sequences.group_cues(rows, 3.0, 20.0, 11.5, 5.0)


@query("SELECT track_id, CAST(sum(len) OVER w AS BIGINT) AS taken_before, pos FROM (SELECT DISTINCT track_id, pos, length(coalesce(text, '')) AS len FROM cues) WINDOW w AS (PARTITION BY track_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) QUALIFY coalesce(sum(len) OVER w, 0) < 400")
def byte_budget(spark, d):
    rows = table(spark, d, "cues").select("track_id", "pos", F.length(_text("text")).alias("len")).distinct()
    w = Window.partitionBy("track_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return sequences.within_budget(rows, "track_id", "pos", "len", 400).withColumn("taken_before", F.sum("len").over(w)).where("taken").select("track_id", "taken_before", "pos")


@query("SELECT bvid, batch_id, arg_min(l, r) AS best FROM (SELECT bvid, batch_id, l, i, (CASE WHEN l = 'zh-CN' THEN 0 WHEN l = 'en' THEN 1 WHEN regexp_replace(lower(l), '^ai-', '') LIKE 'zh%' THEN 100 WHEN regexp_replace(lower(l), '^ai-', '') LIKE 'en%' THEN 101 ELSE 1000 END) * 1000 + (CASE WHEN l LIKE 'ai-%' THEN 500 ELSE 0 END) + i AS r FROM (SELECT bvid, batch_id, unnest(languages) AS l, unnest(range(len(languages))) AS i FROM bilibili_sources)) GROUP BY 1, 2")
def rank_tracks(spark, d):
    rows = table(spark, d, "bilibili_sources").select("bvid", "batch_id", F.posexplode("languages").alias("i", "l"))
    r = language.rank(F.col("l"), ["zh-CN", "en"]) * 1000 + F.when(F.col("l").startswith("ai-"), 500).otherwise(0) + F.col("i")
    return rows.groupBy("bvid", "batch_id").agg(F.min_by("l", r).alias("best"))


@query("SELECT source_id, arg_max(id, struct_pack(a := coalesce(file_size, 0), b := -id)) AS id FROM audio_urls WHERE source_id IS NOT NULL AND file_size > 0 GROUP BY 1")
def stream_argmax(spark, d):
    return _queue(spark, d).where("source_id is not null and file_size > 0").groupBy("source_id").agg(F.max_by("id", F.struct(F.coalesce("file_size", F.lit(0)), -F.col("id"))).alias("id"))


@query("SELECT source_id, artifact_kind, id, row_number() OVER (PARTITION BY source_id, artifact_kind ORDER BY id) AS ordinal FROM audio_urls WHERE source_id IS NOT NULL")
def ordinals_by_kind(spark, d):
    """The number of each asset among those of its kind and item."""
    return identity.numbered(_queue(spark, d).where("source_id is not null"), ["source_id", "artifact_kind"], ["id"]).select("source_id", "artifact_kind", "id", F.col("ordinal").cast("long").alias("ordinal"))


# --- expressions ---------------------------------------------------------------------------------------------------------------------


_BARE = "CASE WHEN regexp_matches(u, '{p}', 'i') THEN lower(regexp_extract(u, '{p}', 1, 'i')) || '://' || lower(regexp_extract(u, '{p}', 2, 'i')) || regexp_extract(u, '{p}', 3, 'i') || regexp_extract(u, '{p}', 4, 'i') ELSE '' END"
_PARTS = "://(?:[^/]*@)?(\\[[^\\]/]*\\]|[^/:\\s]+)(:[0-9]+)?(/.*)?$"


@query(f"SELECT id, field, {_BARE.format(p='^(https?)' + _PARTS)} AS web, {_BARE.format(p='^([a-z][a-z0-9_+.-]*)' + _PARTS)} AS any_scheme, {_BARE.format(p='^(https)' + _PARTS)} AS secure FROM (SELECT id, unnest(['url', 'webpage_url', 'cover_url']) AS field, regexp_replace(trim(coalesce(unnest([url, webpage_url, cover_url]), '')), '[?#].*$', '') AS u FROM audio_urls)")
def url_redact(spark, d):
    """The three ways of redaction over every URL of the queue."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("u")) for c in ("url", "webpage_url", "cover_url")])
    rows = _queue(spark, d).select("id", F.inline(fields))
    return rows.select("id", "field", urls.redact_web(F.col("u")).alias("web"), urls.redact_any(F.col("u")).alias("any_scheme"), urls.redact_secure(F.col("u")).alias("secure"))


@query("SELECT id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS first_segment FROM audio_urls")
def url_host(spark, d):
    return _queue(spark, d).select("id", urls.host(F.col("url")).alias("host"), urls.path_identifier(F.col("url"), 0).alias("first_segment"))


@query("SELECT id, nullif(regexp_extract(url, '(?:^|/)(BV[0-9A-Za-z]{10})(?:[/?#]|$)', 1), '') AS video_id FROM audio_urls")
def id_extract(spark, d):
    return _queue(spark, d).select("id", urls.video_id_long(F.col("url")).alias("video_id"))


@query("SELECT id, substr(regexp_replace(regexp_replace(coalesce(metadata_json, ''), '(https?://)[^/@\\s]*@', '\\1', 'g'), '(https?://[^\\s?#\"''<>]+)[?#][^\\s\"''<>]*', '\\1', 'g'), 1, 2000) AS redacted FROM audio_urls")
def url_in_text_redact(spark, d):
    return _queue(spark, d).select("id", urls.redact_in_text(F.col("metadata_json")).alias("redacted"))


@query("SELECT doc_id, replace(replace(text, 'microphone failed', '[redacted]'), 'night', '[redacted]') AS masked, contains(text, 'microphone failed') OR contains(text, 'night') AS has_needle FROM documents")
def needle_redact(spark, d):
    needles = ["night", "microphone failed"]
    return table(spark, d, "documents").select("doc_id", text.mask_needles(F.col("text"), needles).alias("masked"), text.any_needle(F.col("text"), needles).alias("has_needle"))


@query("SELECT feed_url, coalesce(list_filter(list_transform(string_split(coalesce(genre, ''), ','), lambda g: CASE trim(g) WHEN 'News' THEN 'news' WHEN 'Education' THEN 'lecture' WHEN 'Arts' THEN 'arts' ELSE NULL END), lambda x: x IS NOT NULL)[1], 'other') AS category FROM feed_registry")
def category_map(spark, d):
    genres = F.transform(F.split(_text("genre"), ","), F.trim)
    return table(spark, d, "feed_registry").select("feed_url", text.first_mapped(genres, {"News": "news", "Education": "lecture", "Arts": "arts"}, "other").alias("category"))


@query("SELECT language, CASE WHEN f IN ('zh', 'yue', 'cmn') THEN 'zh' ELSE f END AS family, count(*) AS n_rows FROM (SELECT language, split_part(regexp_replace(lower(trim(coalesce(language, ''))), '^ai-', ''), '-', 1) AS f FROM audio_urls) GROUP BY 1, 2")
def language_families(spark, d):
    return _queue(spark, d).groupBy("language", language.family_folded(F.col("language")).alias("family")).agg(F.count("*").alias("n_rows"))


@query("SELECT bvid, batch_id, l AS track, (NOT a IN ('', 'und') AND NOT b IN ('', 'und') AND (a = b OR (a IN ('zh', 'yue', 'cmn') AND b IN ('zh', 'yue', 'cmn')))) AS matches FROM (SELECT bvid, batch_id, l, split_part(regexp_replace(lower(trim(l)), '^ai-', ''), '-', 1) AS a, split_part(regexp_replace(lower(trim(coalesce(content_language, ''))), '^ai-', ''), '-', 1) AS b FROM (SELECT bvid, batch_id, content_language, unnest(languages) AS l FROM bilibili_sources))")
def language_match(spark, d):
    rows = table(spark, d, "bilibili_sources").select("bvid", "batch_id", "content_language", F.explode("languages").alias("track"))
    return rows.select("bvid", "batch_id", "track", language.matches(F.col("track"), F.col("content_language")).alias("matches"))


@query("SELECT track_id, pos, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS stamp FROM (SELECT DISTINCT track_id, pos, greatest(CAST(round_even(cue_start * 1000, 0) AS BIGINT), 0) AS ms FROM cues)")
def vtt_time_format(spark, d):
    return table(spark, d, "cues").select("track_id", "pos", "cue_start").distinct().select("track_id", "pos", scalars.vtt_text(F.col("cue_start")).alias("stamp"))


@query("SELECT id, field, coalesce(CASE WHEN contains(t, ':') THEN CASE len(p) WHEN 3 THEN p[1] * 3600 + p[2] * 60 + p[3] WHEN 2 THEN p[1] * 60 + p[2] ELSE 0 END WHEN regexp_matches(t, '^[0-9]+$') THEN TRY_CAST(t AS BIGINT) ELSE 0 END, 0) AS seconds FROM (SELECT id, field, t, list_transform(list_filter(string_split(t, ':'), lambda x: regexp_matches(x, '^[0-9]+$')), lambda x: TRY_CAST(x AS BIGINT)) AS p FROM (SELECT id, unnest(['published_at', 'downloaded_at', 'clock']) AS field, trim(coalesce(unnest([published_at, downloaded_at, substr(downloaded_at, 12, 8)]), '')) AS t FROM audio_urls))")
def duration_parse(spark, d):
    """Texts of dates and clocks taken as durations: well formed, with parts that aren't digits, numbers alone, and none."""
    fields = F.array(*[F.struct(F.lit(n).alias("field"), c.alias("t")) for n, c in (("published_at", F.col("published_at")), ("downloaded_at", F.col("downloaded_at")), ("clock", F.substring("downloaded_at", 12, 8)))])
    return _queue(spark, d).select("id", F.inline(fields)).select("id", "field", scalars.duration_seconds(F.col("t")).alias("seconds"))


@query("SELECT id, CASE WHEN coalesce(file_size, 0) <= 0 THEN '-' WHEN file_size < 1024 THEN printf('%d B', file_size) WHEN file_size < 1048576 THEN printf('%.1f KB', file_size / 1024.0) WHEN file_size < 1073741824 THEN printf('%.1f MB', file_size / 1048576.0) WHEN file_size < 1099511627776 THEN printf('%.1f GB', file_size / 1073741824.0) ELSE printf('%.1f TB', file_size / 1099511627776.0) END AS size, CASE WHEN coalesce(floor(duration), 0) <= 0 THEN '-' WHEN duration >= 3600 THEN printf('%d:%02d:%02d', CAST(floor(duration) AS BIGINT) // 3600, CAST(floor(duration) AS BIGINT) % 3600 // 60, CAST(floor(duration) AS BIGINT) % 60) ELSE printf('%d:%02d', CAST(floor(duration) AS BIGINT) // 60, CAST(floor(duration) AS BIGINT) % 60) END AS length FROM audio_urls")
def display_format(spark, d):
    return _queue(spark, d).select("id", text.human_size(F.col("file_size")).alias("size"), text.human_duration(F.col("duration")).alias("length"))


@query("SELECT DISTINCT track_id, pos, substr(sha256(sha256(track_id) || '|' || sha256(coalesce(text, '')) || '|' || CAST(round_even(cue_start * 1000, 0) AS BIGINT) || '|' || CAST(round_even(cue_end * 1000, 0) AS BIGINT) || '|cue-groups-v1|wav-16k-v1'), 1, 20) AS clip_id FROM cues WHERE track_id IS NOT NULL")
def clip_ids(spark, d):
    """The id of a clip: media's hash, captions' hash, start and end in milliseconds, the versions of grouping and encoding."""
    ms = lambda c: F.bround(F.col(c) * 1000).cast("long").cast("string")
    rows = table(spark, d, "cues").where("track_id is not null").select("track_id", "pos", "cue_start", "cue_end", "text").distinct()
    return rows.select("track_id", "pos", scalars.short_hash(F.sha2("track_id", 256), F.sha2(_text("text"), 256), ms("cue_start"), ms("cue_end"), F.lit("cue-groups-v1"), F.lit("wav-16k-v1")).alias("clip_id")).distinct()


@query("SELECT source, count(*) AS n_files, CAST(sum(length(text)) AS BIGINT) AS n_bytes FROM documents WHERE text IS NOT NULL GROUP BY 1")
def bundle_sizes(spark, d):
    return table(spark, d, "documents").where("text is not null").groupBy("source").agg(F.count("*").alias("n_files"), F.sum(F.length("text").cast("long")).alias("n_bytes"))


@query("SELECT source || '/' || doc_id // 100 AS bundle, count(*) AS n_files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS n_bytes, sha256(string_agg(doc_id || '|' || octet_length(encode(text)) || '|' || sha256(text), chr(10) ORDER BY doc_id || '|' || octet_length(encode(text)) || '|' || sha256(text)) || chr(10)) AS fingerprint FROM documents WHERE text IS NOT NULL AND source IS NOT NULL GROUP BY 1")
def closure_hash(spark, d):
    """Bundles of up to a hundred documents: a closure is one text of its files' hashes."""
    files = table(spark, d, "documents").where("text is not null and source is not null").select(F.concat("source", F.lit("/"), F.expr("doc_id div 100").cast("string")).alias("bundle"), F.col("doc_id").cast("string").alias("name"), F.octet_length("text").cast("long").alias("length"), F.sha2("text", 256).alias("sha256"))
    return feeds.closure(files, "|")


@query("SELECT bvid, batch_id, coalesce(rights.status IN ('licensed', 'permission_granted', 'public_domain', 'creative_commons') AND (coalesce(rights.evidence_url, '') <> '' OR coalesce(rights.evidence_text, '') <> ''), false) AS cleared FROM bilibili_sources")
def rights_evidence(spark, d):
    r = F.col("rights.status").isin(*manifests.CLEARED) & ((_text("rights.evidence_url") != "") | (_text("rights.evidence_text") != ""))
    return table(spark, d, "bilibili_sources").select("bvid", "batch_id", F.coalesce(r, F.lit(False)).alias("cleared"))


@query("SELECT track_id, CASE WHEN round(last - 300.0, 6) > 2.0 THEN round(last - 300.0, 6) END AS over_s FROM (SELECT track_id, max(cue_end) AS last FROM cues GROUP BY 1)")
def timeline_overrun(spark, d):
    last = table(spark, d, "cues").groupBy("track_id").agg(F.max("cue_end").alias("last"))
    return last.select("track_id", scalars.overrun(F.array("last"), F.lit(300.0))["over"].alias("over_s"))


@query("SELECT id, CASE WHEN regexp_matches(substr(published_at, 1, 8), '^[0-9]{8}$') AND try_strptime(substr(published_at, 1, 8), '%Y%m%d') IS NOT NULL THEN strftime(try_strptime(substr(published_at, 1, 8), '%Y%m%d'), '%Y-%m-%d') || 'T00:00:00+00:00' ELSE '' END AS iso FROM audio_urls")
def compact_dates(spark, d):
    return _queue(spark, d).select("id", scalars.compact_date(F.substring("published_at", 1, 8)).alias("iso"))


@query()
def rfc2822_dates(spark, d):
    return _queue(spark, d).select("id", scalars.rfc2822_iso("published_at").alias("iso"))


@query()
def html_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.plain_text("text").alias("plain"))


@query()
def html_sanitize(spark, d):
    return table(spark, d, "documents").select("doc_id", text.sanitize_html("text").alias("safe"))


@query()
def caption_clean(spark, d):
    return table(spark, d, "cues").select("track_id", "pos", "text").distinct().select("track_id", "pos", text.clean_caption(F.col("text")).alias("clean"))


@query()
def ocr_clean(spark, d):
    return table(spark, d, "cues").select("track_id", "pos", "text").distinct().select("track_id", "pos", text.clean_ocr("text").alias("clean"))


@query()
def safe_names(spark, d):
    return _queue(spark, d).select("id", text.safe_name(F.col("title")).alias("name"))


@query()
def vtt_render(spark, d):
    return feeds.render_vtt(table(spark, d, "cues").select("track_id", "cue_start", "cue_end", _text("text").alias("text")).distinct(), "track_id", "cue_start", "cue_end", "text")


@query()
def vtt_round_trip(spark, d):
    """Rendered captions read back by the parser."""
    vtt = vtt_render(spark, d)
    return vtt.select("track_id", F.posexplode(feeds.parse_vtt("vtt")).alias("pos", "c")).select("track_id", "pos", "c.start", "c.end", "c.text")


@query()
def rss_parse(spark, d):
    """The queue written as feeds and parsed again."""
    a = _queue(spark, d).where("file_format in ('mp3', 'm4a') and source is not null")
    esc = lambda c: F.concat(F.lit("<![CDATA["), _text(c), F.lit("]]>"))
    item = F.concat(F.lit("<item><title>"), esc("title"), F.lit("</title><guid>"), F.col("id").cast("string"), F.lit('</guid><enclosure url="'), F.col("url"), F.lit('" type="audio/mpeg" length="'), F.coalesce(F.col("file_size"), F.lit(0)).cast("string"), F.lit('"/></item>'))
    body = a.withColumn("feed_url", F.concat(F.lit("https://feeds.example/"), "source", F.lit("/"), (F.floor(F.col("id") / 50)).cast("string"))).groupBy("feed_url").agg(F.array_join(F.collect_list(item), "\n").alias("body"))
    return feeds.rss_items(body).select("feed_url", "guid", "title", "media_url", "bytes")


# --- documents, hashes and frames ----------------------------------------------------------------------------------------------------


@query("SELECT id, CASE WHEN json_valid(metadata_json) AND starts_with(trim(metadata_json), '{') THEN metadata_json ELSE '{}' END AS document FROM audio_urls")
def metadata_objects(spark, d):
    return _queue(spark, d).select("id", documents.as_object(F.col("metadata_json")).alias("document"))


@query()
def json_url_redaction(spark, d):
    return _queue(spark, d).where(_text("metadata_json") != "").select("id", documents.redact_json_urls("metadata_json").alias("redacted"))


@query()
def json_sanitize(spark, d):
    return _queue(spark, d).where(_text("metadata_json") != "").select("id", documents.sanitize_json("metadata_json").alias("r")).select("id", "r.document", F.array_join("r.violations", ",").alias("violations"))


@query()
def metadata_envelopes(spark, d):
    common = F.struct("author", "webpage_url")
    data = F.struct("source_id", "duration")
    assets = F.when(_text("cover_url") != "", F.create_map(F.lit("cover"), F.col("cover_url"))).otherwise(F.create_map().cast("map<string,string>"))
    return _queue(spark, d).where("source is not null").select("id", documents.envelope(F.col("source"), common, data, assets, F.col("downloaded_at")).alias("document"))


_JOB_FIELDS = """'["' || bvid || '",' || part || ',' || cid || ',' || coalesce(max_height, 720) || ',[' || coalesce(array_to_string(list_transform(languages, lambda x: '"' || x || '"'), ','), '') || '],' || coalesce(require_caption, false) || ',"' || coalesce(nullif(source_revision, ''), 'current') || '","job-v1","wav-16k-v1"'
|| CASE WHEN coalesce(batch_id, '') <> '' OR coalesce(content_kind, '') <> '' THEN ',"' || coalesce(batch_id, '') || '","' || coalesce(content_kind, '') || '","' || coalesce(dataset_category, '') || '"' ELSE '' END || ']'"""


@query(f"SELECT bvid, batch_id, part, bvid || '-p' || part || '-c' || cid || '-' || substr(sha256({_JOB_FIELDS}), 1, 12) AS job_key FROM (SELECT *, CAST('0x' || substr(sha256(bvid || '_p' || part), 1, 7) AS BIGINT) AS cid FROM (SELECT *, unnest(parts) AS part FROM bilibili_sources WHERE bvid IS NOT NULL))")
def job_keys(spark, d):
    """The key of each requested part; the catalogue's number of a part, which the tables lack, is taken from a hash of item and part."""
    rows = table(spark, d, "bilibili_sources").where("bvid is not null").withColumn("part", F.explode("parts"))
    rows = rows.withColumn("cid", F.conv(F.substring(F.sha2(F.concat("bvid", F.lit("_p"), "part"), 256), 1, 7), 16, 10).cast("long"))
    return rows.select("bvid", "batch_id", "part", manifests.part_key().alias("job_key"))


@query()
def frame_runs(spark, d):
    """Cues taken as detections of sampled frames, followed over time."""
    c = table(spark, d, "cues").where(F.coalesce(F.trim("text"), F.lit("")) != "").select("track_id", "pos", "cue_start", "text").distinct()
    frame = F.col("pos").cast("int")
    # Places drift from frame to frame and jump now and then, and some are seen less surely, so that texts and boxes both decide.
    x, y = 0.1 + (frame % 7) * 0.03, F.when(frame % 11 == 0, 0.2).otherwise(0.8)
    frames = c.select(
        F.col("track_id").alias("media_id"), frame.alias("frame_index"), (frame / 2.0).alias("ts"), "text", (0.6 + (F.length("text") % 5) * 0.08).alias("confidence"),
        x.alias("x1"), y.alias("y1"), (x + 0.6).alias("x2"), (y + 0.1).alias("y2"), (F.col("cue_start") + 3600).alias("media_s"),
    )
    return sequences.track_frames(frames, sequences.FrameRules(fps=2.0, static_seconds=600.0, static_coverage=0.5))


@query("SELECT lan, count(*) AS n_frames, count(*) FILTER (length(trim(coalesce(text, ''))) > 0) AS accepted, count(*) FILTER (length(trim(coalesce(text, ''))) = 0) AS filtered FROM (SELECT DISTINCT track_id, pos, lan, text FROM cues) GROUP BY 1")
def extraction_counters(spark, d):
    c = table(spark, d, "cues").select("track_id", "pos", "lan", "text").distinct()
    some = F.length(F.trim(_text("text"))) > 0
    return c.groupBy("lan").agg(F.count("*").alias("n_frames"), F.count_if(some).alias("accepted"), F.count_if(~some).alias("filtered"))


@query("SELECT bvid, batch_id, CASE WHEN coalesce(len(languages), 0) = 0 THEN 'not_provided' WHEN len(list_filter(languages, lambda x: starts_with(regexp_replace(lower(x), '^ai-', ''), split_part(lower(coalesce(content_language, '?')), '-', 1)))) = 0 THEN 'no_matching_language' ELSE 'provided' END AS status FROM bilibili_sources")
def inventory_status(spark, d):
    wanted = F.split_part(F.lower(F.coalesce("content_language", F.lit("?"))), F.lit("-"), F.lit(1))
    some = F.exists("languages", lambda x: F.startswith(F.regexp_replace(F.lower(x), "^ai-", ""), wanted))
    status = F.when(F.coalesce(F.size("languages"), F.lit(0)) <= 0, "not_provided").when(~some, "no_matching_language").otherwise("provided")
    return table(spark, d, "bilibili_sources").select("bvid", "batch_id", status.alias("status"))


@query("SELECT source, status, n_rows, rank() OVER (PARTITION BY source ORDER BY n_rows DESC, status) AS place FROM (SELECT source, status, count(*) AS n_rows FROM audio_urls GROUP BY 1, 2)")
def status_ranks(spark, d):
    counts = _queue(spark, d).groupBy("source", "status").agg(F.count("*").alias("n_rows"))
    return counts.withColumn("place", F.rank().over(Window.partitionBy("source").orderBy(F.desc("n_rows"), "status")).cast("long"))


@query("SELECT user_id, count(*) AS n_events, count(DISTINCT event_type) AS n_types FROM events GROUP BY 1")
def events_by_user(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n_events"), F.count_distinct("event_type").alias("n_types"))


# --- quality rules -------------------------------------------------------------------------------------------------------------------


def _rules(**rules: Column) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())


_QUALITY = """SELECT rule, count(*) AS n_rows FROM (SELECT unnest(list_filter([CASE WHEN coalesce(url, '') NOT LIKE 'http%' THEN 'url' END, CASE WHEN coalesce(artifact_kind NOT IN ('audio', 'video_bundle'), true) THEN 'kind' END,
CASE WHEN coalesce(status NOT IN ('pending', 'downloading', 'done', 'failed'), true) THEN 'status' END, CASE WHEN coalesce(duration < 0, true) THEN 'duration' END, CASE WHEN status = 'done' AND coalesce(local_path, '') = '' THEN 'no_path' END,
CASE WHEN artifact_kind = 'video_bundle' AND coalesce(job_key, '') = '' THEN 'no_job' END], lambda x: x IS NOT NULL)) AS rule FROM audio_urls) GROUP BY 1"""


@query(_QUALITY)
def quality_rules(spark, d):
    v = _rules(
        url=~_text("url").startswith("http"), kind=~F.col("artifact_kind").isin("audio", "video_bundle"), status=~F.col("status").isin("pending", "downloading", "done", "failed"),
        duration=F.col("duration") < 0, no_path=F.coalesce(F.col("status") == "done", F.lit(False)) & (_text("local_path") == ""),
        no_job=F.coalesce(F.col("artifact_kind") == "video_bundle", F.lit(False)) & (_text("job_key") == ""),
    )
    return _queue(spark, d).select(F.explode(v).alias("rule")).groupBy("rule").agg(F.count("*").alias("n_rows"))


@query("SELECT bvid, batch_id, array_to_string(list_filter([CASE WHEN NOT regexp_matches(coalesce(bvid, ''), '^BV[0-9A-Za-z]{10}$') THEN 'bvid' END, CASE WHEN coalesce(len(parts), 0) = 0 THEN 'parts' END, CASE WHEN coalesce(list_max(parts), 0) > coalesce(max_parts, 1000) THEN 'max_parts' END, CASE WHEN coalesce(max_duration_seconds <= 0, true) THEN 'max_duration' END, CASE WHEN octet_length(encode(coalesce(candidate_metadata, ''))) > 32768 THEN 'metadata_size' END], lambda x: x IS NOT NULL), ',') AS violations FROM bilibili_sources")
def manifest_rules(spark, d):
    v = _rules(
        bvid=~_text("bvid").rlike("^BV[0-9A-Za-z]{10}$"), parts=F.coalesce(F.size("parts"), F.lit(0)) <= 0, max_parts=F.coalesce(F.array_max("parts"), F.lit(0)) > F.coalesce("max_parts", F.lit(1000)),
        max_duration=F.col("max_duration_seconds") <= 0, metadata_size=F.octet_length(_text("candidate_metadata")) > 32768,
    )
    return table(spark, d, "bilibili_sources").select("bvid", "batch_id", F.array_join(v, ",").alias("violations"))


@query("SELECT reason, count(*) AS n_rows FROM (SELECT CASE WHEN coalesce(source, '') = '' THEN 'no_source' WHEN status <> 'done' THEN 'not_done' WHEN coalesce(content_hash, '') = '' THEN 'no_hash' WHEN coalesce(metadata_json, '') = '' THEN 'no_metadata' ELSE 'eligible' END AS reason FROM audio_urls) GROUP BY 1")
def ordered_funnel(spark, d):
    reason = F.when(_text("source") == "", "no_source").when(F.col("status") != "done", "not_done").when(_text("content_hash") == "", "no_hash").when(_text("metadata_json") == "", "no_metadata").otherwise("eligible")
    return _queue(spark, d).groupBy(reason.alias("reason")).agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_rows, count(DISTINCT source) AS n_sources, count(*) FILTER (NOT regexp_matches(coalesce(url, ''), '^https?://')) AS invalid_urls, min(id) AS first_id, max(id) AS last_id FROM audio_urls WHERE source = 'youtube'")
def source_probe(spark, d):
    return _queue(spark, d).where("source = 'youtube'").agg(F.count("*").alias("n_rows"), F.count_distinct("source").alias("n_sources"), F.count_if(~_text("url").rlike("^https?://")).alias("invalid_urls"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


# --- the star schema -----------------------------------------------------------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, count(*) AS n_rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY 1, 2")
def pricing_summary(spark, d):
    rows = table(spark, d, "lineitem").where("l_shipdate <= date '1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n_rows"), F.sum("l_quantity").cast("double").alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT n_name, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def orders_by_nation(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, d, "orders").select("o_custkey").join(c, "o_custkey").groupBy("c_nationkey").agg(F.count("*").alias("k")).join(n, "c_nationkey").groupBy("n_name").agg(F.sum("k").alias("n_orders"))
