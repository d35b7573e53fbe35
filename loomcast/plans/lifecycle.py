"""Queries of the queue's leases, of bundles, listings and audits over the test tables, each beside its SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import documents, scalars, text, urls
from ..operators import bundles, filters, identity, leases, sequences
from ..session import table
from ..sources import feeds, listings, manifests

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

NOW = dt.datetime(2026, 7, 8, 12, tzinfo=dt.UTC)
_NOW = NOW.isoformat()


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _queue(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "audio_urls")


_FRESH = f"SELECT * REPLACE (CASE WHEN hit THEN 'pending' ELSE status END AS status, CASE WHEN hit THEN '' ELSE claimed_by END AS claimed_by, CASE WHEN hit THEN '' ELSE lease_expires_at END AS lease_expires_at) FROM (SELECT *, coalesce(status = 'downloading' AND {{scope}} AND coalesce(lease_expires_at, '') <> '' AND lease_expires_at <= '{_NOW}', false) AS hit FROM audio_urls)"


@query(f"WITH f AS ({_FRESH.format(scope='artifact_kind = ' + chr(39) + 'audio' + chr(39))}), p AS (SELECT id, source, row_number() OVER (PARTITION BY source ORDER BY id) AS n FROM f WHERE status = 'pending' AND artifact_kind = 'audio' AND coalesce(source, '') <> '') SELECT CASE WHEN n <= 30 THEN 'first:1:a' ELSE 'second:2:b' END AS claimed_by, source, id FROM p WHERE n <= 60")
def claim_disjoint(spark, d):
    """Two workers claim thirty rows of each source, one after the other."""
    after, first = leases.claim(_queue(spark, d), NOW, "first:1:a", 7200, 30, group="source", artifact_kind="audio")
    second = leases.claim(after, NOW, "second:2:b", 7200, 30, group="source", artifact_kind="audio")[1]
    return first.unionByName(second).select("claimed_by", "source", "id")


@query(f"SELECT source, status, count(*) AS n_rows, count(*) FILTER (coalesce(claimed_by, '') <> '') AS n_claimed FROM ({_FRESH.format(scope='source = ' + chr(39) + 'youtube' + chr(39))}) GROUP BY 1, 2")
def expire_scoped(spark, d):
    """Run-out leases of one source are given back; those of the others stay."""
    out = leases.expire(_queue(spark, d), NOW, source="youtube")
    return out.groupBy("source", "status").agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce("claimed_by", F.lit("")) != "").alias("n_claimed"))


@query(f"SELECT id, CASE WHEN status = 'downloading' AND claimed_by = (SELECT max(claimed_by) FROM audio_urls WHERE status = 'downloading') THEN '{(NOW + dt.timedelta(seconds=600)).isoformat()}' ELSE lease_expires_at END AS lease_expires_at FROM audio_urls")
def renew(spark, d):
    """One worker asks for longer leases on all rows and gets them on its own."""
    a = _queue(spark, d)
    worker = a.where("status = 'downloading'").agg(F.max("claimed_by").alias("w")).first()["w"] or "nobody"
    return leases.renew(a, NOW, worker, a.select("id"), 600).select("id", "lease_expires_at")


@query(f"SELECT id, CASE WHEN u THEN CASE WHEN id % 3 = 0 THEN 'failed' ELSE 'done' END ELSE status END AS status, CASE WHEN u AND id % 3 <> 0 THEN 'media/' || source_id ELSE local_path END AS local_path, CASE WHEN u AND id % 3 <> 0 THEN '{_NOW}' ELSE downloaded_at END AS downloaded_at, CASE WHEN u THEN '' ELSE claimed_by END AS claimed_by FROM (SELECT *, EXISTS (SELECT 1 FROM audio_urls b WHERE b.url = a.url AND coalesce(b.job_key, '') = coalesce(a.job_key, '') AND b.status = 'downloading') AND (coalesce(job_key, '') = '' OR (SELECT count(*) FROM audio_urls b WHERE b.url = a.url AND b.job_key = a.job_key) = 1) AS u FROM audio_urls a)")
def transitions(spark, d):
    """All claimed rows end, a third of them failed."""
    a = _queue(spark, d)
    status = F.when(F.col("id") % 3 == 0, "failed").otherwise("done")
    updates = a.where("status = 'downloading'").select("url", "job_key", status.alias("status"), F.concat(F.lit("media/"), "source_id").alias("local_path"))
    return leases.transition(a, updates, NOW)[0].select("id", "status", "local_path", "downloaded_at", "claimed_by")


@query("""WITH f AS (SELECT id AS seq, url, sha256(coalesce(title, '')) AS h FROM audio_urls WHERE status = 'pending'), l AS (SELECT url, max(seq) AS seq, arg_max(h, seq) AS h FROM f GROUP BY 1),
k AS (SELECT l.*, a.artifact_kind FROM l JOIN audio_urls a ON a.url = l.url AND coalesce(a.job_key, '') = ''), m AS (SELECT h, min(seq) AS first FROM k WHERE artifact_kind = 'audio' GROUP BY 1)
SELECT k.url, coalesce(k.artifact_kind = 'audio' AND (k.seq > m.first OR EXISTS (SELECT 1 FROM audio_urls s WHERE s.status = 'done' AND s.artifact_kind = 'audio' AND s.content_hash = k.h AND s.url <> k.url)), false) AS is_duplicate FROM k LEFT JOIN m USING (h)""")
def finalise(spark, d):
    """All pending rows finish, with their titles for contents."""
    a = _queue(spark, d)
    finished = a.where("status = 'pending'").select(F.col("id").alias("seq"), "url", F.concat(F.lit("media/"), "id").alias("local_path"), F.lit("wav").alias("file_format"), F.lit(1).cast("long").alias("file_size"), F.sha2(F.coalesce("title", F.lit("")), 256).alias("content_hash"))
    return leases.finalise(a, finished, NOW)[1]


@query("SELECT id, CASE WHEN status = 'downloading' AND claimed_by = w AND source = s AND artifact_kind = k THEN 'pending' ELSE status END AS status FROM audio_urls, (SELECT claimed_by AS w, source AS s, artifact_kind AS k FROM audio_urls WHERE status = 'downloading' AND coalesce(claimed_by, '') <> '' AND source IS NOT NULL AND artifact_kind IS NOT NULL ORDER BY claimed_by, source, artifact_kind LIMIT 1)")
def recover_scope(spark, d):
    """The claims of one owner, source and kind, counted dry first."""
    a = _queue(spark, d)
    one = a.where("status = 'downloading' and coalesce(claimed_by, '') <> '' and source is not null and artifact_kind is not null").orderBy("claimed_by", "source", "artifact_kind").select("claimed_by", "source", "artifact_kind").first()
    claims = leases.scope(*one)
    return leases.recover(a, claims, leases.recover(a, claims)[1])[0].select("id", "status")


@query("SELECT outcome, count(*) AS n_rows FROM (SELECT id, CASE WHEN status = 'failed' THEN 'applied' ELSE 'stale' END AS outcome FROM audio_urls WHERE coalesce(content_hash, '') = '' AND status IS NOT NULL UNION ALL SELECT -id, 'missing' FROM audio_urls WHERE coalesce(content_hash, '') = '' AND status IS NOT NULL) GROUP BY 1")
def compare_and_swap(spark, d):
    """Changes meant for failed rows, asked of all rows without content and of ids that aren't there."""
    a = _queue(spark, d)
    meant = a.where("coalesce(content_hash, '') = '' and status is not null").select("id", F.lit("failed").alias("old_status"), F.col("content_hash").alias("old_content_hash"), F.lit("pending").alias("new_status"))
    changes = meant.unionByName(meant.withColumn("id", -F.col("id")))
    return leases.compare_and_swap(a, changes, ["status", "content_hash"], ["status"])[1].groupBy("outcome").agg(F.count("*").alias("n_rows"))


@query()
def batch_upsert(spark, d):
    """The pending rows put into all others in one batch: how often each row is enriched."""
    a, pending = _queue(spark, d), F.col("status").eqNullSafe("pending")
    return identity.upsert(a.where(~pending), a.where(pending), "id", ["title", "author", "description"])[2]


@query("SELECT track_id AS media_id, count(DISTINCT pos) AS n_frames, count(*) AS n_candidates, count(*) FILTER (c >= 0.7) AS n_accepted, count(*) FILTER (NOT c >= 0.7) AS n_filtered, count(*) FILTER (c >= 0.7) AS n_cues, CASE WHEN count(*) FILTER (c >= 0.7) > 0 THEN round_even(avg(c) FILTER (c >= 0.7), 6) END AS mean_confidence FROM (SELECT DISTINCT track_id, pos, 0.5 + (length(coalesce(text, '')) % 4) * 0.125 AS c FROM cues WHERE track_id IS NOT NULL AND pos IS NOT NULL) GROUP BY 1")
def recognition_counters(spark, d):
    """Cues taken as detections, each of which that is sure enough as a caption of its own."""
    rows = table(spark, d, "cues").where("track_id is not null and pos is not null")
    found = rows.select(F.col("track_id").alias("media_id"), F.col("pos").alias("frame_index"), (0.5 + (F.length(F.coalesce("text", F.lit(""))) % 4) * 0.125).alias("confidence")).distinct()
    return sequences.extraction_counters(found, found.where("confidence >= 0.7"), 0.7)


# --- manifests and keys --------------------------------------------------------------------------------------------------------------


@query("""SELECT bvid, batch_id, array_to_string(list_filter([CASE WHEN coalesce(profile NOT IN ('youtube_interviews', 'youtube_screen_clips', 'youtube_screen_parents', 'youtube_conference_forums'), true) THEN 'profile' END,
CASE WHEN coalesce(rights.status NOT IN ('needs_review', 'unknown', 'licensed', 'permission_granted', 'public_domain', 'creative_commons'), true) THEN 'rights' END, CASE WHEN rights.evidence_url IS NOT NULL AND (length(rights.evidence_url) > 2048 OR NOT regexp_matches(rights.evidence_url, '^https://[^/@\\s]+(/|$|[?#])')) THEN 'evidence_url' END,
CASE WHEN rights.evidence_text IS NOT NULL AND (trim(rights.evidence_text) = '' OR length(rights.evidence_text) > 4096) THEN 'evidence_text' END, CASE WHEN coalesce(ai_generation.status NOT IN ('declared', 'not_declared', 'suspected', 'unknown'), true) THEN 'ai_generation' END,
CASE WHEN coalesce(profile NOT IN ('youtube_interviews', 'youtube_screen_clips', 'youtube_screen_parents', 'youtube_conference_forums'), true) OR (dataset_category IS NOT NULL AND dataset_category NOT IN ('影视', '访谈', '会议论坛')) OR (content_kind IS NOT NULL AND content_kind NOT IN ('screen_media', 'interview_roundtable', 'conference_forum'))
OR (dataset_category IS NOT NULL AND content_kind IS NOT NULL AND coalesce(CASE content_kind WHEN 'screen_media' THEN '影视' WHEN 'interview_roundtable' THEN '访谈' WHEN 'conference_forum' THEN '会议论坛' END, '') <> dataset_category) THEN 'classification' END,
CASE WHEN CASE WHEN speaker_count IS NULL THEN coalesce(speaker_count_status <> 'needs_review', true) ELSE speaker_count <= 0 OR coalesce(speaker_count_status <> 'verified_manual', true) END THEN 'speaker_count' END, CASE WHEN octet_length(encode(coalesce(candidate_metadata, ''))) > 32768 THEN 'metadata_size' END], lambda x: x IS NOT NULL), ',') AS violations FROM bilibili_sources""")
def item_manifest_rules(spark, d):
    return table(spark, d, "bilibili_sources").select("bvid", "batch_id", F.array_join(manifests.second_violations(), ",").alias("violations"))


@query("""SELECT bvid, batch_id, concat_ws('-', bvid, profile, coalesce(languages[1], 'any'), substr(sha256('["' || bvid || '",' || coalesce('"' || profile || '",', '') || '[' || coalesce(array_to_string(list_transform(languages, lambda x: '"' || x || '"'), ','), '') || '],' || CASE WHEN require_caption = false THEN 'false,' ELSE '' END
|| '"' || coalesce(nullif(source_revision, ''), 'current') || '"' || CASE WHEN content_kind <> CASE profile WHEN 'youtube_interviews' THEN 'interview_roundtable' WHEN 'youtube_screen_clips' THEN 'screen_media' WHEN 'youtube_screen_parents' THEN 'screen_media' WHEN 'youtube_conference_forums' THEN 'conference_forum' END AND dataset_category IS NOT NULL
THEN ',{"dataset_category":"' || dataset_category || '","content_kind":"' || content_kind || '"}' ELSE '' END || ']'), 1, 12)) AS job_key FROM bilibili_sources WHERE bvid IS NOT NULL""")
def item_keys(spark, d):
    return table(spark, d, "bilibili_sources").where("bvid is not null").select("bvid", "batch_id", manifests.item_key(F.col("bvid")).alias("job_key"))


@query("""SELECT bvid, batch_id, c AS dataset_category, k AS content_kind FROM (SELECT bvid, batch_id, k, coalesce(dataset_category, CASE k WHEN 'screen_media' THEN '影视' WHEN 'interview_roundtable' THEN '访谈' WHEN 'conference_forum' THEN '会议论坛' END) AS c FROM (SELECT *, coalesce(content_kind, CASE dataset_category WHEN '影视' THEN 'screen_media' WHEN '访谈' THEN 'interview_roundtable' WHEN '会议论坛' THEN 'conference_forum' END,
CASE WHEN dataset_category IS NULL THEN CASE profile WHEN 'youtube_interviews' THEN 'interview_roundtable' WHEN 'youtube_screen_clips' THEN 'screen_media' WHEN 'youtube_screen_parents' THEN 'screen_media' WHEN 'youtube_conference_forums' THEN 'conference_forum' END END) AS k FROM bilibili_sources))""")
def classified_items(spark, d):
    c = manifests.classification(F.col("profile"), F.col("dataset_category"), F.col("content_kind"))
    return table(spark, d, "bilibili_sources").select("bvid", "batch_id", c["dataset_category"].alias("dataset_category"), c["content_kind"].alias("content_kind"))


# --- more expressions ----------------------------------------------------------------------------------------------------------------


@query("SELECT id, CASE lower(trim(split_part('audio/' || coalesce(file_format, ''), ';', 1))) WHEN 'audio/json' THEN '.json' ELSE CASE lower(regexp_extract(p, '[^/](\\.[^./]*)$', 1)) WHEN '.jpeg' THEN '.jpg' WHEN '.htm' THEN '.html' WHEN '.jpg' THEN '.jpg' WHEN '.png' THEN '.png' WHEN '.webp' THEN '.webp' WHEN '.gif' THEN '.gif' WHEN '.txt' THEN '.txt' WHEN '.html' THEN '.html' WHEN '.vtt' THEN '.vtt' WHEN '.srt' THEN '.srt' WHEN '.json' THEN '.json' WHEN '.xml' THEN '.xml' ELSE '.bin' END END AS extension FROM (SELECT id, file_format, regexp_extract(coalesce(cover_url, ''), '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS p FROM audio_urls)")
def asset_extensions(spark, d):
    """Covers by their addresses, whose rows have media types of no asset."""
    kind = F.concat(F.lit("audio/"), F.coalesce("file_format", F.lit("")))
    return _queue(spark, d).select("id", text.asset_extension(kind, F.col("cover_url")).alias("extension"))


@query("SELECT id, CASE WHEN contains(h, 'bilibili') THEN 'https://www.bilibili.com/' WHEN contains(h, 'example') THEN 'https://example.org/' ELSE regexp_extract(url, '^([a-z]+)://', 1) || '://' || h || '/' END AS referer FROM (SELECT id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS h FROM audio_urls WHERE url IS NOT NULL)")
def referers(spark, d):
    return _queue(spark, d).where("url is not null").select("id", text.referer(F.col("url"), {"bilibili": "https://www.bilibili.com/", "example": "https://example.org/"}).alias("referer"))


@query("SELECT DISTINCT identifier FROM (SELECT s[2] AS identifier FROM (SELECT list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS s FROM audio_urls) WHERE s[1] IN ('podcast_rss', 'youtube')) WHERE identifier IS NOT NULL")
def item_identifiers(spark, d):
    return _queue(spark, d).select(urls.item_identifier(F.col("url"), ["podcast_rss", "youtube"]).alias("identifier")).where("identifier is not null").distinct()


@query("SELECT reason, count(*) AS n_rows FROM (SELECT CASE WHEN trim(u) = '' THEN 'empty' WHEN coalesce(lower(regexp_extract(u, '^([A-Za-z]+)://', 1)), '') <> 'https' THEN 'scheme' WHEN contains(a, '@') THEN 'credentials' WHEN regexp_extract(a, ':([0-9]+)$', 1) NOT IN ('', '443') THEN 'port' WHEN NOT (h = 'oronde.example' OR ends_with(h, '.oronde.example')) THEN 'host' ELSE 'accepted' END AS reason FROM (SELECT u, a, lower(regexp_replace(regexp_replace(a, '^.*@', ''), ':[0-9]+$', '')) AS h FROM (SELECT u, regexp_extract(u, '^[A-Za-z]+://([^/?#]*)', 1) AS a FROM (SELECT CASE id % 6 WHEN 0 THEN replace(coalesce(url, ''), 'https', 'http') WHEN 1 THEN replace(coalesce(url, ''), '://', '://me:pw@') WHEN 2 THEN replace(coalesce(url, ''), '.example', '.example:8443') ELSE coalesce(cover_url, '') END AS u FROM audio_urls)))) GROUP BY 1")
def url_diagnosis(spark, d):
    """The queue's addresses, some of them with another scheme, credentials or a port."""
    u, k = F.coalesce("url", F.lit("")), F.col("id") % 6
    swap = lambda old, new: F.replace(u, F.lit(old), F.lit(new))
    url = F.when(k == 0, swap("https", "http")).when(k == 1, swap("://", "://me:pw@")).when(k == 2, swap(".example", ".example:8443")).otherwise(F.coalesce("cover_url", F.lit("")))
    return _queue(spark, d).groupBy(urls.diagnose(url, ["oronde.example"]).alias("reason")).agg(F.count("*").alias("n_rows"))


@query("SELECT doc_id, CASE WHEN coalesce(s, 0) <> 0 THEN strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' ELSE '' END AS iso FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 0 ELSE CAST(floor(epoch(collected_at)) AS BIGINT) END AS s FROM documents)")
def epoch_dates(spark, d):
    """Moments of collection as seconds since 1970, a seventh of them zero, as text."""
    s = F.when(F.col("doc_id") % 7 == 0, 0).otherwise(F.unix_seconds(F.col("collected_at").cast("timestamp")))
    return table(spark, d, "documents").select("doc_id", scalars.epoch_iso(s).alias("iso"))


@query("SELECT track_id, pos, round(CASE WHEN u > 0 THEN i / u ELSE 0 END, 9) AS iou, round(sqrt(pow((a1 + a3 - b1 - b3) / 2, 2) + pow((a2 + a4 - b2 - b4) / 2, 2)), 9) AS distance, round(0.2 + a1 * 0.5, 9) AS mapped_x1 FROM (SELECT *, greatest(0, least(a3, b3) - greatest(a1, b1)) * greatest(0, least(a4, b4) - greatest(a2, b2)) AS i, (a3 - a1) * (a4 - a2) + (b3 - b1) * (b4 - b2) - greatest(0, least(a3, b3) - greatest(a1, b1)) * greatest(0, least(a4, b4) - greatest(a2, b2)) AS u FROM (SELECT DISTINCT track_id, pos, pos % 5 / 10.0 AS a1, 0.1 AS a2, pos % 5 / 10.0 + 0.4 AS a3, 0.3 AS a4, pos % 3 / 10.0 AS b1, 0.2 AS b2, pos % 3 / 10.0 + pos % 2 * 0.5 AS b3, 0.4 AS b4 FROM cues WHERE pos IS NOT NULL))")
def boxes(spark, d):
    """Overlap, distance and mapping of boxes whose places come from the cues' positions."""
    p = F.col("pos")
    a = F.array(p % 5 / 10.0, F.lit(0.1), p % 5 / 10.0 + 0.4, F.lit(0.3))
    b = F.array(p % 3 / 10.0, F.lit(0.2), p % 3 / 10.0 + p % 2 * 0.5, F.lit(0.4))
    region = F.array(F.lit(0.2), F.lit(0.0), F.lit(0.7), F.lit(1.0))
    rows = table(spark, d, "cues").where("pos is not null").select("track_id", "pos").distinct()
    return rows.select("track_id", "pos", F.round(scalars.box_iou(a, b), 9).alias("iou"), F.round(scalars.box_distance(a, b), 9).alias("distance"), F.round(F.get(scalars.mapped_box(a, region), 0), 9).alias("mapped_x1"))


@query("SELECT track_id, CASE WHEN last - media > 5.0 THEN 'failure' WHEN last - media > 0.5 THEN 'warning' ELSE 'ok' END AS band FROM (SELECT track_id, max(cue_end) AS last, max(cue_start) + length(track_id) % 4 AS media FROM cues WHERE track_id IS NOT NULL GROUP BY 1)")
def overrun_bands(spark, d):
    """How far each track's captions go beyond a medium that ends a little after the last cue begins."""
    last = table(spark, d, "cues").where("track_id is not null").groupBy("track_id").agg(F.max("cue_end").alias("last"), F.max("cue_start").alias("s"))
    return last.select("track_id", scalars.overrun_band(F.col("last"), F.col("s") + F.length("track_id") % 4).alias("band"))


@query("SELECT item, l AS language, k AS kind FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY r, l) AS n FROM (SELECT *, (CASE WHEN l = 'zh-CN' THEN 0 WHEN l = 'en' THEN 1 WHEN f = 'zh' THEN 100 WHEN f = 'en' THEN 101 ELSE 1000 END) * 2 + (k <> 'manual')::INT AS r FROM (SELECT DISTINCT bvid || '/' || batch_id AS item, l, CASE WHEN l LIKE 'ai-%' THEN 'automatic' ELSE 'manual' END AS k, split_part(regexp_replace(lower(trim(l)), '^ai-', ''), '-', 1) AS f FROM (SELECT bvid, batch_id, unnest(languages) AS l FROM bilibili_sources WHERE bvid IS NOT NULL AND batch_id IS NOT NULL))) WHERE r < 2000) WHERE n = 1")
def best_captions(spark, d):
    rows = table(spark, d, "bilibili_sources").where("bvid is not null and batch_id is not null").select(F.concat_ws("/", "bvid", "batch_id").alias("item"), F.explode("languages").alias("language")).distinct()
    offered = rows.withColumn("kind", F.when(F.col("language").startswith("ai-"), "automatic").otherwise("manual"))
    return bundles.best_caption(offered, ["zh-CN", "en"]).select("item", "language", "kind")


@query("SELECT category, speaker, n_rows FROM (SELECT category, speaker, count(*) AS n_rows, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, speaker) AS n FROM audio_urls WHERE coalesce(category, '') <> '' AND coalesce(speaker, '') <> '' GROUP BY 1, 2) WHERE n <= 10")
def category_speakers(spark, d):
    counts = _queue(spark, d).where("coalesce(category, '') <> '' and coalesce(speaker, '') <> ''").groupBy("category", "speaker").agg(F.count("*").alias("n_rows"))
    place = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("n_rows"), "speaker"))
    return counts.withColumn("n", place).where("n <= 10").select("category", "speaker", "n_rows")


@query("SELECT count(*) AS n_kept, coalesce(sum(CAST(duration AS DECIMAL(18, 3))), 0) AS kept_s FROM audio_urls WHERE status = 'done' AND coalesce(local_path, '') <> '' AND local_path NOT ILIKE 'dup:%'")
def kept_duration(spark, d):
    return _queue(spark, d).where(filters.kept()).agg(F.count("*").alias("n_kept"), F.coalesce(F.sum(F.col("duration").cast("decimal(18,3)")), F.lit(0)).cast("decimal(38,3)").alias("kept_s"))


_DIMS = {
    "batch": "batch_id", "category": "dataset_category", "content_kind": "content_kind", "profile": "profile", "language": "content_language", "rights_status": "rights.status", "ai_generation_status": "ai_generation.status",
    "speaker_count_status": "speaker_count_status", "speaker_count_values": "CAST(speaker_count AS VARCHAR)", "caption_required": "CAST(require_caption AS VARCHAR)",
}


@query(f"SELECT dim, value, count(*) AS n_rows, sum(CAST(s AS DECIMAL(18, 3))) AS seconds FROM (SELECT unnest([{', '.join(repr(x) for x in _DIMS)}]) AS dim, unnest([{', '.join(f'coalesce(nullif({x}, {chr(39) * 2}), {chr(39)}unknown{chr(39)})' for x in _DIMS.values())}]) AS value, coalesce(max_duration_seconds, 0) AS s FROM bilibili_sources) GROUP BY 1, 2")
def batch_histograms(spark, d):
    """Ten histograms of a batch with the seconds that its items allow, in one pass."""
    pairs = F.array(*[F.struct(F.lit(n).alias("dim"), F.coalesce(F.nullif(F.expr(c.replace("VARCHAR", "STRING")), F.lit("")), F.lit("unknown")).alias("value")) for n, c in _DIMS.items()])
    rows = table(spark, d, "bilibili_sources").select(F.coalesce("max_duration_seconds", F.lit(0)).alias("s"), F.inline(pairs))
    return rows.groupBy("dim", "value").agg(F.count("*").alias("n_rows"), F.sum(F.col("s").cast("decimal(18,3)")).cast("decimal(38,3)").alias("seconds"))


@query("SELECT track_id, string_agg(x, chr(10) ORDER BY s, e, x) || chr(10) AS txt FROM (SELECT DISTINCT track_id, greatest(cue_start, 0) AS s, greatest(cue_start, cue_end, 0) AS e, trim(text, ' ') AS x FROM cues WHERE trim(coalesce(text, ''), ' ') <> '') GROUP BY 1")
def text_render(spark, d):
    rows = table(spark, d, "cues").select("track_id", F.greatest("cue_start", F.lit(0.0)).alias("s"), F.greatest("cue_start", "cue_end", F.lit(0.0)).alias("e"), F.trim("text").alias("x")).distinct()
    return feeds.render_text(rows, "track_id", "s", "e", "x")


# --- registry, layouts and listings --------------------------------------------------------------------------------------------------


@query("SELECT 'uncrawled' AS scan, feed_url, row_number() OVER (ORDER BY discovered_at NULLS FIRST, feed_url) AS n FROM feed_registry WHERE coalesce(last_crawled, '') = '' UNION ALL SELECT 'crawled', feed_url, row_number() OVER (ORDER BY last_crawled, feed_url) FROM feed_registry WHERE coalesce(last_crawled, '') <> '' UNION ALL SELECT 'all', feed_url, row_number() OVER (ORDER BY discovered_at DESC NULLS LAST, feed_url) FROM feed_registry")
def feed_scans(spark, d):
    """The three ordered scans of the registry, a table of fixed size."""
    r = table(spark, d, "feed_registry")
    crawled = F.coalesce("last_crawled", F.lit("")) != ""
    scan = lambda name, rows, *order: rows.select(F.lit(name).alias("scan"), "feed_url", F.row_number().over(Window.orderBy(*order, "feed_url")).cast("long").alias("n"))
    return scan("uncrawled", r.where(~crawled), "discovered_at").unionByName(scan("crawled", r.where(crawled), "last_crawled")).unionByName(scan("all", r, F.col("discovered_at").desc_nulls_last()))


@query("WITH n AS (SELECT source, CAST(id % 50 AS VARCHAR) AS checkpoint_key, url AS checkpoint_value, coalesce(discovered_at, '') AS updated_at, id FROM audio_urls WHERE source IS NOT NULL) SELECT source, checkpoint_key, arg_max(checkpoint_value, (updated_at, checkpoint_value)) AS checkpoint_value, max(updated_at) AS updated_at FROM n GROUP BY 1, 2")
def checkpoints(spark, d):
    """What was last seen under each of fifty keys of a source; where two were seen at once, the greater value."""
    n = _queue(spark, d).where("source is not null").select("source", (F.col("id") % 50).cast("string").alias("checkpoint_key"), F.col("url").alias("checkpoint_value"), F.coalesce("discovered_at", F.lit("")).alias("updated_at"))
    one = n.groupBy("source", "checkpoint_key", "updated_at").agg(F.max("checkpoint_value").alias("checkpoint_value"))
    return listings.put_checkpoints(one.limit(0), one)


@query("SELECT id, CASE WHEN status = 'downloading' AND coalesce(lease_expires_at, '') = '' THEN 'pending' ELSE status END AS status, coalesce(artifact_kind, 'audio') AS artifact_kind, coalesce(lease_expires_at, '') AS lease_expires_at, '' AS job_key, 0 AS attempts FROM audio_urls")
def evolved_queue(spark, d):
    """The queue as an older layout without keys, brought to the current one."""
    old = _queue(spark, d).select("id", "status", "artifact_kind", "lease_expires_at")
    return listings.evolved(old, {"artifact_kind": ("string", "audio"), "job_key": ("string", ""), "lease_expires_at": ("string", ""), "attempts": ("int", 0)})


@query("SELECT trim(feed_url) AS feed_url, trim(coalesce(podcast_name, '')) AS name, trim(coalesce(artist, '')) AS artist, CASE WHEN language = 'zh' THEN 'zh' ELSE 'en' END AS language FROM feed_registry WHERE trim(coalesce(feed_url, '')) <> ''")
def store_listing(spark, d):
    """The registry written as a store's answers, forty feeds each, and read again."""
    entry = F.struct(F.col("feed_url").alias("feedUrl"), F.col("podcast_name").alias("collectionName"), F.col("artist").alias("artistName"), F.split("genre", ",").alias("genres"))
    rows = table(spark, d, "feed_registry").withColumn("country", F.when(F.col("language") == "zh", "cn").otherwise("us")).withColumn("page", F.abs(F.xxhash64("feed_url")) % 10)
    answers = rows.groupBy("country", "page").agg(F.to_json(F.struct(F.collect_list(entry).alias("results"))).alias("body"))
    return listings.store_results(answers).drop("genres")


@query("SELECT trim(feed_url) AS feed_url, trim(coalesce(podcast_name, '')) AS name, CASE WHEN starts_with(l, 'zh') THEN 'zh' ELSE substr(l, 1, 2) END AS language FROM (SELECT *, lower(trim(coalesce(language, ''))) AS l FROM feed_registry) WHERE trim(coalesce(feed_url, '')) <> '' AND CASE WHEN starts_with(l, 'zh') THEN 'zh' ELSE substr(l, 1, 2) END IN ('', 'zh', 'en')")
def index_listing(spark, d):
    entry = F.struct(F.col("feed_url").alias("originalUrl"), F.col("podcast_name").alias("title"), F.col("language"))
    answers = table(spark, d, "feed_registry").groupBy((F.abs(F.xxhash64("feed_url")) % 10).alias("page")).agg(F.to_json(F.struct(F.collect_list(entry).alias("feeds"))).alias("body"))
    return listings.index_results(answers).select("feed_url", "name", "language")


@query("SELECT DISTINCT bvid, part, bvid || ' - p' || part AS title FROM (SELECT bvid, unnest(parts) AS part FROM (SELECT bvid, arg_min(parts, batch_id) AS parts FROM bilibili_sources WHERE coalesce(bvid, '') <> '' AND parts IS NOT NULL AND batch_id IS NOT NULL GROUP BY 1, batch_id QUALIFY batch_id = min(batch_id) OVER (PARTITION BY bvid)))")
def search_listing(spark, d):
    """Items written as search answers, one for each item and batch, and read again: of an item found in several batches the first counts."""
    b = table(spark, d, "bilibili_sources").where("coalesce(bvid, '') <> '' and parts is not null and batch_id is not null").dropDuplicates(["bvid", "batch_id"])
    pages = F.transform("parts", lambda p: F.struct(p.alias("page"), p.cast("long").alias("cid"), F.concat(F.lit("p"), p).alias("part"), F.lit(1.0).alias("duration")))
    video = F.struct("bvid", F.concat(F.lit("<em>"), "bvid", F.lit("</em>")).alias("title"), pages.alias("pages"))
    answers = b.select(F.col("batch_id").alias("keyword"), F.lit(1).alias("page"), F.to_json(F.struct(F.struct(F.array(video).alias("result")).alias("data"))).alias("body"))
    return listings.search_parts(answers).select("bvid", "part", "title").distinct()


@query()
def probed_frontier(spark, d):
    """Ids of the queue found by probing around three seeds, each source being an album that spreads from fifty hits."""
    known = _queue(spark, d).select(F.col("id").alias("track"), F.col("source").alias("album"))
    return listings.frontier(spark, [5, 300, 900], known, 3, 50, 600)


@query("SELECT count(*) AS n_files, 0 AS n_excluded, count(*) FILTER (contains(text, 'microphone failed') OR contains(text, 'microphone%20failed') OR contains(text, 'microphone+failed') OR contains(text, to_base64(encode('microphone failed'))) OR contains(text, rtrim(to_base64(encode('microphone failed')), '='))) AS n_leaking FROM documents WHERE text IS NOT NULL")
def leaked_needle(spark, d):
    files = table(spark, d, "documents").where("text is not null").select(F.concat("doc_id", F.lit(".txt")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    return bundles.leak_audit(files, ["microphone failed"]).select("n_files", "n_excluded", "n_leaking")


@query("SELECT coalesce(b.bundle, '') AS bundle, CASE WHEN r.id IS NULL THEN 'orphan' WHEN b.key IS NULL THEN 'bundle_missing' WHEN b.key <> r.job_key THEN 'other_job' ELSE 'ok' END AS finding, count(*) AS n_rows FROM (SELECT id, job_key, coalesce(source_id, '') AS bundle FROM audio_urls WHERE status = 'done' AND coalesce(source_id, '') <> '' AND coalesce(job_key, '') <> '') r FULL JOIN (SELECT source_id AS bundle, max(job_key) AS key FROM audio_urls WHERE coalesce(source_id, '') <> '' AND coalesce(job_key, '') <> '' AND source = 'youtube' GROUP BY 1) b ON r.bundle = b.bundle GROUP BY 1, 2")
def bundle_closure(spark, d):
    """Finished rows with a job against the bundles of one source, taken as described by their last job."""
    a = _queue(spark, d).where("coalesce(source_id, '') <> '' and coalesce(job_key, '') <> ''")
    described = a.where("source = 'youtube'").groupBy(F.col("source_id").alias("bundle")).agg(F.max("job_key").alias("k")).select("bundle", F.to_json(F.struct(F.col("k").alias("job_key"))).alias("document"))
    rows = a.select("id", "status", F.col("source_id").alias("bundle_path"), "job_key", F.lit("f").alias("content_hash"))
    found = bundles.row_closure(rows, bundles.read_sidecars(described), described.select("bundle", F.lit("f").alias("fingerprint")))
    known = F.when(F.col("finding") == "bundle_missing", "").otherwise(F.col("bundle"))
    return found.groupBy(known.alias("bundle"), "finding").agg(F.count("*").alias("n_rows"))


@query()
def sidecar_documents(spark, d):
    return _queue(spark, d).select("id", bundles.sidecar_document().alias("document"))


@query()
def track_provenance(spark, d):
    """The manifest's languages as caption tracks, classified by their marks."""
    rows = table(spark, d, "bilibili_sources").select("bvid", "batch_id", F.posexplode("languages").alias("pos", "lan"))
    track = F.to_json(F.struct(F.when(F.col("pos") % 3 < 2, F.col("pos") % 2).alias("type"), "lan", F.struct(F.when(F.col("pos") % 2 == 0, 7).alias("mid")).alias("author")))
    return rows.select("bvid", "batch_id", "pos", documents.provenance(track).alias("p")).select("bvid", "batch_id", "pos", "p.kind", "p.selected_by_rule")
