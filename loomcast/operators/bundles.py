"""Bundles of files with a describing document: validation as lists of violated rules, closure, lineage, relocation and audits.

A rule never throws: a whole corpus is judged in one pass, and each bundle has an array of the names of the rules that it breaks (empty: valid). A rule that can't be
judged because what it looks at is missing counts as broken. Documents that can't be read break the rule `document` alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import documents, language, scalars, text
from ..sources import manifests

SIDECAR = (
    "struct<schema_version:int,asset_type:string,source:string,source_id:string,bvid:string,cid:bigint,part:int,aid:bigint,job_key:string,canonical_url:string,storage_layout:string,content_language:string,"
    "language:string,profile:string,dataset_category:string,content_kind:string,acquired_at:string,rights:struct<status:string,evidence_url:string,evidence_text:string>,rights_cleared:boolean,"
    "ai_generation:struct<status:string,evidence:array<string>>,speaker_count:int,speaker_count_status:string,declared_duration_seconds:double,duration_seconds:double,start_ms:bigint,end_ms:bigint,clip_id:string,"
    "cue_count:int,parent_source_id:string,parent_media_sha256:string,parent_caption_sha256:string,source_streams:string,acquisition_policy:struct<max_height:int>,"
    "caption:struct<status:string,kind:string,language:string,track_language:string,track_count:int,tracks:array<struct<language:string,kind:string>>>,"
    "files:map<string,struct<path:string,bytes:bigint,sha256:string>>>"
)

# States of a caption without tracks, and marks of signed addresses and headers in a document.
NO_CAPTION = ("auth_required", "not_provided_publicly", "no_matching_language", "invalid_track_inventory", "invalid_timeline", "unknown")
SIGNED = ("token=", "signature=", "sig=", "expire=", "expires=", "policy=", "key-pair-id=", "x-goog-", "x-amz-", "authorization:", "authorization=", "cookie:", "cookie=")


def broken(rules: dict[str, Column]) -> Column:
    """The names of the rules whose condition of breach holds, or can't be judged."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules.items()]))


def read_sidecars(sidecars: DataFrame, document: str = "document") -> DataFrame:
    """`bundle`, `document`, `d` (typed, NULL if unreadable)."""
    readable = F.try_parse_json(document).isNotNull() & F.trim(document).startswith("{")
    return sidecars.select("bundle", F.col(document).alias("document"), F.when(readable, F.from_json(document, SIDECAR)).alias("d"))


def _name(bundle: str = "bundle") -> Column:
    return F.regexp_extract(bundle, r"([^/]+)/*$", 1)


def _above(bundle: str = "bundle") -> Column:
    return F.regexp_extract(bundle, r"([^/]+)/[^/]+/*$", 1)


def _shared_rules() -> dict[str, Column]:
    d = F.col("d")
    lower = F.lower(F.col("document"))
    count = d["speaker_count"]
    return {
        "rights": ~d["rights"]["status"].isin(*manifests.RIGHTS), "rights_cleared": ~d["rights_cleared"].eqNullSafe(manifests.cleared(d["rights"])), "ai_generation": ~d["ai_generation"]["status"].isin(*manifests.AI_STATES),
        "speaker_count": F.when(count.isNull(), d["speaker_count_status"] != "needs_review").otherwise((count <= 0) | (d["speaker_count_status"] != "verified_manual")),
        "secrets": F.exists(F.array(*map(F.lit, SIGNED)), lambda m: F.contains(lower, m)),
    }


def part_rules() -> Column:
    """What a bundle of one part of an item breaks of identity, place, provenance and captions."""
    d = F.col("d")
    status, tracks = d["caption"]["status"], d["caption"]["tracks"]
    rules = {
        "asset_type": d["asset_type"] != "bilibili_parent", "bundle_name": d["job_key"] != _name(), "bvid": ~d["bvid"].rlike("^BV[0-9A-Za-z]{10}$"), "part": ~((d["cid"] > 0) & d["part"].between(1, 1000)),
        "source_id": d["source_id"] != F.concat(d["bvid"], F.lit("_p"), d["part"]), "canonical_url": d["canonical_url"] != F.concat(F.lit("https://www.bilibili.com/video/"), d["bvid"], F.lit("?p="), d["part"]),
        "place": ~F.when(F.coalesce(d["storage_layout"], F.lit("")) == "legacy_dataset", _above() == F.concat(F.lit("p"), d["part"])).otherwise(_above() == d["source_id"]),
        "aid": d["aid"] <= 0, "content_language": d["content_language"] == "", "acquired_at": d["acquired_at"] == "", "streams": d["source_streams"].isNull() | F.contains(F.lower(d["source_streams"]), F.lit("url")),
        "declared_duration": ~(scalars.finite(d["declared_duration_seconds"], 0, 1e9) & (d["declared_duration_seconds"] > 0)), "max_height": ~d["acquisition_policy"]["max_height"].between(144, 1080),
        "caption_status": ~status.isin("downloaded", *NO_CAPTION), "track_count": d["caption"]["track_count"] != F.size(tracks), "caption_tracks": (status == "downloaded") != (F.size(tracks) > 0),
        "files": ~F.forall(F.array(F.lit("video"), F.lit("audio")), lambda n: F.map_contains_key(d["files"], n)),
    }
    return F.when(d.isNull(), F.array(F.lit("document"))).otherwise(broken(rules | _shared_rules()))


def item_rules() -> Column:
    """What a bundle of the other platform breaks: a whole item or a clip of one."""
    d = F.col("d")
    clip = d["asset_type"] == "youtube_screen_clip"
    parted = manifests.classification(d["profile"], d["dataset_category"], d["content_kind"])
    has_caption = F.coalesce(d["caption"]["status"], F.lit("downloaded")) == "downloaded"
    wanted = F.when(has_caption, F.array(*map(F.lit, ("audio", "caption_vtt", "transcript_txt", "video")))).otherwise(F.array(F.lit("audio"), F.lit("video")))
    rules = {
        "asset_type": ~d["asset_type"].isin("youtube_parent", "youtube_screen_clip"), "profile": ~d["profile"].isin(*manifests.KIND_OF_PROFILE), "classification": F.size(parted["violations"]) > 0, "language": d["language"] == "",
        "caption_language": has_caption & ~language.matches(F.coalesce(d["caption"]["track_language"], d["caption"]["language"], F.lit("")), d["language"]), "clip_caption": clip & ~has_caption,
        "files": F.array_sort(F.map_keys(d["files"])) != wanted, "bundle_name": F.when(clip, d["clip_id"]).otherwise(d["job_key"]) != _name(),
        "source_id": ~clip & ~d["source_id"].rlike("^[A-Za-z0-9_-]{11}$"), "clip_profile": clip & (d["profile"] != "youtube_screen_clips"),
        "duration": ~(d["duration_seconds"] > 0) | (clip & (F.abs(d["duration_seconds"] - (d["end_ms"] - d["start_ms"]) / 1000) > 0.001)),
    }
    return F.when(d.isNull(), F.array(F.lit("document"))).otherwise(broken(rules | _shared_rules()))


def file_rules(read: DataFrame, files: DataFrame, sidecar: str = "metadata.json") -> DataFrame:
    """`bundle`, `violations` of the closure: declared files (`d.files`) against those that are there (`bundle`, `name`, `length`, `sha256`), both ways.

    One row a file is joined on equal keys and folded to the few names of rules, so no bundle is gathered.
    """
    declared = read.where("d is not null").select("bundle", F.explode(F.map_values("d.files")).alias("f")).select("bundle", F.col("f.path").alias("name"), F.col("f.bytes").alias("bytes"), F.col("f.sha256").alias("hash"))
    twice = declared.groupBy("bundle", "name").agg(F.count("*").alias("n")).where("n > 1").select("bundle", F.lit("file_twice").alias("rule"))
    there = files.where(F.col("name") != sidecar).select("bundle", "name", "length", "sha256").withColumn("there", F.lit(True))
    both = declared.withColumn("declared", F.lit(True)).join(there, ["bundle", "name"], "full")
    escapes = F.col("name").startswith("/") | F.array_contains(F.split("name", "/"), "..") | F.col("name").isNull()
    rule = F.when(F.col("declared") & escapes, "file_escapes").when(F.col("there").isNull(), "file_missing").when(F.col("declared").isNull(), "file_unexpected").when(~F.col("bytes").eqNullSafe(F.col("length")), "file_bytes").when(~F.col("hash").eqNullSafe(F.col("sha256")), "file_hash")
    wrong = both.select("bundle", rule.alias("rule")).where("rule is not null").unionByName(twice).distinct()
    return wrong.groupBy("bundle").agg(F.array_sort(F.collect_set("rule")).alias("violations"))


def media_rules(read: DataFrame, probes: DataFrame, most_drift: float, most_height: int = 1080) -> DataFrame:
    """`bundle`, `violations` of probed streams (`bundle`, `file`, `kind`, `codec`, `sample_rate`, `channels`, `height`, `duration`)."""
    at = lambda file, kind: (F.col("file") == file) & (F.col("kind") == kind)
    n = lambda file, kind: F.count_if(at(file, kind))
    s = probes.groupBy("bundle").agg(
        n("video", "video").alias("vv"), n("video", "audio").alias("va"), n("audio", "audio").alias("aa"), n("audio", "video").alias("av"), F.max(F.when(at("video", "video"), F.col("height"))).alias("h"),
        F.count_if(at("audio", "audio") & (F.col("codec") == "pcm_s16le") & (F.col("sample_rate") == 16000) & (F.col("channels") == 1)).alias("wav"),
        F.max(F.when(F.col("file") == "video", F.col("duration"))).alias("dv"), F.max(F.when(F.col("file") == "audio", F.col("duration"))).alias("da"),
    )
    d = F.col("d")
    declared = F.coalesce(d["declared_duration_seconds"], d["duration_seconds"])
    rules = {
        "video_streams": (F.col("vv") < 1) | (F.col("va") < 1), "audio_streams": (F.col("aa") != 1) | (F.col("av") != 0), "audio_format": F.col("wav") != 1,
        "height": F.col("h") > F.coalesce(d["acquisition_policy"]["max_height"], F.lit(most_height)), "media_duration": ~((F.col("dv") > 0) & (F.col("da") > 0)), "drift": F.abs(F.col("dv") - F.col("da")) > most_drift, "declared": F.abs(F.col("dv") - declared) > 2.0,
    }
    return read.where("d is not null").join(s, "bundle", "left").select("bundle", broken(rules).alias("violations")).where("size(violations) > 0")


def all_violations(judged: DataFrame, *more: DataFrame) -> DataFrame:
    """`bundle`, `violations` of several checks together, a row for every bundle of the first."""
    out = judged.select("bundle", "violations")
    for i, x in enumerate(more):
        out = out.join(x.select("bundle", F.col("violations").alias(f"_{i}")), "bundle", "left")
    parts = [F.coalesce(F.col(f"_{i}"), F.array().cast("array<string>")) for i in range(len(more))]
    return out.select("bundle", F.array_distinct(F.concat("violations", *parts)).alias("violations"))


OCR = "struct<schema_version:int,cues:array<struct<start:double,end:double,text:string,confidence:double,observations:int,bbox_norm:array<double>>>,quality:struct<frames_sampled:int,detections_candidate:int,detections_accepted:int,detections_filtered:int,static_tracks_filtered:int,cues_emitted:int,mean_confidence:double>>"


def ocr_rules(document: Column, media_s: Column, least_seen: int = 2) -> Column:
    """What a document of recognised captions breaks: its keys, six decimal places, order, bounds, and counters that must agree with the cues."""
    d = F.from_json(document, OCR)
    cues, q = d["cues"], d["quality"]
    six = lambda x: F.bround(x, 6) == x
    pairs = F.zip_with(F.slice(cues, F.lit(1), F.greatest(F.size(cues) - 1, F.lit(0))), F.slice(cues, F.lit(2), F.greatest(F.size(cues) - 1, F.lit(0))), lambda a, b: F.struct(a["start"], a["end"]) <= F.struct(b["start"], b["end"]))
    mean = F.bround(F.aggregate(cues, F.lit(0.0), lambda s, c: s + c["confidence"]) / F.size(cues), 6)
    rules = {
        "keys": F.array_sort(F.json_object_keys(document)) != F.array(*map(F.lit, ("cues", "quality", "schema_version"))), "times": ~F.forall(cues, lambda c: (c["start"] >= 0) & (c["end"] > c["start"]) & (c["end"] <= media_s + 1e-6)),
        "rounding": ~F.forall(cues, lambda c: six(c["start"]) & six(c["end"]) & six(c["confidence"]) & F.forall(c["bbox_norm"], six)), "order": ~F.forall(pairs, lambda x: x), "text": ~F.forall(cues, lambda c: F.trim(c["text"]) != ""),
        "confidence": ~F.forall(cues, lambda c: c["confidence"].between(0, 1)), "box": ~F.forall(cues, lambda c: scalars.valid_box(c["bbox_norm"])), "observations": ~F.forall(cues, lambda c: c["observations"] >= least_seen),
        "cues_emitted": q["cues_emitted"] != F.size(cues), "detections": q["detections_candidate"] != q["detections_accepted"] + q["detections_filtered"],
        "mean_confidence": F.when(F.size(cues) == 0, q["mean_confidence"].isNotNull()).otherwise(F.abs(mean - q["mean_confidence"]) > 1.5e-6),
    }
    return F.when(d.isNull() | cues.isNull(), F.array(F.lit("document"))).otherwise(broken(rules))


def doctor(tables: dict[str, DataFrame | None], required: dict[str, list[str]]) -> list[dict[str, object]]:
    """How each table is: ok with its rows, warn if it isn't there, error with the columns that it lacks."""
    out = []
    for name, columns in required.items():
        df = tables.get(name)
        missing = [] if df is None else sorted(set(columns) - set(df.columns))
        out.append({"table": name, "status": "warn" if df is None else "error" if missing else "ok", "missing_columns": missing, "n_rows": None if df is None or missing else df.count()})
    return out


# How media files begin.
MAGIC = {"mp4": "00000018667479|00000020667479|0000001c667479", "wav": "52494646", "ogg": "4f676753", "mp3": "494433|fffb|fff3|fff2", "png": "89504e47", "jpg": "ffd8ff"}


def leak_audit(files: DataFrame, secrets: Iterable[str], declared: DataFrame | None = None) -> DataFrame:
    """One row `n_files`, `n_excluded`, `n_leaking`, `status` over `path`, `content` (binary); counts alone, never what was found.

    A secret counts in any of its written forms. Media are left out only if path, length and hash are as declared (`path`, `bytes`, `sha256`) and the
    content begins as the name says; an input without a secret to look for is an error.
    """
    needles = sorted({f for s in secrets for f in text.secret_forms(s)})
    if not needles:
        raise ValueError("no secret to look for")
    rows = files.select("path", "content", F.octet_length("content").cast("long").alias("_n"), F.sha2("content", 256).alias("_h"))
    begins = F.lower(F.hex(F.substring("content", 1, 8)))
    own = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    looks = F.lit(False)
    for extension, starts in MAGIC.items():
        looks = looks | ((own == extension) & begins.rlike(f"^(?:{starts})"))
    if declared is not None:
        rows = rows.join(declared.select("path", F.col("bytes").alias("_n"), F.col("sha256").alias("_h"), F.lit(True).alias("_known")).distinct(), ["path", "_n", "_h"], "left")
    else:
        rows = rows.withColumn("_known", F.lit(None).cast("boolean"))
    # Bytes one to one as letters, so that a needle is found whatever else the file holds.
    letters = F.decode("content", "ISO-8859-1")
    coded = [n.encode().decode("latin-1") for n in needles]
    judged = rows.select((F.coalesce("_known", F.lit(False)) & looks).alias("out"), text.any_needle(letters, coded).alias("hit"))
    out = judged.agg(F.count("*").alias("n_files"), F.count_if("out").alias("n_excluded"), F.count_if(~F.col("out") & F.col("hit")).alias("n_leaking"))
    return out.withColumn("status", F.when(F.col("n_leaking") > 0, "failed").otherwise("clean"))


def row_closure(rows: DataFrame, read: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """`bundle`, `id`, `finding` for finished rows (`id`, `bundle_path`, `job_key`, `content_hash`) against described bundles and their fingerprints, both ways; the first finding of each."""
    done = rows.where("status = 'done' and coalesce(bundle_path, '') <> ''").select("id", F.col("bundle_path").alias("bundle"), "job_key", "content_hash")
    there = read.select("bundle", F.col("d.job_key").alias("_key"), F.col("d").isNotNull().alias("_readable"), F.lit(True).alias("_there")).join(fingerprints.select("bundle", "fingerprint"), "bundle", "left")
    both = done.withColumn("_row", F.lit(True)).join(there, "bundle", "full")
    finding = (
        F.when(F.col("_row").isNull(), "orphan").when(F.col("_there").isNull(), "bundle_missing").when(~F.col("_readable"), "document_unreadable").when(~F.col("_key").eqNullSafe(F.col("job_key")), "other_job")
        .when(F.col("fingerprint").isNull(), "no_files").when(~F.col("fingerprint").eqNullSafe(F.col("content_hash")), "changed").otherwise("ok")
    )
    return both.select("bundle", "id", finding.alias("finding"))


def clip_lineage(clips: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clips whose parent is valid, those without) by the parent's id and the hashes of its media and captions."""
    key = ["parent_source_id", "parent_media_sha256", "parent_caption_sha256"]
    valid = parents.select(*[F.col(c) for c in key]).distinct()
    return clips.join(valid, key, "left_semi"), clips.join(valid, key, "left_anti")


def inherited(clips: DataFrame, parents: DataFrame, columns: list[str], key: str = "parent_job_key") -> tuple[DataFrame, DataFrame]:
    """(clips with what their parent has where they lack it, clips whose parent isn't there)."""
    one = parents.groupBy(F.col("job_key").alias(key)).agg(*[F.max(c).alias(f"_{c}") for c in columns])
    both = clips.join(one.withColumn("_found", F.lit(True)), key, "left")
    filled = both.select(*[(F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")).alias(c) if c in columns else F.col(c)) for c in clips.columns], "_found")
    return filled.where("_found").drop("_found"), filled.where("_found is null").drop("_found")


def caption_payloads(tracks: DataFrame, media_s: Column, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) tracks with `cues` (array<struct<start,end,text>>): unreadable, empty and over-long ones are kept apart with the reason."""
    over = scalars.overrun(F.transform("cues", lambda c: c["end"]), media_s, most)
    why = F.when(F.col("cues").isNull(), "unreadable").when(F.size("cues") == 0, "empty").when(over.isNotNull(), "invalid_timeline")
    judged = tracks.withColumn("reason", why)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def best_caption(offered: DataFrame, wanted: list[str]) -> DataFrame:
    """`item`, `language`, `kind`, `rule`: the caption to take of those offered (`item`, `language`, `kind` manual or automatic).

    Exact languages come before families in the order wanted, manual before automatic within each; others don't count unless nothing was wanted.
    """
    r = language.rank(F.col("language"), wanted) if wanted else F.lit(1000)
    rule = F.when(r < 100, "exact_requested_language").when(r < 1000, "language_family_fallback").otherwise("first_available_language")
    ranked = offered.withColumn("_r", r * 2 + (F.col("kind") != "manual").cast("int")).withColumn("rule", rule)
    fine = ranked.where("_r < 2000") if wanted else ranked
    return fine.groupBy("item").agg(F.min_by(F.struct("language", "kind", "rule"), F.struct("_r", "language")).alias("b")).select("item", "b.*")


def sidecar_document() -> Column:
    """The describing document of a finished row: named fields alone, addresses made bare."""
    from ..functions import urls

    bare = lambda c: urls.redact_web(F.col(c)).alias(c)
    return F.to_json(F.struct(
        F.lit(2).alias("schema_version"), "id", "source", "source_id", "artifact_kind", "job_key", "title", "language", "category", bare("url"), bare("webpage_url"), F.contains(F.coalesce("url", F.lit("")), F.lit("?")).alias("url_had_query"),
        F.struct("file_format", "file_size", "duration", "content_hash", "local_path").alias("file"), F.struct("published_at", "discovered_at", "downloaded_at").alias("times"), documents.as_object(F.col("metadata_json")).alias("metadata"),
    ))


def relocation(read: DataFrame, registered: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(moves `bundle`, `target`, `job_key`, conflicts with their reason): each readable bundle goes to source, item and job below a root.

    One that is registered there already needs no move; another place, an unreadable document, or a target wanted twice is a conflict.
    """
    target = F.concat_ws("/", F.lit(root.rstrip("/")), F.col("d.source"), F.col("d.source_id"), F.col("d.job_key"))
    asked = read.select("bundle", F.when(F.col("d.source").isNotNull() & F.col("d.source_id").isNotNull() & F.col("d.job_key").isNotNull(), target).alias("target"), F.col("d.job_key").alias("job_key"))
    n = asked.where("target is not null").groupBy("target").agg(F.count("*").alias("_n"))
    have = registered.where("coalesce(job_key, '') <> ''").groupBy("job_key").agg(F.max("bundle_path").alias("_at"))
    judged = asked.join(n, "target", "left").join(have, "job_key", "left")
    elsewhere = (F.coalesce("_at", F.lit("")) != "") & (F.col("_at") != F.col("target"))
    judged = judged.withColumn("reason", F.when(F.col("target").isNull(), "unreadable").when(F.col("_n") > 1, "target_twice").when(elsewhere, "registered_elsewhere"))
    moves = judged.where(F.col("reason").isNull() & ~F.col("_at").eqNullSafe(F.col("target"))).select("bundle", "target", "job_key")
    return moves, judged.where("reason is not null").select("bundle", "target", "job_key", "reason")
