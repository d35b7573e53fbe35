import hashlib
import json

import pytest
from pyspark.sql import functions as F

from loomcast.operators import bundles as B

HASH = hashlib.sha256(b"x").hexdigest()


def part(**changes):
    d = {
        "schema_version": 3, "asset_type": "bilibili_parent", "source": "bilibili", "source_id": "BV1234567890_p2", "bvid": "BV1234567890", "cid": 5, "part": 2, "aid": 9, "job_key": "job", "content_language": "zh", "acquired_at": "2026",
        "canonical_url": "https://www.bilibili.com/video/BV1234567890?p=2", "rights": {"status": "licensed", "evidence_text": "t"}, "rights_cleared": True, "ai_generation": {"status": "unknown"}, "speaker_count": None, "speaker_count_status": "needs_review",
        "declared_duration_seconds": 10.0, "source_streams": {"video": {"codec": 7}}, "acquisition_policy": {"max_height": 480}, "caption": {"status": "downloaded", "track_count": 1, "tracks": [{"language": "zh"}]},
        "files": {"video": {"path": "source.mp4", "bytes": 1, "sha256": HASH}, "audio": {"path": "audio.wav", "bytes": 1, "sha256": HASH}},
    }
    return json.dumps(d | changes)


def item(**changes):
    d = {
        "schema_version": 2, "asset_type": "youtube_parent", "source_id": "abcdefghijk", "job_key": "job", "profile": "youtube_interviews", "language": "en", "caption": {"status": "missing"}, "rights": {"status": "unknown"}, "rights_cleared": False,
        "ai_generation": {"status": "declared"}, "speaker_count": 2, "speaker_count_status": "verified_manual", "duration_seconds": 10.0, "files": {"video": {"path": "v", "bytes": 1, "sha256": HASH}, "audio": {"path": "a", "bytes": 1, "sha256": HASH}},
    }
    return json.dumps(d | changes)


def judged(spark, documents, rules, above="BV1234567890_p2"):
    df = spark.createDataFrame([(f"/root/{i}/{above}/job", d) for i, d in enumerate(documents)], "bundle string, document string")
    return [r.v for r in B.read_sidecars(df).select("bundle", rules.alias("v")).orderBy(F.regexp_extract("bundle", r"/root/(\d+)/", 1).cast("int")).collect()]


def test_rules_of_parts(spark):
    cases = [
        (part(), []), (part(job_key="other"), ["bundle_name"]), (part(part=3), ["source_id", "canonical_url"]), (part(rights_cleared=False), ["rights_cleared"]), (part(speaker_count=2), ["speaker_count"]), (part(cid=None), ["part"]),
        (part(caption={"status": "downloaded", "track_count": 0, "tracks": []}), ["caption_tracks"]), (part(caption={"status": "unknown", "track_count": 2, "tracks": []}), ["track_count"]), (part(source_streams={"baseUrl": 1}), ["streams"]), (part(content_language=None), ["content_language"]),
        (part(source_streams={"x": "sig=1"}), ["secrets"]), (part(declared_duration_seconds=0.0), ["declared_duration"]), (part(files={}), ["files"]), ("{", ["document"]), (None, ["document"]), ("[]", ["document"]),
    ]
    assert judged(spark, [c[0] for c in cases], B.part_rules()) == [c[1] for c in cases]


def test_rules_of_items(spark):
    clip = {"asset_type": "youtube_screen_clip", "clip_id": "job", "profile": "youtube_screen_clips", "start_ms": 0, "end_ms": 10000}
    full = {"video": {}, "audio": {}, "caption_vtt": {}, "transcript_txt": {}}
    captioned = {"caption": {"status": "downloaded", "track_language": "en-GB"}, "files": full}
    cases = [
        (item(), []), (item(profile="x"), ["profile", "classification"]), (item(content_kind="screen_media", dataset_category="访谈"), ["classification"]), (item(**captioned), []), (item(**(captioned | {"language": "de"})), ["caption_language"]), (item(files=full), ["files"]),
        (item(**clip, **captioned), []), (item(**clip), ["clip_caption"]), (item(**(clip | {"end_ms": 9000}), **captioned), ["duration"]), (item(source_id="short"), ["source_id"]), (item(duration_seconds=None), ["duration"]),
    ]
    assert judged(spark, [c[0] for c in cases], B.item_rules()) == [c[1] for c in cases]


def test_closure_of_files(spark):
    read = B.read_sidecars(spark.createDataFrame([("b", part()), ("c", part()), ("d", part(files={"video": {"path": "../x", "bytes": 1, "sha256": HASH}})), ("e", "{")], "bundle string, document string"))
    files = [("b", "source.mp4", 1, HASH), ("b", "audio.wav", 1, HASH), ("b", "metadata.json", 9, "h"), ("c", "source.mp4", 2, HASH), ("c", "audio.wav", 1, "other"), ("c", "extra", 1, HASH), ("f", "alone", 1, HASH)]
    there = spark.createDataFrame(files, "bundle string, name string, length long, sha256 string")
    assert {r.bundle: r.violations for r in B.file_rules(read, there).collect()} == {"c": ["file_bytes", "file_hash", "file_unexpected"], "d": ["file_escapes"], "f": ["file_unexpected"]}
    all_of = B.all_violations(read.select("bundle", B.part_rules().alias("violations")), B.file_rules(read, there))
    got = {r.bundle: r.violations for r in all_of.collect()}
    assert "file_hash" in got["c"] and "file_hash" not in got["b"] and got["e"] == ["document"]


def test_media(spark):
    read = B.read_sidecars(spark.createDataFrame([("b", part()), ("c", part()), ("d", part())], "bundle string, document string"))
    wav = ("audio", "audio", "pcm_s16le", 16000, 1, None, 10.1)
    probes = [("b", "video", "video", "h264", None, None, 480, 10.0), ("b", "video", "audio", "aac", 44100, 2, None, 10.0), ("b", *wav), ("c", "video", "video", "h264", None, None, 720, 13.0), ("c", *wav)]
    df = spark.createDataFrame(probes, "bundle string, file string, kind string, codec string, sample_rate int, channels int, height int, duration double")
    got = {r.bundle: r.violations for r in B.media_rules(read, df, 0.5).collect()}
    assert got["c"] == ["video_streams", "height", "drift", "declared"] and "b" not in got and len(got["d"]) == 7


def test_recognised_captions(spark):
    cue = {"start": 0.0, "end": 1.5, "text": "a", "confidence": 0.9, "observations": 3, "bbox_norm": [0.1, 0.1, 0.5, 0.2]}
    doc = lambda cues, mean=0.9, **q: json.dumps({"schema_version": 1, "cues": cues, "quality": {"detections_candidate": 5, "detections_accepted": 4, "detections_filtered": 1, "cues_emitted": len(cues), "mean_confidence": mean} | q})
    cases = [
        (doc([cue]), []), (doc([], None), []), (doc([cue], 0.8), ["mean_confidence"]), (doc([cue], cues_emitted=2), ["cues_emitted"]), (doc([cue | {"start": 0.1234567}]), ["rounding"]), (doc([cue | {"start": 1.0}, cue]), ["order"]),
        (doc([cue | {"end": 99.0}]), ["times"]), (doc([cue | {"bbox_norm": [0.5, 0.1, 0.1, 0.2]}]), ["box"]), (doc([cue], detections_filtered=2), ["detections"]), ("{}", ["document"]), (doc([cue | {"text": " ", "observations": 1}]), ["text", "observations"]),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    assert [r.v for r in df.select("i", B.ocr_rules(F.col("t"), F.lit(10.0)).alias("v")).orderBy("i").collect()] == [c[1] for c in cases]


def test_doctor_and_leaks(spark):
    found = B.doctor({"a": spark.range(3), "b": spark.range(1)}, {"a": ["id"], "b": ["id", "x"], "c": ["id"]})
    assert [(r["status"], r["missing_columns"], r["n_rows"]) for r in found] == [("ok", [], 3), ("error", ["x"], None), ("warn", [], None)]
    secret = "p+w/é\"1"
    wav = b"RIFF" + secret.encode()
    from loomcast.functions.text import secret_forms

    files = [("clean.txt", b"nothing \xff\x00"), ("a.wav", wav), ("b.wav", wav + b"!"), *[(f"f{i}.txt", b"\xff .. " + f.encode()) for i, f in enumerate(secret_forms(secret))]]
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in files], "path string, content binary")
    declared = spark.createDataFrame([("a.wav", len(wav), hashlib.sha256(wav).hexdigest()), ("b.wav", 1, "h")], "path string, bytes long, sha256 string")
    r = B.leak_audit(df, [secret], declared).first()
    assert (r.n_files, r.n_excluded, r.n_leaking, r.status) == (len(files), 1, len(files) - 2, "failed") and secret not in str(r)
    assert B.leak_audit(df.where("path = 'clean.txt'"), [secret]).first().status == "clean"
    with pytest.raises(ValueError):
        B.leak_audit(df, [""])


def test_rows_lineage_and_moves(spark):
    read = B.read_sidecars(spark.createDataFrame([("p/ok", part()), ("p/orphan", part()), ("p/bad", "{"), ("p/other", part(job_key="o")), ("p/changed", part())], "bundle string, document string"))
    rows = [(i, "done", b, "job", "f") for i, b in enumerate(["p/ok", "p/bad", "p/other", "p/changed", "p/gone"])] + [(9, "pending", "p/x", "job", "f"), (10, "done", "", "job", "f")]
    prints = spark.createDataFrame([("p/ok", "f"), ("p/orphan", "f"), ("p/bad", "f"), ("p/other", "f"), ("p/changed", "g")], "bundle string, fingerprint string")
    got = {r.bundle: r.finding for r in B.row_closure(spark.createDataFrame(rows, "id long, status string, bundle_path string, job_key string, content_hash string"), read, prints).collect()}
    assert got == {"p/ok": "ok", "p/orphan": "orphan", "p/bad": "document_unreadable", "p/other": "other_job", "p/changed": "changed", "p/gone": "bundle_missing"}
    moves, conflicts = B.relocation(read, spark.createDataFrame([("o", "elsewhere")], "job_key string, bundle_path string"), "/lib/")
    assert moves.count() == 0 and sorted((r.bundle, r.reason) for r in conflicts.collect()) == [("p/bad", "unreadable"), ("p/changed", "target_twice"), ("p/ok", "target_twice"), ("p/orphan", "target_twice"), ("p/other", "registered_elsewhere")]
    assert [r.target for r in B.relocation(read.where("bundle = 'p/ok'"), spark.createDataFrame([], "job_key string, bundle_path string"), "/lib")[0].collect()] == ["/lib/bilibili/BV1234567890_p2/job"]
    key = "parent_source_id string, parent_media_sha256 string, parent_caption_sha256 string"
    good, bad = B.clip_lineage(spark.createDataFrame([("a", "m", "c"), ("a", "m", "x")], key), spark.createDataFrame([("a", "m", "c")], key))
    assert good.count() == bad.count() == 1
    filled, lost = B.inherited(spark.createDataFrame([("j", "", "en"), ("k", "x", "")], "parent_job_key string, rights string, language string"), spark.createDataFrame([("j", "licensed", "fr")], "job_key string, rights string, language string"), ["rights", "language"])
    assert [tuple(r) for r in filled.collect()] == [("j", "licensed", "en")] and lost.count() == 1


def test_captions_to_take(spark):
    cues = "id int, cues array<struct<start:double,end:double,text:string>>"
    ok, apart = B.caption_payloads(spark.createDataFrame([(1, [(0.0, 1.0, "a")]), (2, [(0.0, 99.0, "a")]), (3, []), (4, None)], cues), F.lit(10.0))
    assert [r.id for r in ok.collect()] == [1] and sorted((r.id, r.reason) for r in apart.collect()) == [(2, "invalid_timeline"), (3, "empty"), (4, "unreadable")]
    offered = [("v", "en", "automatic"), ("v", "en-GB", "manual"), ("w", "fr", "manual"), ("x", "zh-Hant", "automatic"), ("x", "zh-Hans", "manual")]
    df = spark.createDataFrame(offered, "item string, language string, kind string")
    assert sorted(tuple(r) for r in B.best_caption(df, ["en", "zh"]).collect()) == [("v", "en", "automatic", "exact_requested_language"), ("x", "zh-Hans", "manual", "language_family_fallback")]
    assert {r.item: r.language for r in B.best_caption(df, []).collect()} == {"v": "en-GB", "w": "fr", "x": "zh-Hans"}
