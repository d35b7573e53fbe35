import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from loomcast.functions import documents, language, scalars, text, urls
from loomcast.operators import filters, identity, sequences
from loomcast.sources import feeds, manifests, sinks


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items()))
    return row.select(column.alias("x")).first().x


def test_sequential_accept_against_a_loop(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["", None, *"abcdefgh"]), rng.choice(["", None, *"uvwxyz"])) for i in range(120)]
    urls_seen, ids_seen, want = set(), set(), []
    for i, u, s in rows:
        if (u and u in urls_seen) or (s and s in ids_seen):
            continue
        want.append(i)
        urls_seen |= {u} if u else set()
        ids_seen |= {s} if s else set()
    df = spark.createDataFrame(rows, "id long, url string, source_id string")
    assert sorted(r.id for r in identity.sequential_accept(df, "id", "url", "source_id").collect()) == want
    chain = spark.createDataFrame([(1, "u1", "s1"), (2, "u1", "s2"), (3, "u2", "s2")], df.schema)
    assert sorted(r.id for r in identity.sequential_accept(chain, "id", "url", "source_id").collect()) == [1, 3]


def test_enrichment_keeps_old_values(spark):
    stored = spark.createDataFrame([(1, "k", "old", "a"), (2, "z", "t", "")], "id long, k string, title string, author string")
    new = spark.createDataFrame([(1, "k", "", "x"), (2, "k", "newer", None), (3, "k", "newest", "")], "o long, k string, title string, author string")
    got = {r.id: (r.title, r.author) for r in identity.enrich(stored, new, ["k"], ["title", "author"], "o").collect()}
    assert got == {1: ("newest", "x"), 2: ("t", "")}


def test_upsert_against_a_loop(spark):
    rng = random.Random(4)
    columns = "id long, url string, source string, artifact_kind string, job_key string, source_id string, title string, author string"
    make = lambda i: (i, f"u{rng.randrange(25)}", rng.choice("st"), "audio", rng.choice(["", "", "", f"j{rng.randrange(6)}"]), rng.choice(["", f"i{rng.randrange(20)}"]), rng.choice(["", f"t{i}"]), rng.choice([None, f"a{i}"]))
    stored, taken = [], set()
    for i in range(12):
        r = make(i)
        if not taken & {("url", r[1], bool(r[4])), ("job", r[2], r[4])}:
            stored.append(r)
            taken |= {("url", r[1], bool(r[4])), *([("job", r[2], r[4])] if r[4] else [])}
    incoming = [make(100 + i) for i in range(60)]

    def alike(a, b):
        if a[4] or b[4]:
            return (a[2], a[4]) == (b[2], b[4])
        return a[1] == b[1] or (a[5] != "" and (a[2], a[5]) == (b[2], b[5]))

    # A row without a job also counts as there if a stored row with one has its source's id.
    known = lambda r, rows: any(alike(r, x) or (not r[4] and x in stored and r[5] and (r[2], r[5]) == (x[2], x[5])) for x in rows)
    table, new = list(stored), []
    for r in incoming:
        if not known(r, table):
            table.append(r)
            new.append(r[0])
    want, n = {r[0]: list(r) for r in table}, 0
    for r in incoming:
        if r[0] not in new:
            for x in table:
                if alike(r, x):
                    n += 1
                    for c in (6, 7):
                        want[x[0]][c] = r[c] or want[x[0]][c]
    got_new, after, matches = identity.upsert(spark.createDataFrame(stored, columns), spark.createDataFrame(incoming, columns), "id", ["title", "author"])
    assert sorted(r.id for r in got_new.collect()) == new and len(new) > 10
    assert {r.id: list(r) for r in after.collect()} == want and sum(r.n_rows for r in matches.collect()) == n > 10


def test_first_per_group_prunes_before_the_shuffle(spark, sf):
    df = filters.first_per_group(spark.read.parquet(f"{sf}/audio_urls.parquet"), "source", 3)
    assert "WindowGroupLimit" in df._jdf.queryExecution().toString()


def test_cue_groups(spark):
    cues = [
        ("t", 0, 0.0, 6.0, "a"), ("t", 1, 6.5, 8.0, "b"), ("t", 2, 8.0, 8.5, "x"), ("t", 3, 8.6, 8.6, "no length"), ("t", 4, 8.6, 9.9, ""), ("t", 5, 9.0, 30.0, "too long"), ("t", 6, 20.0, 23.0, "c"),
        ("t", 7, 25.0, 26.0, "d\ne"), ("t", 8, 40.0, 41.0, "short"), ("u", 0, 0.0, 4.0, "f"), ("u", 1, 3.0, 9.5, "g"), ("v", 0, 0.0, 9.0, "h"),
    ]
    # One cue at the target stays open for the next; a group goes on to the cue that reaches it.
    want = [("t", 0.0, 8.0, 2, "a\nb"), ("t", 20.0, 26.0, 2, "c\nd\ne"), ("u", 0.0, 4.0, 1, "f"), ("u", 3.0, 9.5, 1, "g"), ("v", 0.0, 9.0, 1, "h")]
    df = spark.createDataFrame(cues, "track_id string, pos int, cue_start double, cue_end double, text string")
    got = [(r.track_id, r.group_start, r.group_end, r.n_cues, r.text) for r in sequences.group_cues(df, 2.0, 9.0, 5.0).orderBy("track_id", "group_start").collect()]
    assert got == want


def test_rolling_overlap(spark):
    df = spark.createDataFrame([("t", 0, "a\nb"), ("t", 1, "b\nc"), ("t", 2, "b\nc"), ("t", 3, None), ("t", 4, "c")], "track_id string, pos int, text string")
    assert [(r.pos, r.kept_text) for r in sequences.remove_rolling(df).orderBy("pos").collect()] == [(0, "a\nb"), (1, "c"), (4, "c")]


def test_rolling_captions_of_all_cues(spark, tmp_path):
    from loomcast.plans import catalog

    rng = random.Random(5)
    texts = ["\n".join(rng.choices("ab", k=rng.randint(1, 4))) if rng.random() > 0.1 else rng.choice(["", None]) for _ in range(300)]
    cues = [(f"t{i // 100}", "manual" if i // 100 == 2 else "automatic", i % 100, t) for i, t in enumerate(texts)]
    want, before = [], {}
    for t, kind, pos, x in cues:
        now, k = (x or "").split("\n"), 0
        if kind == "automatic" and t in before:
            k = max((k for k in range(1, min(len(now), len(before[t])) + 1) if before[t][-k:] == now[:k]), default=0)
        before[t] = now
        if left := "\n".join(now[k:]):
            want.append((t, pos, left))
    spark.createDataFrame(cues + cues[:9], "track_id string, track_kind string, pos int, text string").write.parquet(str(tmp_path / "cues.parquet"))
    got = [tuple(r) for r in catalog.QUERIES["rolling_captions"](spark, str(tmp_path)).collect()]
    assert sorted(got) == want and sum("\n" in x for *_, x in want) > 50


def test_frames_choose_the_best_supported_text(spark):
    columns = "media_id string, frame_index int, ts double, text string, confidence double, x1 double, y1 double, x2 double, y2 double, media_s double"
    rules = sequences.FrameRules(fps=2.0, static_seconds=5.0, static_coverage=0.5)
    at = lambda m, i, text, x=0.1, sure=0.9, whole=10.0: (m, i, i / 2.0, text, sure, x, 0.8, x + 0.4, 0.9, whole)
    rows = [at("m", i, "Hello world" if i != 1 else "Hella world") for i in range(4)] + [at("m", 19, "Other"), at("n", 0, "x")]
    # Two runs of one text apart from each other stay two; a detection goes to the nearer one.
    rows += [at("two", i, "same", x) for i in range(3) for x in (0.0, 0.55)]
    # A station's sign over most of the medium is no caption; an end is cut at the medium's.
    rows += [at("static", i, "LOGO") for i in range(20)] + [at("cut", i, "end", whole=0.8) for i in range(2)]
    got = sequences.track_frames(spark.createDataFrame(rows, columns), rules, "media_s").collect()
    assert sorted((r.media_id, r.text, r.run_start, r.run_end, r.n_seen, round(r.x1, 2)) for r in got) == [
        ("cut", "end", 0.0, 0.8, 2, 0.1), ("m", "Hello world", 0.0, 2.0, 4, 0.1), ("two", "same", 0.0, 1.5, 3, 0.0), ("two", "same", 0.0, 1.5, 3, 0.55),
    ]
    gap = [at("g", i, "t") for i in (0, 1, 4, 5, 9, 10)]  # two frames missing are bridged, three aren't
    assert sorted((r.run_start, r.n_seen) for r in sequences.track_frames(spark.createDataFrame(gap, columns), rules).collect()) == [(0.0, 4), (4.5, 2)]


def test_vtt_and_caption_json(spark):
    vtt = "WEBVTT\n\nNOTE x\n\n1\n00:01.000 --> 00:02.500 align:start\n<i>Tom &amp; Ann</i>\nTom &amp; Ann\n\n00:03.000 --> 00:02.000\nbackwards\n\n01:00:00.000 --> 01:00:01.000\nlast\n"
    assert feeds.vtt_cues(vtt) == [{"start": 1.0, "end": 2.5, "text": "Tom & Ann"}, {"start": 3600.0, "end": 3601.0, "text": "last"}]
    assert feeds.vtt_cues(None) == []
    text_of = lambda body, **k: [c["text"] for c in feeds.vtt_cues(body, **k)]
    assert text_of("WEBVTT\n\n00:01.000 --> 00:02.000\nuse &lt;b&gt; for <b>bold</b>") == ["use <b> for bold"]
    rolling = "WEBVTT\n\n00:01.000 --> 00:02.000\na\nb\n\n00:02.000 --> 00:03.000\na\nb\nc\n\n00:03.000 --> 00:04.000\nb\nc\n"
    assert text_of(rolling) == ["a\nb", "a\nb\nc", "b\nc"] and text_of(rolling, rolling=True) == ["a\nb", "c"]
    df = spark.createDataFrame([(rolling,), ("x\n00:61.000 --> 00:62.000\ny",), (None,)], "t string")
    assert [r.c and len(r.c) for r in df.select(feeds.parse_rolling_vtt("t").alias("c")).collect()] == [2, None, []]
    with pytest.raises(ValueError):
        feeds.vtt_cues(vtt, most=1)
    good = json.dumps({"body": [{"from": 0, "to": 1, "content": "a"}, {"from": 0.5, "to": 2, "content": "b"}]})
    assert len(one(spark, feeds.caption_json(F.col("x")), x=good)) == 2
    for bad in ('{"body": [{"from": 1, "to": 1, "content": "a"}]}', '{"body": [{"from": 2, "to": 3, "content": "a"}, {"from": 1, "to": 3, "content": "b"}]}', '{"body": [{"from": 0, "to": 1, "content": " "}]}', "{"):
        assert one(spark, feeds.caption_json(F.col("x")), x=bad) is None
    assert one(spark, feeds.transcript_text(F.col("x")), x='{"body": [], "segments": [{"text": " a "}, {"content": "b"}]}') == "a\nb"


RSS = """<rss><channel><item xml:lang="en"><title><![CDATA[One & two]]></title><guid>g1</guid><enclosure url="https://a.example/1.mp3?x=1&amp;y=2" type="audio/mpeg" length="10"/><itunes:duration>1:02:03</itunes:duration>
<pubDate>Wed, 03 Feb 2021 17:36:11 +0800</pubDate><description>short</description><content:encoded>the full text</content:encoded><podcast:person role="guest">Ann</podcast:person><podcast:transcript url="t.vtt" type="text/vtt"/></item>
<item><title>No audio</title><enclosure url="https://a.example/x.pdf" type="application/pdf"/></item></channel></rss>"""


def test_rss(spark):
    df = spark.createDataFrame([("f", RSS), ("g", "")], "feed_url string, body string")
    r = feeds.rss_items(df).collect()
    assert [(x.title, x.guid, x.media_url, x.bytes, x.seconds, x.published) for x in r] == [("One & two", "g1", "https://a.example/1.mp3?x=1&y=2", 10, 3723, "2021-02-03T17:36:11+08:00")]
    m = feeds.rss_metadata(df).where("pos = 0").first()
    assert m.description == "the full text" and m.people[0].name == "Ann" and m.people[0].role == "guest" and m.transcripts[0].url == "t.vtt"


def test_url_functions(spark):
    u = F.col("x")
    assert one(spark, urls.redact_web(u), x="HTTPS://me:pw@[::1]:8080/P?q=1#f") == "https://[::1]:8080/P"
    assert one(spark, urls.redact_web(u), x="http://Host.EXAMPLE/Path") == "http://host.example/Path"
    assert one(spark, urls.redact_web(u), x="ftp://h/p") == "" and one(spark, urls.redact_any(u), x="ftp://h/p?x") == "ftp://h/p" and one(spark, urls.redact_secure(u), x="http://h/p") == ""
    for x, want in [("https://youtu.be/abcdefghijk", "abcdefghijk"), ("https://www.youtube.com/watch?a=1&v=abcdefghijk", "abcdefghijk"), ("https://m.youtube.com/shorts/abcdefghijk", "abcdefghijk"), ("https://evil.com/watch?v=abcdefghijk", None), ("https://a@youtu.be/abcdefghijk", None)]:
        assert one(spark, urls.video_id_short(u), x=x) == want
    for x, want in [("", "empty"), ("http://a.hdslb.com/x", "scheme"), ("https://u@a.hdslb.com/x", "credentials"), ("https://a.hdslb.com:8443/x", "port"), ("https://evil.com/x", "host"), ("https://a.hdslb.com/x", "accepted")]:
        assert one(spark, urls.diagnose(u, ["hdslb.com"]), x=x) == want
    assert one(spark, urls.redact_in_text(u), x="see https://u:p@h/a?k=1 and http://b/c.") == "see https://h/a and http://b/c."


def test_text_functions(spark):
    assert text.plain("<p>Hello&nbsp;<b>world</b></p><script>x()</script><ul><li>a<li>b</ul>") == "Hello world\n\na\nb"
    safe = text.safe('<a href="java\nscript:x" onclick="y" title="t">k</a><script>z</script><iframe src=q>r</iframe><img src="https://i/x.png">')
    assert safe == '<a title="t">k</a><img src="https://i/x.png">'
    assert text.ocr("ｱ​Ａ\x00 b") == "アA b"
    c = F.col("x")
    for x, want in [("<c>a</c>\na\n\n b  c ", "a\nb c"), ("use &lt;b&gt; for\tbold &amp; more\r\nx", "use <b> for bold & more\nx"), ("a\n&#97;\nb", "a\nb"), ("<i></i>", "")]:
        assert one(spark, text.clean_caption(c), x=x) == want
    assert one(spark, text.unwrap_cdata(c), x=" <![CDATA[ a ]]> ") == "a"
    assert one(spark, text.safe_name(c), x="a/b: c?").startswith("a_b_c_") and one(spark, text.safe_name(c), x="").startswith("item_")
    assert tuple(one(spark, text.content_range(c), x="bytes 0-9/10")) == (0, 9, 10) and one(spark, text.content_range(c), x="bytes 5-3/10") is None


def test_scope_and_sides_of_all_ids(spark, tmp_path):
    from loomcast.plans import catalog

    rows = [
        (2, "pending", "k1", "u1", "a", "new"), (4, "done", "k1", "u1", "a", "old"), (6, "pending", "k2", "u2", "b", "t"), (8, "pending", "", "u3", "c", "t"), (9, "done", "", "u3", "d", "t"),
        (7001, "failed", "k3", "u4", "e", "t"), (9000, None, "k3", "u5", "f", "t"),
    ]
    columns = "id long, status string, job_key string, url string, source_id string, title string, author string, source string, artifact_kind string, language string"
    spark.createDataFrame([(*r, "", "youtube", "video_bundle", "en") for r in rows], columns).write.parquet(str(tmp_path / "audio_urls.parquet"))
    got = lambda name: sorted(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect())
    assert got("whole_scope") == [(7001, "k3"), (9000, "k3")] and got("insert_absent_pending") == [(6,)]
    assert got("enrich_from_pending") == [(4, "new", ""), (9, "t", ""), (7001, "t", ""), (9000, "t", "")]


def test_html_of_every_document(spark, tmp_path):
    from loomcast.plans import catalog

    assert text.plain("a <![<({].@&} b > c") == "a c" and text.safe("a <![$~ b > <b>c</b>") == "a  <b>c</b>"
    texts = ["Tom &amp; Ann", "a  b \n\n\n\n c", "<p>x</p>", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = lambda name: [r[1] for r in catalog.QUERIES[name](spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert got("html_text") == ["Tom & Ann", "a b\n\nc", "x", "", ""] and got("html_sanitize") == ["Tom &amp; Ann", texts[1], "<p>x</p>", "", ""]


def test_scalar_functions(spark):
    c = F.col("x")
    for x, want in [("1:02:03.004", 3723.004), ("02:03,500", 123.5), ("00:61.000", None), ("junk", None)]:
        assert one(spark, scalars.vtt_seconds(c), x=x) == want
    assert one(spark, scalars.vtt_text(c), x=3723.0005) == "01:02:03.000" and one(spark, scalars.vtt_text(c), x=-1.0) == "00:00:00.000"
    for x, want in [("1:xx:05", 65), ("xx:05", 0), ("1:02:03", 3723), (" 90 ", 90), ("1:2:3:4", 0), ("9x", 0), ("", 0), ("a:b", 0)]:
        assert one(spark, scalars.duration_seconds(c), x=x) == want
    boxes = F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)), F.array(F.lit(0.5), F.lit(0.0), F.lit(1.5), F.lit(1.0))
    assert abs(one(spark, scalars.box_iou(*boxes), x="") - 1 / 3) < 1e-12 and one(spark, scalars.box_distance(*boxes), x="") == 0.5
    assert one(spark, language.matches(F.col("x"), F.lit("yue-HK")), x="ai-zh") and not one(spark, language.matches(F.col("x"), F.lit("und")), x="und")


def test_documents(spark):
    d = {"page_url": "https://u:p@H/a?k=1", "n": [{"url": "javascript:x"}], "urls": ["http://a/b?c", {"x": "http://a?b"}], "text": "https://h/?q=1"}
    assert documents.redact_urls(json.dumps(d)) == {"page_url": "https://h/a", "n": [{"url": ""}], "urls": ["http://a/b", {"x": "http://a?b"}], "text": "https://h/?q=1"}
    assert one(spark, documents.as_object(F.col("x")), x="[1]") == "{}"
    streams = F.from_json(F.col("x"), "array<struct<height:int,codec:int,bandwidth:int>>")
    assert one(spark, documents.best_stream(streams, 480), x='[{"height":1080,"codec":7,"bandwidth":9},{"height":480,"codec":12,"bandwidth":9},{"height":480,"codec":7,"bandwidth":3},{"height":480,"codec":7,"bandwidth":3}]') == 2


def test_captions_without_secrets(spark):
    d = {
        "cookie": "x", "jwt": "a", "Sign": "b", "API-Key": "c", "SESSDATA": "d", "session_count": 3, "a": {"content": "Bearer abc.def"}, "t": "token=abc, cookie: x; and //host/a?sig=1 https://H.example:80/p?q#f http://x/y",
        "body": [{"content": "https://h/?q=1 token=abc", "note": "Bearer abc.def https://h/a?t=1"}, {"deep": {"content": "password: 'a b' c"}}],
    }
    clean, wrong = documents.sanitize(d)
    assert wrong == [] and documents.sanitize(clean) == (clean, [])
    assert all(clean[k] is None for k in ("cookie", "jwt", "Sign", "API-Key", "SESSDATA")) and clean["session_count"] == 3 and clean["a"]["content"] == "Bearer [redacted]"
    assert clean["t"] == "token:[redacted], cookie:[redacted]; and https://host/a https://h.example:80/p [redacted-transport-url]"
    assert clean["body"][0] == {"content": "https://h/?q=1 token=abc", "note": "Bearer [redacted] https://h/a"} and clean["body"][1]["deep"]["content"] == "password:[redacted] c"
    deep = x = {}
    for _ in range(31):
        x["a"] = x = {}
    x["v"] = 1
    assert documents.sanitize(deep)[1] == []
    x["v"] = {"w": 1}
    assert documents.sanitize(deep) == (None, ["depth"]) and documents.sanitize([1]) == (None, ["no_object"]) and documents.sanitize({"token=a": 1, "token=b": 2}) == (None, ["names_collide"])
    got = spark.createDataFrame([("{",), (None,), ('{"a": "//h/x?y"}',)], "t string").select(documents.sanitize_json("t").alias("r")).select("r.*").collect()
    assert [(r.document, r.violations) for r in got] == [(None, ["unreadable"]), (None, ["no_object"]), ('{"a": "https://h/x"}', [])]


def test_provenance_of_tracks(spark):
    cases = {
        '{"type":1}': ("automatic", "bilibili_type_ai"), '{"type":0,"lan":"ai-zh","author":{"mid":5}}': ("unknown", "bilibili_conflicting_evidence"), '{"type":0,"author":{"mid":5}}': ("manual", "bilibili_cc_with_author"),
        '{"lan":"ai-en"}': ("automatic", "bilibili_auto_label_fallback"), '{"type":"1"}': ("unknown", "bilibili_insufficient_evidence"), '{"type":true,"lan":"ai-zh"}': ("unknown", "bilibili_insufficient_evidence"), "[1]": None, "x": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", documents.provenance(F.col("t")).alias("p")).collect()
    assert {r.t: r.p and (r.p.kind, r.p.selected_by_rule) for r in rows} == cases
    for x, want in [('{"need_login_subtitle":true,"subtitle":{"subtitles":[]}}', "auth_required"), ('{"need_login_subtitle":false,"subtitle":{"subtitles":[]}}', "not_provided_publicly"), ('{"subtitle":{"subtitles":[{}]}}', "provided"), ('{"subtitle":{"subtitles":{}}}', "unknown"), ("x", "unknown")]:
        assert one(spark, documents.inventory_status(F.col("x")), x=x) == want


def test_manifests(spark, tmp_path):
    items = [{"bvid": "BV1234567890", "parts": [2, 1], "max_duration_seconds": 60.0}, {"bvid": "bad", "parts": []}, {"bvid": "BV1234567890", "parts": [1, 2], "max_duration_seconds": 60.0}]
    (tmp_path / "m.json").write_text(json.dumps({"items": items}))
    good, bad = manifests.split_rejects(manifests.read_manifest(spark, str(tmp_path / "m.json")))
    assert good.count() == 2 and bad.first().violations == ["id", "parts"]
    assert sorted((r.bvid, r.part, r.place) for r in manifests.jobs(good).collect()) == [("BV1234567890", 1, 0), ("BV1234567890", 2, 0)]
    (tmp_path / "i.json").write_text(json.dumps({"batch_id": "b", "target_counts": {"s": {"c": 3}}}))
    assert tuple(manifests.read_index(spark, str(tmp_path / "i.json")).first()) == ("b", "s", "c", 3)


def test_closure_of_files_and_versions(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.txt").write_text("x")
    (tmp_path / "b" / "failure.json").write_text("{}")
    before = feeds.read_closure(spark, str(tmp_path / "b")).first()
    (tmp_path / "b" / "a.txt").write_text("y")
    after = feeds.read_closure(spark, str(tmp_path / "b")).first()
    assert before.n_files == 1 and before.fingerprint != after.fingerprint
    v = sinks.Versions(spark, str(tmp_path / "t"))
    assert v.current() == 0
    assert v.write(spark.range(3)) == 1 and v.write(v.read().where("id > 0")) == 2 and v.read().count() == 2
    # A write that broke before its note counts for nothing, and its number is not used again.
    spark.range(99).write.parquet(str(tmp_path / "t" / "rows-3"))
    (tmp_path / "t" / "note-3").mkdir()
    assert v.current() == 2 and v.read().count() == 2
    assert v.write(spark.range(5)) == 4 and v.current() == 4 and v.roll_back(1) == 5 and v.read().count() == 3
    version, bad = sinks.promote(spark.range(4), F.when(F.col("id") > 1, F.array(F.lit("big"))).otherwise(F.array().cast("array<string>")), v)
    assert version == 6 and v.read().count() == 5 and sorted(r.id for r in bad.collect()) == [2, 3]
    assert sinks.snapshot(spark.range(7), str(tmp_path / "copy")) == {"n_rows": 7}
    names = spark.createDataFrame([("a/x.mp3",), ("a/x.ogg",), ("b/y.mp3",)], "path string")
    assert sorted(r.target for r in sinks.target_names(names).collect()) == ["a/x_mp3.wav", "a/x_ogg.wav", "b/y.wav"]
    assert json.loads(sinks.report(spark.range(3).agg(F.count("*").alias("n")))) == {"n": 3}


def test_stream_inserts_each_identity_once(spark, tmp_path):
    from loomcast.streaming import ingest

    schema = "id long, url string, source string, artifact_kind string, job_key string, source_id string"
    rows = [(1, "u1", "s", "audio", "", "a"), (2, "u1", "s", "audio", "", "b"), (3, "u2", "s", "audio", "", "a")]
    target = str(tmp_path / "out")
    for k, part in enumerate([rows[:2], rows[2:], rows[:1]]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.ingest(spark, str(tmp_path / "in"), schema, target, str(tmp_path / "ck")).awaitTermination()
    assert [r.id for r in spark.read.parquet(target).orderBy("id").collect()] == [1]


def test_windows_of_events(spark):
    from loomcast.streaming import ingest

    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, m), "k") for m in (1, 2, 15)], "t timestamp, k string")
    assert sorted(r.n_events for r in ingest.events_by_window(df, "t", "k").collect()) == [1, 2]
