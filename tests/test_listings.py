import json

from pyspark.sql import functions as F

from loomcast.sources import listings as L


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_directories(spark):
    store = [("cn", json.dumps({"results": [{"feedUrl": "f1", "collectionName": "A", "artistName": "x", "genres": ["News"]}, {"collectionName": "no feed"}]})), ("us", "{"), ("us", None)]
    index = [(json.dumps({"feeds": [{"url": "", "originalUrl": "f1", "title": "B", "language": "zh-CN", "categories": {"1": "Arts"}}, {"url": "f2", "language": "de"}, {"url": "f3", "language": None}, {"url": "f4", "language": "EN-us"}]}),)]
    a, b = L.store_results(frame(spark, store, "country string, body string")), L.index_results(frame(spark, index, "body string"))
    assert [tuple(r) for r in a.collect()] == [("f1", "A", "x", ["News"], "zh")]
    assert [(r.feed_url, r.language, r.genres) for r in b.orderBy("feed_url").collect()] == [("f1", "zh", ["Arts"]), ("f3", "", []), ("f4", "en", [])]
    stored = frame(spark, [("f4",)], "feed_url string")
    assert sorted((r.feed_url, r.name) for r in L.first_feeds(a, b, stored=stored).collect()) == [("f1", "A"), ("f3", "")]


def test_books(spark):
    book = {"id": "7", "title": "B", "language": "English", "authors": [{"first_name": "Ann", "last_name": ""}, {"first_name": "", "last_name": ""}, {"first_name": "Bo", "last_name": "Li"}], "description": "<p>x &amp; y</p>", "sections": [{"title": "s0"}]}
    tracks = [("7", 0, "one", "u0", 5), ("7", 1, "two", "u1", None), ("7", 2, "none", "", 1), ("8", 0, "other", "u", 1)]
    out = L.book_tracks(frame(spark, [(json.dumps(book),), ("[",), (None,)], "body string"), frame(spark, tracks, "book_id string, pos int, title string, media_url string, bytes long"))
    assert [(r.pos, r.title, r.author, r.language, r.description, r.section, r.bytes) for r in out.orderBy("pos").collect()] == [(0, "B - one", "Ann, Bo Li", "en", "x & y", "s0", 5), (1, "B - two", "Ann, Bo Li", "en", "x & y", None, 0)]


def test_pages(spark):
    data = {"props": {"pageProps": {"podcast": {"episodes": [{"eid": "e1", "title": "T", "duration": 5, "enclosure": {"url": "https://media.xyzcdn.net/a.m4a"}}, {"title": "no media"}, {"title": "U", "media": {"source": {"url": "https://media.xyzcdn.net/p/b.m4a"}}}]}}}}
    pages = [
        ("1", f'<script id="__NEXT_DATA__" type="x">{json.dumps(data)}</script>'),
        ("2", '<script id="__NEXT_DATA__">{"props":</script>{"eid":"e9","x":1,"title":"a \\"q\\"","enclosure":{"url":"https://media.xyzcdn.net/c.m4a"}}'),
        ("3", '"title": "first" "https://media.xyzcdn.net/d/e.m4a" "https://media.xyzcdn.net/f.m4a" "https://other/g.m4a"'), ("4", None), ("5", ""),
    ]
    out = L.page_episodes(frame(spark, pages, "url string, html string")).orderBy("url", "pos").collect()
    assert [(r.url, r.eid, r.title, r.media_url.rsplit("/", 1)[1], r.found_by) for r in out] == [
        ("1", "e1", "T", "a.m4a", "data"), ("1", "b", "U", "b.m4a", "data"), ("2", "e9", 'a "q"', "c.m4a", "entries"), ("3", "e", "first", "e.m4a", "addresses"), ("3", "f", "", "f.m4a", "addresses"),
    ]


def by_hand(seeds, known, reach, most_an_album, most_probes):
    """A plain queue, probed one by one."""
    queue, seen, hits, spread = list(seeds), set(), [], {}
    while queue and len(seen) < most_probes:
        t = queue.pop(0)
        if t in seen:
            continue
        seen.add(t)
        if t in known:
            hits.append((t, known[t]))
            if known[t] is not None and spread.get(known[t], 0) < most_an_album:
                spread[known[t]] = spread.get(known[t], 0) + 1
                queue += [n for k in range(1, reach + 1) for n in (t + k, t - k) if n not in seen and n not in queue]
    return hits


def test_frontier(spark):
    known = {t: ("a" if t < 30 else "b") for t in [*range(1, 20, 2), 40, 41, 43, 47]} | {12: None}
    table = frame(spark, list(known.items()), "track long, album string")
    for most_an_album, most_probes in ((99, 999), (3, 999), (99, 17), (1, 9)):
        got = [(r.track, r.album) for r in L.frontier(spark, [9, 41, 9], table, 2, most_an_album, most_probes).orderBy("probe_no").collect()]
        assert got == by_hand([9, 41, 9], known, 2, most_an_album, most_probes)
    assert L.frontier(spark, [], table, 2, 9, 9).count() == 0


def test_search_parts(spark):
    v = lambda b, *pages: {"bvid": b, "title": f"<em>{b}</em>", "pages": [{"page": i + 1, "cid": i, "part": p, "duration": 1.5} for i, p in enumerate(pages)]}
    rows = [("k2", 1, json.dumps({"data": {"result": [v("A", "again")]}})), ("k1", 1, json.dumps({"data": {"result": [v("B", "", "x"), v("A", "one")]}})), ("k1", 2, "nothing")]
    out = L.search_parts(frame(spark, rows, "keyword string, page int, body string")).orderBy("bvid", "part").collect()
    assert [(r.bvid, r.part, r.title, r.keyword) for r in out] == [("A", 1, "A - one", "k1"), ("B", 1, "B", "k1"), ("B", 2, "B - x", "k1")]


def test_backward_pages():
    data = [{"newestItemPublishTime": t} for t in range(20, 0, -2)]
    asked = []

    def fetch(since):
        asked.append(since)
        return [x for x in data if since is None or x["newestItemPublishTime"] <= since][:4]

    assert [len(p) for p in L.backward(fetch, 4, 9)] == [4, 4, 2] and asked == [None, 13, 5]
    assert len(list(L.backward(fetch, 4, 1))) == 1 and list(L.backward(lambda s: [], 4, 9)) == [] and len(list(L.backward(lambda s: [{}] * 4, 4, 9))) == 1


def test_adapter_is_a_data_source(spark):
    spark.dataSource.register(L.as_data_source("numbers", lambda o: range(int(o["n"])), lambda o, part: ((part, f"{part}-{i}") for i in range(3)), "part int, item string"))
    df = spark.read.format("numbers").option("n", "4").load()
    assert df.count() == 12 and df.select("part").distinct().count() == 4 and df._jdf.queryExecution().toRdd().getNumPartitions() == 4


def test_sources_fail_alone(spark):
    frames, errors = L.crawl({"a": lambda: spark.range(2), "b": lambda: spark.read.parquet("/nowhere")})
    assert list(frames) == ["a"] and list(errors) == ["b"]


def test_registry_and_layouts(spark):
    feeds = frame(spark, [("https://a.example/1", "2024", "", 0), ("https://b.example/2", "2023", None, 0), ("https://c.example/3", "2022", "2025", 4)], "feed_url string, discovered_at string, last_crawled string, episode_count long")
    assert [r.feed_url for r in L.uncrawled(feeds, [], 9).collect()] == ["https://b.example/2", "https://a.example/1"]
    after = L.mark_crawled(feeds, frame(spark, [("https://a.example/1", 7)], "feed_url string, episode_count long"), "2026")
    assert [r.feed_url for r in L.uncrawled(after, [], 9).collect()] == ["https://b.example/2"] and after.where("episode_count = 7").count() == 1
    old = frame(spark, [(1, None, "downloading", "x"), (2, "video_bundle", "done", "y")], "id long, artifact_kind string, status string, legacy string")
    new = L.evolved(old, {"artifact_kind": ("string", "audio"), "job_key": ("string", ""), "lease_expires_at": ("string", "")})
    assert [tuple(r) for r in new.orderBy("id").collect()] == [(1, "audio", "pending", "x", "", ""), (2, "video_bundle", "done", "y", "", "")]
    kv = "source string, checkpoint_key string, checkpoint_value string, updated_at string"
    put = L.put_checkpoints(frame(spark, [("s", "k", "1", "2024"), ("s", "l", "1", "2024")], kv), frame(spark, [("s", "k", "2", "2024"), ("s", "k", "3", "2023")], kv))
    assert sorted((r.checkpoint_key, r.checkpoint_value) for r in put.collect()) == [("k", "2"), ("l", "1")]
    links = L.bare_links(frame(spark, [("https://U@h/a?b",), (None,)], "u string"), "u").select(F.struct("u", "had_query").alias("x")).collect()
    assert [tuple(r.x) for r in links] == [("https://h/a", True), ("", False)]
