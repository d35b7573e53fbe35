"""Listings of directories, catalogues and pages as tables: answers that were stored as text, one row an answer, become rows of feeds, tracks and episodes.

Defined results: an answer that is NULL, empty or unreadable gives no row; entries without the address that they are about are dropped; nothing is fetched here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text, urls

FEED = ["feed_url", "name", "artist", "genres", "language"]


def _filled(*options: Column) -> Column:
    """The first option that isn't empty, else ''."""
    return F.coalesce(*[F.nullif(F.trim(o), F.lit("")) for o in options], F.lit(""))


def store_results(answers: DataFrame, body: str = "body", country: str = "country") -> DataFrame:
    """Feeds of a store's search answers (`results`): the language follows the country, which is the store's."""
    rows = F.from_json(body, "struct<results:array<struct<feedUrl:string,collectionName:string,artistName:string,genres:array<string>>>>")["results"]
    out = answers.select(F.col(country).alias("_c"), F.explode(rows).alias("r"))
    language = F.when(F.lower("_c") == "cn", "zh").otherwise("en")
    return out.select(_filled(F.col("r.feedUrl")).alias("feed_url"), _filled(F.col("r.collectionName")).alias("name"), _filled(F.col("r.artistName")).alias("artist"), F.coalesce("r.genres", F.array().cast("array<string>")).alias("genres"), language.alias("language")).where("feed_url <> ''")


def index_results(answers: DataFrame, body: str = "body") -> DataFrame:
    """Feeds of an index's answers (`feeds`): an original address stands in for a missing one; languages other than zh and en are dropped, unknown ones kept."""
    rows = F.from_json(body, "struct<feeds:array<struct<url:string,originalUrl:string,title:string,author:string,language:string,categories:map<string,string>,newestItemPublishTime:bigint>>>")["feeds"]
    out = answers.select(F.explode(rows).alias("r"))
    raw = F.lower(_filled(F.col("r.language")))
    out = out.select(
        _filled(F.col("r.url"), F.col("r.originalUrl")).alias("feed_url"), _filled(F.col("r.title")).alias("name"), _filled(F.col("r.author")).alias("artist"),
        F.coalesce(F.map_values("r.categories"), F.array().cast("array<string>")).alias("genres"), F.when(raw.startswith("zh"), "zh").otherwise(F.substring(raw, 1, 2)).alias("language"),
    )
    return out.where("feed_url <> '' and language in ('', 'zh', 'en')")


def first_feeds(*listings: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Feeds of several listings in their order, each address once, those of the registry left out."""
    ordered = [x.select(*FEED).withColumn("_o", F.lit(i)) for i, x in enumerate(listings)]
    out = ordered[0]
    for x in ordered[1:]:
        out = out.unionByName(x)
    once = out.groupBy("feed_url").agg(F.min_by(F.struct(*FEED[1:]), F.struct("_o", "name", "artist")).alias("r")).select("feed_url", "r.*")
    return once if stored is None else once.join(stored.select("feed_url").distinct(), "feed_url", "left_anti")


BOOK = (
    "struct<id:string,title:string,description:string,language:string,url_librivox:string,coverart_jpg:string,url_text_source:string,"
    "authors:array<struct<first_name:string,last_name:string>>,sections:array<struct<title:string,playtime:string>>>"
)


def book_tracks(books: DataFrame, tracks: DataFrame, body: str = "body", most: int = 0) -> DataFrame:
    """Tracks of books: `books` is one JSON book a row, `tracks` the parsed feed of each (`book_id`, `pos`, `title`, `media_url`, `bytes`).

    The nth section of a book belongs to the nth track; names of authors are joined; `most` bounds the tracks of a book (0: none).
    """
    b = books.select(F.from_json(body, BOOK).alias("b")).where("b.id is not null")
    whole_name = lambda a: F.trim(F.concat_ws(" ", F.nullif(F.trim(a["first_name"]), F.lit("")), F.nullif(F.trim(a["last_name"]), F.lit(""))))
    authors = F.array_join(F.filter(F.transform("b.authors", whole_name), lambda a: a != ""), ", ")
    b = b.select(
        F.col("b.id").alias("book_id"), F.col("b.title").alias("book"), F.lower(F.substring(_filled(F.col("b.language")), 1, 2)).alias("language"), _filled(F.col("b.url_librivox")).alias("webpage_url"),
        _filled(F.col("b.coverart_jpg")).alias("cover_url"), F.coalesce(authors, F.lit("")).alias("author"), text.plain_text("b.description").alias("description"), _filled(F.col("b.url_text_source")).alias("text_url"), F.col("b.sections").alias("sections"),
    )
    t = tracks.where("coalesce(media_url, '') <> ''")
    joined = (t.where(F.col("pos") < most) if most else t).join(b, "book_id")
    section = F.get("sections", F.col("pos"))
    return joined.select("book_id", "pos", "media_url", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.concat_ws(" - ", "book", "title").alias("title"), "author", "language", "description", "webpage_url", "cover_url", "text_url", section["title"].alias("section"))


_EPISODES = "array<struct<eid:string,title:string,url:string,duration:double,published_at:string>>"


def page_episodes(pages: DataFrame, url: str = "url", body: str = "html", media_host: str = "media.xyzcdn.net", most: int = 0) -> DataFrame:
    """Episodes of show pages: `url`, `pos`, `eid`, `title`, `media_url`, `duration`, `published_at`, `found_by`.

    First the page's data script; where it has none, entries with id, title and media address; else bare media addresses with the page's titles by place.
    """
    html = F.coalesce(F.col(body), F.lit(""))
    script = F.regexp_extract(html, r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    episode = "struct<eid:string,title:string,duration:double,pubDate:string,enclosure:struct<url:string>,media:struct<source:struct<url:string>>>"
    listed = F.from_json(script, f"struct<props:struct<pageProps:struct<podcast:struct<episodes:array<{episode}>>>>>")["props"]["pageProps"]["podcast"]["episodes"]
    as_row = lambda eid, title, media, seconds, at: F.struct(eid.alias("eid"), title.alias("title"), media.alias("url"), seconds.alias("duration"), at.alias("published_at"))
    none, no_time = F.lit(None).cast("string"), F.lit(None).cast("double")
    own_id = lambda eid, media: _filled(eid, F.regexp_extract(media, r"([^/]+?)(?:\.[^/]*)?$", 1))
    media_of = lambda e: _filled(e["enclosure"]["url"], e["media"]["source"]["url"])
    first = F.filter(F.transform(listed, lambda e: as_row(own_id(e["eid"], media_of(e)), _filled(e["title"]), media_of(e), e["duration"], e["pubDate"])), lambda r: r["url"] != "")
    host = media_host.replace(".", r"\.")
    entry = rf'\{{"eid":"[^"]+".*?"title":"(?:[^"\\]|\\.)*".*?"enclosure":\{{[^}}]*"url":"https://{host}/[^"]+\.m4a"'
    entries = F.regexp_extract_all(html, F.lit(entry), F.lit(0))
    plain = lambda t: F.coalesce(F.get_json_object(F.concat(F.lit('{"t":"'), t, F.lit('"}')), "$.t"), t)
    second = F.transform(entries, lambda e: as_row(F.regexp_extract(e, r'"eid":"([^"]+)"', 1), plain(F.regexp_extract(e, r'"title":"((?:[^"\\]|\\.)*)"', 1)), F.regexp_extract(e, rf'"(https://{host}/[^"]+\.m4a)"$', 1), no_time, none))
    bare, titles = F.regexp_extract_all(html, F.lit(rf'"(https://{host}/[^"]+\.m4a)"'), 1), F.regexp_extract_all(html, F.lit(r'"title"\s*:\s*"((?:[^"\\]|\\.)*)"'), 1)
    third = F.transform(bare, lambda m, i: as_row(own_id(F.lit(""), m), F.coalesce(F.get(titles, i), F.lit("")), m, no_time, none))
    some = lambda a: F.coalesce(F.size(a), F.lit(0)) > 0
    found = F.when(some(first), F.struct(F.lit("data").alias("by"), first.cast(_EPISODES).alias("rows"))).when(some(second), F.struct(F.lit("entries").alias("by"), second.cast(_EPISODES).alias("rows"))).otherwise(F.struct(F.lit("addresses").alias("by"), third.cast(_EPISODES).alias("rows")))
    out = pages.select(F.col(url).alias("url"), found.alias("f")).select("url", F.col("f.by").alias("found_by"), F.posexplode("f.rows").alias("pos", "r"))
    out = out.where(F.col("pos") < most) if most else out
    return out.select("url", "pos", "r.eid", "r.title", F.col("r.url").alias("media_url"), "r.duration", "r.published_at", "found_by")


def frontier(spark: SparkSession, seeds: list[int], known: DataFrame, reach: int, most_an_album: int, most_probes: int) -> DataFrame:
    """`track`, `album`, `probe_no`: ids found by probing seeds and, around every hit, its neighbours up to `reach` places away.

    `known` (`track`, `album`) says which ids exist. Ids are probed in the order they were found, each once; an album spreads from its first `most_an_album` hits only; no
    more than `most_probes` ids are probed in all, which bounds a level. A round probes all ids of one distance from the seeds by joins; the driver holds counts alone.
    """
    from ..session import checkpointed

    todo = spark.createDataFrame([(t, (0, i)) for i, t in enumerate(dict.fromkeys(seeds))], "track long, o struct<p:long,i:int>")
    seen: DataFrame | None = None
    spread: DataFrame | None = None
    hits, probed = None, 0
    while True:
        level = checkpointed(todo.orderBy("o").limit(max(0, most_probes - probed)))
        n = level.count()
        if not n:
            return hits if hits is not None else spark.createDataFrame([], "track long, album string, probe_no long")
        numbered = level.withColumn("probe_no", F.row_number().over(Window.orderBy("o")) + probed)
        found = checkpointed(numbered.join(known.select("track", "album"), "track").select("track", "album", F.col("probe_no").cast("long").alias("probe_no")))
        hits = found if hits is None else hits.unionByName(found)
        seen = level.select("track") if seen is None else seen.unionByName(level.select("track"))
        before = spread.groupBy("album").agg(F.count("*").alias("had")) if spread is not None else None
        ranked = found.withColumn("r", F.row_number().over(Window.partitionBy("album").orderBy("probe_no")))
        ranked = ranked.join(before, "album", "left") if before is not None else ranked.withColumn("had", F.lit(0).cast("long"))
        spreading = checkpointed(ranked.where(F.col("album").isNotNull() & (F.coalesce("had", F.lit(0)) + F.col("r") <= most_an_album)).select("track", "album", "probe_no"))
        spread = spreading if spread is None else spread.unionByName(spreading)
        steps = F.array(*[F.struct(F.lit(s * k).alias("d"), F.lit(2 * k + (s < 0)).alias("i")) for k in range(1, reach + 1) for s in (1, -1)])
        near = spreading.select("track", "probe_no", F.explode(steps).alias("s")).select((F.col("track") + F.col("s.d")).alias("track"), F.struct(F.col("probe_no").alias("p"), F.col("s.i").alias("i")).alias("o"))
        todo = near.groupBy("track").agg(F.min("o").alias("o")).join(seen, "track", "left_anti")
        probed += n


def search_parts(answers: DataFrame, body: str = "body") -> DataFrame:
    """Parts of the videos of search answers (`keyword`, `page`, `body`): `bvid`, `part`, `cid`, `title`, `duration`, `keyword`; of a video found again the first place counts."""
    video = "struct<bvid:string,title:string,author:string,pages:array<struct<page:int,cid:bigint,part:string,duration:double>>>"
    rows = answers.select("keyword", "page", F.posexplode(F.from_json(body, f"struct<data:struct<result:array<{video}>>>")["data"]["result"]).alias("place", "v")).where("coalesce(v.bvid, '') <> ''")
    once = rows.groupBy("v.bvid").agg(F.min_by(F.struct("keyword", "v"), F.struct("keyword", "page", "place")).alias("f")).select("bvid", "f.keyword", "f.v")
    parts = once.select("bvid", "keyword", F.col("v.title").alias("video"), F.inline("v.pages"))
    bare = F.regexp_replace("video", r"<[^>]+>", "")
    return parts.select("bvid", F.col("page").alias("part"), "cid", F.when(F.coalesce(F.trim("part"), F.lit("")) == "", bare).otherwise(F.concat_ws(" - ", bare, "part")).alias("title"), "duration", "keyword")


def backward(fetch: Callable[[int | None], list[dict]], per_page: int, most_pages: int, at: str = "newestItemPublishTime") -> Iterator[list[dict]]:
    """Pages from the newest back: the next one ends before the oldest entry of the last. It ends with an empty or short page, an entry without time, or the stated number of pages."""
    since = None
    for _ in range(most_pages):
        page = fetch(since)
        if not page:
            return
        yield page
        oldest = page[-1].get(at) or 0
        if not oldest or len(page) < per_page:
            return
        since = oldest - 1


class _Part(InputPartition):
    def __init__(self, value: object):
        self.value = value


def as_data_source(name: str, parts: Callable[[dict], Iterable[object]], rows: Callable[[dict, object], Iterable[tuple]], schema: str) -> type[DataSource]:
    """An adapter as a Spark data source: `parts` splits its work by the options, `rows` gives the rows of a part.

    `spark.dataSource.register(...)` makes it `spark.read.format(name)`; the parts are read in parallel, each by one task. The class is made here so that it
    travels whole to the workers.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.options = options

        def partitions(self) -> list[InputPartition]:
            return [_Part(p) for p in parts(self.options)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            yield from rows(self.options, partition.value)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader(dict(self.options))

    return Source


def crawl(sources: dict[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(frames, errors) of several sources; one that fails leaves the others be."""
    frames, errors = {}, {}
    for name, source in sources.items():
        try:
            frames[name] = source()
            frames[name].schema  # an unreadable source fails here, not later
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {e}"[:500]
    return frames, errors


def uncrawled(registry: DataFrame, hosts_out: list[str], most: int) -> DataFrame:
    """The feeds that weren't crawled yet, the earliest found first, without excluded hosts; a feed that failed has no mark and comes again."""
    from ..operators import filters

    return filters.without_hosts(registry.where("coalesce(last_crawled, '') = ''"), "feed_url", hosts_out).orderBy("discovered_at", "feed_url").limit(most)


def mark_crawled(registry: DataFrame, successes: DataFrame, at: str) -> DataFrame:
    """The registry with the time and count of each success (`feed_url`, `episode_count`) of a round."""
    done = successes.groupBy("feed_url").agg(F.max("episode_count").alias("_n"))
    out = registry.join(done, "feed_url", "left")
    hit = F.col("_n").isNotNull()
    return out.withColumn("last_crawled", F.when(hit, at).otherwise(F.col("last_crawled"))).withColumn("episode_count", F.coalesce("_n", "episode_count")).select(*registry.columns)


def evolved(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """`df` with every column of the current layout (name -> type, default): missing ones are added, NULLs of given ones become the default, unknown ones stay.

    Rows that are claimed without a lease, as older layouts left them, are open again.
    """
    kept = [F.coalesce(F.col(c), F.lit(columns[c][1]).cast(columns[c][0])).alias(c) if c in columns else F.col(c) for c in df.columns]
    new = [F.lit(default).cast(kind).alias(c) for c, (kind, default) in columns.items() if c not in df.columns]
    out = df.select(*kept, *new)
    if {"status", "lease_expires_at"} <= set(out.columns):
        stale = (F.col("status") == "downloading") & (F.coalesce("lease_expires_at", F.lit("")) == "")
        out = out.withColumn("status", F.when(stale, "pending").otherwise(F.col("status")))
    return out


def put_checkpoints(stored: DataFrame, new: DataFrame) -> DataFrame:
    """A table of `source`, `checkpoint_key`, `checkpoint_value`, `updated_at` with new values: the last write of each key counts."""
    both = stored.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)))
    last = both.groupBy("source", "checkpoint_key").agg(F.max_by(F.struct("checkpoint_value", "updated_at"), F.struct("updated_at", "_o")).alias("r"))
    return last.select("source", "checkpoint_key", "r.*")


def bare_links(df: DataFrame, column: str) -> DataFrame:
    """`df` with a column of URLs made bare, and a mark whether a query was there."""
    return df.withColumn("had_query", F.contains(F.coalesce(F.col(column), F.lit("")), F.lit("?"))).withColumn(column, urls.redact_web(F.col(column)))
