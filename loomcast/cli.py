"""Commands over a folder of tables: `python -m loomcast.cli COMMAND ...`. Reports are JSON; commands that change something are dry unless `--apply` is given."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import bundles, filters, identity, leases
from .plans import catalog
from .session import local_session, table
from .sources import listings, sinks

#: Columns that a queue must have to be worked on.
QUEUE_COLUMNS = ["id", "url", "source", "artifact_kind", "job_key", "status", "local_path", "content_hash", "claimed_by", "lease_expires_at", "metadata_json"]

#: The viewer's reports without arguments, by name.
VIEWS = {
    "overview": "overview", "published": "published_stats", "months": "month_histogram", "duration": "duration_totals", "categories": "category_summary", "coverage": "metadata_coverage", "statuses": "status_counts_by_dimension",
    "speakers": "top_speakers", "channels": "feed_channels",
}


def _rows(df: DataFrame, limit: int) -> list[dict]:
    return [json.loads(r) for r in df.limit(limit).toJSON().collect()]


def collect(spark: SparkSession, a: argparse.Namespace) -> object:
    """Load incoming files into the target, row by row if absent; with --loop again and again."""
    from .streaming import ingest

    schema = spark.read.parquet(a.incoming).schema.simpleString().removeprefix("struct<").removesuffix(">")
    rounds = 0
    while True:
        ingest.ingest(spark, a.incoming, ", ".join(x.replace(":", " ", 1) for x in schema.split(",")), a.target, a.checkpoint).awaitTermination()
        rounds += 1
        if not a.loop or rounds == a.rounds:
            return {"rounds": rounds, "rows": spark.read.parquet(a.target).count()}
        time.sleep(a.interval)


def claim(spark: SparkSession, a: argparse.Namespace) -> object:
    """Lease the next rows of a versioned queue to a worker."""
    now = dt.datetime.now(dt.UTC)
    queue = sinks.Versions(spark, a.queue)
    after, taken = leases.claim(queue.read(), now, a.worker, a.lease, a.limit, "failed" if a.retry else "pending", a.per, source=a.source, category=a.category, language=a.language, artifact_kind=a.kind)
    rows = _rows(taken.select("id", "source", "url"), a.limit if not a.per else 10_000)
    return {"version": queue.write(after) if a.apply else None, "claimed": rows}


def stats(spark: SparkSession, a: argparse.Namespace) -> object:
    return {n: _rows(catalog.QUERIES[n](spark, a.tables), a.limit) for n in ("status_rollup", "status_counts_by_dimension", "disk_totals")}


def fix_meta(spark: SparkSession, a: argparse.Namespace) -> object:
    """Write the describing documents that finished rows lack."""
    done = table(spark, a.tables, "audio_urls").where(filters.kept())
    documents = done.select("id", bundles.sidecar_document().alias("document"))
    try:
        have = spark.read.json(a.target, schema="id long, document string")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        have = spark.createDataFrame([], "id long, document string")
    missing = sinks.missing_documents(documents, have, "id")
    n = missing.count()
    if a.apply and n:
        missing.write.mode("append").json(a.target)
    return {"missing": n, "written": n if a.apply else 0}


def discover(spark: SparkSession, a: argparse.Namespace) -> object:
    """What the registry holds, and which feeds are next."""
    registry = table(spark, a.tables, "feed_registry")
    if a.stats:
        return _rows(catalog.QUERIES["feed_channels"](spark, a.tables), a.limit)
    return _rows(listings.uncrawled(registry, a.without_host, a.limit).select("feed_url", "discovered_at"), a.limit)


def view(spark: SparkSession, a: argparse.Namespace) -> object:
    q = table(spark, a.tables, "audio_urls")
    if a.report in VIEWS:
        return _rows(catalog.QUERIES[VIEWS[a.report]](spark, a.tables), a.limit)
    if a.report == "id":
        return _rows(q.where(F.col("id") == int(a.value)), 1)
    if a.report == "month":
        return _rows(q.where(F.col("published_at").startswith(a.value)).orderBy(F.desc("published_at"), F.desc("id")), a.limit)
    equal = {} if a.report in ("all", "since") else {a.report: a.value}
    since = a.value if a.report == "since" else a.since
    rows = q.where(filters.viewer_filter(since, a.before, **equal))
    order = [F.desc("published_at"), F.desc("id")] if since or a.before else [F.col("id")]
    return _rows(rows.orderBy(*order), a.limit)


def audit(spark: SparkSession, a: argparse.Namespace) -> object:
    names = {"coverage": ["metadata_coverage", "transcript_states"], "batch": ["quota_cells", "quota_equality", "manifest_reconciliation"], "queue": ["quality_rules", "orphan_tracks", "content_duplicates"]}[a.what]
    return {n: _rows(catalog.QUERIES[n](spark, a.tables), a.limit) for n in names}


def doctor(spark: SparkSession, a: argparse.Namespace) -> object:
    found = {}
    for name in ("audio_urls", "feed_registry"):
        try:
            found[name] = table(spark, a.tables, name)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return bundles.doctor(found, {"audio_urls": QUEUE_COLUMNS, "feed_registry": ["feed_url", "last_crawled"]})


def recover(spark: SparkSession, a: argparse.Namespace) -> object:
    """Give the exactly stated claims back."""
    queue = sinks.Versions(spark, a.queue)
    claims = leases.scope(a.claimed_by, a.source, a.kind, a.category, a.language, tuple(a.ids) if a.ids else None, a.job_key)
    n = leases.recover(queue.read(), claims)[1]
    return {"matched": n, "version": queue.write(leases.recover(queue.read(), claims, n)[0]) if a.apply else None}


def manifest(spark: SparkSession, a: argparse.Namespace) -> object:
    from .sources import manifests

    items = table(spark, a.tables, "bilibili_sources")
    rules = manifests.violations() if a.platform == "parts" else manifests.second_violations()
    counts = items.select(F.explode(rules).alias("rule")).groupBy("rule").agg(F.count("*").alias("n_items")).orderBy("rule")
    return {"items": items.count(), "listed_twice": identity.uniqueness_violations(items, ["bvid"]).count(), "violations": _rows(counts, 100)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomcast", description=__doc__)
    commands = p.add_subparsers(required=True)

    def command(name, function, **flags):
        c = commands.add_parser(name, help=(function.__doc__ or "").strip().split("\n")[0])
        c.set_defaults(function=function)
        for flag, options in flags.items():
            c.add_argument(flag if flag.islower() and options.pop("place", False) else "--" + flag.replace("_", "-"), **options)

    tables = {"tables": {"required": True}, "limit": {"type": int, "default": 50}}
    narrow = {"source": {}, "category": {}, "language": {}, "kind": {}}
    command("collect", collect, incoming={"required": True}, target={"required": True}, checkpoint={"required": True}, loop={"action": "store_true"}, interval={"type": float, "default": 60.0}, rounds={"type": int, "default": 0})
    command("claim", claim, queue={"required": True}, worker={"required": True}, lease={"type": int, "default": 7200}, limit={"type": int, "default": 50}, per={"choices": ["source", "category"]}, retry={"action": "store_true"}, apply={"action": "store_true"}, **narrow)
    command("stats", stats, **tables)
    command("fix-meta", fix_meta, tables={"required": True}, target={"required": True}, apply={"action": "store_true"})
    command("discover", discover, **tables, stats={"action": "store_true"}, without_host={"nargs": "*", "default": []})
    command("view", view, report={"place": True, "choices": [*VIEWS, "all", "id", "source", "status", "category", "language", "since", "month"]}, value={"place": True, "nargs": "?"}, **tables, since={}, before={})
    command("audit", audit, what={"place": True, "choices": ["coverage", "batch", "queue"]}, **tables)
    command("doctor", doctor, **tables)
    command("recover", recover, queue={"required": True}, claimed_by={"required": True}, **{**narrow, "source": {"required": True}, "kind": {"required": True}}, ids={"type": int, "nargs": 2}, job_key={"nargs": "*"}, apply={"action": "store_true"})
    command("manifest", manifest, platform={"place": True, "choices": ["parts", "items"]}, **tables)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or local_session()
    out = a.function(spark, a)
    print(json.dumps(out, ensure_ascii=False, sort_keys=True, default=str))
    bad = isinstance(out, list) and any(isinstance(r, dict) and r.get("status") == "error" for r in out)
    return int(bad)


if __name__ == "__main__":
    raise SystemExit(main())
