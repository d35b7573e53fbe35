"""The p-queries of the core: timestamps and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import shred, timestamps
from ..session import table

_TIMES = ["published_at", "discovered_at"]


def _normalized(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.normalize(table(spark, d, "audio_urls"), _TIMES, "source", table(spark, d, "source_clocks"), "downloaded_at")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _normalized(spark, d).where(timestamps.not_canonical(F.col("raw_text"), F.col("utc_text"))).select("id", "field_name", "utc_text")


def p1_normalized(spark: SparkSession, d: str) -> DataFrame:
    return _normalized(spark, d)


def p1_zones(spark: SparkSession, d: str) -> DataFrame:
    """The clock that each source's own zone-less times point to, beside the stated one."""
    clocks = table(spark, d, "source_clocks")
    rows = table(spark, d, "audio_urls").select("source", "discovered_at", "downloaded_at")
    parts = timestamps.with_parts(rows.join(F.broadcast(clocks.select("source", "day_order")), "source", "left"), "discovered_at", "day_order", timestamps.known_zones(spark))
    seen = parts.withColumn("g", F.unix_micros(F.try_to_timestamp(F.concat("downloaded_at", F.lit("Z")))))
    found = timestamps.estimate_zones(timestamps.without_zone(seen), "source", "_local", "g", usual_lag_s=timestamps.usual_lag(seen, "g"))
    return found.join(clocks.select("source", F.col("clock_zone").alias("stated_zone")), "source", "left").select("source", "stated_zone", F.col("clock_zone").alias("estimated_zone"), "violations", "n_rows")


def p1_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Every stated clock held out: how many values of each source get the same instant by the estimated one."""
    clocks = table(spark, d, "source_clocks").withColumn("clock_zone", F.lit(None).cast("string"))
    queue = table(spark, d, "audio_urls")
    held_out = timestamps.normalize(queue, _TIMES, "source", clocks, "downloaded_at").select("id", "field_name", F.col("utc_text").alias("estimated"))
    both = _normalized(spark, d).where("utc_text is not null").join(held_out, ["id", "field_name"]).join(queue.select("id", "source"), "id")
    return both.groupBy("source", "field_name").agg(F.count("*").alias("n_rows"), F.count_if(F.col("utc_text") == F.col("estimated")).alias("n_same"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.nodes(table(spark, d, "audio_urls")).select("id", "node_path")


def p7_nodes(spark: SparkSession, d: str) -> DataFrame:
    return shred.nodes(table(spark, d, "audio_urls"))


def p7_levels(spark: SparkSession, d: str) -> DataFrame:
    return shred.levels(table(spark, d, "audio_urls"))


def p7_people(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of people, linked to their record."""
    return shred.child_table(shred.nodes(table(spark, d, "audio_urls")), "common.people[]", ["name", "role", "group", "image"])


QUERIES = {f.__name__: f for f in (p1_found, p1_normalized, p1_zones, p1_agreement, p7_found, p7_nodes, p7_levels, p7_people)}
#: Estimation is right on these tables if every value agrees: what it must find, not how.
SQL: dict[str, str] = {
    "p1_agreement": "SELECT source, field_name, count(*) AS n_rows, count(*) AS n_same FROM (SELECT source, unnest(['published_at', 'discovered_at']) AS field_name, unnest([published_at, discovered_at]) AS t FROM audio_urls) WHERE trim(coalesce(t, ''), ' ') <> '' GROUP BY 1, 2",
}
