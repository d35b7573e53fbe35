"""Manifests and batch indexes: nested documents to items, parts and rule columns, rejects split off instead of thrown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = (
    "bvid string, url string, parts array<int>, max_parts int, max_height int, max_duration_seconds double, profile string, languages array<string>, content_language string, require_caption boolean, "
    "rights struct<status:string,evidence_url:string,evidence_text:string,note:string>, ai_generation struct<status:string,evidence:array<string>>, speaker_count int, batch_id string, content_kind string, dataset_category string"
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each item of the manifests at a path, with its place and file."""
    documents = spark.read.schema(f"items array<struct<{', '.join(c.replace(' ', ':', 1) for c in ITEM.split(', '))}>>").option("multiLine", True).json(path)
    return documents.select(F.col("_metadata.file_path").alias("manifest"), F.posexplode("items").alias("place", "item")).select("manifest", "place", "item.*")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """`batch_id`, `source`, `category`, `target`: the quotas of a batch index, one row a cell."""
    raw = spark.read.schema("batch_id string, target_counts map<string,map<string,int>>").option("multiLine", True).json(path)
    cells = raw.select("batch_id", F.explode("target_counts").alias("source", "cells"))
    return cells.select("batch_id", "source", F.explode("cells").alias("category", "target"))


def violations() -> Column:
    """The rules that an item breaks, by name."""
    c = F.col
    rules = {
        "id": ~F.coalesce(c("bvid"), c("url"), F.lit("")).rlike(r"^(BV[0-9A-Za-z]{10}|https://\S+)$"),
        "parts": (F.size(F.coalesce("parts", F.array().cast("array<int>"))) == 0) | F.exists(F.coalesce("parts", F.array().cast("array<int>")), lambda p: p.isNull() | (p < 1)),
        "max_height": ~F.coalesce(c("max_height"), F.lit(720)).between(144, 4320),
        "max_duration": F.coalesce(c("max_duration_seconds"), F.lit(1.0)) <= 0,
    }
    return F.filter(F.array(*[F.when(F.coalesce(v, F.lit(True)), F.lit(k)) for k, v in rules.items()]), lambda x: x.isNotNull())


def split_rejects(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects with their violations)."""
    judged = items.withColumn("violations", violations())
    return judged.where("size(violations) = 0").drop("violations"), judged.where("size(violations) > 0")


def jobs(items: DataFrame) -> DataFrame:
    """One row for each requested part of each item, the earliest place first where an item is listed again with the same parts."""
    once = items.withColumn("_sorted", F.array_sort("parts")).groupBy("bvid", "_sorted").agg(F.min_by(F.struct(*[c for c in items.columns if c not in ("bvid",)]), F.struct("manifest", "place")).alias("i"))
    return once.select("bvid", "i.*").withColumn("part", F.explode("parts"))


# The states of rights, those of them that clear an item given evidence, the states of machine generation; what belongs to which category; what a profile holds by itself.
RIGHTS = ("needs_review", "unknown", "licensed", "permission_granted", "public_domain", "creative_commons")
CLEARED = ("licensed", "permission_granted", "public_domain", "creative_commons")
AI_STATES = ("declared", "not_declared", "suspected", "unknown")
CATEGORY_OF_KIND = {"screen_media": "影视", "interview_roundtable": "访谈", "conference_forum": "会议论坛"}
KIND_OF_PROFILE = {"youtube_interviews": "interview_roundtable", "youtube_screen_clips": "screen_media", "youtube_screen_parents": "screen_media", "youtube_conference_forums": "conference_forum"}


def _map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def cleared(rights: Column) -> Column:
    """Whether rights (a struct) are cleared: a clearing state, and evidence."""
    some = lambda f: F.coalesce(rights[f], F.lit("")) != ""
    return F.coalesce(rights["status"].isin(*CLEARED) & (some("evidence_url") | some("evidence_text")), F.lit(False))


def classification(profile: Column, category: Column, kind: Column) -> Column:
    """struct(dataset_category, content_kind, violations): each given one decides the other, the profile both; unknown and unlike ones are violations."""
    kinds, own = _map(CATEGORY_OF_KIND), _map(KIND_OF_PROFILE)
    kind_of = _map({c: k for k, c in CATEGORY_OF_KIND.items()})
    k = F.coalesce(kind, F.try_element_at(kind_of, category), F.when(category.isNull(), F.try_element_at(own, profile)))
    c = F.coalesce(category, F.try_element_at(kinds, k))
    wrong = [
        (F.coalesce(~F.map_contains_key(own, profile), F.lit(True)), "profile"), (category.isNotNull() & ~category.isin(*CATEGORY_OF_KIND.values()), "dataset_category"),
        (kind.isNotNull() & ~kind.isin(*CATEGORY_OF_KIND), "content_kind"), (category.isNotNull() & kind.isNotNull() & (F.coalesce(F.try_element_at(kinds, kind), F.lit("")) != category), "inconsistent"),
    ]
    return F.struct(c.alias("dataset_category"), k.alias("content_kind"), F.array_compact(F.array(*[F.when(w, F.lit(n)) for w, n in wrong])).alias("violations"))


def _json(text: Column) -> Column:
    """A text as JSON writes it, other letters than ASCII as they are."""
    inside = F.to_json(F.struct(text.alias("t")))
    return F.substring(inside, F.lit(6), F.length(inside) - 6)


def _list(texts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(texts, F.array().cast("array<string>")), _json), ","), F.lit("]"))


def _hashed(*fields: Column) -> Column:
    """Twelve hexadecimal digits of the SHA-256 of a compact JSON array, byte for byte."""
    return F.substring(F.sha2(F.concat(F.lit("["), F.concat_ws(",", *fields), F.lit("]")), 256), 1, 12)


def part_key(identity_version: str = "job-v1", encoding: str = "wav-16k-v1") -> Column:
    """The key of one part (`bvid`, `part`, `cid`) of an item; classification counts only where a batch or a kind is given, so older keys stay."""
    c = F.col
    given = (F.coalesce("batch_id", F.lit("")) != "") | (F.coalesce("content_kind", F.lit("")) != "")
    extra = F.when(given, F.concat_ws(",", *[_json(F.coalesce(x, F.lit(""))) for x in ("batch_id", "content_kind", "dataset_category")]))
    digest = _hashed(
        _json(c("bvid")), c("part").cast("string"), c("cid").cast("string"), F.coalesce(c("max_height"), F.lit(720)).cast("string"), _list(c("languages")), F.coalesce(c("require_caption"), F.lit(False)).cast("string"),
        _json(F.coalesce(F.nullif("source_revision", F.lit("")), F.lit("current"))), F.lit(f'"{identity_version}"'), F.lit(f'"{encoding}"'), extra,
    )
    return F.concat(c("bvid"), F.lit("-p"), c("part"), F.lit("-c"), c("cid"), F.lit("-"), digest)


def item_key(video_id: Column) -> Column:
    """The key of a manifest item of the other platform: the caption's need counts only where it is waived, classification only where it isn't the profile's own."""
    c = F.col
    own = F.try_element_at(_map(KIND_OF_PROFILE), c("profile"))
    extra = F.when(c("content_kind") != own, F.concat(F.lit('{"dataset_category":'), _json(c("dataset_category")), F.lit(',"content_kind":'), _json(c("content_kind")), F.lit("}")))
    needed = F.when(~F.coalesce("require_caption", F.lit(True)), F.lit("false"))
    revision = _json(F.coalesce(F.nullif("source_revision", F.lit("")), F.lit("current")))
    digest = _hashed(_json(video_id), _json(c("profile")), _list(c("languages")), needed, revision, extra)
    first = F.coalesce(F.get("languages", 0), F.lit("any"))
    return F.concat_ws("-", video_id, c("profile"), first, digest)


def second_violations() -> Column:
    """The rules of a manifest of the other platform that an item breaks: the ones above, and profile, classification, rights' evidence and the size of its metadata."""
    c = F.col
    url, text = c("rights.evidence_url"), c("rights.evidence_text")
    rules = {
        "profile": ~F.coalesce(c("profile").isin(*KIND_OF_PROFILE), F.lit(False)), "rights": ~F.coalesce(c("rights.status").isin(*RIGHTS), F.lit(False)),
        "evidence_url": url.isNotNull() & ((F.length(url) > 2048) | ~url.rlike(r"^https://[^/@\s]+(/|$|[?#])")), "evidence_text": text.isNotNull() & ((F.trim(text) == "") | (F.length(text) > 4096)),
        "ai_generation": ~F.coalesce(c("ai_generation.status").isin(*AI_STATES), F.lit(False)), "classification": F.size(classification(c("profile"), c("dataset_category"), c("content_kind"))["violations"]) > 0,
        "speaker_count": F.when(c("speaker_count").isNull(), F.coalesce(c("speaker_count_status") != "needs_review", F.lit(True))).otherwise((c("speaker_count") <= 0) | F.coalesce(c("speaker_count_status") != "verified_manual", F.lit(True))),
        "metadata_size": F.octet_length(F.coalesce("candidate_metadata", F.lit(""))) > 32768,
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit(True)), F.lit(k)) for k, v in rules.items()]))


def missing_parts(requested: DataFrame, offered: DataFrame) -> DataFrame:
    """Requested parts (`bvid`, `part`) that the item's offered pages don't have."""
    return requested.join(offered.select("bvid", "part").distinct(), ["bvid", "part"], "left_anti")


def index_violations(cells: DataFrame, items: DataFrame, baseline: DataFrame) -> DataFrame:
    """`rule`, `source`, `category`, `wanted`, `found`: cells whose count of distinct items differs from the index, items listed twice, and items of the baseline."""
    found = items.groupBy("source", "category").agg(F.count_distinct("bvid").alias("found"))
    cell = cells.select("source", "category", F.col("target").cast("long").alias("wanted")).join(found, ["source", "category"], "full").select(F.lit("quota").alias("rule"), "source", "category", F.coalesce("wanted", F.lit(0)).alias("wanted"), F.coalesce("found", F.lit(0)).alias("found")).where("wanted <> found")
    twice = items.groupBy("source", "category", "bvid").agg(F.count("*").alias("n")).where("n > 1").groupBy("source", "category").agg(F.count("*").alias("found"))
    old = items.join(baseline.select("bvid").distinct(), "bvid", "left_semi").groupBy("source", "category").agg(F.count_distinct("bvid").alias("found"))
    none = lambda df, rule: df.select(F.lit(rule).alias("rule"), "source", "category", F.lit(0).cast("long").alias("wanted"), "found")
    return cell.unionByName(none(twice, "listed_twice")).unionByName(none(old, "in_baseline"))
