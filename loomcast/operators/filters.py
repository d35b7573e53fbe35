"""Filters over queue tables. Each builds one Column; Catalyst pushes what the file format can take."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars, urls

BATCH_PATHS = ("$.source_data.batch_id", "$.batch_id")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def queue_filter(status: str | None = None, published_since: str | None = None, published_before: str | None = None, batch_id: str | None = None, **equal: str | None) -> Column:
    """Rows of a status that equal every given attribute; an upper bound that is a bare day includes the day."""
    out = [F.col(k) == v for k, v in {"status": status, **equal}.items() if v]
    if published_since:
        out.append(F.col("published_at") >= published_since)
    if published_before:
        out.append(scalars.inclusive_before(F.col("published_at"), published_before))
    if batch_id:
        out.append(scalars.json_text(F.col("metadata_json"), *BATCH_PATHS) == batch_id)
    return all_of(out)


def viewer_filter(since: str | None = None, before: str | None = None, **equal: str | None) -> Column:
    """As `queue_filter`, but the upper bound is taken as written, so a bare day ends at its start."""
    out = [F.col(k) == v for k, v in equal.items() if v]
    if since:
        out.append(F.col("published_at") >= since)
    if before:
        out.append(F.col("published_at") <= before)
    return all_of(out)


def first_per_group(df: DataFrame, group: str, n: int, key: str = "id") -> DataFrame:
    """The first n rows of each non-empty group by key; the plan prunes with WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(group).orderBy(key)
    return df.where(F.coalesce(F.col(group), F.lit("")) != "").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def without_hosts(df: DataFrame, url: str, hosts: list[str]) -> DataFrame:
    """Rows whose host isn't among the excluded; blank entries are ignored, an empty list excludes nothing."""
    out = sorted({h.strip().lower() for h in hosts if h.strip()})
    return df.where(~urls.host(F.col(url)).isin(*out)) if out else df


def titled(title: Column, required: list[str], excluded: list[str]) -> Column:
    """Any required term and no excluded term."""
    some = reduce(lambda a, b: a | b, [F.contains(title, F.lit(t)) for t in required]) if required else F.lit(True)
    none = reduce(lambda a, b: a | b, [F.contains(title, F.lit(t)) for t in excluded]) if excluded else F.lit(False)
    return some & ~none


def kept() -> Column:
    """Done and physically there: a path that isn't the mark of a duplicate."""
    path = F.coalesce(F.col("local_path"), F.lit(""))
    return (F.col("status") == "done") & (path != "") & ~path.ilike("dup:%")


def present(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key exists on the other side; NULL and empty keys never do. A semi join in bulk, not look-ups one by one."""
    return df.where(F.coalesce(F.col(on), F.lit("")) != "").join(keys.select(on).distinct(), on, "left_semi")
