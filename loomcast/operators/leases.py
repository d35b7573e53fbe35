"""Leases on rows of a queue table: pure functions from a snapshot and a stated moment to the next snapshot.

The moment is an argument, so the same call gives the same result; times are kept as ISO text in UTC and compared as text. What changes is decided by filters,
first-N selections and joins on equal keys; a snapshot is written by `sinks.Versions`.

Defined results: a NULL lease or claim is an empty one; an empty queue stays empty; extra columns pass through.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import filters

CLAIM = ("claimed_by", "claimed_at", "lease_expires_at")


def _set(queue: DataFrame, where: Column, **values: Column) -> DataFrame:
    """`queue` with new values in the rows where the condition holds (not where it is NULL)."""
    hit = F.coalesce(where, F.lit(False))
    return queue.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in queue.columns])


def _free(status: str) -> dict[str, Column]:
    return {"status": F.lit(status)} | {c: F.lit("") for c in CLAIM}


def _some(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def expire(queue: DataFrame, now: dt.datetime, **scope: str | None) -> DataFrame:
    """Leases that have run out, within the scope (as `filters.queue_filter` takes it), are given back."""
    out = filters.queue_filter("downloading", **scope) & _some("lease_expires_at") & (F.col("lease_expires_at") <= now.isoformat())
    return _set(queue, out, **_free("pending"))


def claim(queue: DataFrame, now: dt.datetime, worker: str, lease_s: int, limit: int, status: str = "pending", group: str | None = None, **scope: str | None) -> tuple[DataFrame, DataFrame]:
    """(the next snapshot, the claimed rows): run-out leases of the scope are given back, then the first `limit` rows of a state by id (of each group, if one is named) are leased.

    The claims of two workers on successive snapshots share no row. Without groups the choice is `limit` ids, which bounds what is broadcast.
    """
    if limit <= 0 or lease_s <= 0 or not worker:
        raise ValueError("a worker, a positive limit and a positive lease are needed")
    fresh = expire(queue, now, **scope)
    open_rows = fresh.where(filters.queue_filter(status, **scope))
    chosen = filters.first_per_group(open_rows, group, limit) if group else open_rows.orderBy("id").limit(limit)
    ids = chosen.select("id", F.lit(True).alias("_taken"))
    lease = {"status": F.lit("downloading"), "claimed_by": F.lit(worker), "claimed_at": F.lit(now.isoformat()), "lease_expires_at": F.lit((now + dt.timedelta(seconds=lease_s)).isoformat())}
    marked = fresh.join(ids, "id", "left")
    done = _set(marked, F.col("_taken"), **lease)
    return done.drop("_taken").select(*queue.columns), done.where("_taken").select(*queue.columns)


def renew(queue: DataFrame, now: dt.datetime, worker: str, ids: DataFrame, lease_s: int) -> DataFrame:
    """A longer lease for the rows that are still this worker's; all others stay."""
    if lease_s <= 0 or not worker:
        raise ValueError("a worker and a positive lease are needed")
    marked = queue.join(ids.select("id", F.lit(True).alias("_asked")).distinct(), "id", "left")
    own = F.col("_asked") & (F.col("status") == "downloading") & (F.col("claimed_by") == worker)
    return _set(marked, own, lease_expires_at=F.lit((now + dt.timedelta(seconds=lease_s)).isoformat())).select(*queue.columns)


def heartbeat_s(lease_s: int) -> int:
    """How often a worker renews: three times a lease, once a second at most and once a minute at least."""
    return min(60, max(1, lease_s // 3))


def transition(queue: DataFrame, updates: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(the next snapshot, what is wrong) for `url`, `job_key`, `status`, `local_path`: done stamps path and time, every state ends the claim.

    A keyed update that matches no row or several is wrong and changes nothing; of several updates of one key the last by status and path counts.
    """
    key = F.coalesce("job_key", F.lit("")).alias("_key")
    last = updates.select("url", key, F.struct(F.col("status").alias("s"), F.col("local_path").alias("p")).alias("u")).groupBy("url", "_key").agg(F.max("u").alias("u"))
    rows = queue.withColumn("_key", F.coalesce("job_key", F.lit("")))
    n = rows.groupBy("url", "_key").agg(F.count("*").alias("_n"))
    judged = last.join(n, ["url", "_key"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    wrong = judged.where("_key <> '' and _n <> 1").select("url", F.col("_key").alias("job_key"), F.col("_n").alias("n_rows"))
    marked = rows.join(judged.where("_key = '' or _n = 1").select("url", "_key", "u"), ["url", "_key"], "left")
    done = F.col("u.s") == "done"
    new = {"status": F.col("u.s"), "local_path": F.when(done, F.col("u.p")).otherwise(F.col("local_path")), "downloaded_at": F.when(done, F.lit(now.isoformat())).otherwise(F.col("downloaded_at"))} | {c: F.lit("") for c in CLAIM}
    return _set(marked, F.col("u").isNotNull(), **new).select(*queue.columns), wrong


def finalise(queue: DataFrame, finished: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(the next snapshot, `url`, `is_duplicate`) for finished downloads `seq`, `url`, `local_path`, `file_format`, `file_size`, `content_hash` of rows without a job.

    Audio whose content another audio row already has (done before, or earlier in this batch) keeps no file: its path becomes `dup:<hash>`. Bundles never
    are duplicates. The first of each content is found by one aggregate, so a hash that a third of the rows share stays one row.
    """
    plain = queue.where(F.coalesce("job_key", F.lit("")) == "").select("url", F.col("artifact_kind").alias("_kind"))
    now_done = finished.groupBy("url").agg(F.max_by(F.struct("seq", "local_path", "file_format", "file_size", "content_hash"), "seq").alias("f")).select("url", "f.*").join(plain, "url")
    audio = F.col("_kind") == "audio"
    stored = queue.where((F.col("status") == "done") & (F.col("artifact_kind") == "audio") & _some("content_hash")).groupBy("content_hash").agg(F.min("url").alias("_low"), F.max("url").alias("_high"))
    first = now_done.where(audio & _some("content_hash")).groupBy("content_hash").agg(F.min("seq").alias("_first"))
    known = now_done.join(stored, "content_hash", "left").join(first, "content_hash", "left")
    other = F.coalesce((F.col("_low") != F.col("url")) | (F.col("_high") != F.col("url")), F.lit(False))
    judged = known.withColumn("is_duplicate", audio & _some("content_hash") & (other | F.coalesce(F.col("seq") > F.col("_first"), F.lit(False))))
    path = F.when(F.col("is_duplicate"), F.concat(F.lit("dup:"), "content_hash")).otherwise(F.col("local_path"))
    new = judged.select("url", "is_duplicate", F.struct(path.alias("path"), F.col("file_format").alias("format"), F.col("file_size").alias("size"), F.col("content_hash").alias("hash")).alias("_f"))
    marked = queue.join(new, "url", "left")
    here = F.col("_f").isNotNull() & (F.coalesce("job_key", F.lit("")) == "")
    values = {"status": F.lit("done"), "local_path": F.col("_f.path"), "file_format": F.col("_f.format"), "file_size": F.col("_f.size"), "content_hash": F.col("_f.hash"), "downloaded_at": F.lit(now.isoformat())} | {c: F.lit("") for c in CLAIM}
    return _set(marked, here, **values).select(*queue.columns), new.select("url", "is_duplicate")


def scope(claimed_by: str, source: str, artifact_kind: str, category: str | None = None, language: str | None = None, ids: tuple[int, int] | None = None, job_keys: list[str] | None = None) -> Column:
    """The claims that an operator means, every part of the owner's identity stated."""
    if not (claimed_by and source and artifact_kind):
        raise ValueError("owner, source and kind must be stated")
    if ids and not 0 < ids[0] <= ids[1]:
        raise ValueError("a range of ids has two positive ends in order")
    out = filters.queue_filter("downloading", claimed_by=claimed_by, source=source, artifact_kind=artifact_kind, category=category, language=language)
    out = out & F.col("id").between(*ids) if ids else out
    return out & F.col("job_key").isin(job_keys) if job_keys else out


def recover(queue: DataFrame, claims: Column, expected: int | None = None) -> tuple[DataFrame, int]:
    """(the next snapshot, matched claims). Without `expected` it is a dry run: nothing changes. With it, another number of claims is an error."""
    n = queue.where(claims).count()
    if expected is None:
        return queue, n
    if n != expected:
        raise ValueError(f"{n} claims match, {expected} were meant")
    return _set(queue, claims, **_free("pending")), n


def compare_and_swap(queue: DataFrame, changes: DataFrame, guarded: list[str], changed: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the next snapshot, `id`, `outcome`) for changes `id`, `old_<guarded>`..., `new_<changed>`...: a row is changed only if it still has all old values.

    Outcomes are applied, stale and missing, and ambiguous for an id that is changed or kept more than once.
    """
    n_rows = queue.groupBy("id").agg(F.count("*").alias("_rows"))
    n_changes = changes.groupBy("id").agg(F.count("*").alias("_changes"))
    rows = queue.select("id", *[F.col(c).alias(f"_{c}") for c in guarded]).dropDuplicates(["id"])
    same = filters.all_of([F.col(f"_{c}").eqNullSafe(F.col(f"old_{c}")) for c in guarded])
    judged = changes.join(n_changes, "id").join(n_rows, "id", "left").join(rows, "id", "left")
    outcome = F.when(F.col("_rows").isNull(), "missing").when((F.col("_rows") > 1) | (F.col("_changes") > 1), "ambiguous").when(same, "applied").otherwise("stale")
    judged = judged.withColumn("outcome", outcome)
    fine = judged.where("outcome = 'applied'").select("id", F.lit(True).alias("_hit"), *[F.col(f"new_{c}") for c in changed])
    marked = queue.join(fine, "id", "left")
    return _set(marked, F.col("_hit"), **{c: F.col(f"new_{c}") for c in changed}).select(*queue.columns), judged.select("id", "outcome").distinct()
