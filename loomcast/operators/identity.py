"""Identity of rows: insert if absent, enrichment, content duplicates and sequential deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def insert_absent(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows that no stored row shares an identity with: the job's key, else the URL, else the source's id.

    Three anti joins on equal keys; one join on an OR of them would become a nested loop.
    """
    job = ["source", "artifact_kind", "job_key"]
    with_job, without = incoming.where("coalesce(job_key, '') <> ''"), incoming.where("coalesce(job_key, '') = ''")
    new_job = with_job.join(stored.where("coalesce(job_key, '') <> ''").select(*job).distinct(), job, "left_anti")
    new_url = without.join(stored.where("coalesce(job_key, '') = ''").select("url").distinct(), "url", "left_anti")
    ids = ["source", "source_id", "artifact_kind"]
    new_id = new_url.join(stored.where("coalesce(source_id, '') <> ''").select(*ids).distinct(), ids, "left_anti")
    return new_job.unionByName(new_id)


def enrich(stored: DataFrame, incoming: DataFrame, on: list[str], columns: list[str], order: str) -> DataFrame:
    """Stored rows with the last non-empty incoming value of each column; empty values never overwrite.

    The incoming side is reduced to one row a key before the join, so a hot key stays one row.
    """
    last = [F.max(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.struct(F.col(order).alias("o"), F.col(c).alias("v")))).getField("v").alias(f"_{c}") for c in columns]
    new = incoming.groupBy(*on).agg(*last)
    joined = stored.join(new, on, "left")
    return joined.select(*[(F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)) for c in stored.columns])


def upsert(stored: DataFrame, incoming: DataFrame, order: str, columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new rows, all rows after it, matches): a batch put into a table in the batch's order.

    A row is new if no stored row and no new row before it has its identity: its job's key, or without one its URL or its source's id; rows that aren't
    new lend no identity to others. Each of these enriches the rows that it matches: its non-empty `columns` replace theirs, the last one that has a
    value winning. `matches` counts them: `id`, `n_rows` for each row that is enriched, whether or not it changes. Both tables have the same columns, with a unique `id`.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = lambda *c: F.when(text(c[-1]) != "", F.concat_ws("\x1f", *[text(x) for x in c]))
    job, by_source = key("source", "artifact_kind", "job_key"), key("source", "artifact_kind", "source_id")
    rows = incoming.withColumn("_o", F.col(order))
    fresh = insert_absent(rows, stored)
    # A key stands in for the URL of rows with a job, so that one rule settles both kinds; the source's id is theirs no longer.
    marks = fresh.select("_o", F.coalesce(F.concat(F.lit("job\x1f"), job), F.concat(F.lit("url\x1f"), F.col("url"))).alias("_a"), F.when(job.isNull(), by_source).alias("_b"))
    new = fresh.join(sequential_accept(marks, "_o", "_a", "_b"), "_o", "left_semi")
    rest = rows.join(new.select("_o"), "_o", "left_anti")
    whole = stored.unionByName(new.drop("_o"))
    targets = whole.select(F.col("id").alias("_id"), job.alias("_job"), F.when(job.isNull(), F.col("url")).alias("_url"), F.when(job.isNull(), by_source).alias("_source"))
    gifts = rest.select("_o", *[F.col(c).alias(f"_{c}_new") for c in columns], job.alias("_job"), F.when(job.isNull(), F.col("url")).alias("_url"), F.when(job.isNull(), by_source).alias("_source"))
    met = None
    for k in ("_job", "_url", "_source"):  # joins on equal keys, never one on an OR of them
        one = gifts.where(F.col(k).isNotNull()).join(targets.where(F.col(k).isNotNull()).select("_id", k), k).select("_id", "_o", *[f"_{c}_new" for c in columns])
        met = one if met is None else met.unionByName(one)
    met = met.dropDuplicates(["_id", "_o"])
    last = [F.max(F.when(F.coalesce(F.col(f"_{c}_new").cast("string"), F.lit("")) != "", F.struct(F.col("_o").alias("o"), F.col(f"_{c}_new").alias("v")))).getField("v").alias(f"_{c}") for c in columns]
    best = met.groupBy("_id").agg(F.count("*").alias("_n"), *last)
    joined = whole.join(best, whole["id"] == best["_id"], "left")
    after = joined.select(*[(F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)) for c in stored.columns])
    return new.drop("_o"), after, best.select(F.col("_id").alias("id"), F.col("_n").alias("n_rows"))


def mark_content_duplicates(df: DataFrame, content: str, order: str) -> DataFrame:
    """`kept_path`: the first row of a content hash keeps its path, later ones get `dup:<hash>`. Rows without a hash keep theirs."""
    first = df.where(F.coalesce(F.col(content), F.lit("")) != "").groupBy(content).agg(F.min(order).alias("_first"))
    out = df.join(first, content, "left")
    return out.withColumn("kept_path", F.when(F.col("_first").isNotNull() & (F.col(order) > F.col("_first")), F.concat(F.lit("dup:"), F.col(content))).otherwise(F.col("local_path"))).drop("_first")


def sequential_accept(df: DataFrame, order: str, first: str, second: str) -> DataFrame:
    """Rows accepted in order of arrival: a row is a duplicate if an accepted earlier row has its first or second identity.

    Identities of rejected rows count for nothing, so this isn't two deduplications. It is solved by rounds over the whole table: a row
    that is the first open one under both of its identities is surely accepted, and whatever shares an identity with an accepted row is
    rejected; every round settles at least the first open row of each chain. Each round is two windows and a semi join of what is open,
    and is written to the shared folder. Empty identities match nothing.
    """
    from ..session import checkpointed

    rows = df.select(F.col(order).alias("o"), F.nullif(F.coalesce(F.col(first).cast("string"), F.lit("")), F.lit("")).alias("a"), F.nullif(F.coalesce(F.col(second).cast("string"), F.lit("")), F.lit("")).alias("b"))
    accepted, open_rows = None, checkpointed(rows)
    while True:  # each round settles the first open row at least
        fa = open_rows.where("a is not null").groupBy("a").agg(F.min("o").alias("fa"))
        fb = open_rows.where("b is not null").groupBy("b").agg(F.min("o").alias("fb"))
        seen = open_rows.join(fa, "a", "left").join(fb, "b", "left").select("o", "a", "b", "fa", "fb")
        now = checkpointed(seen.where("(a is null or o = fa) and (b is null or o = fb)").select("o", "a", "b"))
        accepted = now if accepted is None else accepted.unionByName(now)
        left = open_rows.join(now.select("o"), "o", "left_anti")
        left = left.join(now.where("a is not null").select("a").distinct(), "a", "left_anti").join(now.where("b is not null").select("b").distinct(), "b", "left_anti")
        open_rows = checkpointed(left.select("o", "a", "b"))
        if open_rows.isEmpty():
            return accepted.select(F.col("o").alias(order))


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key: one partial aggregate, no window."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return best.select(*keys, "_r.*")


def uniqueness_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: the constraint holds if there are none."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))

