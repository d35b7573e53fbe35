"""Samples whose cells have given shares of the whole, small cells kept, with a report of what can't be met.

An item is a distinct `source_id`; it belongs to a cell if one of its rows has the cell's category, source and language, exactly as written.
Each cell's acceptance probability is the ratio of what it needs to what it has; items are accepted independently by a hash of their id, with
some oversampling; the count is then corrected exactly at a threshold that a histogram of the hashes gives, so that only the one bin that the
threshold falls into is ordered. No task ever holds a cell.

Defined results: rows without a `source_id` are no items; NULL attributes match only `*`; a plan with no items needs `min_rows` and has none;
cells of more items than needed give exactly what is needed, others all they have; ties in the hash are settled by the id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OVERSAMPLING = 1.25
SLACK = 20
BINS = 4096
ATTRIBUTES = ("category", "source", "language")


def _memberships(items: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """`plan_id`, `target_id`, `item`: distinct items of each cell. Each distinct row of attributes is spread to its eight wildcard forms."""
    from ..session import small_side

    rows = items.select(F.col(key).alias("item"), *[F.col(a) for a in ATTRIBUTES]).where("item is not null and trim(item) <> ''").distinct()
    forms = F.array(*[
        F.struct(*[(F.col(a) if keep >> i & 1 else F.lit("*")).alias(f"_{a}") for i, a in enumerate(ATTRIBUTES)]) for keep in range(1 << len(ATTRIBUTES))
    ])
    spread = rows.select("item", F.inline(F.array_distinct(forms)))
    cells = small_side(targets.select("plan_id", "target_id", *[F.col(a).alias(f"_{a}") for a in ATTRIBUTES]).distinct())
    return spread.join(cells, [f"_{a}" for a in ATTRIBUTES]).select("plan_id", "target_id", "item").distinct()


def cells(items: DataFrame, targets: DataFrame, key: str = "source_id", members: DataFrame | None = None) -> DataFrame:
    """One row for each target: `plan_id`, `target_id`, `items`, `sample_size`, `needed`, `observed`, `accept_probability`."""
    total = items.select(F.col(key).alias("item")).where("item is not null and trim(item) <> ''").agg(F.count_distinct("item").alias("items"))
    n = total.collect()[0]["items"]  # one number
    have = (_memberships(items, targets, key) if members is None else members).groupBy("plan_id", "target_id").agg(F.count("*").alias("observed"))
    want = targets.select("plan_id", "target_id", "sample_bp", "share_bp", "min_rows").distinct()
    out = want.join(have, ["plan_id", "target_id"], "left").withColumn("items", F.lit(n).cast("long"))
    out = out.withColumn("sample_size", F.expr("cast(sample_bp as bigint) * items div 10000"))
    out = out.withColumn("needed", F.greatest(F.col("min_rows").cast("long"), F.expr("cast(share_bp as bigint) * sample_size div 10000")))
    out = out.withColumn("observed", F.coalesce("observed", F.lit(0)).cast("long"))
    out = out.withColumn("accept_probability", F.when(F.col("observed") > 0, F.least(F.lit(1.0), F.col("needed") / F.col("observed"))).otherwise(0.0))
    return out.select("plan_id", "target_id", "items", "sample_size", "needed", "observed", "accept_probability")


def candidates(items: DataFrame, targets: DataFrame, key: str = "source_id", seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The items that each cell accepts, `plan_id`, `target_id`, `item`, `u`, `needed`, and the cells. A cell that accepted too few has all its items."""
    from ..session import checkpointed, small_side

    members = checkpointed(_memberships(items, targets, key))  # counted, drawn from and corrected: worked out once
    plan = small_side(cells(items, targets, key, members))
    unit = (F.xxhash64(F.lit(seed), "plan_id", "target_id", "item").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).alias("u")
    hashed = members.select("plan_id", "target_id", "item", unit).join(plan.drop("items", "sample_size"), ["plan_id", "target_id"])
    # Independent acceptance, with slack for small cells; a cell that still came out short (rare) is completed from its other items.
    limit = F.least(F.lit(1.0), F.col("accept_probability") * OVERSAMPLING + SLACK / F.greatest(F.col("observed"), F.lit(1)))
    hashed = hashed.withColumn("accepted", F.col("u") < limit)
    counts = hashed.groupBy("plan_id", "target_id").agg(F.count_if("accepted").alias("n_accepted"), F.min(F.least("needed", "observed")).alias("wanted"))
    short = small_side(counts.where("n_accepted < wanted").select("plan_id", "target_id", F.lit(True).alias("short")))
    return hashed.join(short, ["plan_id", "target_id"], "left").where("accepted or short").select("plan_id", "target_id", "item", "u", "needed"), plan


def _drawn(hashed: DataFrame) -> DataFrame:
    """Of the accepted items, exactly as many as are needed."""
    hashed = hashed.withColumn("bin", F.floor(F.col("u") * BINS).cast("int"))
    bins = hashed.groupBy("plan_id", "target_id", "bin", "needed").agg(F.count("*").alias("n"))
    over = Window.partitionBy("plan_id", "target_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = bins.withColumn("before", F.coalesce(F.sum("n").over(over), F.lit(0)))
    # Accepted items are the lowest hashes, so counting from below corrects both ways with one rule. At most BINS rows a cell.
    edge = before.where("before < needed").select("plan_id", "target_id", "bin", "before", (F.col("before") + F.col("n") > F.col("needed")).alias("edge"))
    kept = hashed.join(edge, ["plan_id", "target_id", "bin"])
    whole = kept.where("not edge").select("plan_id", "target_id", "item")
    rank = F.row_number().over(Window.partitionBy("plan_id", "target_id").orderBy("u", "item"))
    part = kept.where("edge").withColumn("rank", rank).where("rank <= needed - before").select("plan_id", "target_id", "item")
    return whole.unionByName(part)


def draw(items: DataFrame, targets: DataFrame, key: str = "source_id", seed: int = 7) -> DataFrame:
    """The samples: `plan_id`, `target_id`, `item`; exactly `drawn` items of each target of the report."""
    return _drawn(candidates(items, targets, key, seed)[0])


def report(items: DataFrame, targets: DataFrame, key: str = "source_id", seed: int = 7) -> DataFrame:
    """One row for each target: the columns of `cells`, `drawn` (the items of the sample, counted) and `deficit` (what the sample lacks)."""
    hashed, plan = candidates(items, targets, key, seed)
    counts = _drawn(hashed).groupBy("plan_id", "target_id").agg(F.count("*").alias("drawn"))
    out = plan.join(counts, ["plan_id", "target_id"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)).cast("long"))
    return out.withColumn("deficit", F.greatest(F.col("needed") - F.col("drawn"), F.lit(0)))
