"""Session, table and small-side helpers shared by every operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a dimension may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 20_000
#: Bytes up to which it may be.
BROADCAST_BYTES = 16 << 20


def local_session(cpus: int | str = "*", app: str = "loomcast") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` as a broadcast side if it proves to have at most `max_rows` rows and `max_bytes` bytes, else `df` unhinted.

    The check runs the (cheap) dimension once with a limit; a side that grows with the data fails it
    and the join falls back to a shuffle, where AQE splits skewed keys.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows or sum(len(v) if isinstance(v, (str, bytes)) else 8 for r in rows for v in r) > max_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that `spark.checkpoint.dir` names.

    Where it is unset, a session on one machine (as in tests) gets a temporary folder; on a cluster that is an error, because executors can't share one.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="loomcast-"))
    return df.checkpoint()


def balanced(df: DataFrame) -> DataFrame:
    """Spread an input that has fewer partitions than the cluster has cores, for per-row work in Python; else it is read where it lies.

    For frames straight from files. A small file would be one task; a round-robin exchange of narrow rows makes it two tasks a core.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if "Exchange" in plan.toString():  # was spread by an exchange already
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if plan.execute().getNumPartitions() >= cores else df.repartition(cores * 2)
