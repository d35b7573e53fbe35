"""Sinks: documents beside rows, reports, and versioned tables whose versions never change."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_documents(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One JSON document a row, in as many files as the data has partitions."""
    df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value")).write.mode("overwrite").text(path)


def missing_documents(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows that have no document yet."""
    return df.join(existing.select(key).distinct(), key, "left_anti")


def report(df: DataFrame) -> str:
    """A small aggregated frame (one row) as one JSON text."""
    rows = df.limit(2).toJSON().collect()
    if len(rows) != 1:
        raise ValueError("a report is one row")
    return json.dumps(json.loads(rows[0]), sort_keys=True, ensure_ascii=False)


class Versions:
    """A table as numbered snapshots. A version counts once its own note, written once and never changed, names its rows.

    A broken write leaves no note, so readers keep the version before and the next write takes a number that nothing has used. An error in
    looking for versions is an error, and never "none yet".
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, kind: str) -> list[int]:
        folder = self._fs_path(self.path)
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n.rpartition("-")[2]) for n in names if n.rpartition("-")[0] == kind and n.rpartition("-")[2].isdigit())

    def current(self) -> int:
        """The last version whose note is complete; 0 if there is none."""
        done = [n for n in self._numbers("note") if self._fs.exists(self._fs_path(f"{self.path}/note-{n}/_SUCCESS"))]
        return max(done, default=0)

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows-{version or self.current()}")

    def write(self, df: DataFrame) -> int:
        """The next version, checked against what was meant before it counts."""
        version = max([0, *self._numbers("rows"), *self._numbers("note")]) + 1
        where = f"{self.path}/rows-{version}"
        df.write.mode("errorifexists").parquet(where)
        back = self.spark.read.parquet(where)
        if back.schema.names != df.schema.names:
            raise ValueError("the written version differs")
        note = back.agg(F.lit(version).alias("version"), F.count("*").alias("n_rows"))
        note.coalesce(1).write.mode("errorifexists").json(f"{self.path}/note-{version}")
        return version

    def roll_back(self, version: int) -> int:
        """A new version with the rows of an earlier one."""
        return self.write(self.read(version))


def snapshot(df: DataFrame, path: str) -> dict[str, int]:
    """A copy of a table, checked: rows and an order-free digest of both must be the same."""
    digest = lambda x: x.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in x.columns]).cast("decimal(38,0)")).cast("string").alias("h")).first()
    df.write.mode("errorifexists").parquet(path)
    want, got = digest(df), digest(df.sparkSession.read.parquet(path))
    if want != got:
        raise ValueError("the copy differs")
    return {"n_rows": got.n}


def promote(staged: DataFrame, violations: Column, stored: Versions) -> tuple[int, DataFrame]:
    """Staged rows without violations become part of the next version, the rest is given back with what is wrong."""
    judged = staged.withColumn("violations", violations)
    good = judged.where("size(violations) = 0").drop("violations")
    whole = stored.read().unionByName(good) if stored.current() else good
    return stored.write(whole), judged.where("size(violations) > 0")


def target_names(files: DataFrame, path: str = "path", extension: str = "wav") -> DataFrame:
    """`path`, `target`: the name of each file with another extension; of files that would get the same one, all keep their old extension within the name."""
    base, own = F.regexp_extract(path, r"^(.*?)(?:\.([^./]*))?$", 1), F.regexp_extract(path, r"^(.*?)(?:\.([^./]*))?$", 2)
    shared = files.select(base.alias("_base")).groupBy("_base").agg(F.count("*").alias("_n"))
    named = files.select(F.col(path).alias("path"), base.alias("_base"), own.alias("_own")).join(shared, "_base")
    return named.select("path", F.concat("_base", F.when(F.col("_n") > 1, F.concat(F.lit("_"), "_own")).otherwise(""), F.lit("." + extension)).alias("target"))
