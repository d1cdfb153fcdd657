"""Intermediate tables that cut lineage, kept where driver and executors both see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """The cluster's shared folder. Where the session names none, a local session (tests) gets one of its own; on a
    cluster that is an error, as a folder of one machine isn't seen by the others."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="lakespan-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


class Scratch:
    """Parquet tables of one run, under a folder of its own."""

    #: Folders of this process, in the order they were made.
    made: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{root(spark)}/lakespan-{name}-{uuid.uuid4().hex[:12]}"
        self.made.append(self)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back: later stages restart from these files, not from the source."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def last(self, df: DataFrame, name: str = "out") -> DataFrame:
        """cut(), after which the other tables of this run are deleted."""
        out = self.cut(df, name)
        fs, base = self._fs(self.base)
        for status in fs.listStatus(base):
            if status.getPath().getName() != name:
                fs.delete(status.getPath(), True)
        return out

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more; all of them where none is named."""
        for path in map(self.path, names) if names else [self.base]:
            fs, p = self._fs(path)
            fs.delete(p, True)


def sweep(since: int, but: Scratch) -> None:
    """Delete what operators made after the first `since` folders, but not that of `but`: nothing may read it any more."""
    for s in Scratch.made[since:]:
        if s is not but:
            s.drop()
    Scratch.made[since:] = [s for s in Scratch.made[since:] if s is but]
