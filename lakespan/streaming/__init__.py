"""The reference reads and writes bounded tables only; these extend it to streams, batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakespan.sources.bridge import Bridge


def upsert_batches(stream: DataFrame, table: str, merge_key: str):
    """A writer that merges each micro-batch into table by merge_key; call start() on it."""
    return stream.writeStream.outputMode("update").foreachBatch(lambda df, _: df.isEmpty() or Bridge(df.sparkSession).write(df, "append", table=table, merge_key=merge_key) and None)


def windowed(stream: DataFrame, at: str, late: str, size: str, keys: list[str], aggregates: dict[str, Column], slide: str | None = None) -> DataFrame:
    """Aggregates over windows of event time: tumbling, or sliding by slide. Rows more than late behind are left out;
    the state of older windows is dropped."""
    rows = stream.withWatermark(at, late).groupBy(F.window(at, size, slide), *keys).agg(*(a.alias(name) for name, a in aggregates.items()))
    return rows.select(F.col("window.start").alias("start"), *keys, *aggregates)


def sessions(stream: DataFrame, at: str, late: str, gap: str, keys: list[str]) -> DataFrame:
    """Sessions of each key: stretches of rows with no gap as long as gap."""
    rows = stream.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(F.count("*").alias("n"))
    return rows.select(F.col("session_window.start").alias("start"), *keys, "n")
