"""Rows that a table doesn't take, and how many of them a write may have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespan.sources.names import quoted

#: The column that says why a row is rejected.
REASON = "rejected_reason"


def reason(rules: dict):
    """Why a row is rejected, or null; rules: not_null names columns, octets and items give greatest sizes of columns."""
    faults = [(F.col(quoted(c)).isNull(), f"null in {c}") for c in rules.get("not_null", [])]
    faults += [(F.octet_length(quoted(c)) > n, f"more than {n} bytes in {c}") for c, n in rules.get("octets", {}).items()]
    faults += [(F.size(quoted(c)) > n, f"more than {n} items in {c}") for c, n in rules.get("items", {}).items()]
    return F.coalesce(*[F.when(bad, F.lit(why)) for bad, why in faults], F.lit(None).cast("string"))


def failed(copied: int, rejected: int) -> float:
    """The failed fraction, 1 where nothing was copied."""
    return rejected / (copied + rejected) if copied else 1.0


def summary(rejected: DataFrame, rows: int = 10) -> DataFrame:
    """The most frequent reasons, with a sample row each."""
    data = F.to_json(F.struct(*[quoted(c) for c in rejected.columns if c != REASON]))
    return rejected.groupBy(REASON).agg(F.count("*").alias("count"), F.min(data).alias("sample")).orderBy(F.desc("count"), REASON).limit(rows)
