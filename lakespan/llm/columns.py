"""How the operators treat columns of their input that are named like those of their result."""

from __future__ import annotations

from pyspark.sql import DataFrame


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns of these names, whatever their case: the operator's own take their place."""
    gone = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in gone]
    return df if len(kept) == len(df.columns) else df.select(["`" + c.replace("`", "``") + "`" for c in kept])
