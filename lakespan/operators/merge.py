"""Upsert by key.

Parquet tables know no MERGE. A source whose rows take little memory is sent to all tasks, so the target isn't
shuffled; its keys that the source has are then few, and an anti join with them finds what is new. A larger source
meets the target in the same joins by sorted keys, of which nothing passes through the driver. A full outer join would
read the target once, but holds all rows of a key in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakespan.sources.errors import MergeError
from lakespan.sources.names import quoted

#: A source of at most so many bytes in memory is broadcast.
MOST_SENT = 32 * 2**20
#: What a row and each of its columns take in a table that is broadcast, about; text in a key is there twice, and nested
#: values take up to some 8 bytes for a character of their text.
_ROW, _COLUMN, _TEXT, _NESTED = 64, 16, 2, 8
#: Types without a part of variable size.
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def is_small(df: DataFrame) -> bool:
    """Whether df can be broadcast. Files are compressed, so of what Spark expects to be small the rows are counted and their texts added up."""
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > MOST_SENT:
        return False
    weights = {f.name: _TEXT if isinstance(f.dataType, T.StringType | T.BinaryType) else _NESTED for f in df.schema if not isinstance(f.dataType, _FIXED)}
    n, *octets = df.agg(F.count(F.lit(1)), *[F.sum(F.octet_length(F.col(quoted(c)).cast("string"))) for c in weights]).first()
    return n * (_ROW + _COLUMN * len(df.columns)) + sum(w * (x or 0) for w, x in zip(weights.values(), octets, strict=True)) <= MOST_SENT


def merge(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target after an upsert of source.

    Rows of target with a key in source take source's columns and keep the others; each duplicate of a target
    row is updated. Source rows without a match are added, their missing columns null. Null keys match nothing.
    The keys of source must be unique. Names of columns may hold any characters, and match whatever their case.
    """
    of_target, of_source = ({c.lower(): i for i, c in enumerate(df.columns)} for df in (target, source))
    missing = [k for k in keys if k.lower() not in of_target or k.lower() not in of_source]
    if missing:
        raise MergeError("merge keys aren't in both tables", missing)
    unknown = [c for c in source.columns if c.lower() not in of_target]
    if unknown:
        raise MergeError("columns aren't in the target", unknown)
    t = target.select([F.col(quoted(c)).alias(f"t{i}") for i, c in enumerate(target.columns)] + [F.lit(True).alias("old")])
    s = source.select([F.col(quoted(c)).alias(f"s{i}") for i, c in enumerate(source.columns)] + [F.lit(True).alias("new")])
    of_t, of_s = ([f"{p}{at[k.lower()]}" for k in keys] for p, at in (("t", of_target), ("s", of_source)))
    twice = s.dropna(subset=of_s).groupBy(*of_s).count().where("count > 1").limit(1)
    if not twice.isEmpty():
        raise MergeError(f"keys of the source repeat: {', '.join(keys)}")
    on = [F.col(a) == F.col(b) for a, b in zip(of_t, of_s, strict=True)]
    pick = [(F.when(F.col("new"), F.col(f"s{of_source[c.lower()]}")).otherwise(F.col(f"t{i}")) if c.lower() in of_source else F.col(f"t{i}")).alias(c) for i, c in enumerate(target.columns)]
    small = is_small(source)
    how, held = "broadcast" if small else "merge", t.select(of_t)
    updated = t.join(s.hint(how), on, "left").select(pick)
    if small:  # at most as many keys as the source has
        held = held.join(F.broadcast(s.select(of_s)), on, "left_semi")
    added = s.join(held.distinct().hint(how), on, "left_anti")
    blank = [(F.col(f"s{of_source[c.lower()]}") if c.lower() in of_source else F.lit(None)).cast(updated.schema[i].dataType).alias(c) for i, c in enumerate(target.columns)]
    return updated.unionAll(added.select(blank))
