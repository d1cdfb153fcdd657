"""Joins that don't gather a frequent key in one task, nor shuffle wide rows that have no partner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in a filter. It is broadcast: at most so many rows of two numbers, whatever the input.
SLOTS = 1 << 18
#: Tables are written by no more tasks, in as many files, than have so many rows each, but by a few tasks at least.
ROWS_A_TASK, FEW_TASKS = 12_500, 8


def few(df: DataFrame, rows: int) -> DataFrame:
    """df, which has at most so many rows, in no more partitions than they are worth: small ones aren't worth a file each."""
    return df.coalesce(max(FEW_TASKS, rows // ROWS_A_TASK))


def _hash(key: str) -> str:
    return f"xxhash64(17, `{key}`)"


def row_key():
    """A number of 64 bits for a row's doc_id and text, so rows needn't be copied to have one that lasts."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def maybe_in(df: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """df with a boolean: false where key is surely none of ids' (column key). A bitmap of fixed size tells, so with
    very many ids more rows are taken for possible ones; none that is in ids is missed."""
    word, bit = f"shiftright({_hash(key)}, 6) & {SLOTS - 1}", f"cast({_hash(key)} & 63 as int)"
    bits = ids.where(F.col(key).isNotNull()).groupBy(F.expr(word).alias("__word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("__bits"))
    out = df.withColumn("__word", F.expr(word)).join(F.broadcast(bits), "__word", "left")
    return out.withColumn(name, F.expr(f"coalesce(shiftright(__bits, {bit}) & 1L = 1L, false)")).drop("__word", "__bits")


def semi(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of df whose key is in ids; of the others only few are shuffled."""
    return maybe_in(df, key, ids, "__maybe").where("__maybe").drop("__maybe").join(ids.select(key), key, "left_semi")


def minus(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of df whose key isn't in ids, null keys among them; those that surely aren't are not shuffled."""
    marked = maybe_in(df, key, ids, "__maybe")
    left = marked.where("__maybe").join(ids.select(key), key, "left_anti")
    return marked.where("not __maybe").unionByName(left.select(marked.columns)).drop("__maybe")


def join_hot(rows: DataFrame, small: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with small, which has a row for each key; rows of the keys of hot stay where they are.

    hot has at most as many rows as may be broadcast."""
    h = F.broadcast(hot.select(key))
    warm = rows.join(h, key, "left_semi").join(F.broadcast(small.join(h, key, "left_semi")), key, how)
    return warm.unionByName(rows.join(h, key, "left_anti").join(small, key, how))


def hot_from(n: int, least: int = 1000, most: int = 100_000) -> int:
    """Keys with more of n rows than that are hot; there are at most `most` of them."""
    return max(least, n // most)
