"""Joins by nearness: as-of and range joins. They aren't the reference's; they extend it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: str, at: str, width: float, values: list[str]) -> DataFrame:
    """left, and values of the last row of right with the same by and the same or a lower at (null without one).

    Both sides have the columns by and at, at being a number. Rows meet within stretches of width, so a key with
    very many rows is spread over as many tasks; what a stretch starts with is found over one row for each
    stretch. Of right rows that tie, that with the greatest values counts. Null keys match nothing.
    """
    cell = F.floor(F.col(at) / F.lit(width)).alias("__cell")
    r = right.where(F.col(by).isNotNull()).select(F.col(by).alias("__by"), F.col(at).alias("__at"), cell, F.struct(*values).alias("__v"))
    last = r.groupBy("__by", "__cell").agg(F.max(F.struct("__at", "__v"))["__v"].alias("__v"))
    numbered = left.select("*", cell)
    # The value that a stretch starts with: the last of those before it, among the stretches of either side.
    cells = last.unionByName(numbered.select(F.col(by).alias("__by"), "__cell").distinct(), allowMissingColumns=True).groupBy("__by", "__cell").agg(F.max("__v").alias("__v"))
    before = Window.partitionBy("__by").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    start = cells.select("__by", "__cell", F.last("__v", ignorenulls=True).over(before).alias("__start"))
    rows = numbered.select(F.col(by).alias("__by"), F.col(at).alias("__at"), "__cell", F.struct(*left.columns).alias("__l")).unionByName(r, allowMissingColumns=True)
    upto = Window.partitionBy("__by", "__cell").orderBy("__at", F.col("__l").isNotNull(), "__v").rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("__own", F.last("__v", ignorenulls=True).over(upto)).where("__l is not null")
    found = own.join(start, ["__by", "__cell"], "left").withColumn("__found", F.coalesce("__own", "__start"))
    return found.select("__l.*", *(F.col(f"__found.{v}").alias(v) for v in values))


def range_join(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, width: float) -> DataFrame:
    """Rows of points and ranges with low <= at <= high, by an equi-join of cells of width.

    A range is in as many cells as it spans, so width should be about the size of a range.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(width))
    spread = ranges.where(F.col(low) <= F.col(high)).withColumn("__cell", F.explode(F.sequence(cell(low), cell(high))))
    return points.withColumn("__cell", cell(at)).join(spread, "__cell").where(F.col(at).between(F.col(low), F.col(high))).drop("__cell")


def micros(c: str) -> Column:
    """A timestamp without zone as a number of microseconds."""
    return F.unix_micros(F.col(c).cast("timestamp"))
