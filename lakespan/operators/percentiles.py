"""Exact percentiles of few large groups, without a group's values in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values so far from a percentile, as shares of the rows, are only counted; the approximation errs by a fourth of that.
NEAR, ACCURACY = 0.002, 2000


def percentiles(df: DataFrame, key: str, value: str, at: dict[str, float], *stats) -> DataFrame:
    """(key, names of at, stats): the interpolated percentiles of value for each of a few keys, a row for null too.

    Approximate percentiles only part the values into bins. Exact counts tell the bins that hold the wanted ranks, whatever
    the approximation's error, and only their distinct values are shuffled and ranked."""
    marks = sorted({min(max(p + d, 0.0), 1.0) for p in at.values() for d in (-NEAR, NEAR)})
    d = df.withColumnsRenamed({key: "__key", value: "__value"})
    own = df.groupBy(key).agg(F.count(value).alias("__n"), F.percentile_approx(value, marks, ACCURACY).alias("__marks"), *stats).withColumnRenamed(key, "__own")
    bin_ = reduce(lambda x, y: x + y, ((F.col("__value") > F.col("__marks")[i]).cast("int") for i in range(len(marks))))
    # A row for each key: few by contract.
    rows = d.select("__key", "__value").where("__value is not null").join(F.broadcast(own.select("__own", "__n", "__marks")), F.col("__key").eqNullSafe(F.col("__own")))
    rows = rows.select("__key", "__value", "__n", bin_.alias("__bin"))

    place = {name: (F.col("__n") - 1) * F.lit(p) for name, p in at.items()}
    ordered = Window.partitionBy("__key").orderBy("__bin")
    bins = rows.groupBy("__key", "__n", "__bin").agg(F.count("*").alias("__c")).withColumn("__upto", F.sum("__c").over(ordered))
    bins = bins.withColumn("__before", F.col("__upto") - F.col("__c"))
    holds = reduce(lambda x, y: x | y, ((F.col("__before") <= F.ceil(x)) & (F.col("__upto") > F.floor(x)) for x in place.values()))
    wanted = bins.where(holds).select(F.col("__key").alias("__k"), F.col("__bin").alias("__b"), "__before")
    near = rows.join(F.broadcast(wanted), F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__bin") == F.col("__b")))
    ranked = near.groupBy("__key", "__n", "__bin", "__before", "__value").agg(F.count("*").alias("__c"))
    upto = F.col("__before") + F.sum("__c").over(Window.partitionBy("__key", "__bin").orderBy("__value"))
    ranked = ranked.withColumn("__upto", upto)
    ends = [F.min(F.when(F.col("__upto") > f(x), F.col("__value"))).alias(f"__{end}_{name}") for name, x in place.items() for end, f in (("lo", F.floor), ("hi", F.ceil))]
    found = ranked.groupBy("__key", "__n").agg(*ends)
    between = {
        name: F.when(F.floor(x) == F.ceil(x), F.col(f"__lo_{name}")).otherwise((F.ceil(x) - x) * F.col(f"__lo_{name}") + (x - F.floor(x)) * F.col(f"__hi_{name}"))
        for name, x in place.items()
    }
    found = found.select("__key", *(x.alias(name) for name, x in between.items()))
    out = own.join(F.broadcast(found), F.col("__own").eqNullSafe(F.col("__key")), "left")
    return out.drop("__key", "__n", "__marks").withColumnRenamed("__own", key).select(key, *at, *out.columns[3 : -1 - len(at)])
