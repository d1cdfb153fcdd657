"""Percentiles of large groups: exact, and no group's values in one task."""

import random
import re

from pyspark.sql import functions as F

from lakespan.operators.percentiles import percentiles
from lakespan.plans.registry import QUERIES

AT = {"least": 0.0, "mid": 0.5, "high": 0.9, "most": 1.0}


def test_as_spark_has_them(spark):
    r = random.Random(3)
    rows = [("many", r.random() ** 9) for _ in range(3001)] + [("ties", float(r.choice([1, 1, 1, 2, 7]))) for _ in range(500)]
    rows += [(None, r.random()) for _ in range(10)] + [("one", 5.0), ("none", None), ("two", 1.0), ("two", 2.0), ("odd", float("nan")), ("odd", -0.5), ("odd", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = percentiles(df, "k", "v", AT, F.count("*").alias("rows"))
    want = df.groupBy("k").agg(*(F.percentile("v", p).alias(n) for n, p in AT.items()), F.count("*").alias("rows"))
    by = lambda x: sorted(map(str, x.collect()))
    assert got.columns == want.columns and by(got) == by(want)


def test_no_group_in_one_task(spark):
    plan = QUERIES["agg_percentiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\bpercentile\(", plan)
