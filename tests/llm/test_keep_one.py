"""One row of each group stays, where a group is large enough to be joined apart."""

from pyspark.sql import functions as F

from lakespan.llm import minhash


def test_large_group(spark):
    copies = spark.range(100, 1400).select(F.col("id").alias("doc_id"), F.lit("the same seven words in every row").alias("text"))
    pair = spark.range(2000, 2002).select(F.col("id").alias("doc_id"), F.lit("another text of eight words that repeats once").alias("text"))
    alone = spark.range(20).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.concat(F.lit(w), F.col("id").cast("string")) for w in "abcdefgh")).alias("text"))
    kept = minhash.keep_one(copies.unionByName(pair).unionByName(alone).repartition(5)).collect()
    assert sorted(r.doc_id for r in kept) == [*range(20), 100, 2000]
