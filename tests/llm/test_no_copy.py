"""The pipeline's stages leave no copy of the documents in the shared folder."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from lakespan.llm import decontam, minhash
from lakespan.llm.scratch import Scratch


def left(since: int) -> int:
    return sum(p.stat().st_size for s in Scratch.made[since:] for p in Path(s.base.removeprefix("file:")).rglob("*.parquet"))


def test_stages_keep_no_copy(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, " ".join(f"{r.getrandbits(60):x}" for _ in range(1000)), f"l{i % 3}") for i in range(100)]
    rows += [(7, rows[7][1], "again"), (500, rows[8][1], "copy"), (9, "", "one"), (9, "", "two"), (None, None, "none"), (None, None, "none")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    size = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    before = len(Scratch.made)
    kept = minhash.keep_one(docs)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert [x[:2] for x in got] == sorted([*((False, i) for i in range(100)), (False, 9), (False, 9), (True, 0), (True, 0)])
    assert left(before) < size / 4
    before = len(Scratch.made)
    items = spark.createDataFrame([(1, rows[3][1][:400])], "item_id long, text string")
    clean = decontam.keep_clean(docs, items)
    assert clean.where(F.col("doc_id") == 3).isEmpty() and clean.count() == len(rows) - 1
    assert left(before) < size / 4
