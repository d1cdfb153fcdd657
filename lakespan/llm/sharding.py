"""Sharding by balanced label propagation, with DataFrame operations only.

Documents of equal texts are linked. Groups too large for one shard are broken into parts of half a shard
first, so no part outgrows a shard; smaller groups are one part. Rows of groups and parts that may fill a task are met
by broadcasting what is joined to them, whose number of rows is bounded; the others are shuffled. Labels start at a hash; then, round after round, a join tells every linked
document which shard most of its neighbours are in, and whole parts move there as far as the shard's quota
goes: parts are admitted by buckets of a hash, whose sizes are summed per shard. Parts that found no room try
their next best shard in the next round. A last step evens the shards out exactly: linked documents come
first in each shard, so those that leave an overfull one are unlinked as long as there are any.

The law is `rows`: counts of shards are at most one apart. Ranks come in two steps, within buckets and over
the bounded table of bucket sizes, so no window spans a shard.

Defined cases: a null text has no bytes, the checksum of an empty text, and is linked with empty texts; rows
that repeat a doc_id are placed each; a null doc_id is placed like any other; with fewer rows than shards
some shards stay empty; equal sizes and counts are told apart by hashes, so ties are settled alike in each run; texts
of any length only give their size, checksum and digest; other columns are left out; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakespan.llm.scratch import Scratch
from lakespan.llm.skew import hot_from, join_hot

SHARDS, ROUNDS = 8, 4
#: A shard's rows over the rows of a part, where a group has more than a shard.
PARTS = 2
#: A group of more rows isn't shuffled; from 100,000 times that many rows on, the number rises with the table.
LARGE = 500
#: Buckets of admission; their sizes per shard are a table of at most SHARDS x BUCKETS rows.
BUCKETS = 1024
#: Rows of a bucket of ranks, and most such buckets for each shard.
RANK_ROWS, RANK_BUCKETS = 50_000, 65_536


def base(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, size, text_crc32, g) of docs (doc_id, text): g stands for the text."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    size = F.octet_length(raw).cast("long") + 1
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), size.alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(F.md5(raw), size).alias("g"))


def propagate(linked: DataFrame, s: Scratch, quota: int, shards: int, rounds: int) -> DataFrame:
    """(uid, shard) of linked (uid, part, large): labels after some rounds of propagation. large marks the rows of parts
    of more rows than a task should take."""
    now = s.cut(linked.select("uid", "part", "large", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard")), "labels-0")
    for i in range(1, rounds + 1):
        counts = now.groupBy("part", "shard").agg(F.count("*").alias("c"))
        # The neighbours' shard: of all members of a part, the most frequent; from the second round on, a part
        # that is still split over shards may have met a full one, so chance has a say as well.
        lean = F.col("c") + F.when(F.lit(i > 1), F.pmod(F.xxhash64("part", "shard", F.lit(i)), F.lit(97)) / 97.0 * F.col("all") * 0.5).otherwise(F.lit(0.0))
        whole = counts.groupBy("part").agg(F.sum("c").alias("all"), F.max("c").alias("most"))  # a part has a row for each shard here
        best = counts.join(whole, "part").withColumn("lean", lean).groupBy("part").agg(F.max(F.struct("lean", F.xxhash64("part", "shard"), "shard"))["shard"].alias("to"), F.max("all").alias("all"), F.max("most").alias("most"))
        # Room in each shard: its quota less the parts that are whole and stay.
        settled = best.where("most = all").groupBy("to").agg(F.sum("all").alias("held"))
        asks = best.where("most < all").withColumn("bucket", F.pmod(F.xxhash64("part", F.lit(i)), F.lit(BUCKETS)).cast("int"))
        sums = asks.groupBy("to", "bucket").agg(F.sum("all").alias("rows"))
        run = Window.partitionBy("to").orderBy("bucket")
        open_ = sums.withColumn("upto", F.sum("rows").over(run)).join(settled, "to", "left").where(F.col("upto") + F.coalesce("held", F.lit(0)) <= quota).select("to", "bucket")
        moves = s.cut(asks.join(F.broadcast(open_), ["to", "bucket"]).select("part", "to"), f"moves-{i}")
        theirs = now.where("large").select("part").distinct()
        few = now.where("large").join(F.broadcast(moves.join(F.broadcast(theirs), "part", "left_semi")), "part", "left")
        many = now.where("not large").join(moves, "part", "left")
        now = s.cut(few.unionByName(many).select("uid", "part", "large", F.coalesce("to", "shard").alias("shard")), f"labels-{i}")
        s.drop(f"labels-{i - 1}")
        if now.groupBy("part").agg(F.min("shard").alias("a"), F.max("shard").alias("b")).where("a <> b").isEmpty():
            break
    return now


def level(rows: DataFrame, s: Scratch, n: int, shards: int) -> DataFrame:
    """rows (uid, shard, rank_key) with shard changed as needed and slot: counts at most one apart, slots gapless.

    rank_key 0 rows stay first, 1 rows leave first."""
    buckets = int(min(RANK_BUCKETS, max(16, n // shards // RANK_ROWS)))
    rows = s.cut(rows.withColumn("bucket", F.pmod(F.xxhash64("uid", F.lit(5)), F.lit(buckets)).cast("int")), "ranked")
    sizes = rows.groupBy("shard", "rank_key", "bucket").agg(F.count("*").alias("c"))
    # At most shards x 2 x RANK_BUCKETS rows, whatever the input.
    run = Window.partitionBy("shard").orderBy("rank_key", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("c").over(run), F.lit(0))).drop("c")
    own = Window.partitionBy("shard", "rank_key", "bucket").orderBy("uid")
    rows = rows.join(before, ["shard", "rank_key", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(own) - 1)
    # shards numbers reach the driver: how many rows each shard has, and so how many leave or come.
    have = {r["shard"]: r["c"] for r in sizes.groupBy("shard").agg(F.sum("c").alias("c")).collect()}
    order = sorted(range(shards), key=lambda k: (-have.get(k, 0), k))
    target = {k: n // shards + (i < n % shards) for i, k in enumerate(order)}
    leave = {k: max(0, have.get(k, 0) - target[k]) for k in range(shards)}
    out, first_leaving, at = [], {}, 0
    for k in range(shards):
        first_leaving[k], at = at, at + leave[k]
    at = 0
    for k in range(shards):
        room = max(0, target[k] - have.get(k, 0))
        out.append((k, at, at + room, have.get(k, 0)))
        at += room

    def choose(pairs, key, other):
        c = F.lit(other)
        for k, v in pairs:
            c = F.when(key == k, F.lit(v)).otherwise(c)
        return c

    goal = choose(target.items(), F.col("shard"), 0)
    number = choose(first_leaving.items(), F.col("shard"), 0) + F.col("rank") - goal
    rows = rows.withColumn("leaving", F.when(F.col("rank") >= goal, number))
    to, slot = F.col("shard"), F.col("rank")
    for k, a, b, c in out:
        into = (F.col("leaving") >= a) & (F.col("leaving") < b)
        to, slot = F.when(into, F.lit(k)).otherwise(to), F.when(into, F.col("leaving") - a + c).otherwise(slot)
    return rows.select("uid", to.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of docs (doc_id, text)."""
    s = Scratch(docs.sparkSession, "sharding")
    rows = s.cut(base(docs), "base")
    n = rows.count()
    quota, large = -(-n // shards), hot_from(n, LARGE)
    groups = s.cut(rows.groupBy("g").agg(F.count("*").alias("c")).where("c > 1"), "groups")
    parts = F.when(F.col("c") <= quota, F.lit(1)).otherwise(F.ceil(F.col("c") * PARTS / F.lit(quota)))
    met = join_hot(rows.select("uid", "g"), groups, "g", groups.where(F.col("c") > large))
    linked = met.select("uid", F.xxhash64("g", F.pmod(F.xxhash64("uid", F.lit(1)), parts)).alias("part"), (F.col("c") > large).alias("large"))
    labels = propagate(s.cut(linked, "linked"), s, quota, shards, rounds)
    all_ = rows.select("uid").join(labels.select("uid", F.col("shard").alias("own")), "uid", "left")
    placed = all_.select("uid", F.coalesce("own", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")).alias("shard"), F.when(F.col("own").isNull(), 1).otherwise(0).alias("rank_key"))
    even = level(placed, s, n, shards)
    return s.last(rows.join(even, "uid").select("doc_id", "size", "text_crc32", "shard", "slot"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
